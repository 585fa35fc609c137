import math
import random
from fractions import Fraction

import pytest

from smoglake.functions import numbers as N
from smoglake.operators.cleaning import column_means, impute_mean


def _mean(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return column_means(df, ["v"], prefix="m_").first().m_v


def test_any_order_and_partitioning_gives_the_same_bits(spark):
    pick = random.Random(5)
    values = [pick.choice([-1, 1]) * pick.random() * 10.0 ** pick.randint(-12, 14) for _ in range(3000)]
    got = {_mean(spark, pick.sample(values, len(values)), parts) for parts in (1, 4, 13)}
    want = float(sum(map(Fraction, values)) / len(values))
    assert len(got) == 1 and math.isclose(got.pop(), want, rel_tol=4e-16)


@pytest.mark.parametrize("values", [[1e12, 1e-8, -1e12], [1e300, 1.0, -1e300, 2.0], [5e-324, 5e-324, -1e-310, 2.0 ** -1060],
                                    [1.7e308, -1.7e308, 3.0], [2.0 ** 32 - 2.0 ** -20, 2.0 ** 32, 2.0 ** -32, 4294967295.999],
                                    [0.0, -0.0], [0.1] * 10, [-1e-9, -3.5, -2.0 ** 31]])
def test_hard_cases_against_exact_arithmetic(spark, values):
    want = float(sum(map(Fraction, values))) / len(values)
    assert math.isclose(_mean(spark, values), want, rel_tol=4e-16, abs_tol=0.0)


def test_missing_and_infinite_values(spark):
    nan, inf = float("nan"), float("inf")
    assert _mean(spark, [nan, 2.0, None, 4.0]) == 3.0 and _mean(spark, [nan, None]) == 0.0
    assert _mean(spark, [inf, 1.0]) == inf and _mean(spark, [-inf, 1e300]) == -inf and math.isnan(_mean(spark, [inf, -inf]))
    df = spark.createDataFrame([(1.0, None), (None, nan), (4.0, 7.25)], "a double, b double")
    assert sorted(map(tuple, impute_mean(df, ["a", "b"]).collect())) == [(1.0, 7.25), (2.5, 7.25), (4.0, 7.25)]


def test_parts_of_a_sum_add_up(spark):
    pick = random.Random(6)
    rows = [(pick.choice("ab"), pick.uniform(-1, 1) * 10.0 ** pick.randint(-5, 9)) for _ in range(500)] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    whole = N.means(N.binned_sums(df, ["k"], "v"), ["k"], "m")
    parts = N.binned_sums(df.limit(0), ["k"], "v")
    for part in df.randomSplit([0.5, 0.3, 0.2], seed=1):
        parts = N.combined(parts.unionByName(N.binned_sums(part, ["k"], "v")), ["k"])
    assert sorted(map(tuple, N.means(parts, ["k"], "m").collect())) == sorted(map(tuple, whole.collect()))
    assert dict(map(tuple, whole.collect()))["c"] is None
