"""Property tests (hypothesis): codec round trip, name normalisation, normalised range."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from smoglake.operators.reshape import min_max_normalize
from smoglake.session import scale_conf
from smoglake.sources.delimited import normalize_name
from smoglake.sources.json_codec import decode_json, encode_json, raw_schema

finite = st.floats(allow_nan=False, allow_infinity=False, width=64)
text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)
row = st.tuples(st.one_of(st.none(), text), st.one_of(st.none(), text),
                *[st.one_of(st.none(), finite)] * 13)


@given(st.text(max_size=30))
def test_normalize_name_is_idempotent_and_alnum(name):
    n = normalize_name(name)
    assert normalize_name(n) == n and all(c.isascii() and c.isalnum() for c in n)


@settings(max_examples=15, deadline=None)
@given(st.lists(row, min_size=1, max_size=20))
def test_json_decode_of_encode_is_identity(spark, rows):
    df = spark.createDataFrame(rows, raw_schema())
    back = decode_json(encode_json(df), raw_schema())
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.floats(-1e6, 1e6)), min_size=1, max_size=30))
def test_normalised_values_stay_in_unit_range(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    for r in min_max_normalize(df, ["g"], "v", "n").collect():
        assert r.n is None or (-1e-12 <= r.n <= 1 + 1e-12)
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    nulls = {r.g for r in min_max_normalize(df, ["g"], "v", "n").collect() if r.n is None}
    assert nulls == {g for g, vs in groups.items() if max(vs) == min(vs)}


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 10**12, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == math.ceil(100 * 10**12 / (256 << 20))
    assert scale_conf(10, cores=8)["spark.sql.shuffle.partitions"] == "8"
