import random

import numpy as np
import pytest

from smoglake.llm import embedding_dedup as ed


def brute(rows, similarity=0.95):
    units = {i: ed.unit(v) for i, v in rows}
    links, parent = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = [i for i, _ in rows]
    for k, a in enumerate(ids):
        for b in ids[:k]:
            u, v = units[a], units[b]
            if u is not None and v is not None and len(u) == len(v) and u @ v >= similarity:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (links[i], root(i), root(i) == i) for i in ids}


def test_against_brute_force_with_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(ed, "CELLS_PER_ROOT", 0.8)
    monkeypatch.setattr(ed, "BLOCK", 60)  # several blocks in a cell
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    rows = [b + rng.normal(size=16) * rng.uniform(0, 0.25) for b in base for _ in range(4)]
    rows += [base[0] * s for s in rng.uniform(0.5, 2, 150)]  # one direction many times
    rows += [base[1]] * 100
    rows += [base[2] + rng.normal(size=16) * 0.12 for _ in range(200)]  # near copies of one vector
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    random.Random(1).shuffle(data)
    out = ed.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out} == brute(sorted(data))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]),
            (8, [1.0, 0.0, 0.0]), (9, [1e300, 0.0]), (10, [1e-300, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS kept", "'y' AS n", "0 AS unit")
    out = {r.vec_id: (r.n_links, r.component_id) for r in ed.near_duplicates(df).collect()}
    assert len(out) == 12 and all(out[i] == (0, i) for i in (0, 1, 2, 3, 4, 5, 8, None))
    assert all(out[i] == (3, 6) for i in (6, 7, 9, 10))
    assert ed.near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_count_as_vectors_of_their_own(spark):
    data = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0])]
    out = ed.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    data = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (2, [1.0, 0.01]), (7, [0.01, 1.0])]
    out = ed.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.component_id) for r in out) == [(2, 2), (5, 2), (5, 5), (7, 5)]


@pytest.mark.parametrize(("dims", "rank"), [(64, 64), (256, 256), (768, 768), (768, 8), (768, 4), (256, 16)])
def test_links_are_found_in_data_of_any_rank(dims, rank):
    """The cells that linked vectors meet in, for planted links: recall 0.99 at least, of pairs (each counts for both ends)."""
    rng = np.random.default_rng(dims + rank)
    basis = np.linalg.qr(rng.normal(size=(dims, rank)))[0].T
    base = rng.normal(size=(4_000, rank)) @ basis
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = rng.normal(size=(4_000, rank)) @ basis
    noise -= (noise * base).sum(1)[:, None] * base
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = rng.uniform(0.9501, 0.97, (4_000, 1))
    other = cosine * base + np.sqrt(1 - cosine ** 2) * noise
    sample = base[:2_000]
    middle = ed.centres(sample, 45)
    apart = np.sqrt(np.maximum(2 - 2 * middle @ middle.T, 0))
    reach = np.sqrt(1 - 0.95 ** 2) / 0.95 * np.minimum(1, ed.SIGMAS * ed.lean(sample, middle, 0.95)) * apart + 1e-9
    (h1, m1), (h2, m2) = ed.visits(base, middle, reach), ed.visits(other, middle, reach)
    i = np.arange(len(base))
    assert (m1[i, h2] | m2[i, h1]).mean() >= 0.99


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '/root/testdata/{sf}/embeddings.parquet'")
    want = sorted(con.sql(ed.OP10_SQL).fetchall())
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.op10_embedding_dedup(spark, f"/root/testdata/{sf}").collect())
    assert got == want
