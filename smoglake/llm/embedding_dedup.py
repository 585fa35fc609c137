"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Equal vectors are merged first and keep their count. Spherical k-means on a
bounded sample gives cell centres, whose number grows with the square root of the
rows; every distinct vector belongs to the cell of its nearest centre. Two linked vectors
of different cells meet in one of the two: which one depends on the cells alone, and the
other vector visits it if a vector linked to it may be at home there. At cosine s a linked vector is s times the
vector plus sqrt(1 - s * s) times a direction across it, and the plane between two
centres must lie within ``SIGMAS`` standard deviations of that direction's lean towards
it. The deviation is measured along the line between the two centres on the sample: that
of the sample's own spread, or of the differences between linked vectors in it if these lean more. The
sure bound, a lean of 1, is taken where it is smaller, as in data of few effective dimensions.

Inside a cell, home vectors are held against home vectors and visitors, in blocks of rows. Vectors travel
with their visits and once more per block of the other side; large cells are dealt out
to several tasks by block pair. A block product keeps counts for both ends and one
spanning forest of its links, never its pairs.

Cosines are computed in double precision. Defined results: a vector that is
null, zero, or holds null or non-finite components links with nothing;
vectors of different lengths never link; rows that repeat a vec_id count as
vectors of their own, each with its own links and class, a class being named by its
smallest vec_id; a row without an id links with
nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, INT, field, map_columns, staged
from .components import components

SIMILARITY = 0.95
SIGMAS = 4.5
CELLS_PER_ROOT = 0.5  # cells for each square root of the number of vectors
SAMPLE_PER_CELL = 8  # vectors that the centres are fitted on, 4,000 at least ...
SAMPLE_BYTES = 16 << 20  # ... and at most so many bytes of them
BLOCK = 2_000  # rows per block


def unit(values: list[float] | None) -> np.ndarray | None:
    """The vector at unit length in double precision; none if it can link with nothing."""
    if not values or any(v is None for v in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if not top:
        return None
    v = v / top  # no overflow or underflow in the squares
    return v / np.sqrt(v @ v)


def centres(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from farthest-first starts; deterministic."""
    picked = [0]
    best = rows @ rows[0]
    for _ in range(1, min(k, len(rows))):
        picked.append(int(best.argmin()))
        best = np.maximum(best, rows @ rows[picked[-1]])
    out = rows[picked].copy()
    for _ in range(rounds):
        cell = (rows @ out.T).argmax(1)
        sums = np.zeros_like(out)
        np.add.at(sums, cell, rows)
        length = np.sqrt((sums ** 2).sum(1))
        out = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], out)
    return out


def lean(sample: np.ndarray, middle: np.ndarray, similarity: float) -> np.ndarray:
    """Cells x cells: standard deviation, along the line between two centres, of the direction (of unit length) in
    which linked vectors differ; the larger of two estimates from the sample."""
    spread = [np.cov(sample.T, bias=True)] if len(sample) > 1 else []
    few = sample[:2_000]
    x, y = np.nonzero(np.triu(few @ few.T >= similarity, 1))
    if len(x) >= 20:
        gaps = few[x[:20_000]] - few[y[:20_000]]
        gaps /= np.maximum(np.sqrt((gaps ** 2).sum(1)), 1e-12)[:, None]
        spread.append(gaps.T @ gaps / len(gaps))
    out = np.full((len(middle), len(middle)), 0.0 if spread else 1.0)
    for c in spread:
        c = np.atleast_2d(c) / max(np.trace(np.atleast_2d(c)), 1e-300)
        for i in range(len(middle)):
            line = middle - middle[i]
            size = np.maximum((line ** 2).sum(1), 1e-300)
            out[i] = np.maximum(out[i], np.sqrt(np.maximum(((line @ c) * line).sum(1), 0) / size))
    return out


def visits(v: np.ndarray, middle: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home cell per row, rows x cells: whether the row is at home there or visits).

    ``reach`` is how much nearer its home's centre than another a vector may be and still have a linked vector
    at home with the other. Of two cells the one that is visited by the other's vectors is fixed.
    """
    near = v @ middle.T
    home = near.argmax(1)
    lead = near[np.arange(len(v)), home][:, None] - near
    cell = np.arange(len(middle))
    may = (lead <= reach[home]) & (((home[:, None] + cell) % 2 == 0) == (home[:, None] > cell))
    may[np.arange(len(v)), home] = True
    return home, may


def forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a spanning forest of the given links."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    similarity: float = SIMILARITY) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    spark = vectors.sparkSession

    def pack(values):
        made = [unit(v) for v in values]
        return [[None if v is None else (v + 0.0).tobytes() for v in made]]

    rows = staged(map_columns(vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")),
                              ["v"], [field("unit", BINARY)], pack, ["id"]), "vector-units")
    distinct = staged(rows.filter("unit IS NOT NULL AND id IS NOT NULL").groupBy("unit").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
                      .withColumns({"dim": (F.length("unit") / 8).cast("int"), "node": F.monotonically_increasing_id()}), "vector-distinct")
    # the centres: per dimension, on a bounded sample of the distinct vectors
    total, longest = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max("dim"), F.lit(1))).first()
    most = max(1, SAMPLE_BYTES // (8 * longest))
    cells = max(1, min(int(CELLS_PER_ROOT * total ** 0.5), most // SAMPLE_PER_CELL))
    size = min(most, max(4_000, SAMPLE_PER_CELL * cells))
    cut = int(min(1.0, size / max(1, total)) * (1 << 30))
    picked = distinct.filter(F.pmod(F.xxhash64("unit"), F.lit(1 << 30)) <= cut).orderBy(F.xxhash64("unit")).limit(2 * size)
    by_dim: dict[int, list[np.ndarray]] = {}
    for r in picked.select("unit").collect():
        v = np.frombuffer(bytes(r["unit"]), np.float64)
        by_dim.setdefault(len(v), []).append(v)
    fitted = {}
    for d, sample in by_dim.items():
        sample = np.stack(sample)
        middle = centres(sample, cells)
        apart = np.sqrt(np.maximum(2 - 2 * middle @ middle.T, 0))  # centres have unit length
        fitted[d] = middle, np.sqrt(1 - similarity ** 2) / similarity * np.minimum(1.0, SIGMAS * lean(sample, middle, similarity)) * apart + 1e-9

    def place(units):
        out: list = [None] * len(units)
        sizes: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            sizes.setdefault(len(u) // 8, []).append(i)
        for d, at in sizes.items():
            if d not in fitted:
                for i in at:
                    out[i] = [{"cell": 0, "home": True}]
                continue
            home, may = visits(np.stack([np.frombuffer(units[i], np.float64) for i in at]), *fitted[d])
            for row, i in enumerate(at):
                out[i] = [{"cell": int(c), "home": bool(c == home[row])} for c in np.flatnonzero(may[row])]
        return [out]

    spot = T.ArrayType(T.StructType([field("cell", INT), field("home", T.BooleanType())]))
    placed = staged(map_columns(distinct, ["unit"], [field("spots", spot)], place, ["node", "n", "unit", "dim"]), "vector-cells")

    # home rows and all rows of each cell are dealt to blocks by hash; a home block and a block of all is one task group
    spots = placed.select("dim", F.explode("spots").alias("s")).select("dim", "s.*")
    sizes = staged(spots.groupBy("dim", "cell").agg(
        F.ceil(F.count_if("home") / BLOCK).cast("int").alias("left_blocks"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("right_blocks")).filter("left_blocks > 0"), "vector-blocks")
    sized = placed.select("node", "n", "unit", "dim", F.explode("spots").alias("s")).select("node", "n", "unit", "dim", "s.*").join(
        F.broadcast(sizes), ["dim", "cell"])  # a row per cell: bounded with the sample

    def dealt(blocks):
        return F.pmod(F.xxhash64("unit", F.lit(3)), F.col(blocks)).cast("int")

    as_left = sized.filter("home").select("dim", "cell", dealt("left_blocks").alias("x"), F.explode(
        F.sequence(F.lit(0), F.col("right_blocks") - 1)).alias("y"), "node", "n", "unit", "home", F.lit(True).alias("left"))
    as_right = sized.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)).alias("x"),
                            dealt("right_blocks").alias("y"), "node", "n", "unit", "home", F.lit(False).alias("left"))
    met = as_left.unionByName(as_right)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        side = frame["left"].to_numpy()
        one, two = frame[side], frame[~side]
        if not len(one) or not len(two):
            return pd.DataFrame({"node": [], "linked": [], "other": []}).astype("int64")
        a = np.stack([np.frombuffer(u, np.float64) for u in one["unit"]])
        b = np.stack([np.frombuffer(u, np.float64) for u in two["unit"]])
        ids, others = one["node"].to_numpy(np.int64), two["node"].to_numpy(np.int64)
        n_one, n_two = one["n"].to_numpy(np.int64), two["n"].to_numpy(np.int64)
        guests = ~two["home"].to_numpy(bool)  # what is at home meets its partners as a left row too
        mine = {x: i for i, x in enumerate(ids.tolist())}
        counts, back, pairs = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), []
        for at in range(0, len(a), 512):
            hit = a[at:at + 512] @ b.T >= similarity
            hit &= ids[at:at + 512, None] != others[None, :]
            counts[at:at + 512] = hit @ n_two
            back += n_one[at:at + 512] @ hit
            x, y = np.nonzero(hit)
            pairs.append(np.stack([x + at, y], 1))
        back[~guests] = 0
        places = np.array([mine.get(o, len(ids) + j) for j, o in enumerate(others.tolist())], np.int64)
        joined = np.concatenate(pairs)
        kept = forest(len(ids) + len(others), np.stack([joined[:, 0], places[joined[:, 1]]], 1))
        names = np.concatenate([ids, others])
        edges = [(int(names[x]), int(names[y])) for x, y in kept]
        all_counts = np.concatenate([counts, back])
        has = all_counts > 0
        return pd.DataFrame({"node": names[has].tolist() + [x for x, _ in edges],
                             "linked": all_counts[has].tolist() + [0] * len(edges),
                             "other": [None] * int(has.sum()) + [y for _, y in edges]}).astype({"other": "Int64"})

    found = staged(met.groupBy("dim", "cell", "x", "y").applyInPandas(compare, "node long, linked long, other long"), "vector-links")
    edges = found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    named = components(edges, "vector-classes").withColumnRenamed("component", "class")
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    per_vector = staged(distinct.select("unit", "id", "n", "node").join(linked, "node", "left").join(named, "node", "left").select(
        "unit", "id", F.coalesce("class", "node").alias("class"), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links")),
        "vector-result")
    least = per_vector.groupBy("class").agg(F.min("id").alias("component_id"))
    per_vector = per_vector.join(least, "class").select("unit", "n_links", "component_id")
    out = rows.withColumn("unit", F.when(F.col("id").isNotNull(), F.col("unit"))).join(per_vector, "unit", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and class of every vector."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id
"""
