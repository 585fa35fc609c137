"""Mixing sources to target weights with hash-threshold histograms.

Each document has a fixed 60-bit hash of its id. A source's mix takes every
document ``floor(target / size)`` times, and once more those whose hash lies
below the source's threshold. The threshold is found without sorting: tokens
are summed by source and hash bucket, the bucket in which the running sum
crosses the budget is found, and only that bucket is counted again on a
finer grid, until it holds a single hash. Thresholds of growing budgets are
nested: a larger mix contains every smaller one.

Defined results: a null text has size 0; null sources are one source, last
in order; rows with one id are taken or left together; an empty table gives
an empty table; a corpus without words has targets 0. Reruns agree, because
all sums are exact integers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, load_documents, ranked, small_side, staged

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
HASH_BITS, LEVEL_BITS = 60, 12
BROADCAST_SOURCES = 50_000  # sources (about 100 bytes each) that may be broadcast


def document_hash(id_col: str) -> Column:
    """60 bits of the MD5 of the id as text (a null id counts as the empty text)."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_key(source_col: str) -> Column:
    """Never null; "0" + the source, and "1" for a null source, so that it sorts last."""
    source = F.col(f"`{source_col}`").cast("string")
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                   budgets: Sequence[float] = (1.0,)) -> DataFrame:
    """(source, source_size, budget, target) from rows of (source, size).

    The sources, in code point order, share ``budget`` times all sizes by
    the repeating weights; a target stops at ``max_repeats`` times its source's size
    and the excess is shared again by weight until no target is above. Each
    round reads two sums of the source table; the level only rises, so the
    rounds end when no further source is capped.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = ranked(by_source, ["source"], "rank", "mix-sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = staged(table.select("source", "source_size",
                                F.element_at(cycle, (F.col("rank") % len(weights)).cast("int") + 1).alias("weight")),
                   "mix-weights")
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    out = None
    for number, share in enumerate(budgets):
        goal = float(total or 0) if share == 1.0 else (total or 0) * share
        level, capped = (goal / weight if weight else 0.0), 0
        while True:
            over = F.col("source_size") * max_repeats < F.col("weight") * F.lit(level)
            held, free, count = table.agg(
                F.sum(F.when(over, F.col("source_size") * max_repeats)), F.sum(F.when(~over, F.col("weight"))),
                F.count(F.when(over, 1))).first()
            if not free or count == capped:
                break
            level, capped = (goal - (held or 0)) / free, count
        target = F.least(F.col("source_size").cast("double") * max_repeats, F.col("weight") * F.lit(level))
        part = table.select("source", "source_size", F.lit(number).alias("budget"), target.alias("target"))
        out = part if out is None else out.unionByName(part)
    return out


def thresholds(hashed: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` plus ``full`` (times that all documents are taken) and ``threshold``.

    ``hashed`` has (source, size, hash). Per level one histogram of at most
    sources x 2^12 rows, summed before the shuffle.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("full", whole).withColumn(
        "left", F.col("target") - F.col("full") * F.col("source_size"))
    # prefix: the boundary bucket so far; left: the part of the budget that falls into it
    state = staged(state.withColumns({"prefix": F.lit(0).cast("long"),
                                      "threshold": F.when(F.col("left") <= 0, F.lit(0)).cast("long")}), "mix-state")
    done = state.filter("threshold IS NOT NULL")
    open_ = state.filter("threshold IS NULL")
    shift = HASH_BITS
    while shift and not open_.isEmpty():
        above, shift = shift, shift - LEVEL_BITS
        bounds = open_.select("source", "prefix").distinct()
        inside = hashed.withColumn("prefix", F.shiftright("hash", above)).join(
            small_side(bounds, BROADCAST_SOURCES), ["source", "prefix"])
        hist = inside.groupBy("source", "prefix", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("tokens"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        upto = Window.partitionBy("source", "prefix").orderBy("bucket")
        running = hist.withColumn("upto", F.sum("tokens").over(upto))
        crossing = (open_.drop("threshold").join(running, ["source", "prefix"])
                    .filter(F.col("upto") >= F.col("left"))
                    .groupBy("source", "source_size", "budget", "target", "full")
                    .agg(F.min(F.struct("bucket", "upto", "tokens", "low", "high", "left")).alias("b")))
        before = F.col("b.left") - (F.col("b.upto") - F.col("b.tokens"))
        single = F.col("b.low") == F.col("b.high")
        edge = F.when(before * 2 >= F.col("b.tokens"), F.col("b.high") + 1).otherwise(F.col("b.low"))
        state = staged(crossing.select("source", "source_size", "budget", "target", "full", before.alias("left"),
                                       F.col("b.bucket").alias("prefix"), F.when(single, edge).alias("threshold")),
                       "mix-state")
        done = done.unionByName(state.filter("threshold IS NOT NULL"))
        open_ = state.filter("threshold IS NULL")
    return done.drop("left", "prefix")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        carry: Sequence[str] | None = None) -> tuple[DataFrame, str]:
    """``carry`` columns plus the mix columns, and the prefix these have.

    Added: size, source_size, target, times (how often the mix takes the
    row) and taken (size x times). The rows with their sizes and hashes are
    written once; the histograms scan three narrow columns of that.
    """
    carry = list(docs.columns if carry is None else carry)
    p = "m_"
    while any(c.startswith(p) for c in docs.columns):
        p += "_"
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = staged(docs.select(*[f"`{c}`" for c in carry], size.alias(p + "size"), document_hash(id_col).alias(p + "hash"),
                              source_key(source_col).alias(p + "source")), "mix-sizes")
    narrow = rows.select(F.col(p + "source").alias("source"), F.col(p + "size").alias("size"),
                         F.col(p + "hash").alias("hash"))
    targets = staged(source_targets(narrow), "mix-targets")
    found = staged(thresholds(narrow, targets), "mix-thresholds")
    chosen = small_side(found.select(F.col("source").alias(p + "source"), F.col("source_size").alias(p + "source_size"),
                                     F.col("target").alias(p + "target"), F.col("full").alias(p + "full"),
                                     F.col("threshold").alias(p + "threshold")), BROADCAST_SOURCES)
    times = F.least(F.col(p + "full") + (F.col(p + "hash") < F.col(p + "threshold")).cast("long"), F.lit(MAX_REPEATS))
    out = rows.join(chosen, p + "source").withColumn(p + "times", times.cast("long"))
    return out.withColumn(p + "taken", F.col(p + "times") * F.col(p + "size")), p


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it (0 to 3 times)."""
    rows, p = mix(docs, id_col, text_col, source_col)
    repeated = rows.filter(F.col(p + "times") > 0).withColumn(
        p + "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(p + "times"))))
    return repeated.select(*[f"`{c}`" for c in docs.columns])


def op3_source_mix(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    rows, p = mix(load_documents(spark, sf_dir), carry=["doc_id"])
    return rows.select("doc_id", *[F.col(p + c).alias(c) for c in ("size", "source_size", "target", "taken")])


OP3_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE
              ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source),
rounds AS (
  SELECT 0 AS k, (SELECT sum(source_size) / sum(weight) FROM s) AS level, CAST(0 AS BIGINT) AS capped,
         CAST(-1 AS BIGINT) AS before
  UNION ALL
  SELECT k + 1, ((SELECT sum(source_size) FROM s) - coalesce(sum(source_size * 3) FILTER (source_size * 3 < weight * level), 0))
                / sum(weight) FILTER (NOT source_size * 3 < weight * level),
         count(*) FILTER (source_size * 3 < weight * level), capped
  FROM rounds, s WHERE capped <> before GROUP BY k, level, capped, before),
t AS (
  SELECT source, source_size, least(source_size * 3, weight * (SELECT level FROM rounds ORDER BY k DESC LIMIT 1)) AS target
  FROM s),
u AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.*, u.source_size, u.target, u.whole, u.target - u.whole * u.source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY hash) AS upto, sum(size) OVER (PARTITION BY d.source, hash) AS unit
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
c AS (
  SELECT *, CASE WHEN rest > 0 AND (upto < rest OR (upto - unit < rest AND (rest - (upto - unit)) * 2 >= unit)) THEN 1 ELSE 0 END AS extra
  FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * least(whole + extra, 3) AS BIGINT) AS taken
FROM c
"""
