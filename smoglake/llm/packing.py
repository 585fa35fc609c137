"""Packing documents into sequences by cutting-stock column generation.

A document is its token ids followed by the end id. Documents of ``capacity``
tokens or more give full sequences from their start; the rest of each is an
item. The items' histogram (fewer than ``capacity`` lengths, whatever the
corpus) goes to the driver, where column generation finds patterns of
lengths and how often to use each (see ``cutting_stock``). Items are ranked
by length across the cluster and a pattern's slots are runs of ranks, so
each item finds its sequence and offset by arithmetic on its own rank. Items
that the rounded patterns leave over are laid end to end and cut at the
sequence borders; the last border stretch is cut into powers of two. So
padding stays only in patterns that lack at most a few tokens.

Defined results: a null text is an empty one and consists of the end id;
every row is a document of its own, also where rows repeat an id; an empty
table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, LONG, field, load_documents, map_columns, ranked, small_batches, staged
from .cutting_stock import whole_patterns
from .tokens import encoder

CAPACITY = 2048
END_ID = 1
BROADCAST_CROSSING = 50_000  # leftovers across borders (three longs each) that may be broadcast

PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, doc_tokens, crcs, ids) per row of ``docs``, written once.

    ``crcs`` has a checksum per full sequence and one of the rest, ``ids``
    the rest's ids (16 bits each if they fit, else 32).
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(texts):
        counts, crcs, rests = [], [], []
        for made in encoder(path).encode([t or "" for t in texts]):
            made += end
            counts.append(len(made) // 4)
            cuts = range(0, len(made), 4 * capacity)
            crcs.append([zlib.crc32(made[a:a + 4 * capacity]) for a in cuts])
            rest = np.frombuffer(made, "<u4", offset=len(made) - len(made) % (4 * capacity))
            small = not rest.size or int(rest.max()) < 1 << 16
            rests.append((b"\x02" if small else b"\x04") + rest.astype("<u2" if small else "<u4").tobytes())
        return [counts, crcs, rests]

    made = map_columns(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), ["text"],
                       [field("doc_tokens", LONG), field("crcs", T.ArrayType(LONG)), field("ids", BINARY)], run, ["doc_id"], tokens=True)
    with small_batches(docs.sparkSession):
        return staged(made.withColumn("row", F.monotonically_increasing_id()), "pack-tokens")


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple], list[tuple], int, int]:
    """Where the items go, by length and rank within the whole order (by length, then row).

    Returns slots (length, first rank, rank after, first sequence, per
    sequence, offset), leftovers (length, first rank, rank after, tokens
    before), the leftovers' tokens and the number of pattern sequences.
    """
    patterns, left = whole_patterns({s: n for s, n in counts.items() if s}, capacity)
    at, total = {}, 0
    for size in sorted(counts):
        at[size], total = total, total + counts[size]
    slots, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for size, each in sorted(pattern.items(), reverse=True):
            slots.append((size, at[size], at[size] + each * times, sequence, each, offset))
            at[size] += each * times
            offset += size * each
        sequence += times
    rest, tokens = [], 0
    for size, n in sorted(left.items()):
        rest.append((size, at[size], at[size] + n, tokens))
        tokens += size * n
    return slots, rest, tokens, sequence


def borders(tokens: int, capacity: int) -> tuple[int, list[tuple[int, int]]]:
    """(full sequences, (begin, end) of the last ones): the remainder as falling powers of two."""
    full, at, out = tokens // capacity, tokens - tokens % capacity, []
    rest = tokens % capacity
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, at + size))
        at, rest = at + size, rest - size
    return full, out


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """One row per piece; see ``PIECES``."""
    spark = docs.sparkSession
    rows = tokenized(docs, path or tokenizer_path(), id_col, text_col, capacity)
    items = rows.select("row", "doc_id", "doc_tokens", (F.col("doc_tokens") % capacity).alias("size"),
                        F.element_at("crcs", -1).alias("crc"))
    counts = {int(r["size"]): int(r["count"]) for r in items.groupBy("size").count().collect()}  # < capacity rows
    slots, rest, tokens, n_pattern = plan(counts, capacity)
    place = (ranked(items.filter("size > 0"), ["size", "row"], "rank0", "pack-ranks")
             .withColumn("rank", F.col("rank0") + F.lit(counts.get(0, 0))).drop("rank0"))

    slot_table = spark.createDataFrame(slots, "size long, low long, high long, sequence long, each long, shift long")
    inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    s = place.join(F.broadcast(slot_table.withColumnRenamed("size", "its")), (F.col("size") == F.col("its")) & inside)
    nth = F.col("rank") - F.col("low")
    whole = s.select("doc_id", (F.col("doc_tokens") - F.col("size")).alias("start"), F.col("size").alias("length"),
                     F.col("crc").alias("ids_crc32"), "doc_tokens",
                     (F.col("sequence") + F.floor(nth / F.col("each")).cast("long")).alias("sequence_id"),
                     (F.col("shift") + (nth % F.col("each")) * F.col("size")).alias("offset"))

    # leftovers: end to end; only rows that cross a border need their ids
    rest_table = spark.createDataFrame(rest, "size long, low long, high long, before long")
    full, last = borders(tokens, capacity)
    laid = (place.join(F.broadcast(rest_table.withColumnRenamed("size", "its")), (F.col("size") == F.col("its")) & inside)
            .withColumn("begin", F.col("before") + (F.col("rank") - F.col("low")) * F.col("size")))
    fits = F.floor(F.col("begin") / capacity) == F.floor((F.col("begin") + F.col("size") - 1) / capacity)
    fits = fits & (F.col("begin") + F.col("size") <= full * capacity)
    uncut = laid.filter(fits).select(
        "doc_id", (F.col("doc_tokens") - F.col("size")).alias("start"), F.col("size").alias("length"),
        F.col("crc").alias("ids_crc32"), "doc_tokens",
        (n_pattern + F.floor(F.col("begin") / capacity)).cast("long").alias("sequence_id"),
        (F.col("begin") % capacity).alias("offset"))

    def cut(sizes, begins, totals, ids):
        out = []
        for size, begin, total, data in zip(sizes, begins, totals, ids, strict=True):
            values = np.frombuffer(data, "<u2" if data[:1] == b"\x02" else "<u4", offset=1).astype("<u4")
            pieces, at = [], begin
            while at < begin + size:
                if at < full * capacity:
                    first, stop, number = at - at % capacity, at - at % capacity + capacity, at // capacity
                else:
                    k = next(i for i, (_, b) in enumerate(last) if at < b)
                    (first, stop), number = last[k], full + k
                stop = min(stop, begin + size)
                pieces.append({"start": total - size + at - begin, "length": stop - at,
                               "ids_crc32": zlib.crc32(values[at - begin:stop - begin].tobytes()),
                               "sequence_id": n_pattern + number, "offset": at - first})
                at = stop
            out.append(pieces)
        return [out]

    shape = T.ArrayType(T.StructType([field(c, LONG) for c in ("start", "length", "ids_crc32", "sequence_id", "offset")]))
    # a border is crossed by one row at most, and the last stretch has fewer rows than ``capacity``
    crossing = laid.filter(~fits).select("row", "size", "begin")
    crossing = F.broadcast(crossing) if full + capacity <= BROADCAST_CROSSING else crossing
    pieces = map_columns(crossing.join(rows.select("row", "doc_id", "doc_tokens", "ids"), "row"),
                         ["size", "begin", "doc_tokens", "ids"], [field("piece", shape)], cut, ["doc_id", "doc_tokens"])
    parts = pieces.select("doc_id", "doc_tokens", F.explode("piece").alias("p")).select(
        "doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset")

    # full sequences, numbered after the others: per file part of the tokens (a few rows) by a running count
    n_others = n_pattern + full + len(last)
    fulls = rows.filter(F.col("doc_tokens") >= capacity).withColumn("n_full", F.floor(F.col("doc_tokens") / capacity).cast("long"))
    widest = fulls.agg(F.max("n_full")).first()[0] or 0
    long_rows = ranked(fulls.select("row", "doc_id", "doc_tokens", "n_full", F.slice("crcs", 1, F.col("n_full").cast("int")).alias("crcs")),
                       ["row"], "nth", "pack-fulls")
    whole_sequences = long_rows.select("doc_id", "doc_tokens", "nth", F.posexplode("crcs").alias("k", "ids_crc32")).select(
        "doc_id", (F.col("k").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), "ids_crc32",
        "doc_tokens", (F.lit(n_others).cast("long") + F.col("nth") * widest + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return (whole.select(*PIECES).unionByName(uncut.select(*PIECES)).unionByName(parts.select(*PIECES))
            .unionByName(whole_sequences.select(*PIECES)))


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of all documents."""
    return pack(load_documents(spark, sf_dir))
