"""Near-duplicates by Order MinHash, verified by banded alignment.

Each text becomes its sequence of five-word shingles (A-Z lower-cased), once
distinct in order of first place, as links count them, and, where some repeat,
once more with each labelled with its occurrence number. A sketch takes the few
shingles with the least values under one of many hash functions, keeps them
in text order and hashes that tuple: two texts meet if they share the
minima *and* their order, so the chance depends on edit similarity. Short
texts take fewer minima per sketch; the length ranges overlap so far that
two texts of similarity 0.8 always have a kind of sketch of the distinct shingles in common.

Two texts are linked if their sets of shingles have a Jaccard similarity of
``SIMILARITY`` or more and the banded alignment places at least ``IN_ORDER``
of the shared shingles in the same order. The band is the number of shingles
that the two texts do not share, which no in-order match can exceed.
Documents joined by links form a class; its least doc_id stays.

Linking in rounds. Equal texts are one class from the start, so groups of
copies cost one row each. First every text is held against the shortest text
of the buckets it is in, the one it meets most often. Then all texts
that meet in small buckets are compared, unless they are linked already, and
in each larger bucket every member with the shortest, the pivot. The members
of a large bucket that has not become one class are the rest, and among them
links are sought exactly. In one order of all shingles, the rarest first, two
texts of similarity 0.8 have a shingle in common among the first fifth (plus
one) of each, so the rest is dealt by these shingles alone. A few turns hold
the members of such large buckets against a pivot, another one each turn, to
join what belongs together. Then all pairs of different classes
are compared whose lengths, places in the order and bit signatures allow the
similarity; these are bounds, not estimates. So no
link between two texts that met is left out, whatever the bucket's size.
A large bucket is joined in pairs of blocks, so none is gathered in one task
and none is dropped or cut. Where many texts share more than four fifths of
their shingles with many others and still differ, this work grows with their pairs.

Defined results: a text of one to four words is one shingle; a text without
words (null, empty, blank) is linked with nothing; rows with a null id never
stand for a class with other ids; rows that repeat an id and text are copies.
"""

from __future__ import annotations

import functools
import hashlib
from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, BOOL, LONG, field, load_documents, map_columns, staged, words_of
from .components import components
from .shingles import first_occurrences, mixed, occurrence_labelled, shingle_codes, word_codes

SHINGLE = 5
SIMILARITY = 0.8
IN_ORDER = 0.9
#: (least and most shingles, minima per sketch, sketches). Neighbouring ranges
#: overlap by a factor of 0.8, so that linked texts share a kind of sketch.
KINDS = ((1, 20, 2, 24), (16, 64, 4, 32), (50, None, 6, 48))
SMALL_BUCKET = 24  # texts that are all held against each other
TURNS = 3  # at most, of pivots in the rest; what they leave apart is compared in pairs
BLOCK = 500  # members of a bucket that one task joins with as many others
SLOTS = 1 << 20  # counters that give the order of the shingles
SLOT_RANGE = 1 << 14  # of them in a row
SIGNATURE = 8  # longs of a text's bit signature


@functools.lru_cache(maxsize=8)
def _multipliers(kind: int, sketches: int) -> np.ndarray:
    return np.random.default_rng(7919 + kind).integers(0, 1 << 63, sketches, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch_keys(text: str | None) -> list[int]:
    """Bucket keys of a text: of its distinct shingles and, if some repeat, of the labelled ones."""
    codes = shingle_codes(word_codes(text), SHINGLE)
    if not len(codes):
        return []
    labelled = occurrence_labelled(codes)
    once = occurrence_labelled(first_occurrences(codes))  # each is a first occurrence
    keys = _keys(once)
    return keys if len(once) == len(labelled) else list(dict.fromkeys(keys + _keys(labelled)))


def _keys(codes: np.ndarray) -> list[int]:
    """One key per sketch of each kind that the number of ``codes`` calls for."""
    n, keys = len(codes), []
    for kind, (low, high, minima, sketches) in enumerate(KINDS):
        if n < low or high is not None and n > high:
            continue
        take = min(minima, n)
        factors = _multipliers(kind, sketches)
        block = max(1, 4_000_000 // n)  # sketches at a time, so that memory stays bounded for long texts
        for at in range(0, sketches, block):
            values = mixed(codes[None, :] * factors[at:at + block, None])
            least = np.argpartition(values, take - 1, axis=1)[:, :take]
            least.sort(axis=1)  # text order
            key = np.arange(at, at + len(values), dtype=np.uint64) + np.uint64(kind << 16)
            for k in range(take):
                key = mixed(key * np.uint64(0x9FB21C651E98DF25) + codes[least[:, k]])
            keys += key.view(np.int64).tolist()
    return keys


def digest(text: str | None) -> bytes | None:
    """Equal for texts with the same words (A-Z lower-cased); none for a text without words."""
    words = words_of(text)
    return hashlib.blake2b(b" ".join(words).lower(), digest_size=16).digest() if words else None


def in_order(left: np.ndarray, right: np.ndarray, band: int) -> int:
    """Longest run of matches (left place, right place; one per shingle) in order on both sides within the band."""
    right = right[np.abs(left - right) <= band]
    if not len(right) or (np.diff(right) > 0).all():
        return len(right)
    tails: list[int] = []
    for x in right.tolist():
        k = bisect_left(tails, x)
        tails[k:k + 1] = [x]
    return len(tails)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sequences of distinct shingle codes are near-duplicates."""
    if not len(a) or not len(b) or min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    _, left, right = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = len(left)
    if shared < SIMILARITY * (len(a) + len(b) - shared):
        return False
    order = np.argsort(left)
    return in_order(left[order], right[order], len(a) + len(b) - 2 * shared) >= IN_ORDER * shared


def text_shingles(text: str | None) -> np.ndarray:
    return first_occurrences(shingle_codes(word_codes(text), SHINGLE))


def with_sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, n, keys) per row: digest of the words, distinct shingles, bucket keys. One map over the texts."""
    def run(texts):
        return [[digest(t) for t in texts], [len(text_shingles(t)) for t in texts], [sketch_keys(t) for t in texts]]

    return map_columns(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")),
                       ["text"], [field("digest", BINARY), field("n", LONG), field("keys", T.ArrayType(LONG))], run, ["id"])


_SIGN = -(1 << 63)


def node_of(id_: Column, digest_: Column) -> Column:
    """24 bytes that sort by id (null last), then digest."""
    number = F.lpad(F.hex(id_.bitwiseXOR(F.lit(_SIGN))), 16, "0")
    return F.concat(F.unhex(F.coalesce(number, F.lit("F" * 16))), digest_)


def id_of(node: Column) -> Column:
    number = F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))
    return F.when(number != F.lit((1 << 63) - 1), number)


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, pivot, linked) of the pairs (a, b, pivot), written.

    Texts reach their pairs by two joins; none is broadcast.
    """
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b")

    def run(left, right):
        known: dict[str, np.ndarray] = {}

        def codes(text):
            if text not in known:
                if len(known) > 64:
                    known.clear()
                known[text] = text_shingles(text)
            return known[text]

        return [[linked(codes(x), codes(y)) for x, y in zip(left, right, strict=True)]]

    return staged(map_columns(both, ["text_a", "text_b"], [field("linked", BOOL)], run, ["a", "b", "pivot"]), "near-compared")


def with_pivots(members: DataFrame) -> DataFrame:
    """``members`` (key, node, n) of buckets of two or more, plus size and pivot (least n, then node)."""
    info = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("n", "node")).alias("least")).filter("size > 1")
    return members.join(info.select("key", "size", F.col("least.node").alias("pivot")), "key")


def meetings(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, pivot) to compare.

    ``members`` has key, node, size and pivot; in small buckets all
    pairs of different classes, in large ones each member with the pivot.
    """
    few = members.filter(f"size <= {SMALL_BUCKET}").join(labels, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("class"))
    other = few.select("key", F.col("node").alias("b"), F.col("class").alias("class_b"))
    small = few.join(other, "key").filter("node > b AND class <> class_b")
    large = members.filter(f"size > {SMALL_BUCKET} AND node <> pivot")
    return (small.select(F.col("node").alias("a"), "b", F.lit(False).alias("pivot"))
            .unionByName(large.select(F.col("node").alias("a"), F.col("pivot").alias("b"), F.lit(True).alias("pivot")))
            .groupBy("a", "b").agg(F.max("pivot").alias("pivot")))


def left_apart(held: DataFrame, labels: DataFrame) -> DataFrame:
    """(node) of the members of large buckets that are not one class; ``held``: members compared with their pivots."""
    own = labels.select(F.col("node").alias("a"), F.col("component").alias("class_a"))
    its = labels.select(F.col("node").alias("b"), F.col("component").alias("class_b"))
    seen = held.select("a", "b").join(own, "a", "left").join(its, "b", "left")
    torn = seen.filter(F.coalesce("class_a", "a") != F.coalesce("class_b", "b")).select("b").distinct()
    return held.select("a", "b").join(torn, "b").select(F.col("a").alias("node")).unionByName(
        torn.select(F.col("b").alias("node"))).distinct()


def slots_of(codes: np.ndarray) -> np.ndarray:
    return (codes % np.uint64(SLOTS)).astype(np.int64)


def rare_prefix(codes: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles among which every text of similarity 0.8 shares one, and their places in the order.

    The order is by the count of a shingle's slot (``level``), then by code.
    Shingles that no other text has (level 0) are left out.
    """
    order = np.lexsort((codes, level[slots_of(codes)]))[:len(codes) // 5 + 1]
    at = np.flatnonzero(level[slots_of(codes[order])])
    return codes[order[at]], at


def signature(codes: np.ndarray) -> np.ndarray:
    """64 * ``SIGNATURE`` bits, each the parity of the shingles that fall on it.

    A shingle that only one of two texts has flips one bit, so the signatures
    differ in no more bits than the texts differ in shingles.
    """
    spots = (mixed(codes) % np.uint64(64 * SIGNATURE)).astype(np.int64)
    parity = np.bincount(spots, minlength=64 * SIGNATURE) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


SLOT_PARTS = T.StructType([field("range", LONG), field("slots", T.ArrayType(LONG)), field("counts", T.ArrayType(LONG))])


def _slot_rows(start: int, counts: np.ndarray):
    """A row per range of slots with a count above 0; ``counts`` are those of the slots from ``start`` on."""
    import pyarrow as pa

    filled = np.flatnonzero(counts)
    ranges, first = np.unique((start + filled) // SLOT_RANGE, return_index=True)
    offsets = pa.array(np.append(first, len(filled)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (start + filled, counts[filled])]
    return pa.RecordBatch.from_arrays([pa.array(ranges), *lists], names=SLOT_PARTS.names)


def slot_parts(texts: DataFrame) -> DataFrame:
    """(range, slots, counts): what each task counted in its own texts, one row per range of slots."""
    def run(batches):
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                slots, n = np.unique(slots_of(text_shingles(text)), return_counts=True)
                total[slots] += n
        yield _slot_rows(0, total)

    return texts.select("text").mapInArrow(run, SLOT_PARTS)


def slot_counts(texts: DataFrame) -> DataFrame:
    """(range, slots, counts) over the shingles of all texts, slots counted more than once only; a row per range."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, slots, counts in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                total = sums.setdefault(k, np.zeros(SLOT_RANGE, np.int64))
                total[np.asarray(slots.values) - k * SLOT_RANGE] += np.asarray(counts.values)
        for k, total in sums.items():
            yield _slot_rows(k * SLOT_RANGE, np.where(total > 1, total, 0))

    return slot_parts(texts).repartition("range").mapInArrow(run, SLOT_PARTS)


def prefixes(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(code, place, node, n) of the shingles in the prefixes of ``texts`` (node, text), and (node, signature); written."""
    level = np.zeros(SLOTS, np.uint8)
    for r in slot_counts(texts).collect():  # at most SLOTS counts
        level[r["slots"]] = np.round(4 * np.log2(np.array(r["counts"], float))).clip(1, 255)

    def run(rows):
        out = [[], [], [], []]
        for text in rows:
            codes = text_shingles(text)
            kept, at = rare_prefix(codes, level)
            made = len(codes), kept.view(np.int64).tolist(), at.tolist(), signature(codes).tolist()
            for column, value in zip(out, made, strict=True):
                column.append(value)
        return out

    longs = T.ArrayType(LONG)
    made = staged(map_columns(texts, ["text"], [field("n", LONG), field("codes", longs), field("places", longs), field("signature", longs)],
                              run, ["node"]), "near-prefixes")
    dealt = made.select("node", "n", F.explode(F.arrays_zip("codes", "places")).alias("x"))
    return dealt.select(F.col("x.codes").alias("code"), F.col("x.places").alias("place"), "node", "n"), made.select("node", "signature")


def open_buckets(dealt: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """``dealt`` with class, size and the turn's pivot, in buckets that hold more than one class."""
    named = dealt.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")
    info = named.groupBy("code").agg(
        F.count(F.lit(1)).alias("size"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "class", "n")).alias("p"))
    return named.join(info.filter("low < high").select("code", "size", "p"), "code")


def all_pairs(opened: DataFrame, signatures: DataFrame) -> DataFrame:
    """(a, b, pivot) of different classes that share a bucket and may be similar, each once.

    With the first shingle that two prefixes share at places i and j, the
    texts have at most min(n_a - i, n_b - j) in common, and need 4/9 of
    n_a + n_b. So they differ in no more than 1/9 of n_a + n_b.
    """
    opened = opened.join(signatures, "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cut = opened.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("code", F.least("block", "met").alias("low"), F.greatest("block", "met").alias("high"),
                     "node", "class", "n", "place", "block", *[F.col("signature")[i].alias(f"s{i}") for i in range(SIGNATURE)])
    on = ["code", "low", "high"]
    other = cut.select(*on, *[F.col(c).alias(c + "_b") for c in cut.columns if c not in on])
    differ = "+".join(f"bit_count(s{i} ^ s{i}_b)" for i in range(SIGNATURE))
    both = cut.join(other, on).filter(
        "node > node_b AND class <> class_b AND (low = high OR block <> block_b)"
        f" AND 9 * least(n - place, n_b - place_b) >= 4 * (n + n_b) AND 9 * ({differ}) <= n + n_b")
    return both.select(F.col("node").alias("a"), F.col("node_b").alias("b"), F.lit(False).alias("pivot")).distinct()


def joined_rest(apart: DataFrame, texts: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (node, component) after all links among the nodes of ``apart``; ``links`` are those found before."""
    texts = staged(texts.join(apart, "node", "left_semi"), "near-rest")
    dealt, signatures = prefixes(texts)
    for turn in range(TURNS):
        large = open_buckets(dealt, labels, turn).filter(f"size > {SMALL_BUCKET} AND class <> p.class AND 5 * least(n, p.n) >= 4 * greatest(n, p.n)")
        pairs = staged(large.select(F.col("node").alias("a"), F.col("p.node").alias("b"), F.lit(True).alias("pivot")).distinct(), "near-pairs")
        if pairs.isEmpty():
            break
        more = compared(pairs, texts).filter("linked").select("a", "b")
        if more.isEmpty():
            break
        links = links.unionByName(more)
        labels = staged(components(links, "near-classes"), "near-classes")
    pairs = staged(all_pairs(open_buckets(dealt, labels, TURNS), signatures), "near-pairs")
    if pairs.isEmpty():
        return labels
    more = compared(pairs, texts).filter("linked").select("a", "b")
    return labels if more.isEmpty() else staged(components(links.unionByName(more), "near-classes"), "near-classes")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, digest) per row of ``docs``, and (digest, id, node, component) per distinct text that has words."""
    rows = staged(with_sketches(docs, id_col, text_col), "near-sketches")
    firsts = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.min("n").alias("n"), F.min("keys").alias("keys"))
    firsts = staged(firsts.select("digest", node_of(F.col("id"), F.col("digest")).alias("node"), "n", "keys"), "near-firsts")
    members = staged(with_pivots(firsts.select("node", "n", F.explode("keys").alias("key"))), "near-members")
    # texts that meet another one, fetched once
    wanted = members.select("node").distinct().withColumn("id", id_of(F.col("node")))
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = map_columns(source.join(wanted, "id"), ["text"], [field("own", BINARY)],
                        lambda texts: [[digest(t) for t in texts]], ["node", "text"])
    texts = staged(found.filter("own = substring(node, 9, 16)").select("node", "text").dropDuplicates(["node"]), "near-texts")
    # the pivot that a text meets most often
    often = (members.filter("node <> pivot").groupBy("node", "pivot").count()
             .groupBy("node").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("b")))
    first = compared(staged(often.select(F.col("node").alias("a"), "b", F.lit(False).alias("pivot")), "near-pairs"), texts)
    links = first.filter("linked").select("a", "b")
    parents = links
    for _ in range(2):  # a pivot may have a pivot of its own: follow up to four
        above = parents.select(F.col("a").alias("b"), F.col("b").alias("higher"))
        parents = parents.join(above, "b", "left").select("a", F.coalesce("higher", "b").alias("b"))
    labels = parents.select(F.col("a").alias("node"), F.col("b").alias("component"))
    done = compared(staged(meetings(members, labels), "near-pairs"), texts)
    links = links.unionByName(done.filter("linked").select("a", "b"))
    labels = staged(components(links, "near-classes"), "near-classes")
    # what is still apart in large buckets
    apart = staged(left_apart(done.filter("pivot"), labels), "near-apart")
    if not apart.isEmpty():
        labels = joined_rest(apart, texts, links, labels)
    return rows.select("id", "digest"), firsts.join(labels, "node", "left").select(
        "digest", id_of(F.col("node")).alias("id"), "node", F.coalesce("component", "node").alias("component"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component_id, kept) per row of ``docs``; the id is an integer."""
    rows, texts = _classes(docs, id_col, text_col)
    named = texts.select("digest", id_of(F.col("component")).alias("component_id"))
    out = rows.select("id", "digest").join(named, "digest", "left").withColumn(
        "component_id", F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")))
    return out.select("id", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with the columns of ``docs``: a row of the class's least id and that id's text.

    Texts that share an id are told apart, so none is dropped for another's sake. Rows without an id are compared as
    copies only (equal words), among themselves and with the rest: one stays where no row with an id does. Rows
    without words stay, copies (id and text) taken once.
    """
    own = "words_digest"
    while own in docs.columns:
        own += "_"
    _, texts = _classes(docs, id_col, text_col)
    stands = texts.filter("node = component").select(F.col("digest").alias(own), F.col("id").alias(f"{own}id"))
    made = map_columns(docs, [text_col], [field(own, BINARY)], lambda rows: [[digest(t) for t in rows]])
    has, number = F.col(own).isNotNull(), F.col(f"`{id_col}`").cast("long")
    with_id = (made.filter(has & number.isNotNull()).withColumn(f"{own}id", number)
               .join(stands.filter(F.col(f"{own}id").isNotNull()), [own, f"{own}id"], "left_semi")
               .dropDuplicates([own, f"{own}id"]))
    without = (made.filter(has & number.isNull()).dropDuplicates([own])
               .join(stands.filter(F.col(f"{own}id").isNull()).select(own), own, "left_semi"))
    wordless = made.filter(~has).dropDuplicates([id_col, text_col])
    columns = [f"`{c}`" for c in docs.columns]
    return with_id.select(*columns).unionByName(without.select(*columns)).unionByName(wordless.select(*columns))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Class and verdict of every document."""
    return classes(load_documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "component_id", "kept")


OP6_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
e AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE common >= 0.8 * (a.n + b.n - common)),
r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, component_id, doc_id = component_id AS kept FROM documents JOIN c ON c.x = doc_id
"""
