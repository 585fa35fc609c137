"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of each text.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B
(sentence pieces, which add the space themselves) the text. Both cut the same
bytes into tokens, that is into intervals without gaps. Interval coalescing
finds the groups: all tokens of a batch are sorted by start, the running maximum
of the ends is accumulated, and a group breaks where a start reaches it (there
tokens of both end). Inside the groups the overlapping pairs are expanded.

The id pairs of all texts are then counted, for each B id its most frequent
partners are marked, and every text gets the sums over its links. A text keeps its
distinct pairs with their number. Pairs that make up a 2^-20 part of all links
or more (so at most 2^20 of them, at any size of the corpus) are looked up by
broadcast, the others, none of which is frequent, by a shuffled join. One map
over the texts encodes and aligns; nothing is collected.

Texts are cut before a blank that follows a letter or digit, where both
tokenizers always end a token, so long texts are aligned a segment at a time
and every stretch between blanks goes through B once per worker.

Defined results: null and empty texts, and texts whose tokens of either
side do not spell the space and the text (such as those with U+2581) have no
tokens: zeros and an empty digest. Repeated rows and ids, null ids included, count
row by row, in the corpus-wide counts too. A B id's highest count can be tied; all pairs
with it count. Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONG, STRING, field, load_documents, staged
from .tokens import Encoder

SEGMENT = 1 << 16  # characters after which a text may be cut
BATCH = 1 << 20  # characters aligned at once
CACHE_STRETCHES = 600_000
LONGEST_CACHED = 64
FREQUENT = 1 << 20  # pairs with at least this part of all links are looked up by broadcast
KEY = 1 << 32  # a pair's key is A id * KEY + B id

CUT = re.compile(r"(?<=\w)(?= )")
STRETCH = re.compile(" +[^ ]*")
# Where no piece joins a letter and a mark: blanks and letters, blanks and marks, or all up to the next blank.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
FINE = re.compile(rf" *+[{_LETTER}]++(?![^{_LETTER}\W])| *+[^\w ]++(?![^{_LETTER}\W])| *+[^ ]+| +")
JOINED = re.compile(rf"[{_LETTER}][^\w▁]|[^\w▁][{_LETTER}]")


class PlainEncoder(Encoder):
    """A's ids, with the strings of special tokens as ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.specials = re.compile("|".join(re.escape(x.content) for x in self.plain.get_added_tokens_decoder().values()) or "(?!)")
        spelled = {c: i for i, c in self.letters.items()}
        vocab = self.plain.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for entry, i in vocab.items():
            self.lengths[i] = len(entry) if all(c in spelled for c in entry) else len(entry.encode())

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = self.plain.encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in made]

    def _group(self, texts: list[str]) -> list[bytes]:
        if not any(map(self.specials.search, texts)):
            return super()._group(texts)
        return [self._whole([x])[0] if self.specials.search(x) else super(PlainEncoder, self)._group([x])[0] for x in texts]


class PieceEncoder:
    """B's ids of texts that begin with a blank, stretch by stretch."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        #: What no piece joins can be encoded apart; with newlines, or blanks inside pieces, texts are taken whole.
        words = [p for i, p in enumerate(pieces) if not self.model.is_byte(i) and not self.model.is_control(i)
                 and not self.model.is_unknown(i)]
        self.cut = (None if any("▁" in p.lstrip("▁") or "\n" in p for p in words)
                    else STRETCH if any(map(JOINED.search, words)) else FINE)
        self.known: dict[str, bytes | None] = {}

    def _encode(self, stretches: list[str]) -> list[bytes | None]:
        """Ids, or None where they do not spell the stretch.

        The model adds a blank in front of what is not empty: a stretch's own first blank is left to it. Others get a
        newline (a token by itself) in front, which is dropped again with the blank.
        """
        own = [s[0] == " " and len(s) > 1 for s in stretches]
        made = self.model.encode([s[1:] if o else "\n" + s for o, s in zip(own, stretches, strict=True)], num_threads=1)
        made = [ids if o else ids[2:] for o, ids in zip(own, made, strict=True)]
        get = self.bytes.__getitem__
        return [np.array(ids, "<u4").tobytes() if b"".join(map(get, ids)) == s.encode() else None
                for s, ids in zip(stretches, made, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes | None]:
        cut = [self.cut.findall(t) if self.cut else [t] for t in texts]
        missing = set().union(*cut).difference(self.known)
        if len(self.known) + len(missing) > CACHE_STRETCHES:
            self.known.clear()
            missing = set().union(*cut)
        made = list(missing)
        fresh = dict(zip(made, self._encode(made), strict=True))
        self.known.update((s, ids) for s, ids in fresh.items() if len(s) <= LONGEST_CACHED)
        out = []
        for stretches in cut:
            ids = [fresh[s] if s in fresh else self.known[s] for s in stretches]
            out.append(None if None in ids else b"".join(ids))
        return out


def segments(text: str) -> list[str]:
    """The blank and the text, cut where both tokenizers always end a token."""
    text = " " + text
    out, start = [], 0
    while len(text) - start > SEGMENT and (m := CUT.search(text, start + SEGMENT)):
        out.append(text[start:m.start()])
        start = m.start()
    return [*out, text[start:]]


class Aligner:
    """Both tokenizers and the alignment of lists of texts."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = PlainEncoder(a_path), PieceEncoder(b_path)
        n = max(len(self.a.lengths), len(self.b.lengths))
        self.spelled = [f"{i}{mark}" for i in range(n) for mark in (",", "|", ";", "")]

    def align(self, texts: list[str | None]) -> list[dict | None]:
        """Per text n_a, n_b, n_groups, n_links, groups (as text), keys and counts of its id pairs; None without tokens."""
        out: list[dict | None] = [None] * len(texts)
        parts: list[tuple[int, str]] = [(i, s) for i, t in enumerate(texts) if t for s in segments(t)]
        failed: set[int] = set()
        at = 0
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (end == at or size + len(parts[end][1]) <= BATCH):
                size += len(parts[end][1])
                end += 1
            for i, found in zip((i for i, _ in parts[at:end]), self._batch([s for _, s in parts[at:end]]), strict=True):
                if found is None:
                    failed.add(i)
                elif out[i] is None:
                    out[i] = found
                else:
                    for k, v in found.items():
                        out[i][k] = np.concatenate([out[i][k], v]) if k in ("keys", "counts") else (
                            f"{out[i][k]};{v}" if k == "groups" else out[i][k] + v)
            at = end
        return [None if i in failed else x for i, x in enumerate(out)]

    def _batch(self, texts: list[str]) -> list[dict | None]:
        ids_b = self.b.encode(texts)
        good = [i for i, x in enumerate(ids_b) if x is not None]
        ids_a = dict(zip(good, self.a.encode([texts[i] for i in good]), strict=True))
        sizes = {i: len(texts[i].encode()) for i in good}
        good = [i for i in good if int(self.a.lengths[np.frombuffer(ids_a[i], "<u4")].sum()) == sizes[i]]
        out: list[dict | None] = [None] * len(texts)
        if good:
            made = self._aligned([np.frombuffer(ids_a[i], "<u4") for i in good], [np.frombuffer(ids_b[i], "<u4") for i in good])
            for i, x in zip(good, made, strict=True):
                out[i] = x
        return out

    def _aligned(self, each_a: list[np.ndarray], each_b: list[np.ndarray]) -> list[dict]:
        """Texts of equally many bytes on both sides, laid end to end: text borders are common ends too."""
        n_a, n_b = np.array([len(x) for x in each_a]), np.array([len(x) for x in each_b])
        a, b = np.concatenate(each_a).astype(np.int32), np.concatenate(each_b).astype(np.int32)
        ids = np.concatenate([a, b])
        a_size, b_size = self.a.lengths[a], self.b.lengths[b]
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        a_start, b_start = a_end - a_size, b_end - b_size
        # coalescing: a group breaks where a start reaches the running maximum of the ends
        start = np.concatenate([a_start, b_start])
        order = np.lexsort((start,))
        starts = start[order]
        reach = np.maximum.accumulate(np.concatenate([a_end, b_end])[order])
        breaks = np.concatenate([[True], starts[1:] >= reach[:-1]])
        group = np.empty(len(order), np.int32)
        group[order] = np.cumsum(breaks, dtype=np.int32)
        borders = np.concatenate([[0], a_end[np.cumsum(n_a) - 1]])
        n_groups = np.diff(np.searchsorted(starts[breaks], borders))
        # each group's A ids, then its B ids; a mark after each tells what follows
        group *= 2
        group[len(a):] += 1
        order = np.lexsort((group,))
        g = group[order]
        marks = np.full(len(g), 3, np.int32)  # 3 nothing, 2 a group, 1 the B ids, 0 an id
        step = g[1:] - g[:-1]
        marks[:-1] = np.minimum(step, 1) + (g[1:] % 2 < step)
        marks[np.cumsum(n_a + n_b) - 1] = 3
        spelled = list(map(self.spelled.__getitem__, (ids[order] * 4 + marks).tolist()))
        # overlaps inside the groups
        low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
        links = high - low
        before = np.cumsum(links) - links
        partner = np.arange(len(links) and before[-1] + links[-1]) + np.repeat(low - before, links)
        n_links = np.diff(np.concatenate([[0], np.cumsum(links)[np.cumsum(n_a) - 1]]))
        pairs = np.repeat(a, links) * np.int64(KEY) + b[partner]
        out, at, token = [], 0, 0
        for i in range(len(n_a)):
            keys, counts = np.unique(pairs[at:at + n_links[i]], return_counts=True)
            both = int(n_a[i] + n_b[i])
            out.append({"n_a": int(n_a[i]), "n_b": int(n_b[i]), "n_groups": int(n_groups[i]), "n_links": int(n_links[i]),
                        "groups": "".join(spelled[token:token + both]), "keys": keys, "counts": counts})
            at, token = at + n_links[i], token + both
        return out


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One pair of encoders, with their caches, per worker."""
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          digest: bool = True) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, keys, counts) per row, without a shuffle.

    ``groups`` lists the groups' ids, or with ``digest`` its SHA-256; ``keys`` are the distinct id pairs
    (A id * 2^32 + B id) and ``counts`` their number of links.
    """
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    schema = T.StructType([docs.schema[id_col], *[field(c, LONG) for c in numbers], field("groups", STRING),
                           field("keys", T.ArrayType(LONG)), field("counts", T.ArrayType(T.IntegerType()))])

    def lists(parts: list[np.ndarray], kind) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = {**dict.fromkeys(numbers, 0), "groups": "", "keys": np.zeros(0, np.int64), "counts": np.zeros(0, np.int64)}
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                made = [x or none for x in aligner(a_path, b_path).align(b.column(1).to_pylist())]
                shown = [hashlib.sha256(x["groups"].encode()).hexdigest() if digest and x is not none else x["groups"] for x in made]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array([x[c] for x in made], pa.int64()) for c in numbers], pa.array(shown, pa.string()),
                     lists([x["keys"] for x in made], np.int64), lists([x["counts"] for x in made], np.int32)],
                    names=[id_col, *numbers, "groups", "keys", "counts"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(key, n, best) of every id pair; ``best``: no pair with the same B id has more links. A written table."""
    counts = staged(aligned.select(F.explode(F.arrays_zip("keys", "counts")).alias("p"))
                    .groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.counts").alias("n")), "pair-counts")
    top = counts.groupBy((F.col("key") % KEY).alias("b")).agg(F.max("n").alias("top"))  # a row per entry of B's vocabulary
    marked = counts.withColumn("b", F.col("key") % KEY).join(F.broadcast(top), "b")
    return staged(marked.select("key", "n", (F.col("n") == F.col("top")).alias("best")), "pair-best")


def with_corpus_counts(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The rows of :func:`align` (written and read back) without the pairs, plus n_best and count_sum."""
    rows = staged(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    pairs = pair_counts(rows)
    total = pairs.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") >= F.lit(total / frequent)  # at most ``frequent`` pairs
    links = rows.select("row", F.explode(F.arrays_zip("keys", "counts")).alias("p")).select(
        "row", F.col("p.keys").alias("key"), F.col("p.counts").alias("links"))
    common = F.broadcast(pairs.filter(often))
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("n")).alias("count_sum")]
    by_lookup = links.join(common, "key").groupBy("row").agg(*sums)
    by_shuffle = links.join(common.select("key"), "key", "left_anti").join(pairs.filter(~often), "key").groupBy("row").agg(*sums)
    found = by_lookup.unionByName(by_shuffle).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return (rows.drop("keys", "counts").join(found, "row", "left").drop("row")
            .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")}))


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment of byte_bpe_50k and piece_bpe_32k on every document."""
    import public_tokenizers as public

    made = with_corpus_counts(align(load_documents(spark, sf_dir), public.path("byte_bpe_50k.json"),
                                    public.path("piece_bpe_32k.model")))
    return made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       F.col("groups").alias("groups_sha256"))
