"""Periodic run detection over the words of whole texts, by an online sparse diagonal table.

A run is a stretch of words with smallest period q, at least ``LEAST`` words
and two periods long, that no neighbouring word extends keeping the period.
Words that match the word d places before lie on the diagonal of lag d; a run
of period q is a diagonal of q or more matches in a row.

The words are read in order. A word's earlier occurrences open diagonals,
every further matching word adds one to the length of the active ones, and a
diagonal that ends with sufficient length emits its run at once. Two rules keep
the table sparse and lose no run:

* An occurrence counts with the words before it. Lags are taken in octaves
  [b, 2b), and a diagonal is opened where b words in a row (6 for the lags
  below 12) match, as those of every run do.
* A block of b words inside a run of period p, b/2 or less, opens nothing but
  diagonals to another run of that period that reaches its run's start, and
  those only if it begins in its run's first p words. Other blocks come back no
  sooner than b/2 words later, so a word opens a few diagonals per octave at most.

Why the second rule loses nothing: if the matches of a run of the octave hold a
block that is not of that kind, it opens the diagonal. Else they lie in one run R
of some period p, and the words a lag before in another run S of that period (in
the same, the whole stretch had the period p). The matches begin where R or S
(moved by the lag) begins and follow the words they match, so S reaches them;
two runs of period p share fewer than p words, so they begin in R's first p words.

Work is n log n and the total length of the runs, also in texts of one
word or loop; memory follows the longest text.

Blocks are found by 64-bit hashes; diagonals compare the words themselves.
Each text is taken by itself in one map, without a shuffle.

Defined results: null, empty and blank texts have no words and no runs, and
collapse to the empty text; a null id counts as the empty id; repeated rows give
repeated results; extra columns are carried along by :func:`periodic_runs`
(under their own names, so they must not be named ``runs`` or ``collapsed``)
and left out of the query; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONG, STRING, field, load_documents, map_columns, words_of

LEAST = 12  # words of the shortest run
BLOCK = LEAST // 2  # words that match in a row on the diagonal of any run, whatever its period

RUN = T.StructType([field("start", LONG), field("length", LONG), field("period", LONG)])
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # an odd constant that spreads bits


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each distinct word, at the word's places."""
    known = dict.fromkeys(words)
    for i, w in enumerate(known):
        known[w] = i
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = (first ^ (first >> np.uint64(29))) * _FACTOR + second
    return (h ^ (h >> np.uint64(32))) * _FACTOR


def _block_hashes(ids: np.ndarray) -> np.ndarray:
    """Hash of the ``BLOCK`` words that start at each place."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * _FACTOR
    out = h[:len(ids) - BLOCK + 1]
    for k in range(1, BLOCK):
        out = _mixed(out, h[k:len(ids) - BLOCK + 1 + k])
    return out


def _near_openings(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(last word, lag) of blocks that come back within fewer than ``LEAST`` words."""
    places, lags = [], []
    for d in range(1, LEAST):
        at = np.flatnonzero(hashes[d:] == hashes[:-d]) if len(hashes) > d else []
        places.append(np.asarray(at, np.int64) + d + BLOCK - 1)
        lags.append(np.full(len(at), d))
    return np.concatenate(places), np.concatenate(lags)


def _shorter_runs(runs: dict, n: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs that hold a block and have at most half its length as period, by start: the run that the block
    ending at each word lies in (else -1), the starts, the periods, and the run of the same period that reaches the
    word before the start (else -1). A last entry stands for none."""
    fit = sorted((start, length, q) for (start, length), q in runs.items() if 2 * q <= block <= length)
    inside, reached, last = np.full(n, -1), [], {}
    for k, (start, length, q) in enumerate(fit):
        inside[start + block - 1:start + length] = k
        end, other = last.get(q, (-1, -1))
        reached.append(other if end >= start - 1 else -1)
        last[q] = (start + length - 1, k)
    starts, periods = [r[0] for r in fit], [r[2] for r in fit]
    return inside, np.array([*starts, 0]), np.array([*periods, 0]), np.array([*reached, -1])


def _far_openings(at: np.ndarray, hashes: np.ndarray, block: int, shorter: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(last word, lag) of blocks that come back ``block`` to twice as many words later. Sorted by hash and place."""
    inside, starts, periods, reached = shorter
    own = inside[at]
    later = np.flatnonzero((own < 0) | (reached[own] >= 0) & (at - block + 1 - starts[own] < periods[own]))
    places, lags, shift = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while len(later):
        shift += 1
        later = later[later >= shift]
        lag = at[later] - at[later - shift]
        near = (hashes[later] == hashes[later - shift]) & (lag < 2 * block)
        later, lag = later[near], lag[near]
        fit = (lag >= block) & ((own[later] < 0) | (own[later - shift] == reached[own[later]]))
        places.append(at[later[fit]])
        lags.append(lag[fit])
    return np.concatenate(places), np.concatenate(lags)


def _sweep(ids: list[int], places: np.ndarray, lags: np.ndarray, least: int, runs: dict) -> None:
    """The diagonal table over one octave of lags: adds to ``runs`` ((start, length) -> period)."""
    order = np.lexsort((lags, places))
    opens = list(zip(places[order].tolist(), lags[order].tolist(), strict=True))
    active: dict[int, int] = {}  # lag -> words matched in a row

    def end(i: int, lag: int) -> None:
        matched = active.pop(lag)
        if matched >= max(least - lag, lag):
            key = (i - matched - lag, matched + lag)
            runs[key] = min(lag, runs.get(key, lag))

    k, n, i = 0, len(ids), 0
    while active or k < len(opens):
        if not active:
            i = opens[k][0]
        if i == n:
            for lag in list(active):
                end(n, lag)
            break
        word = ids[i]
        for lag in [d for d in active if ids[i - d] != word]:
            end(i, lag)
        for lag in active:
            active[lag] += 1
        while k < len(opens) and opens[k][0] == i:
            lag = opens[k][1]
            k += 1
            if lag not in active:
                j = i
                while j >= lag and ids[j] == ids[j - lag]:
                    j -= 1
                if j < i:
                    active[lag] = i - j
        i += 1


def find_runs(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period. ``least`` is ``LEAST`` or more."""
    n = len(words)
    if n < least:
        return []
    ids = numbered(words)
    runs: dict[tuple[int, int], int] = {}
    hashes = _block_hashes(ids)
    places, lags = _near_openings(hashes)
    as_list = None
    if len(places):
        _sweep(as_list := ids.tolist(), places, lags, least, runs)
    at, block = np.arange(BLOCK - 1, n), BLOCK
    while 4 * block <= n:  # two periods of the next octave's least lag
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        at, hashes = at[again], hashes[again]  # in order of place
        before = np.searchsorted(at, at - block)  # the block that ends where this one starts
        whole = before < len(at)
        whole[whole] = at[before[whole]] == at[whole] - block
        at, hashes = at[whole], _mixed(hashes[before[whole]], hashes[whole])
        block *= 2
        if len(at) < 2:
            break
        order = np.argsort(hashes, kind="stable")
        places, lags = _far_openings(at[order], hashes[order], block, _shorter_runs(runs, n, block))
        if len(places):
            as_list = ids.tolist() if as_list is None else as_list
            _sweep(as_list, places, lags, least, runs)
    return sorted(((s, length, q) for (s, length), q in runs.items()), key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what any run repeats after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
                  carry: list[str] | None = None) -> DataFrame:
    """``carry`` (all columns) plus ``runs`` and ``collapsed``, the text's words without repeated periods.

    ``rewrite(id, words)`` may change the words before they are searched.
    """
    def run(ids, texts):
        runs, left = [], []
        for i, text in zip(ids, texts, strict=True):
            words = words_of(text)
            words = rewrite(i, words) if rewrite else words
            runs.append(find_runs(words, least))
            left.append(b" ".join(kept_words(words, runs[-1])).decode())
        return [runs, left]

    return map_columns(docs, [id_col, text_col], [field("runs", T.ArrayType(RUN)), field("collapsed", STRING)], run, carry)


def looped(doc_id, words: list[bytes]) -> list[bytes]:
    """The rewriting that the query is defined with: a tenth of the texts end in a loop over some of their words."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Number, longest and digests of the runs of every document."""
    found = periodic_runs(load_documents(spark, sf_dir), rewrite=looped, carry=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[
        r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_reduce(list_concat([4294967295::BIGINT], range(8 * length(coalesce(doc_id::VARCHAR, '')))), lambda c, k:
           CASE WHEN k % 8 = 0 THEN
             CASE WHEN xor(c, ascii(substr(doc_id::VARCHAR, (k // 8)::INT + 1, 1))) & 1 = 1
                  THEN xor(xor(c, ascii(substr(doc_id::VARCHAR, (k // 8)::INT + 1, 1))) >> 1, 3988292384)
                  ELSE xor(c, ascii(substr(doc_id::VARCHAR, (k // 8)::INT + 1, 1))) >> 1 END
           WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS inverted
  FROM documents),
h AS (SELECT r, doc_id, w, len(w) AS n, xor(inverted, 4294967295) AS h, xor(inverted, 4294967295) // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT r, n, i, w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
      FROM (SELECT r, n, w, a, p, unnest(range(n)) AS i FROM p)),
m AS (SELECT y.r, y.i - x.i AS q, y.i FROM t x JOIN t y ON x.r = y.r AND x.word = y.word AND x.i < y.i
      WHERE 2 * (y.i - x.i) <= y.n),
g AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m),
s AS (SELECT r, q, min(i) - q AS start, count(*) + q AS length FROM g GROUP BY r, q, island
      HAVING count(*) >= greatest(12 - q, q)),
runs AS (SELECT r, start, length, min(q) AS q FROM s GROUP BY r, start, length),
u AS (SELECT r, count(*) AS n_runs, string_agg(concat_ws(',', start, length, q) || chr(10), '' ORDER BY start, q) AS listed,
             min(struct_pack(l := -length, s := start, q := q)) AS best FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT t.r, string_agg(t.word, ' ' ORDER BY t.i) AS collapsed FROM t ANTI JOIN dropped x ON t.r = x.r AND t.i = x.i
         GROUP BY t.r)
SELECT d.doc_id, coalesce(u.n_runs, 0)::BIGINT AS n_runs, u.best.s::BIGINT AS start, (-u.best.l)::BIGINT AS length,
       u.best.q::BIGINT AS period, (1000 * -u.best.l // u.best.q)::BIGINT AS exponent_milli,
       sha256(coalesce(u.listed, '')) AS runs_sha256, sha256(coalesce(kept.collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN u ON d.r = u.r LEFT JOIN kept ON d.r = kept.r
"""
