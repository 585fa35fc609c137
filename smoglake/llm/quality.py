"""Quality rules: fixed word rules, then a robust multivariate outlier test.

Every text becomes a vector of transformed statistics. For each language and
source a minimum-covariance-determinant (MCD) estimate gives the centre and
scatter of the ordinary documents: starting from the coordinate medians,
concentration steps repeatedly take the half (``SHARE``) of the group nearest
to the current estimate and re-estimate from it, until nothing changes. A
document is rejected when its Mahalanobis distance from its group's estimate
passes the cut-off.

Defined results: a null or empty text has no words and fails the base rule;
a null language or source is a group of its own; repeated rows are scored
row by row; an empty table gives an empty table. Groups too small for an
estimate of their own use their language's, then that of all documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LONG, field, load_documents, map_columns, small_side, staged, words_of

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines"]

#: Transformed statistics, each with its cell width, its number of cells and
#: the least scatter it is granted (a statistic that is constant among the
#: ordinary documents must not reject over a trifle). Short ordinary documents have up
#: to a third of duplicate lines or 29 % of repeated words, so those two
#: scatters let such shares pass.
STATISTICS = {
    "log_word_length": (0.025, 128, 0.06),
    "symbol_share": (0.07, 24, 0.04),
    "dup_line_share": (0.07, 24, 0.16),
    "repeat_word_share": (0.07, 24, 0.16),
}
SHARE = 0.5  # of a group that the determinant is minimised over
MIN_GROUP = 100  # documents that a group needs for an estimate of its own
CUTOFF = 0.99999  # quantile of the chi-square law with len(STATISTICS) degrees of freedom
BROADCAST_GROUPS = 20_000  # estimates (about 250 bytes each) that may be broadcast


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found twice or more (the first included).

    Equal windows are first sought among 64-bit mixes of the words' hashes;
    the few windows whose mix repeats are then compared word by word.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mix = hashes[:n].copy()
    for k in range(1, size):
        mix = mix * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n + k]
    ranked = np.sort(mix)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not twice.size:
        return 0
    places: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(mix, twice)).tolist():
        places.setdefault(tuple(words[i:i + size]), []).append(i)
    cover = np.zeros(len(words), bool)
    for found in places.values():
        if len(found) > 1:
            at = np.array(found)
            for k in range(size):
                cover[at + k] = True
    return int(cover.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a whole text."""
    if not text:
        return (0, 0, 0, 0, 0, 0)
    words = words_of(text)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines))


def with_counts(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None,
                prefix: str = "") -> DataFrame:
    """``docs`` (or its ``carry`` columns) plus the counts of each text; one pass, no shuffle."""
    def run(texts):
        rows = [text_counts(t) for t in texts]
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(6)]

    return map_columns(docs, [text_col], [field(prefix + c, LONG) for c in COUNTS + EXTRA], run, carry)


def base_failed(prefix: str = "", min_words: int = 50, repeat_percent: int = 50) -> Column:
    n, rep = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < min_words) | (rep * 100 > n * repeat_percent)


def statistics(prefix: str = "") -> list[Column]:
    """The transformed statistics: log of the mean word length, arcsine roots of the shares."""
    c = {k: F.col(prefix + k) for k in COUNTS + EXTRA}

    def share(part, whole):
        return F.asin(F.sqrt(F.least(F.lit(1.0), part / F.greatest(whole, F.lit(1)))))

    return [F.log(F.greatest(c["word_chars"] / F.greatest(c["n_words"], F.lit(1)), F.lit(1.0))),
            share(c["n_symbols"], c["word_chars"]), share(c["n_dup_lines"], c["n_lines"]),
            share(c["n_repeat_words"], c["n_words"])]


def chi_square_cdf(x: float, dof: int) -> float:
    """For an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(dof // 2):
        term = term * (x / 2) / k if k else 1.0
        total += term
    return 1.0 - float(np.exp(-x / 2)) * total


def chi_square_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dof) < q else (low, mid)
    return (low + high) / 2


def mcd(n: np.ndarray, sums: np.ndarray, products: np.ndarray, floor: np.ndarray,
        share: float = SHARE, steps: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter of least determinant over ``share`` of the documents.

    Input: one row per cell with its document count, sums (cells x p) and
    sums of products (cells x p x p), so that moments are those of the
    documents. Starts from the weighted medians with the floors' scale and
    with the spread of the nearest half; the concentration steps of each
    start run to a fixed point and the smaller determinant wins. A
    reweighting step over the documents within the 97.5 % ellipsoid ends it.
    """
    p = sums.shape[1]
    mids = sums / n[:, None]
    need = max(1.0, share * n.sum())

    def moments(pick):
        m = n[pick].sum()
        centre = sums[pick].sum(0) / m
        return centre, products[pick].sum(0) / m - np.outer(centre, centre)

    def distances(centre, scatter):
        off = mids - centre
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter + np.diag(floor ** 2)), off)

    def nearest(d):
        order = np.argsort(d, kind="stable")
        return np.sort(order[: int(np.searchsorted(np.cumsum(n[order]), need)) + 1])

    median = np.empty(p)
    for j in range(p):
        order = np.argsort(mids[:, j], kind="stable")
        median[j] = mids[order[int(np.searchsorted(np.cumsum(n[order]), n.sum() / 2))], j]
    best = None
    for scale in (np.zeros(p), moments(nearest((((mids - median) / floor) ** 2).sum(1)))[1].diagonal()):
        pick = nearest(distances(median, np.diag(scale)))
        for _ in range(steps):
            centre, scatter = moments(pick)
            again = nearest(distances(centre, scatter))
            if np.array_equal(again, pick):
                break
            pick = again
        centre, scatter = moments(pick)
        size = np.linalg.slogdet(scatter + np.diag(floor ** 2))[1]
        if best is None or size < best[0]:
            best = (size, centre, scatter)
    _, centre, scatter = best
    inner = chi_square_quantile(share, p)
    scatter = scatter * share / chi_square_cdf(inner, p + 2)
    pick = np.flatnonzero(distances(centre, scatter) <= chi_square_quantile(0.975, p))
    return moments(pick) if pick.size else (centre, scatter)


def group_estimates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(key, n, centre, precision) for each value of each column in ``keys``.

    ``rows`` has the statistics as x0, x1, ... Documents are first counted
    into grid cells (count, sums, sums of products; exact decimals, combined
    before the shuffle), so what one task gathers for a group is bounded by
    the grid (``STATISTICS``), whatever share of the documents it holds.
    """
    p = len(STATISTICS)
    cells, moments = [], []
    for j, (width, count, _) in enumerate(STATISTICS.values()):
        cells.append(F.least(F.floor(F.col(f"x{j}") / width).cast("int"), F.lit(count - 1)).alias(f"c{j}"))
    fixed = [F.round(F.col(f"x{j}") * 1e6).cast("long").cast("decimal(18,0)") for j in range(p)]
    for j in range(p):
        moments.append(F.sum(fixed[j]).cast("double").alias(f"s{j}"))
        moments += [F.sum(fixed[j] * fixed[k]).cast("double").alias(f"p{j}{k}") for k in range(j, p)]
    keyed = rows.select(F.explode(F.array(*keys)).alias("key"), *cells, *[f"x{j}" for j in range(p)])
    counted = keyed.groupBy("key", *[f"c{j}" for j in range(p)]).agg(F.count(F.lit(1)).alias("n"), *moments)
    floor = np.array([f for _, _, f in STATISTICS.values()])

    def estimate(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values([f"c{j}" for j in range(p)])
        n = cells["n"].to_numpy(float)
        sums = np.stack([cells[f"s{j}"].to_numpy(float) for j in range(p)], 1) / 1e6
        prods = np.empty((len(n), p, p))
        for j in range(p):
            for k in range(j, p):
                prods[:, j, k] = prods[:, k, j] = cells[f"p{j}{k}"].to_numpy(float) / 1e12
        centre, scatter = mcd(n, sums, prods, floor)
        inverse = np.linalg.inv(scatter + np.diag(floor ** 2))
        return pd.DataFrame({"key": [cells["key"].iloc[0]], "n": [int(n.sum())], "centre": [centre.tolist()],
                             "precision": [inverse.ravel().tolist()]})

    return counted.groupBy("key").applyInPandas(
        estimate, "key string, n long, centre array<double>, precision array<double>")


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """``carry`` columns (default: all) plus the verdict, and the prefix of the added columns.

    Added, under a prefix that no input column has: the counts, base_failed,
    distance (squared; null where no group has an estimate) and kept. The
    rows with their counts are written once to the shared folder; the
    estimates and the verdicts both read them there.
    """
    carry = list(docs.columns if carry is None else carry)
    prefix = "q_"
    while any(c.startswith(prefix) for c in [*docs.columns]):
        prefix += "_"
    keyed = docs.withColumns({prefix + "g": F.to_json(F.struct(F.col(f"`{lang_col}`").alias("l"), F.col(f"`{source_col}`").alias("s"))),
                              prefix + "l": F.to_json(F.struct(F.col(f"`{lang_col}`").alias("l")))})
    rows = staged(with_counts(keyed, text_col, [*carry, prefix + "g", prefix + "l"], prefix), "quality-counts")
    p = len(STATISTICS)
    good = rows.filter(~base_failed(prefix)).select(
        F.col(prefix + "g").alias("g"), F.concat(F.lit("L"), prefix + "l").alias("l"), F.lit("all").alias("a"),
        *[c.alias(f"x{j}") for j, c in enumerate(statistics(prefix))])
    found = staged(group_estimates(good, ["g", "l", "a"]), "quality-estimates")
    enough = found.filter(F.col("n") >= MIN_GROUP)

    def level(name):
        return enough.select(F.col("key").alias(name), F.struct("centre", "precision").alias("e_" + name))

    groups = rows.select(F.col(prefix + "g").alias("g"), F.concat(F.lit("L"), prefix + "l").alias("l")).distinct()
    chosen = (groups.withColumn("a", F.lit("all"))
              .join(level("g"), "g", "left").join(level("l"), "l", "left").join(level("a"), "a", "left")
              .select(F.col("g").alias(prefix + "g"), F.coalesce("e_g", "e_l", "e_a").alias(prefix + "e")))
    chosen = small_side(staged(chosen, "quality-chosen"), BROADCAST_GROUPS)
    cut = chi_square_quantile(CUTOFF, p)
    judged = (rows.join(chosen, prefix + "g", "left")
              .withColumns({f"{prefix}x{j}": c for j, c in enumerate(statistics(prefix))}))
    off = [F.col(f"{prefix}x{j}") - F.col(f"{prefix}e.centre")[j] for j in range(p)]
    square = F.lit(0.0)
    for j in range(p):
        for k in range(p):
            square = square + off[j] * off[k] * F.col(f"{prefix}e.precision")[j * p + k]
    judged = judged.withColumn(prefix + "distance", square).withColumn(prefix + "base_failed", base_failed(prefix))
    kept = ~F.col(prefix + "base_failed") & (F.coalesce(F.col(prefix + "distance"), F.lit(0.0)) <= cut)
    return judged.withColumn(prefix + "kept", kept), prefix


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    judged, prefix = judge(docs, text_col, lang_col, source_col)
    return judged.filter(F.col(prefix + "kept")).select(*[f"`{c}`" for c in docs.columns])


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    judged, q = judge(load_documents(spark, sf_dir), carry=["doc_id"])
    return judged.select("doc_id", *[F.col(q + c).alias(c) for c in COUNTS], F.col(q + "base_failed").alias("base_failed"),
                         F.col(q + "kept").alias("kept"), F.col(q + "distance").alias("distance"))
