"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a lexicon learned from the training
labels (plain, after undoing character swaps, near a second-person word),
capitals, punctuation and obfuscation rates. Training rows are split by a
hash of their id: most fit the lexicon and the trees, the rest fit the
isotonic map from the trees' margin to a probability.

Fitting reads at most about ``SAMPLE_DOCS`` labelled documents outside the
held-out fifth, chosen by hash; the lexicon has at most ``LEXICON`` words.
Scoring covers every document. Labels, language, source and id are never
inputs of a score.

Defined results: a null or empty text has all features 0 and is scored like
any other; repeated rows are scored row by row; a label that is null does not
take part; if labels of one class only (or none) are there to learn from, every
score is that class's share (0 without labels); an empty table gives an empty
table.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import DOUBLE, STRING, field, hash_sample, id_remainder, load_documents, map_columns, staged

SAMPLE_DOCS = 10_000
LEXICON = 500
STEM = 6  # letters of the longest stem
MIN_ODDS = 3.0  # least log odds ratio of a lexicon entry
HELD_OUT = 5
NEAR = 6  # words between a lexicon word and a second-person word
TREES, DEPTH, STEP = 25, 4, 0.2

# Second-person words of the corpus languages.
SECOND_PERSON = frozenset("""you your yours yourself u ur
du dich dir dein deine deinen deiner ihr euch euer eure
tu te toi ton ta tes vous votre vos
tú ti tus vosotros usted ustedes vuestro vuestra os""".split())

# Characters that stand in for letters.
SWAPS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None,
                       "-": None, "_": None, "+": "t"})

TOKENS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
SWAPPED = re.compile(r"[^\W_]+[0134579@$!*_+-]+[^\W_]+")
SWAPPED_HINT = re.compile(r"[^\W_][0134579@$!*_+-]+[^\W\d_]")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SHOUTS = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")

FEATURES = ["log_words", "lexicon_density", "lexicon_weight", "lexicon_hits", "lexicon_distinct", "hits_near_person",
            "person_density", "swapped_hits", "swapped_rate", "capital_rate", "shout_rate", "exclamation_rate",
            "question_rate", "punctuation_rate"]


def tokens(text: str | None) -> list[str]:
    return TOKENS.findall(text.lower()) if text else []


def features(text: str | None, lexicon: dict[str, float], heads: frozenset[str]) -> list[float]:
    """See ``FEATURES``; rates are per word, or per letter for capitals. ``heads``: first two letters of the entries."""
    if not text:
        return [0.0] * len(FEATURES)
    words = tokens(text)
    n = max(1, len(words))
    found = lexicon_weights(words, lexicon, heads)
    hits = np.array(sorted(found), np.int64)
    persons = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON], np.int64)
    near = 0
    if len(hits) and len(persons):
        at = np.searchsorted(persons, hits)
        left = np.abs(persons[np.maximum(at - 1, 0)] - hits)
        right = np.abs(persons[np.minimum(at, len(persons) - 1)] - hits)
        near = int((np.minimum(left, right) <= NEAR).sum())
    swapped = [m.lower().translate(SWAPS) for m in SWAPPED.findall(text)] if SWAPPED_HINT.search(text) else []
    undone = len(lexicon_weights(swapped, lexicon, heads))
    letters = max(1, sum(map(len, words)))
    capitals = len(CAPITALS.findall(text))
    shouts = len(SHOUTS.findall(text))
    marks = sum(map(text.count, ".,;:!?\"'()"))
    return [float(np.log1p(len(words))), len(hits) / n, sum(found.values()) / n, float(min(len(hits), 1000)),
            float(len({words[i] for i in found})), near / n, len(persons) / n, undone / n, len(swapped) / n,
            capitals / letters, shouts / n, text.count("!") / n, text.count("?") / n, marks / n]


def entries(word: str) -> list[str]:
    """The word and its stems: beginnings of three to ``STEM`` letters, marked by a star."""
    return [word, *[word[:k] + "*" for k in range(3, min(STEM, len(word) - 1) + 1)]]


def learn_lexicon(rows: DataFrame, limit: int = LEXICON) -> dict[str, float]:
    """Words and stems tied to toxic documents, with their log odds ratios, from rows of (text, label).

    Counted per distinct text, so that copies weigh once. An entry needs a
    log odds ratio of ``MIN_ODDS`` and a likelihood ratio statistic beyond
    what the number of entries tried would give by chance; the surest ``limit`` stay.
    """
    def distinct(texts):
        return [[sorted({e for w in set(tokens(t)) for e in entries(w)}) for t in texts]]

    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.max("text").alias("text"), F.max("label").alias("label"))
    words = map_columns(rows, ["text"], [field("words", T.ArrayType(STRING))], distinct, ["label"])
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = float(totals.get(1, 0)), float(totals.get(0, 0))
    counts = staged(words.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("label").cast("double").alias("t"), F.sum(1 - F.col("label")).cast("double").alias("c")), "toxic-words")
    tried = max(2, counts.count())
    t, c = F.col("t"), F.col("c")
    odds = F.log((t + 0.5) / (toxic + 0.5 - t)) - F.log((c + 0.5) / (clean + 0.5 - c))

    def part(seen, row, column):
        return F.when(seen > 0, seen * F.log(seen * (toxic + clean) / (row * column))).otherwise(0.0)

    has, lacks = t + c, (toxic + clean) - t - c
    ratio = 2 * (part(t, has, F.lit(toxic)) + part(c, has, F.lit(clean))
                 + part(toxic - t, lacks, F.lit(toxic)) + part(clean - c, lacks, F.lit(clean)))
    top = (counts.withColumn("odds", odds).withColumn("sure", ratio)
           .filter((F.col("odds") >= MIN_ODDS) & (F.col("sure") >= 2 * float(np.log(tried))))
           .orderBy(F.desc("sure"), "word").limit(limit))
    return {r["word"]: round(r["odds"], 6) for r in top.select("word", "odds").collect()}


def lexicon_weights(words: list[str], lexicon: dict[str, float], heads: frozenset[str]) -> dict[int, float]:
    """Place -> greatest weight of an entry that the word there matches."""
    out = {}
    for i, w in enumerate(words):
        if w[:2] in heads and (found := [lexicon[e] for e in entries(w) if e in lexicon]):
            out[i] = max(found)
    return out


def with_features(rows: DataFrame, text_col: str, carry: list[str], lexicon: dict[str, float]) -> DataFrame:
    """``carry`` plus the feature array of each text. One map, no shuffle."""
    heads = frozenset(e[:2] for e in lexicon)

    def run(texts):
        return [[features(t, lexicon, heads) for t in texts]]

    return map_columns(rows, [text_col], [field("features", T.ArrayType(DOUBLE))], run, carry)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          held_out: int = HELD_OUT, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``."""
    rest = id_remainder(id_col, held_out)
    known = (labels.filter((rest != 0) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label")))
    chosen = staged(hash_sample(known, "id", sample_docs), "toxic-sample")
    train = staged(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
                   .join(F.broadcast(chosen), "id").withColumn("fold", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4))),
                   "toxic-train")  # the sample is bounded
    share = train.agg(F.avg("label")).first()[0] or 0.0
    keyed = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text_"),
                        (rest == 0).alias("held_out"))
    folds = {(r["label"], r["fold"] == 0) for r in train.select("label", "fold").distinct().collect()}
    if not {(0, False), (1, False)} <= folds:
        flat = keyed.select(id_col, "held_out", F.lit(float(share)).alias("score"))
        return flat.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    lexicon = learn_lexicon(train.filter("fold <> 0").select("text", "label"))
    fitted = staged(with_features(train, "text", ["label", "fold"], lexicon), "toxic-features").select(
        F.col("label").cast("double").alias("label"), "fold", array_to_vector("features").alias("features"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=17, checkpointInterval=-1).fit(
        fitted.filter("fold <> 0"))

    def margins(rows):
        return trees.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1])

    tuning = fitted.filter("fold = 0") if {(0, True), (1, True)} <= folds else fitted
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(
        margins(tuning).select("margin", "label"))
    scored = with_features(keyed, "text_", [id_col, "held_out"], lexicon).withColumn("features", array_to_vector("features"))
    out = curve.transform(margins(scored))
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return out.select(id_col, "held_out", bounded.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return score(load_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
