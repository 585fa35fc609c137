"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A dictionary is trained on blocks of each label's texts. A text is cut into
blocks, every block is compressed with either dictionary, and the difference of
the sizes over the whole text divided by their sum says which dictionary knows
more of it. A logistic curve, fitted on documents that the dictionaries have
not seen, maps that to the probability of label 1.

Fitting reads at most about ``SAMPLE_DOCS`` labelled documents outside the
held-out fifth, and at most about ``SAMPLE_BLOCKS`` blocks of each label for its
dictionary, all chosen by hash. One task trains a dictionary from those few
megabytes; the dictionaries (``DICTIONARY`` bytes each) and the curve go with the
map that scores every block of every document, without a shuffle. Labels,
language, source and id are never inputs of a score.

Defined results: a null or empty text has difference 0, and the score that
the curve gives to it; repeated rows are scored row by row; a label that is null
does not take part, of several labels of an id the greatest counts; if labels of one
class only (or none) are there to learn from, every score is that class's share (0
without labels); with too little text to train on, the text itself is the
dictionary. Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import functools

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, DOUBLE, INT, field, hash_sample, id_remainder, load_documents, map_columns, staged

HELD_OUT = 5
SAMPLE_DOCS = 20_000
SAMPLE_BLOCKS = 4_000
SAMPLE_BLOCK = 1024  # bytes of a block to train on
BLOCK = 2048  # bytes compressed at a time
DICTIONARY = 112_640
LEVEL = 3
THRESHOLD = 0.3


def blocks(text: str | None, size: int = BLOCK) -> list[bytes]:
    """The whole text as UTF-8, cut into blocks."""
    whole = (text or "").encode()
    return [whole[i:i + size] for i in range(0, len(whole), size)]


def build_dictionary(parts: list[bytes]) -> bytes:
    """A trained dictionary; with too little to train on, the text itself."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY:]


@functools.lru_cache(maxsize=8)
def _compressor(dictionary: bytes):
    import zstandard

    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    data = zstandard.ZstdCompressionDict(dictionary)  # trained, or else plain text
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def size_difference(text: str | None, good: bytes, bad: bytes) -> float:
    """(size with ``bad`` - size with ``good``) / (their sum), over all blocks; 0 for an empty text."""
    parts = blocks(text)
    with_good = sum(len(_compressor(good).compress(p)) for p in parts)
    with_bad = sum(len(_compressor(bad).compress(p)) for p in parts)
    return (with_bad - with_good) / (with_bad + with_good) if parts else 0.0


def learn_dictionaries(rows: DataFrame, sample_blocks: int = SAMPLE_BLOCKS) -> dict[int, bytes]:
    """Label -> dictionary from rows of (id, text, label), texts that are alike taken once."""
    once = rows.groupBy("label", F.xxhash64("text").alias("h")).agg(F.max("text").alias("text"))
    cut = map_columns(once, ["text"], [field("parts", T.ArrayType(BINARY))],
                      lambda texts: [[blocks(t, SAMPLE_BLOCK) for t in texts]], ["label", "h"])
    parts = staged(cut.select("label", "h", F.posexplode("parts").alias("place", "part")), "quality-blocks")
    counts = {r["label"]: r["count"] for r in parts.groupBy("label").count().collect()}
    spot = F.pmod(F.xxhash64("h", "place", F.lit(7)), F.lit(1 << 30))
    share = F.lit(0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1 << 30, int(sample_blocks / n * (1 << 30)))).otherwise(share)
    chosen = parts.filter(spot < share)

    def train(key, frame):
        import pandas as pd

        frame = frame.sort_values(["h", "place"])
        return pd.DataFrame({"label": [key[0]], "dictionary": [build_dictionary(list(frame["part"]))]})

    made = chosen.groupBy("label").applyInPandas(train, T.StructType([field("label", INT), field("dictionary", BINARY)]))
    return {r["label"]: bytes(r["dictionary"]) for r in made.collect()}


def with_difference(rows: DataFrame, text_col: str, carry: list[str], good: bytes, bad: bytes) -> DataFrame:
    """``carry`` plus the size difference of each text. One map, no shuffle."""
    return map_columns(rows, [text_col], [field("difference", DOUBLE)],
                       lambda texts: [[size_difference(t, good, bad) for t in texts]], carry)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          held_out: int = HELD_OUT, sample_docs: int = SAMPLE_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``."""
    rest = id_remainder(id_col, held_out)
    known = (labels.filter((rest != 0) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label")))
    chosen = staged(hash_sample(known, "id", sample_docs), "quality-sample")
    train = staged(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
                   .join(F.broadcast(chosen), "id").withColumn("fold", F.pmod(F.xxhash64("id", F.lit(12)), F.lit(4))),
                   "quality-train")  # the sample is bounded
    share = train.agg(F.avg("label")).first()[0] or 0.0
    keyed = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text_"),
                        (rest == 0).alias("held_out"))
    folds = {(r["label"], r["fold"] == 0) for r in train.select("label", "fold").distinct().collect()}
    if not {(0, False), (1, False)} <= folds:
        flat = keyed.select(id_col, "held_out", F.lit(float(share)).alias("score"))
        return flat.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    dictionaries = learn_dictionaries(train.filter("fold <> 0"))
    good, bad = (dictionaries.get(k, b"") for k in (1, 0))
    tuning = train.filter("fold = 0") if {(0, True), (1, True)} <= folds else train
    seen = staged(with_difference(tuning, "text", ["label"], good, bad), "quality-tuning").select(
        F.col("label").cast("double").alias("label"), array_to_vector(F.array("difference")).alias("features"))
    curve = LogisticRegression(maxIter=100, regParam=1e-4).fit(seen)
    slope, middle = float(curve.coefficients[0]), float(curve.intercept)
    scored = with_difference(keyed, "text_", [id_col, "held_out"], good, bad)
    return scored.select(id_col, "held_out", (1 / (1 + F.exp(-(F.col("difference") * slope + middle)))).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def op12_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return score(load_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
