"""Corpus pipeline: quality rules, near-dedup, secret scan, source mix and packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the next frame. ``run`` applies them to ``documents``, each result
written as Parquet in the shared folder and read back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smoglake.llm.common import load_documents, staged
from smoglake.llm.mixing import mixed
from smoglake.llm.near_dedup import keep_one
from smoglake.llm.packing import pack
from smoglake.llm.quality import keep_good
from smoglake.llm.secrets import redact


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and n_chars brought up to date."""
    return redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 rows)."""
    return mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences. Each row of docs is packed by itself."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near dedup", dedup_stage),
    ("secret scans", secrets_stage),
    ("source mix", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the outlier test nor packing; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
