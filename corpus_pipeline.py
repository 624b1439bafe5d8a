"""From raw documents to packed sequences: five stages, each one operator of ``streakline.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline.llm import line_dedup, packing, quality, secret_scan, simhash
from streakline.llm.common import documents, stored


def _with_text(df: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns of the documents, with the new text and its length."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("bigint")}
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.quality(docs).where("kept").select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more go; the documents stay, also without any line left."""
    return _with_text(line_dedup.drop_repeated_lines(docs, min_docs=10), docs.columns, "kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of three-word fingerprints within three bits stays."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    return _with_text(secret_scan.redact_secrets(docs, path="source"), docs.columns, "text")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its sequence and place."""
    return packing.packed_documents(docs, params=packing.PackParams(capacity=2048), end=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packed_sequences),
]

#: The outlier estimate, the forest and the genetic algorithm have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, name)
    return docs
