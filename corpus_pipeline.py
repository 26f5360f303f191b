"""The corpus pipeline: five stages from raw documents to packed training windows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next stage's docs; all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalmart.llm import classifier, line_dedup, ngram_join, packing, quality_rules
from rentalmart.llm.common import read, stored
from rentalmart.llm.queries import tokenizer

# Near-duplicates in the pipeline: five-word shingles, a similarity of 0.8.
WORDS, PERCENT = 5, 80


def _same_columns(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in like.columns])


def _rows_where(scored: DataFrame, condition: str, like: DataFrame) -> DataFrame:
    """The rows of ``scored`` for which ``condition`` holds, with the columns of ``like``.

    A plain filter would be pushed below the projections that compute the statistics, with
    their expressions put in place of every reference, so that each is computed many times
    over; an exploded array of no or one row is not.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in like.columns])
    kept = scored.select(F.explode(F.when(F.expr(condition), F.array(row))).alias("row"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in like.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = classifier.quality_scores(docs, read(spark, sf_dir, "labels"))
    return _rows_where(scored, "predicted = 1", docs)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ruled = quality_rules.quality_rules(docs, read(spark, sf_dir, "labels").where("quality = 1"))
    return _rows_where(ruled, "kept", docs)


def strip_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines; n_chars follows the text."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _same_columns(cleaned, docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the least id."""
    classes = ngram_join.similar(docs, k=WORDS, percent=PERCENT)
    gone = stored(classes.where("component_id != doc_id").select("doc_id").distinct(), "near_duplicates")
    return _same_columns(docs.join(gone, "doc_id", "left_anti"), docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in windows of 1024 tokens."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", keep_good),
    ("quality_rules", keep_by_rules),
    ("line_dedup", strip_boilerplate),
    ("ngram_join", keep_one_of_each_group),
    ("packing", pack_windows),
]

# SQL cannot train the classifier or run the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline_{name}")
    return docs
