"""The registered query of each text operator: whole tables in, the operator's result out."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_job, classifier, exact_dedup, filter_audit, fingerprints, html_template, line_dedup, merkle, ngram_join,
               packing, pseudo_lm, quality_rules, shards)
from .common import read
from .oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

def tokenizer(name: str, folder: str | None = None) -> str:
    """A tokenizer's file: one of the public ones, or one in ``folder``."""
    return Path(folder, name).read_text(encoding="utf-8") if folder else Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.minimax_shards(read(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(read(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read(spark, sf_dir, "labels").where("quality = 1")
    out = quality_rules.quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text"), good)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "llr", "kept")


def op5_pseudo_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_lm.scores(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return out.drop("ids", "queue")


def op7_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(read(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).drop("source")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_job.digests(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return classifier.quality_scores(docs, read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.checked(read(spark, sf_dir, "documents"), {"n_chars": F.when(hit, F.col("n_chars") + 1)})


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_minimax_shards, op2_ngram_join, op3_fingerprints, op4_quality_rules, op5_pseudo_lm, op6_packing,
    op7_html_template, op8_line_dedup, op9_bpe, op10_quality_classifier, op11_merkle_manifest,
    op12_exact_dedup, op13_filter_audit)}
