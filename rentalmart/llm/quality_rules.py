"""Quality rules: hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are counted: one over a trusted target corpus, one over
the whole raw corpus. The target's is smoothed towards the raw one (``PRIOR`` n-grams dealt
out by the raw shares), so that a bucket without evidence has a ratio near 0 whatever the
sizes of the two corpora. A text's score is the mean over its n-grams of
log p_target(bucket) - log p_raw(bucket); a text is kept when the score reaches a fixed
threshold. The n-grams are single word ends and pairs of neighbouring word ends (the last
characters of a word, with its letter case), because in a corpus with an open vocabulary
whole words are too rare to tell the two corpora apart.

Everything is a DataFrame expression. Counting pre-aggregates per bucket before the shuffle,
so what reaches the driver is one row per bucket (``buckets`` rows, a parameter), and
scoring looks the buckets up in an array literal of that size. Both models count every
document they are about. Trusted ids become one bitmap per range of 32,768 ids, so documents
are marked by a broadcast of a bit per id and texts are not shuffled; ids that lie in more
than ``BITMAPS`` ranges are joined as they are.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from . import stats
from .common import number_literal

BUCKETS = 1 << 14
BITMAPS = 1 << 13  # bitmaps (of 4 KB) that are broadcast, at most
TAIL = 3  # characters of a word end
PRIOR = 1000.0  # n-grams of the raw corpus that the target model starts from
THRESHOLD = -0.15
MIN_WORDS = 10  # fewer words: the base rule fails the text
MAX_REPEAT_PERCENT = 20  # more repeated words than this: the base rule fails the text


def ngrams(w: str, buckets: int, tail: int = TAIL) -> Column:
    """Buckets of the n-grams of the word array column ``w``; none for no words."""
    ends = f"transform({w}, x -> right(x, {tail}))"
    return F.expr(f"""
        concat(transform({ends}, x -> cast(pmod(xxhash64(x), {buckets}) as int)),
               transform(slice({ends}, 1, greatest(size({w}) - 1, 0)),
                         (x, i) -> cast(pmod(xxhash64(x, right(get({w}, i + 1), {tail})), {buckets}) as int)))""")


def counts(docs: DataFrame, text_col: str, trusted: Column, buckets: int) -> tuple[list[int], list[int]]:
    """N-gram counts of the rows where ``trusted`` holds and of all rows, by bucket."""
    seen = (stats.with_words(docs.select(text_col, trusted.cast("long").alias("trusted")), text_col)
            .select("trusted", F.explode(ngrams("w", buckets)).alias("bucket"))
            .groupBy("bucket").agg(F.sum("trusted").alias("target"), F.count("*").alias("raw")))
    target, raw = [0] * buckets, [0] * buckets
    for b, t, r in seen.collect():  # at most ``buckets`` rows
        target[b], raw[b] = t, r
    return target, raw


def log_ratios(target: list[int], raw: list[int], prior: float = PRIOR) -> list[float]:
    """log p_target - log p_raw per bucket, with p_target = (target + prior * p_raw) / (total
    + prior); zero without any target, and for buckets that no document has."""
    t, r = sum(target), sum(raw)
    if not t:
        return [0.0] * len(raw)
    return [log((a * r / b + prior) / (t + prior)) if b else 0.0 for a, b in zip(target, raw)]


def score(ratios: list[float]) -> Column:
    """Mean log ratio of the n-grams of column ``w``; 0 for a text without words."""
    grams = ngrams("w", len(ratios))
    total = F.aggregate(grams, F.lit(0.0), lambda acc, b: acc + F.get(number_literal(ratios), b))
    return F.coalesce(total / F.greatest(F.lit(1), 2 * F.size("w") - 1), F.lit(0.0))


def with_trust(docs: DataFrame, good: DataFrame, id_col: str, bitmaps: int = BITMAPS) -> DataFrame:
    """Adds ``trusted``: whether the row's id is among the ids of ``good``."""
    ids = good.select(F.col(id_col).alias("good_id")).where("good_id is not null")
    whole = all(isinstance(t, (ByteType, ShortType, IntegerType, LongType))
                for t in (docs.schema[id_col].dataType, ids.schema["good_id"].dataType))
    ranges = F.bitmap_bucket_number(F.col("good_id").cast("long")).alias("range")
    if not whole or ids.select(ranges).distinct().count() > bitmaps:
        return (docs.join(ids.distinct(), F.col(id_col) == F.col("good_id"), "left")
                .withColumn("trusted", F.col("good_id").isNotNull()).drop("good_id"))
    marks = ids.groupBy(ranges).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("good_id").cast("long"))).alias("bits"))
    place = F.bitmap_bit_position(F.col(id_col).cast("long"))
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1))
    return (docs.join(F.broadcast(marks), F.bitmap_bucket_number(F.col(id_col).cast("long")) == F.col("range"), "left")
            .withColumn("trusted", F.coalesce(bit == 1, F.lit(False))).drop("range", "bits"))


def quality_rules(docs: DataFrame, good: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
                  buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    llr (the mean log ratio) and kept.

    ``good`` has the ids of the trusted documents; the texts of all of them are the target
    corpus, all rows are the raw corpus. A null text has no words and fails the base rule, as does any
    text under ``MIN_WORDS`` words; without trusted documents every ratio is 0 and only the
    base rule decides. Repeated rows are scored alike, each counts. Columns of ``docs`` with
    the names above are replaced, other columns stay. An empty table gives an empty result.
    """
    lean = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    target, raw = counts(with_trust(lean, good.select(F.col(id_col).alias("id")), "id"),
                         "text", F.col("trusted"), buckets)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    scored = (stats.with_base(stats.with_words(row, "text"))
              .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
              .withColumn("llr", score(log_ratios(target, raw))))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr"]
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in [*added, "kept"]], *added,
                         (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"))
