"""Statistics of whole texts, as DataFrame expressions (one row in, one row out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, words

# Fixed: characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def _kept(column: str, pattern: str):
    """How many characters are left when those that match ``pattern`` are taken out."""
    return F.length(F.regexp_replace(column, pattern, "")).cast("long")


def with_words(df: DataFrame, text_col: str) -> DataFrame:
    """Adds t (the text, a null one empty), w (its words) and n_words."""
    return (df.withColumn("t", F.coalesce(F.col(text_col), F.lit("")))
            .withColumn("w", words(F.col("t")))
            .withColumn("n_words", F.size("w").cast("long")))


def with_base(df: DataFrame) -> DataFrame:
    """Adds word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words, from t and w.

    n_repeat_words counts the words inside five-word windows found twice or more: the
    windows' hashes carry their position in the low bits (just enough for the text), so one
    sort puts equal windows side by side and keeps where they were.
    """
    return (
        df.withColumn("word_chars", _kept("t", SPACES))
        .withColumn("n_symbols", _kept("t", f"[^{SYMBOLS}]+"))
        .withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)))
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("lines")))
        .withColumn("high", F.expr("shiftleft(-1L, length(bin(n_words)))"))
        .withColumn("found", F.expr("""
            if(n_words < 6, array(), sort_array(transform(slice(w, 1, cast(n_words as int) - 4),
               (x, i) -> (xxhash64(x, get(w, i + 1), get(w, i + 2), get(w, i + 3), get(w, i + 4)) & high) | i)))"""))
        .withColumn("at", F.expr("""
            sort_array(transform(filter(found, (x, i) ->
                (i > 0 and (x & high) = (get(found, i - 1) & high))
                or (i < size(found) - 1 and (x & high) = (get(found, i + 1) & high))), x -> x & ~high))"""))
        .withColumn("n_repeat_words", F.expr("""
            aggregate(transform(at, (p, i) -> if(i = size(at) - 1, 5L, least(5L, get(at, i + 1) - p))),
                      0L, (a, b) -> a + b)"""))
        .drop("lines", "high", "found", "at")
    )


def with_shape(df: DataFrame) -> DataFrame:
    """Adds the ratios that the quality classifier looks at, from t, w and the base counts.
    A text without words has zero ratios."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return (
        df.withColumn("log_words", F.log1p(F.col("n_words").cast("double")))
        .withColumn("word_length", F.col("word_chars") / n)
        .withColumn("symbols", F.col("n_symbols") / n)
        .withColumn("dup_lines", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)))
        .withColumn("repeats", F.col("n_repeat_words") / n)
        .withColumn("distinct", F.size(F.array_distinct("w")) / n)
        .withColumn("upper", _kept("t", r"[^\p{Lu}]+") / chars)
        .withColumn("digits", _kept("t", r"[^\p{Nd}]+") / chars)
        .withColumn("bangs", _kept("t", r"[^!?]+") / n)
        .withColumn("bars", _kept("t", r"[^|]+") / n)
        .withColumn("stops", _kept("t", r"[^.,;:]+") / n)
        .withColumn("marks", _kept("t", r"[\p{L}\p{M}\p{N}\s.,;:!?#*$%&|<>]+") / n)
        .withColumn("lines_per_word", F.col("n_lines") / n)
        .withColumn("longest", F.coalesce(F.array_max(F.transform("w", F.length)), F.lit(0)).cast("double"))
    )


#: The ratios of ``with_shape``, in order.
SHAPE = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "digits",
         "bangs", "bars", "stops", "marks", "lines_per_word", "longest"]
