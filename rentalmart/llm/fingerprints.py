"""Document fingerprints: one-permutation MinHash with optimal densification and b bits.

Every five-word shingle of a text is hashed once. The hash's top bits name one of ``BINS``
bins, the other bits are the value; a bin keeps its least value. An empty bin borrows from
the first non-empty bin in a random order of its own (the bins ranked by a hash of both
bins), which is optimal densification with a whole permutation as probe sequence. Of each
bin the lowest four bits are kept: one hexadecimal digit per bin.

Two fingerprints agree in a bin by chance once in 16, so the likeness is corrected:
(agreement - 1/16) / (1 - 1/16), at least 0.

All of it is array expressions on one row. Comparing a text with its neighbour in id order
needs the neighbour's text: rows are dealt to small id ranges, each with a copy of the next
range's first row, so no window runs over more than a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stats
from .common import stored

BINS = 128
WORDS = 5
BITS = 4  # one hexadecimal digit a bin
RANGES, LEAST_ROWS, MOST_ROWS = 4096, 500, 20_000  # id ranges wanted; rows in one
CUTS = 64  # quantiles of the id that even out clustered ids before equal-width ranges


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: BINS hexadecimal digits for column ``text`` (no nulls); the empty
    string for a text without words. Under five words the whole sequence is one shingle."""
    shift = 63 - (BINS.bit_length() - 1)  # the sign bit goes
    value = (1 << shift) - 1
    hashed = " , ".join(f"get(fp_w, i + {k})" for k in range(1, WORDS))
    return (
        stats.with_words(df, text).drop("t", "n_words").withColumnRenamed("w", "fp_w")
        .withColumn("fp_sorted", F.expr(f"""
            sort_array(if(size(fp_w) < {WORDS},
                          if(size(fp_w) = 0, array(), array(xxhash64(array_join(fp_w, ' ')) & {(1 << 63) - 1}L)),
                          transform(slice(fp_w, 1, size(fp_w) - {WORDS - 1}),
                                    (x, i) -> xxhash64(x, {hashed}) & {(1 << 63) - 1}L)))"""))
        .withColumn("fp_least", F.expr(f"""
            filter(fp_sorted, (x, i) -> i = 0 or shiftright(x, {shift}) != shiftright(get(fp_sorted, i - 1), {shift}))"""))
        .withColumn("fp_empty", F.expr(f"""
            if(size(fp_least) in (0, {BINS}), array(), array_except(sequence(0L, {BINS - 1}L),
               transform(fp_least, x -> shiftright(x, {shift}))))"""))
        .withColumn("fp_all", F.expr(f"""
            sort_array(concat(fp_least, transform(fp_empty, b -> shiftleft(b, {shift})
              | (get(fp_least, cast(array_min(transform(fp_least, (x, i) ->
                   (xxhash64(b, shiftright(x, {shift})) & {~(BINS - 1)}L) | i)) & {BINS - 1} as int)) & {value}L))))"""))
        .withColumn(name, F.expr("array_join(transform(fp_all, x -> lower(hex(x & 15L))), '')"))
        .drop("fp_w", "fp_sorted", "fp_least", "fp_empty", "fp_all")
    )


def likeness(a: Column, b: Column) -> Column:
    """Corrected share of equal bins, 0 to 1; two empty fingerprints are alike (1), an
    empty and another one are not (0)."""
    agree = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)),
                            lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))))
    chance = 1 / (1 << BITS)
    return (F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0)
            .otherwise(F.greatest(F.lit(0.0), (agree / BINS - chance) / (1 - chance))))


def _longs(values) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def with_range(docs: DataFrame, id_col: str, range_rows: int | None = None) -> DataFrame:
    """Adds ``part`` and ``range``, both rising as ids fall, in ranges of about even size:
    quantiles of the id (parts), then equal widths inside each. Null ids come last."""
    n, low, high = docs.agg(F.count("*"), F.min(id_col), F.max(id_col)).first()
    if low is None:
        return docs.withColumn("part", F.lit(1)).withColumn("range", F.lit(1).cast("long"))
    range_rows = range_rows or min(MOST_ROWS, max(LEAST_ROWS, n // RANGES))
    parts = max(1, min(CUTS, n // range_rows))
    inner = docs.agg(F.percentile_approx(id_col, [k / parts for k in range(1, parts)] or [0.0], 10000)).first()[0]
    cuts = sorted({low, *inner})
    per = max(1, -(-n // (len(cuts) * range_rows)))  # ranges inside a part
    step = [max(1, -(-(b - a) // per)) for a, b in zip(cuts, [*cuts[1:], high + 1])]
    i = F.col(id_col)
    part = sum(((i >= F.lit(c)).cast("int") for c in cuts[1:]), F.lit(0))
    return (docs.withColumn("part", F.coalesce(-part, F.lit(1)))
            .withColumn("range", F.coalesce(
                F.col("part") * F.lit(per).cast("long")
                - F.floor((i - F.get(_longs(cuts), -F.col("part"))) / F.get(_longs(step), -F.col("part"))).cast("long"),
                F.lit(per).cast("long"))))


def with_halo(docs: DataFrame, id_col: str, text_col: str, range_rows: int | None = None) -> DataFrame:
    """Adds ``range``, ``halo`` and ``tie``: each range, in descending id order, ends with a
    copy (halo) of the first row of the next range, the last one with that of the first."""
    ranged = with_range(docs, id_col, range_rows).withColumn("tie", F.xxhash64(text_col))
    heads = stored(ranged.groupBy("part", "range").agg(F.max(F.struct(F.coalesce(id_col, F.lit(0)).alias("i"), "tie")).alias("head")),
                   "range_heads")
    ends = sorted(tuple(r) for r in heads.groupBy("part").agg(F.min("range"), F.max("range")).collect())  # at most CUTS + 1
    before = {p: ends[k - 1][2] for k, (p, _, _) in enumerate(ends)}
    into = sum((F.when(F.col("part") == p, F.lit(r)).otherwise(0) for p, r in before.items()), F.lit(0).cast("long"))
    to = F.coalesce(F.lag("range").over(Window.partitionBy("part").orderBy("range")), into)
    heads = heads.select(F.col("range").alias("head_range"), F.col("head.i").alias("head_id"),
                         F.col("head.tie").alias("head_tie"), to.alias("to"))
    with_heads = ranged.join(heads, (F.col("range") == F.col("head_range")) & (F.col("tie") == F.col("head_tie"))
                             & (F.coalesce(id_col, F.lit(0)) == F.col("head_id")), "left")
    own = F.struct(F.col("range"), F.lit(False).alias("halo"))
    copy = F.struct(F.col("to").alias("range"), F.lit(True).alias("halo"))
    return (with_heads.withColumn("into", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, copy))))
            .withColumn("range", F.col("into.range")).withColumn("halo", F.col("into.halo"))
            .drop("into", "part", "to", "head_range", "head_id", "head_tie"))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 range_rows: int | None = None) -> DataFrame:
    """Per row: the id, n_chars, fingerprint; and of the edited text (its last floor(n/2)
    characters replaced by as many of the next document's first, in descending id order,
    after the last the first): edited_sha256, edited_fingerprint; and near_edited, near_next,
    the likeness of the fingerprint to that of the edited text and of the next document.

    A null text counts as empty. Rows with equal ids follow each other by a hash of the
    text. Null ids come after all others. A lone row is its own next document. Repeated rows
    stay; other columns are ignored; an empty table gives an empty result.
    """
    lean = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = Window.partitionBy("range").orderBy("halo", F.col("id").desc_nulls_last(), F.col("tie").desc())
    half = F.floor(F.col("n_chars") / 2).cast("int")
    pairs = (with_halo(lean, "id", "text", range_rows)
             .withColumn("next", F.coalesce(F.lead("text").over(order), F.lit("")))
             .withColumn("n_chars", F.length("text").cast("long"))
             .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                            F.substring("next", F.lit(1), half))))
    printed = with_fingerprint(with_fingerprint(pairs, "text", "fingerprint"), "edited", "edited_fingerprint")
    return (printed.withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "edited", "next")
            .withColumn("next_fingerprint", F.lead("fingerprint").over(order)).where("not halo")
            .select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")))
