"""Exact dedup: rows grouped by a 128-bit hash of their content, bytes compared inside groups.

Texts are equal when they are identical without white space. Three steps:

1. One scan takes each text's 128-bit hash, digest, length and id (no texts are kept), and
   rows are counted per hash.
2. The bytes of every hash that has two rows or more are compared: (hash, text) is a grouping
   key, which Spark compares byte by byte, and copies in one task become one row before
   anything is shuffled, so the largest group of copies costs one text a task. Rows whose
   hash stands alone are passed over by a bitmap of fixed size (its false positives are
   compared for nothing and change nothing). A hash with two different texts is a collision:
   its texts are numbered from 1, and the number becomes part of the group's key.
3. Per group the row that stays is an aggregate of lean rows, joined back to all of them;
   groups that hold more than a small part of all rows are broadcast instead of shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .hot_groups import join_groups

BITS = 1 << 25  # of the bitmap of repeated hashes: 4 MB at any size of input
HASH = ["h1", "h2"]
# Fixed: what does not count in a comparison, as a Java regular expression.
IGNORED = r"[\x20\x09-\x0D]+"


def content_hash(text: Column) -> list[Column]:
    """128 bits in two longs: the halves of the MD5 of the text's UTF-8 bytes."""
    md5 = F.md5(text.cast("binary"))
    return [F.conv(F.substring(md5, start, 16), 16, -10).cast("long") for start in (1, 17)]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), IGNORED, "")


def collided(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """The hashes that more than one different text has. ``texts`` has the hash and ``same``
    (the text), ``counts`` the hash and ``group_size``."""
    place = F.pmod(F.col("h1"), F.lit(BITS)) + 1  # bitmaps count from 1
    repeated = (counts.where("group_size > 1").groupBy(F.bitmap_bucket_number(place).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")))  # at most BITS bits
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    seen = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    candidates = texts.join(F.broadcast(repeated), F.bitmap_bucket_number(place) == F.col("bucket")).where(seen)
    return (candidates.select(*HASH, "same").distinct()
            .groupBy(*HASH).agg(F.count("*").alias("n")).where("n > 1").select(*HASH))


def exact_dedup(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", hashed=content_hash) -> DataFrame:
    """Per row: the id, keep_id (the id of the row of its group that stays), group_size (long),
    kept, text_sha256 (of the text without white space) and n_chars (code points of the text).

    Of a group the row with the most code points stays, then the one with the smallest id; a
    null id comes last, and of rows alike in both exactly one is kept. A null text counts as
    empty; all texts of white space alone are one group. Other columns are ignored; an empty
    table gives an empty result. ``hashed`` gives the two longs of a text's hash.
    """
    same = normalised(F.col(text_col))
    h1, h2 = hashed(F.col("same"))
    texts = (docs.select(F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_chars"),
                         same.alias("same"))
             .withColumns({"h1": h1, "h2": h2}))
    lean = stored(texts.select("id", "n_chars", *HASH, F.unhex(F.sha2("same", 256)).alias("digest"),
                               F.lit(0).alias("variant"), F.monotonically_increasing_id().alias("row")), "content_hashes")
    counts = stored(lean.groupBy(*HASH).agg(F.count("*").alias("group_size")), "content_counts")
    met = stored(collided(texts, counts), "collisions")
    if not met.isEmpty():
        apart = texts.withColumn("row", F.monotonically_increasing_id()).join(met, HASH, "left_semi")
        variants = (apart.select(*HASH, "same").distinct()
                    .withColumn("variant", F.row_number().over(Window.partitionBy(*HASH).orderBy("same"))))
        numbered = (apart.join(variants, [*HASH, "same"])
                    .withColumn("digest", F.unhex(F.sha2("same", 256))).select(*lean.columns))
        lean = stored(lean.join(met, HASH, "left_anti").select(*lean.columns).unionByName(numbered), "content_variants")
    key = [*HASH, "variant"]
    first = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("id").isNull().alias("no_id"), "id", "row"))
    groups = stored(lean.groupBy(*key).agg(F.count("*").alias("group_size"), first.alias("first"))
                    .select(*key, "group_size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row")),
                    "content_groups")
    out = join_groups(lean, groups, key, "group_size", lean.count())
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"), "n_chars")
