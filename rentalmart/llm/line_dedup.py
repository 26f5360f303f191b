"""Line dedup: boilerplate lines by distinct-site spread.

A line that many different sites carry is boilerplate. For each line's hash, a HyperLogLog
sketch of its sites merges by aggregation (partly before the shuffle, so a line that a third
of all documents carry costs a row per task). Lines with an estimate near the threshold get
an exact distinct count before anything is removed.

Copies of a document also bring its lines to many sites, so a content counts once, at the
site of the row with the least id: copies are told by a hash of the whole text, and their
rows are marked without moving any text. Boilerplate goes from copies too. Of every
boilerplate line the first occurrence, by document id, stays, so no text is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, stored
from .hot_groups import join_groups
from .quality_rules import with_trust

SITES = 10  # sites from which a line is boilerplate
MIN_WORDS = 1  # lines with fewer words are none
LG_K = 10  # sketches of 2^LG_K registers: a standard error of about 3 %
NEAR = 0.15  # estimates this near the threshold are counted exactly


def _lines(min_words: int) -> Column:
    """(pos, k1, k2) of each line in ``lines`` that has enough words; k1 and k2 are its key."""
    enough = WORD + (f"+({SPACES}{WORD}+)" + f"{{{min_words - 1}}}" if min_words > 1 else "")
    return F.filter(F.expr("transform(lines, (x, i) -> struct(i as pos, xxhash64(trim(x)) as k1, hash(trim(x)) as k2, x as line))"),
                    lambda s: s["line"].rlike(enough))


def copies(docs: DataFrame) -> DataFrame:
    """The ids of rows whose whole text a row with a smaller id has too. ``docs`` has id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    same = ["h1", "h2"]
    lean = stored(docs.where("id is not null").select("id", F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2")),
                  "content_hashes")
    groups = stored(lean.groupBy(*same).agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
                    .where("copies > 1"), "content_groups")
    return join_groups(lean, groups, same, "copies", lean.count()).where("id > first_id").select("id").distinct()


def boilerplate(docs: DataFrame, *, text_col: str = "text", site_col: str = "source", id_col: str = "doc_id",
                sites: int = SITES, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lines of all rows: id, site, copy, text_hash, pos, k1, k2; the keys of boilerplate with
    n_sites and its first occurrence). A null site is no site."""
    lean = docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marked = with_trust(lean, stored(copies(lean), "copies"), "id").withColumnRenamed("trusted", "copy")
    lines = (marked.select("id", "site", "copy", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
             .select("id", "site", "copy", "text_hash", F.explode(_lines(min_words)).alias("l"))
             .select("id", "site", "copy", "text_hash", "l.pos", "l.k1", "l.k2"))
    counted = lines.withColumn("site", F.when(~F.col("copy"), F.col("site")))
    spread = stored(counted.groupBy("k1", "k2")
                    .agg(F.count("*").alias("n"), F.min(F.struct("id", "pos")).alias("first"),
                         F.hll_sketch_agg("site", LG_K).alias("sites"))
                    .where(F.col("n") >= sites)
                    .select("k1", "k2", "first", F.hll_sketch_estimate("sites").alias("n_sites"))
                    .where(F.col("n_sites") >= sites * (1 - NEAR)), "line_spread")
    near = spread.where(F.col("n_sites") <= sites * (1 + NEAR))
    exact = (counted.where("site is not null").join(near.select("k1", "k2"), ["k1", "k2"], "left_semi")
             .select("k1", "k2", "site").distinct().groupBy("k1", "k2").agg(F.count("*").alias("exact_sites")))
    found = (spread.join(exact, ["k1", "k2"], "left")
             .withColumn("n_sites", F.coalesce("exact_sites", F.when(F.col("n_sites") > sites * (1 + NEAR), F.col("n_sites")), F.lit(0)))
             .where(F.col("n_sites") >= sites).select("k1", "k2", "first", "n_sites"))
    return lines, stored(found, "boilerplate")


def dedup_lines(docs: DataFrame, *, text_col: str = "text", site_col: str = "source", id_col: str = "doc_id",
                sites: int = SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and n_lines, n_removed.

    A line is compared without surrounding spaces; a line without a word is never boilerplate.
    The first occurrence of a boilerplate line (least id, then position) stays. A null text
    stays null; rows with equal ids are copies or not together, and repeated rows are treated
    alike; a row without an id is never a copy, and comes first; a text of boilerplate only
    becomes empty, its row stays. An existing n_lines or n_removed is replaced, other columns
    stay. An empty table gives an empty result.
    """
    lines, found = boilerplate(docs, text_col=text_col, site_col=site_col, id_col=id_col, sites=sites, min_words=min_words)
    is_first = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.pos") == F.col("pos"))
    gone = (lines.join(found, ["k1", "k2"]).where(~is_first)
            .groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone"))
            .withColumnsRenamed({"id": "gone_id", "text_hash": "gone_hash"}))
    text = F.col(f"row.`{text_col}`")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    joined = row.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left") \
        .withColumn("lines", F.split(text, "\n")).withColumn("kept", F.expr("""
            if(gone is null, lines, transform(array_except(sequence(0, size(lines) - 1), gone), i -> get(lines, i)))"""))
    added = ["n_lines", "n_removed"]
    return joined.select(
        *[F.array_join("kept", "\n").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
          for c in docs.columns if c not in added],
        F.greatest(F.size("lines"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).alias("n_removed"))
