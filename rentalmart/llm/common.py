"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalmart.session import discard, discard_at_exit, fresh_path

# Fixed: the separators between words, as a Java regular expression.
SPACES = r"[\x20\x09-\x0D]+"
# Fixed: the same separators, one or more, around anything that is a word.
WORD = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """The words of a text (runs without ASCII white space); none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost
    executors. The files go when the application ends (or earlier, with ``drop``)."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    discard_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    discard(df.sparkSession, df.stored_path)


def number_literal(values) -> Column:
    """A double array literal of any length (one parsed constant, not one per element)."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")
