"""Landed CSV files -> raw Parquet tables, with a load report (J-37, SRC-1..3, SNK-1, SNK-8).

Files are read with their header, every column as text, then cast *by name* to the
declared schema (``schemas.py``), so extra columns in a real export are ignored and a
missing declared column is an error instead of a silent shift. Listings and reviews have
free text with line breaks in quotes: their records are found range by range
(``records.py``) and parsed one by one, so a file is read by many tasks. The calendar and
the neighbourhoods are split like any text file. Output files are sized by bytes
(``rebalance``). Gzip files (``.csv.gz``) are read directly; they cannot be cut, so each is
one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rentalmart.operators import versions
from rentalmart.session import exists
from rentalmart.sources.records import records
from rentalmart.sources.schemas import RAW_TABLES

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}
FREE_TEXT = {"raw_listings", "raw_reviews"}  # inputs whose quoted fields may span lines


class MissingColumnError(ValueError):
    pass


def free_text_csv(spark: SparkSession, path: str, needed: list[str]) -> DataFrame:
    """All columns, as text, of a CSV file or folder whose quoted fields may span lines.

    The names come from the header of the first file; another file's header that has one of
    the ``needed`` columns in another place fails the read.
    """
    names = spark.read.options(**CSV_OPTIONS, multiLine=True).csv(path).columns  # reads the header only
    schema = StructType([StructField(n, StringType()) for n in names])
    options = {**CSV_OPTIONS, "multiLine": "true"}
    parsed = F.from_csv("record", schema.simpleString(), options)
    rows = records(spark, path).withColumn("is_header", (F.col("start") == 0) & (F.col("at") == 0))

    def same(r):
        return reduce(lambda x, y: x & y, [r[n] == n for n in needed], F.lit(True))

    # one call of the parser: a call for each column makes code too large to be compiled
    agrees = F.coalesce(F.exists(F.array(parsed), same), F.lit(False))
    other = F.raise_error(F.concat(F.lit("HeaderError: other columns than in the first file: "), "file"))
    body = rows.where(F.when(~F.col("is_header"), True).when(agrees, False).otherwise(other.cast("boolean"))) \
        .select(parsed.alias("r"))
    return body.select("r.*")


def read_csv(spark: SparkSession, path: str, schema: StructType, free_text: bool = True) -> DataFrame:
    """Read one landed CSV (file or folder) and cast it to ``schema`` by name; ``free_text``
    allows line breaks inside quotes."""
    plain = spark.read.options(**CSV_OPTIONS, multiLine=free_text).csv(path)  # plans, reads the header
    missing = [f.name for f in schema.fields if f.name not in plain.columns]
    if missing:
        raise MissingColumnError(f"{path}: missing columns {missing}")
    text = free_text_csv(spark, path, [f.name for f in schema.fields]) if free_text else plain
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """Write a frame as header CSV with RFC-4180 quoting (the format ``read_csv`` reads)."""
    (df.write.mode("overwrite").option("header", "true").option("quote", '"')
     .option("escape", '"').csv(path))


@dataclass
class LoadedTable:
    table: str
    rows: int
    cols: int
    skipped: bool


def landed(spark: SparkSession, folder: str, name: str) -> str | None:
    """``<folder>/<name>``, else ``<name>.gz``, else None: one input, by its exact name."""
    return next((p for p in (f"{folder}/{name}", f"{folder}/{name}.gz") if exists(spark, p)), None)


def load_raw(spark: SparkSession, landing: dict[str, str], out_dir: str,
             database: str | None = None) -> DataFrame:
    """Load every landed file to ``<out_dir>/<table>`` as Parquet. A table is replaced in one
    step (``versions``): a failed load leaves the one before.

    ``landing`` maps table name -> CSV path. With ``database`` the tables are catalog tables
    ``<database>.<table>`` (read later with ``spark.table``). A missing file is skipped and
    reported, as in the reference. Returns the load report: table, rows, cols, skipped.
    """
    report: list[LoadedTable] = []
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
                  f"LOCATION '{out_dir.rstrip('/')}/{database}.db'")
    for table, (_, schema) in RAW_TABLES.items():
        path = landing.get(table)
        if path is None or not exists(spark, path):
            report.append(LoadedTable(table, 0, 0, True))
            continue
        rows = read_csv(spark, path, schema, table in FREE_TEXT).hint("rebalance")
        if database:
            rows.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{table}")
            loaded = spark.table(f"{database}.{table}")
        else:
            loaded = versions.replace(spark, rows, f"{out_dir.rstrip('/')}/{table}")
        report.append(LoadedTable(table, loaded.count(), len(loaded.columns), False))
    return spark.createDataFrame(
        [(r.table, r.rows, r.cols, r.skipped) for r in report],
        "table string, rows long, cols int, skipped boolean")


def read_raw(spark: SparkSession, out_dir: str, table: str,
             database: str | None = None) -> DataFrame:
    if database:
        return spark.table(f"{database}.{table}")
    return versions.read(spark, f"{out_dir.rstrip('/')}/{table}")
