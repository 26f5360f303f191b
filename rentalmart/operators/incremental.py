"""Incremental append of rows with unseen keys (SNK-4..SNK-7).

Semantics kept from the reference:

* first run (target missing): the whole batch is written;
* later runs: only rows whose key is not yet in the target are appended, so the **first
  version wins** (a changed row with a known key is ignored);
* **duplicates inside one batch are kept** (no distinct), and nothing enforces uniqueness;
* a batch whose columns or types differ from the target's **fails** the run.

Plan: ``batch LEFT ANTI JOIN target_keys`` (explicit; Spark does not turn LEFT JOIN +
IS NULL, or a two-column NOT IN, into an anti-join by itself - the latter becomes a
nested-loop join). Keys are matched null-safely, so a replay appends nothing, also for rows
with a NULL key part. Rows match on the keys alone. How much of the target is read:

* where the storage partition is a function of the keys (the month of a date key), the
  partition values of the batch;
* otherwise the files whose key filter (``key_filters``, written with each append) says that
  they may have a key of the batch, so a batch of new keys reads none. A batch with more
  keys than can be sent to the filters reads every file's key column.

A target folder is a table of whole commits (``versions``): an append is visible at once or
not at all. If another writer commits first, the rows written are matched against what it
appended before the next try, so two appends at once leave no key from both. Catalog tables
are appended by Spark's own committer.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rentalmart.operators import key_filters, versions
from rentalmart.session import discard


class SchemaChangeError(RuntimeError):
    """The batch's schema differs from the target table's (on_schema_change = fail)."""


@dataclass
class AppendResult:
    target: str
    mode: str  # "full" on the first run, "append" afterwards
    files_read: int | None = None  # whose keys were read, where key filters decide it


def is_table_name(target: str) -> bool:
    """A catalog table (``db.name`` / ``name``) rather than a storage path."""
    return "/" not in target and ":" not in target


def _shape(schema: StructType, skip: str | None) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name != skip]


def _check_schema(target: str, known: StructType, batch: DataFrame, partition_col: str | None) -> None:
    if _shape(known, partition_col) != _shape(batch.schema, partition_col):
        raise SchemaChangeError(f"schema of batch {_shape(batch.schema, partition_col)} differs from target "
                                f"{target}: {_shape(known, partition_col)}")


def _unseen(batch: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    seen = seen.select(*[F.col(k).alias(f"seen_{k}") for k in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"seen_{k}")) for k in keys])
    return batch.join(seen, same, "left_anti").select(*batch.columns)


def _same_partitions(existing: DataFrame, batch: DataFrame, partition_col: str) -> DataFrame:
    # One value per month in the batch, also NULL: a short list at any batch size.
    values = [r[0] for r in batch.select(partition_col).distinct().collect()]
    part = F.col(partition_col)
    return existing.where(part.isin([v for v in values if v is not None])
                          | (part.isNull() if None in values else F.lit(False)))


def append_new(spark: SparkSession, batch: DataFrame, target: str, keys: list[str],
               partition_col: str | None = None, partition_expr: Column | None = None,
               buckets: tuple[int, str] | None = None) -> AppendResult:
    """Append the rows of ``batch`` whose ``keys`` are not in ``target``.

    ``target`` is a catalog table name (``db.table``; existence via the catalog, writes via
    ``saveAsTable``) or a folder. ``partition_col``/``partition_expr`` name and compute the
    storage partition, which must be a function of the keys (e.g. ``trunc(date, 'month')`` of
    a date key); ``read_table`` drops that column again. ``buckets`` (a number and a column)
    buckets a catalog table.
    """
    rows = batch if partition_col is None else batch.withColumn(partition_col, partition_expr)
    if is_table_name(target):
        return _append_to_catalog(spark, rows, target, keys, partition_col, buckets)
    target = target.rstrip("/")
    version = versions.current(spark, target)
    mode, files, tries = "full", None, []
    if version is not None:
        _check_schema(target, version.schema, rows, partition_col)
        mode, (rows, files) = "append", _new_rows(spark, rows, target, version, keys, partition_col)
    kept = None
    try:
        while kept is None:
            folder = versions.new_folder()
            tries.append(folder)
            _writer(rows, partition_col).save(f"{target}/{folder}")
            written = spark.read.schema(versions.as_stored(rows.schema)).parquet(f"{target}/{folder}")
            if mode == "append" and written.isEmpty():
                break
            index = None
            if partition_col is None:
                index = versions.new_folder(versions.KEYS)
                tries.append(index)
                key_filters.build(written, keys).write.parquet(f"{target}/{index}")
            mine = versions.Version((version.number if version else 0) + 1, versions.as_stored(rows.schema),
                                    {**(version.folders if version else {}), folder: index})
            if versions.commit(spark, target, mine):
                kept = {folder, index}
                break
            # another writer was first: leave out what it appended, and try again on top of it
            newer = versions.current(spark, target)
            _check_schema(target, newer.schema, rows, partition_col)
            known = version.folders if version else {}
            theirs = {f: k for f, k in newer.folders.items() if f not in known}
            rows = _unseen(written, versions.read(spark, target, versions.Version(newer.number, newer.schema, theirs)), keys)
            mode, version = "append", newer
    finally:
        for name in tries:
            if not kept or name not in kept:
                discard(spark, f"{target}/{name}")
    return AppendResult(target, mode, files)


def _new_rows(spark: SparkSession, rows: DataFrame, target: str, version: versions.Version, keys: list[str],
              partition_col: str | None) -> tuple[DataFrame, int | None]:
    """The rows with unseen keys, and how many files' keys that reads (None: not by filters)."""
    if partition_col is not None:
        return _unseen(rows, _same_partitions(versions.read(spark, target, version), rows, partition_col), keys), None
    indexes = {k: f for f, k in version.folders.items() if k}
    hashes = key_filters.batch_hashes(rows, keys) if indexes else None
    if hashes is None:
        return _unseen(rows, versions.read(spark, target, version), keys), None
    filters = spark.read.schema(key_filters.SCHEMA).parquet(*[f"{target}/{k}" for k in indexes]).withColumn(
        "folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    hits = key_filters.hit(filters, hashes).select("folder", "file").collect()  # names, one a file at most
    paths = [f"{target}/{indexes[r.folder]}/{r.file}" for r in hits]
    paths += [f"{target}/{f}" for f, k in version.folders.items() if not k]
    if not paths:
        return rows, 0
    return _unseen(rows, spark.read.schema(version.schema).parquet(*paths), keys), len(paths)


def _writer(rows: DataFrame, partition_col: str | None) -> DataFrameWriter:
    # Files sized by bytes; with a storage partition, about one file per value (a hot
    # value is split into several) instead of one per (task, value).
    rows = rows.hint("rebalance", *([partition_col] if partition_col is not None else []))
    w = rows.write.format("parquet")
    return w.partitionBy(partition_col) if partition_col is not None else w


def _append_to_catalog(spark: SparkSession, rows: DataFrame, target: str, keys: list[str],
                       partition_col: str | None, buckets: tuple[int, str] | None) -> AppendResult:
    mode = "full"
    if spark.catalog.tableExists(target):
        mode, existing = "append", spark.table(target)
        _check_schema(target, existing.schema, rows, partition_col)
        if partition_col is not None:
            existing = _same_partitions(existing, rows, partition_col)
        rows = _unseen(rows, existing, keys)
    w = _writer(rows, partition_col)
    (w.bucketBy(*buckets) if buckets else w).mode("append").saveAsTable(target)
    return AppendResult(target, mode)


def read_table(spark: SparkSession, target: str,
               partition_col: str | None = None) -> DataFrame:
    df = spark.table(target) if is_table_name(target) else versions.read(spark, target.rstrip("/"))
    return df.drop(partition_col) if partition_col else df


def first_versions(batches: list[DataFrame], keys: list[str]) -> DataFrame:
    """What appending ``batches`` in order to a new table leaves, as a plan that writes
    nothing: of every key the rows of the first batch that has it.

    A batch is matched against the keys of those before it, so the first one moves nothing,
    and a task holds no more than the sorted rows of one match. Meant for a few batches: each
    is read again for every later one.
    """
    out = batches[0]
    for k, batch in enumerate(batches[1:], 1):
        seen = reduce(DataFrame.unionByName, [b.select(*keys) for b in batches[:k]])
        out = out.unionByName(_unseen(batch, seen, keys))
    return out
