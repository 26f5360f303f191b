"""Records of quoted CSV files, read by many tasks a file.

A quoted field may hold line breaks, so a line is a record only where it starts outside
quotes. Whether it does follows from the number of quotes before it: every quote, also each
half of an escaped one, flips inside and outside. So a file is read as the byte ranges that
Spark cuts it into:

1. One scan counts the quotes of every range (one row per range); the parity of all ranges
   before it says whether a range starts inside quotes.
2. Each range joins its own lines to records. What it has of a record that starts before it
   or ends after it is a fragment: two a range at most, or the whole range where one field
   covers it.
3. The fragments of a file, in order, are joined to the records that cross ranges.

No range is read as a whole by the driver and no file by one task. Files follow RFC 4180: a
quote stands only around a field, and doubled inside one. A stray quote makes records of the
wrong number of fields, which the parser refuses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentalmart.session import discard_at_exit, fresh_path

RANGE = ["file", "start"]
OPEN_RANGES = 100_000  # ranges that start inside quotes that are broadcast, at most


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (first byte of the range), line and quotes, in the order of the range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"), F.expr("length(value) - length(replace(value, '\"', ''))").alias("quotes"))


def ranges(lines: DataFrame) -> DataFrame:
    """Per range: starts_open and ends_open, whether its first and last byte are inside quotes."""
    odd = lines.groupBy(*RANGE).agg((F.sum("quotes") % 2).alias("odd"))
    upto = Window.partitionBy("file").orderBy("start")  # one row per range of a file
    ends = odd.withColumn("ends_open", F.sum("odd").over(upto) % 2 == 1)
    return ends.select(*RANGE, "ends_open", (F.col("ends_open") != (F.col("odd") == 1)).alias("starts_open"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of ranges that come one after another, numbered in each range; kind 0 is a
    whole record, 1 the start of one, 2 the end of one, 3 a range inside one.

    A batch's lines of one range are joined at once: where the count of quotes so far is even
    a record ends, and lines that are records by themselves are passed on as they are."""
    key, held, is_open, begun, at = None, [], False, True, 0
    for batch in batches:
        file, start = batch.column("file"), batch.column("start").to_numpy(zero_copy_only=False)
        moved = pc.not_equal(file.slice(1), file.slice(0, max(0, len(file) - 1))).to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero(moved | (start[1:] != start[:-1])) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            if low == high:
                continue
            if (here := (file[int(low)].as_py(), int(start[low]))) != key:
                if held:
                    yield _table(key, at, ["\n".join(held)], [1 if begun else 3])
                starts_open = batch.column("starts_open")[int(low)].as_py()
                key, held, is_open, begun, at = here, [], starts_open, not starts_open, 0
            lines = batch.column("line").slice(low, high - low)
            quotes = batch.column("quotes").slice(low, high - low).to_numpy(zero_copy_only=False)
            open_after = (np.cumsum(quotes & 1) + is_open) & 1
            ends = np.flatnonzero(open_after == 0) + 1
            is_open = bool(open_after[-1])
            if len(ends):
                first, rest = int(ends[0]), int(ends[-1])
                texts = lines.slice(0, rest)
                if len(ends) != rest:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), texts), "\n")
                if held:
                    head = "\n".join([*held, *lines.slice(0, first).to_pylist()])
                    texts = pa.concat_arrays([pa.array([head], texts.type), texts.slice(1)])
                kinds = np.zeros(len(ends), np.int32)
                kinds[0] = 0 if begun else 2
                blank = pc.is_in(texts, pa.array(["", "\r"], texts.type)).to_numpy(zero_copy_only=False) & (kinds == 0)
                if blank.any():
                    texts, kinds = texts.filter(pa.array(~blank)), kinds[~blank]
                yield _table(key, at, texts, kinds)
                at, held, begun, lines = at + len(kinds), [], True, lines.slice(rest)
            held += lines.to_pylist()
    if held:
        yield _table(key, at, ["\n".join(held)], [1 if begun else 3])


def _table(key: tuple[str, int], at: int, records, kinds) -> pa.RecordBatch:
    n = len(kinds)
    records = records if isinstance(records, pa.Array) else pa.array(records, pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(key[0], pa.string()), n), pa.repeat(pa.scalar(key[1], pa.int64()), n),
         pa.array(np.arange(at, at + n)), pa.array(kinds, pa.int32()), records.cast(pa.string())],
        names=["file", "start", "at", "kind", "record"])


def _assembled(lines: DataFrame, some: DataFrame, how: str, broadcast: bool) -> DataFrame:
    """The joined lines of the ranges in ``some`` (with ``how="left"``, of all ranges)."""
    if broadcast:
        met = lines.join(F.broadcast(some), RANGE, how)
    else:  # shuffled by range, so each range's lines are put in order again
        met = (lines.withColumn("place", F.monotonically_increasing_id()).join(some.hint("merge"), RANGE, how)
               .repartition(*RANGE).sortWithinPartitions(*RANGE, "place"))
    return (met.select(*RANGE, "line", "quotes", F.coalesce("starts_open", F.lit(False)).alias("starts_open"))
            .mapInArrow(_joined, "file string, start long, at long, kind int, record string"))


def records(spark: SparkSession, path: str, open_ranges: int = OPEN_RANGES) -> DataFrame:
    """file, start, at and record: every record of the file, or of the files in the folder,
    ``path``, with its line breaks; (start, at) is its order in the file, (0, 0) the first.

    Line breaks in quotes are kept as they are. Blank lines between records are left out. A record whose quotes are never closed ends
    with its file.
    """
    lines = _lines(spark, path)
    where = fresh_path(spark, "crossing_ranges")
    ranges(lines).where("starts_open or ends_open").write.parquet(where)  # at most a row per range
    crossing = spark.read.parquet(discard_at_exit(spark, where))
    small = crossing.count() <= open_ranges
    out = _assembled(lines, crossing.where("starts_open").select(*RANGE, "starts_open"), "left", small)
    columns = [*RANGE, "at", "record"]
    found = out.where("kind = 0").select(*columns)
    if not crossing.isEmpty():
        parts = _assembled(lines, crossing.select(*RANGE, "starts_open"), "inner", small).where("kind != 0")
        begins = F.col("kind") == 1
        # in a range the end of a record comes before the start of the next; two rows a range at most
        upto = Window.partitionBy("file").orderBy("start", begins)
        whole = (parts.withColumn("number", F.sum(begins.cast("long")).over(upto)).groupBy("file", "number")
                 .agg(F.sort_array(F.collect_list(F.struct("start", "at", "record"))).alias("parts"))
                 .select("file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["at"].alias("at"),
                         F.concat_ws("\n", "parts.record").alias("record")))
        found = found.unionByName(whole)
    ended = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return found.select(*RANGE, "at", ended.alias("record"))
