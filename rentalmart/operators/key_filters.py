"""Bloom filters of the keys in each file of a table, and which files a batch can be in.

A filter has BITS bits for every key of its file, so its false positives are a few in a
million keys whatever the file's size; a file is bounded, and so is its filter. The filters
are a table of their own, one row per file. A batch's key hashes (a bounded number) are
sent to the filters' tasks, which name the files that some key of the batch may be in; only
their key columns have to be read. A filter never misses a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, PROBES = 32, 8  # per key
SCHEMA = "file string, n long, bits binary"
PROBED_KEYS = 1 << 22  # different keys of a batch that are sent out: 32 MB


def key_hash(keys: list[str]) -> Column:
    """Equal keys have equal hashes, also where parts are null."""
    return F.xxhash64(*keys)


def _place(h: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """The bit of each hash in one probe."""
    step = (h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    return (((h + step * np.uint64(probe)) >> np.uint64(7)) % np.uint64(bits)).astype(np.int64)


def build(files: DataFrame, keys: list[str]) -> DataFrame:
    """file (its name), n (its different keys) and bits, for each file that ``files`` is read from."""

    def run(table: pa.Table) -> pa.Table:
        hashes = np.unique(table["h"].to_numpy())
        size = max(64, -(-len(hashes) * BITS // 8) * 8)
        marks = np.zeros(size, np.uint8)
        for probe in range(PROBES):
            marks[_place(hashes.view(np.uint64), probe, size)] = 1
        return pa.table({"file": table["file"][:1], "n": pa.array([len(hashes)], pa.int64()),
                         "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    hashed = files.select(F.col("_metadata.file_name").alias("file"), key_hash(keys).alias("h"))
    return hashed.groupBy("file").applyInArrow(run, SCHEMA)


def batch_hashes(batch: DataFrame, keys: list[str], most: int = PROBED_KEYS) -> np.ndarray | None:
    """The different key hashes of a batch, None if there are more than ``most``."""
    found = batch.select(key_hash(keys).alias("h")).distinct().limit(most + 1).toArrow()
    return None if found.num_rows > most else found["h"].to_numpy()


def hit(filters: DataFrame, hashes: np.ndarray) -> DataFrame:
    """The rows of ``filters`` (without bits) whose file may have one of the keys."""
    sent = filters.sparkSession.sparkContext.broadcast(hashes)
    names = [c for c in filters.columns if c != "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = []
            for bits in batch.column("bits").to_pylist():
                marks, left = np.frombuffer(bits, np.uint8), sent.value.view(np.uint64)
                for probe in range(PROBES):
                    place = _place(left, probe, len(marks) * 8)
                    left = left[(marks[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
                maybe.append(len(left) > 0)
            yield batch.select(names).filter(pa.array(maybe, pa.bool_()))

    return filters.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in filters.dtypes if c != "bits"))
