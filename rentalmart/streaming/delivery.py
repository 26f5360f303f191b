"""Continuous delivery of landed files into the incremental facts (section 7, step 7).

The reference is batch-only; this module lets the same incremental append run as a
Structured Streaming query: files landing in a folder are read with ``readStream``,
staged, and appended with ``append_new`` from ``foreachBatch``. With
``trigger(availableNow=True)`` each run processes exactly the files that arrived since the
previous run (tracked in the checkpoint), then stops - the scheduled-batch pattern.

Replays are safe: if a micro-batch is re-run after a failure, the anti-join finds the keys
the first attempt already appended and writes nothing for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Stage = Callable[[DataFrame], DataFrame]
Append = Callable[[SparkSession, DataFrame, str], object]


def start_delivery(spark: SparkSession, landing: str, schema: StructType, stage: Stage,
                   append: Append, target: str, checkpoint: str, fmt: str = "parquet",
                   options: dict[str, str] | None = None) -> StreamingQuery:
    """Start an availableNow streaming run from ``landing`` into ``target``."""
    source = spark.readStream.schema(schema).format(fmt).options(**(options or {}))

    def each_batch(batch: DataFrame, _epoch: int) -> None:
        append(spark, stage(batch), target)

    return (source.load(landing).writeStream
            .foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def deliver(spark: SparkSession, landing: str, schema: StructType, stage: Stage,
            append: Append, target: str, checkpoint: str, fmt: str = "parquet",
            options: dict[str, str] | None = None) -> None:
    """Run one availableNow delivery to completion."""
    q = start_delivery(spark, landing, schema, stage, append, target, checkpoint, fmt,
                       options)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
