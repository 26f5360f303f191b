"""Incrementally appended facts (J-11 ``fct_reviews``, J-12 ``fct_calendar``).

The calendar is stored by the month of its date key, so a new batch is matched against the
target months it covers only. A review's month is not a function of its key (a review can
come again with another date), so reviews match on ``review_id`` against the files whose key
filter says that they may have one of the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalmart.operators.incremental import AppendResult, append_new, first_versions, read_table

REVIEW_KEYS = ["review_id"]
CALENDAR_KEYS = ["listing_id", "calendar_date"]
CALENDAR_PART = "calendar_month"


def with_cal_key(calendar: DataFrame) -> DataFrame:
    """Staged calendar + ``cal_key`` = '<listing_id>-<yyyy-mm-dd>' (NULL if a part is)."""
    return calendar.withColumn(
        "cal_key", F.concat(F.col("listing_id").cast("string"), F.lit("-"),
                            F.col("calendar_date").cast("string")))


def fct_reviews(spark: SparkSession, reviews: DataFrame, target: str) -> AppendResult:
    """J-11: append staged reviews whose ``review_id`` is not in ``target``."""
    return append_new(spark, reviews, target, REVIEW_KEYS)


def fct_calendar(spark: SparkSession, calendar: DataFrame, target: str, buckets: int | None = None) -> AppendResult:
    """J-12: append staged calendar days whose (listing_id, calendar_date) is unseen; a catalog
    table may have ``buckets`` by listing."""
    return append_new(spark, with_cal_key(calendar), target, CALENDAR_KEYS, CALENDAR_PART,
                      F.trunc("calendar_date", "month"), (buckets, "listing_id") if buckets else None)


def read_fct_reviews(spark: SparkSession, target: str) -> DataFrame:
    return read_table(spark, target)


def read_fct_calendar(spark: SparkSession, target: str) -> DataFrame:
    return read_table(spark, target, CALENDAR_PART)


def reviews_after(batches: list[DataFrame]) -> DataFrame:
    """The fact that appending staged ``batches`` leaves, without writing it."""
    return first_versions(batches, REVIEW_KEYS)


def calendar_after(batches: list[DataFrame]) -> DataFrame:
    """The fact that appending staged ``batches`` leaves, without writing it."""
    return with_cal_key(first_versions(batches, CALENDAR_KEYS))
