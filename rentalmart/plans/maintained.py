"""Marts kept up to date from changes, without reading what has not changed.

``monthly_occupancy`` (J-13): the partial sums of (listing, month) add up, so they are a
table of their own, stored by month. An update reads the fact's commits that it has not yet
applied, adds their sums to those of the months they are in, and rewrites these months, of
the sums and of the mart. Which commits are applied is part of the same commit, so an update
that is repeated, or comes after one that failed half way, adds nothing twice.

``pricing_analysis`` (J-14): the counts of each segment's prices add up too, also negatively.
Changed listings are taken out as they were and put in as they are; the quartiles follow
from the counts, which are far fewer than listings. Counts are stored by a hash of the
segment, and only the parts with changed segments are rewritten.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalmart.operators import versions
from rentalmart.plans import facts, marts

MONTH, PART, PARTS = "part_month", "segment_part", 64


def _sums(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``columns`` added up by ``keys``, in their own types."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in columns])


def _news(spark: SparkSession, fact: str, applied: list[str] | None) -> tuple[versions.Version, list[str] | None]:
    """(the fact's newest version, its folders that are not ``applied``; None where a folder that
    is applied is no longer part of the fact, so that everything has to be made again)."""
    now = versions.current(spark, fact)
    if now is None:
        raise versions.NotATableError(f"{fact}: no commit")
    if applied is None or set(applied) - set(now.folders):
        return now, None
    return now, [f for f in now.folders if f not in set(applied)]


def _rows(spark: SparkSession, fact: str, now: versions.Version, folders: list[str] | None) -> DataFrame:
    """The fact's rows in ``folders`` (None: all)."""
    some = now.folders if folders is None else {f: None for f in folders}
    return versions.read(spark, fact, versions.Version(now.number, now.schema, {f: None for f in some}))


def _months(days: DataFrame) -> list:
    """A short list at any number of days: the fact is stored by month, so no day is read."""
    return [r[0] for r in days.select(facts.CALENDAR_PART).distinct().collect()]


def update_month_parts(spark: SparkSession, fact: str, parts: str) -> list | None:
    """Bring the partial sums up to the fact's newest version; the months rewritten (None: all)."""
    fact, parts = fact.rstrip("/"), parts.rstrip("/")
    old = versions.current(spark, parts)
    now, folders = _news(spark, fact, old.applied if old else None)
    if folders == []:
        return []
    days = _rows(spark, fact, now, folders)
    months = _months(days)
    added = marts.calendar_month_parts(days).withColumn(MONTH, F.col("month"))
    if folders is not None:
        before = versions.read_parts(spark, parts, MONTH, months, old)
        added = added.select(*before.columns)
    else:  # all of it: what is there now goes
        before = None
        months = sorted({*months, *_stored_months(old)}, key=str) if old else months
    schema = added.schema if before is None else before.schema
    # the sums of new days alone are one row per (listing, month) already
    summed = added if before is None else _sums(before.unionByName(added), ["listing_id", "month", MONTH], marts.MONTH_SUMS)
    out = summed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    versions.replace_parts(spark, out, parts, MONTH, months, old, [*now.folders])
    return None if folders is None else months


def _stored_months(version: versions.Version) -> list:
    names = [f.rpartition("=")[2] for f in version.folders]
    return [None if n.startswith("__HIVE") else dt.date.fromisoformat(n) for n in names]


def update_monthly(spark: SparkSession, fact: str, listings: DataFrame, parts: str, mart: str) -> list | None:
    """Bring the partial sums and ``monthly_occupancy`` up to the fact's newest version; the
    mart's months rewritten (None: all). ``listings`` is the listing dimension; if it has
    changed, ``reprice_monthly`` makes the mart again from the sums."""
    update_month_parts(spark, fact, parts)
    mart = mart.rstrip("/")
    old, sums = versions.current(spark, mart), versions.current(spark, parts.rstrip("/"))
    if old is not None and set(old.applied) <= set(sums.applied):
        folders = [f for f in sums.applied if f not in set(old.applied)]
        if not folders:
            return []
        now = versions.current(spark, fact.rstrip("/"))
        months = _months(_rows(spark, fact.rstrip("/"), now, folders))
        some = versions.read_parts(spark, parts.rstrip("/"), MONTH, months, sums)
        _write_months(spark, some, listings, mart, months, old, sums.applied)
        return months
    reprice_monthly(spark, listings, parts, mart)
    return None


def reprice_monthly(spark: SparkSession, listings: DataFrame, parts: str, mart: str) -> None:
    """The whole mart from the partial sums: listings have changed, days have not."""
    old, sums = versions.current(spark, mart.rstrip("/")), versions.current(spark, parts.rstrip("/"))
    months = [*{*_stored_months(sums), *(_stored_months(old) if old else ())}]
    _write_months(spark, versions.read(spark, parts.rstrip("/"), sums), listings, mart.rstrip("/"), months, old, sums.applied)


def _write_months(spark, sums: DataFrame, listings: DataFrame, mart: str, months: list, old, applied: list[str]) -> None:
    rows = marts.monthly_from_parts(sums.drop(MONTH), listings).withColumn(MONTH, F.col("month"))
    versions.replace_parts(spark, rows, mart, MONTH, months, old, applied)


def read_monthly(spark: SparkSession, mart: str) -> DataFrame:
    return versions.read(spark, mart.rstrip("/")).drop(MONTH)


def _parted(counts: DataFrame) -> DataFrame:
    return counts.withColumn(PART, F.pmod(F.xxhash64(*marts.SEGMENT), F.lit(PARTS)).cast("int"))


def build_price_counts(spark: SparkSession, listings: DataFrame, counts: str) -> None:
    """The counts of all listings, from the start."""
    versions.replace_parts(spark, _parted(marts.price_counts(listings)), counts.rstrip("/"), PART, [*range(PARTS)],
                           versions.current(spark, counts.rstrip("/")))


def change_price_counts(spark: SparkSession, before: DataFrame, after: DataFrame, counts: str) -> list[int]:
    """Take listings out as they were (``before``) and put them in as they are (``after``); new
    listings are only in the latter, gone ones only in the former. Returns the parts rewritten."""
    counts = counts.rstrip("/")
    old = versions.current(spark, counts)
    taken = marts.price_counts(before)
    signed = marts.price_counts(after).unionByName(taken.select(
        *marts.SEGMENT, "value", *[(-F.col(c)).alias(c) for c in marts.PRICE_SUMS]))
    keys = [*marts.SEGMENT, "value", PART]
    delta = _sums(_parted(signed), keys, marts.PRICE_SUMS).where(
        " OR ".join(f"coalesce({c}, 0) != 0" for c in marts.PRICE_SUMS))
    parts = [r[0] for r in delta.select(PART).distinct().collect()]  # PARTS at most
    if not parts:
        return []
    known = versions.read_parts(spark, counts, PART, parts, old)
    merged = _sums(known.unionByName(delta.select(*known.columns)), keys, marts.PRICE_SUMS).where("c != 0")
    # nothing to average: no sum, as when counted anew
    merged = merged.withColumns({f"{n}_sum": F.when(F.col(f"{n}_n") != 0, F.col(f"{n}_sum")) for n in marts.AVERAGED})
    out = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in known.schema.fields])
    versions.replace_parts(spark, out, counts, PART, parts, old)
    return sorted(parts)


def pricing(spark: SparkSession, counts: str) -> DataFrame:
    """J-14 from the stored counts."""
    return marts.pricing_from_counts(versions.read(spark, counts.rstrip("/")).drop(PART))
