"""Registered queries: one callable per job, ``(spark, sf_dir) -> DataFrame``.

Each query builds the raw inputs from the shared test tables (``sources.adapters``), runs
the job chain the reference runs, and returns the job's output. DECIMAL outputs are cast
to DOUBLE at this boundary only (the jobs themselves keep exact decimals), so results
compare across engines whose DataFrame conversions treat decimals differently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from rentalmart.plans import marts, staging
from rentalmart.sources import adapters

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (query boundary only)."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, DecimalType) for f in fields):
        return df
    return df.selectExpr(*[f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`"
                           if isinstance(f.dataType, DecimalType) else f"`{f.name}`"
                           for f in fields])


def register(name: str):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return wrap


# ---------------------------------------------------------------- model chain helpers
_raw_listings = adapters.raw_listings
_raw_reviews = adapters.raw_reviews
_raw_calendar = adapters.raw_calendar
_raw_neighbourhoods = adapters.raw_neighbourhoods


def _raw_inputs(spark, sf_dir):
    return adapters.RawInputs(_raw_listings(spark, sf_dir), _raw_reviews(spark, sf_dir),
                              _raw_calendar(spark, sf_dir), _raw_neighbourhoods(spark, sf_dir))


def _stg_listings(spark, sf_dir):
    return staging.stg_listings(_raw_listings(spark, sf_dir))


def _stg_reviews(spark, sf_dir):
    return staging.stg_reviews(_raw_reviews(spark, sf_dir))


def _stg_calendar(spark, sf_dir):
    return staging.stg_calendar(_raw_calendar(spark, sf_dir))


def _enriched(spark, sf_dir):
    return marts.listings_enriched(_stg_listings(spark, sf_dir), _stg_reviews(spark, sf_dir),
                                   _stg_calendar(spark, sf_dir))


def _dim_listing(spark, sf_dir):
    return marts.dim_listing(_enriched(spark, sf_dir))


def _dim_host(spark, sf_dir):
    return marts.dim_host(marts.host_metrics(_stg_listings(spark, sf_dir)))


def _monthly(spark, sf_dir):
    return marts.monthly_occupancy(_stg_calendar(spark, sf_dir), _dim_listing(spark, sf_dir))


# ---------------------------------------------------------------- J-01 .. J-14
@register("stg_listings")
def q_stg_listings(spark, sf_dir):
    """J-01"""
    return _stg_listings(spark, sf_dir)


@register("stg_reviews")
def q_stg_reviews(spark, sf_dir):
    """J-02"""
    return _stg_reviews(spark, sf_dir)


@register("stg_calendar")
def q_stg_calendar(spark, sf_dir):
    """J-03"""
    return _stg_calendar(spark, sf_dir)


@register("review_stats")
def q_review_stats(spark, sf_dir):
    """J-04"""
    return marts.review_stats(_stg_reviews(spark, sf_dir))


@register("calendar_stats")
def q_calendar_stats(spark, sf_dir):
    """J-05"""
    return marts.calendar_stats(_stg_calendar(spark, sf_dir))


@register("listings_enriched")
def q_listings_enriched(spark, sf_dir):
    """J-06"""
    return _enriched(spark, sf_dir)


@register("host_metrics")
def q_host_metrics(spark, sf_dir):
    """J-07"""
    return marts.host_metrics(_stg_listings(spark, sf_dir))


@register("dim_listing")
def q_dim_listing(spark, sf_dir):
    """J-08"""
    return _dim_listing(spark, sf_dir)


@register("dim_host")
def q_dim_host(spark, sf_dir):
    """J-09"""
    return _dim_host(spark, sf_dir)


@register("dim_neighbourhood")
def q_dim_neighbourhood(spark, sf_dir):
    """J-10"""
    return marts.dim_neighbourhood(_stg_listings(spark, sf_dir))


@register("monthly_occupancy")
def q_monthly_occupancy(spark, sf_dir):
    """J-13, over the appended calendar fact."""
    return marts.monthly_occupancy(_fct_calendar(spark, sf_dir), _dim_listing(spark, sf_dir))


@register("monthly_occupancy_kept")
def q_monthly_occupancy_kept(spark, sf_dir):
    """J-13 kept up to date: the calendar's batches are appended one after another, and the mart
    is updated from each."""
    from rentalmart.plans import facts, maintained
    from rentalmart.session import discard_at_exit, fresh_path
    fact, parts, mart = (fresh_path(spark, n) for n in ("fct_calendar", "month_parts", "monthly"))
    listings = _dim_listing(spark, sf_dir)
    for batch in adapters.calendar_batches(_raw_calendar(spark, sf_dir)):
        facts.fct_calendar(spark, staging.stg_calendar(batch), fact)
        maintained.update_monthly(spark, fact, listings, parts, mart)
    for path in (fact, parts, mart):
        discard_at_exit(spark, path)
    return maintained.read_monthly(spark, mart)


@register("pricing_analysis_kept")
def q_pricing_analysis_kept(spark, sf_dir):
    """J-14 kept up to date: two thirds of the listings, some with another price, are counted;
    then these prices change back and the other third comes in."""
    from rentalmart.plans import maintained
    from rentalmart.session import discard_at_exit, fresh_path
    counts = fresh_path(spark, "price_counts")
    final = _dim_listing(spark, sf_dir)
    first = final.where("listing_id % 3 != 0").withColumn(
        "price", F.expr("CAST(IF(listing_id % 5 = 0, price + 7, price) AS DECIMAL(10,2))"))
    maintained.build_price_counts(spark, first, counts)
    maintained.change_price_counts(spark, first.where("listing_id % 5 = 0"),
                                   final.where("listing_id % 3 != 0 AND listing_id % 5 = 0"), counts)
    maintained.change_price_counts(spark, final.where("false"), final.where("listing_id % 3 = 0"), counts)
    discard_at_exit(spark, counts)
    return maintained.pricing(spark, counts)


@register("pricing_analysis")
def q_pricing_analysis(spark, sf_dir):
    """J-14"""
    return marts.pricing_analysis(_dim_listing(spark, sf_dir))


# ---------------------------------------------------------------- J-11, J-12: incremental
# Fixed snapshot date of the time-dependent checks, so reruns and the oracle agree.
AS_OF = "2025-09-30"
SOURCES_AS_OF = "1999-02-15"  # one source is fresh, one due and one late then


def _changed_known_keys(raw_cal: DataFrame) -> DataFrame:
    """A later batch that repeats known days with a different price: must append nothing."""
    return raw_cal.where("date >= DATE'2000-01-01'").withColumn("price", F.lit("$1.00"))


def _appended(spark, name, batches, stage, append, read):
    """The fact after appending ``batches`` in order to a new table."""
    from rentalmart.session import discard_at_exit, fresh_path
    target = fresh_path(spark, name)
    for b in batches:
        append(spark, stage(b), target)
    discard_at_exit(spark, target)
    return read(spark, target)


def _fct_reviews(spark, sf_dir):
    """What loading the review batches leaves; reports read it without loading anything."""
    from rentalmart.plans import facts
    return facts.reviews_after([staging.stg_reviews(b) for b in adapters.review_batches(_raw_reviews(spark, sf_dir))])


def _fct_calendar(spark, sf_dir):
    from rentalmart.plans import facts
    return facts.calendar_after([staging.stg_calendar(b) for b in adapters.calendar_batches(_raw_calendar(spark, sf_dir))])


@register("fct_reviews")
def q_fct_reviews(spark, sf_dir):
    """J-11: even review ids, then all, then all again with another month and text."""
    from rentalmart.plans import facts
    raw = _raw_reviews(spark, sf_dir)
    return _appended(spark, "fct_reviews", [*adapters.review_batches(raw), adapters.moved_reviews(raw)],
                     staging.stg_reviews, facts.fct_reviews, facts.read_fct_reviews)


def _later_days(spark, sf_dir):
    """Batches after the first two: known days with other prices, undated days twice."""
    raw = _raw_calendar(spark, sf_dir)
    return [_changed_known_keys(raw), adapters.undated_days(raw), adapters.undated_days(raw)]


@register("fct_calendar")
def q_fct_calendar(spark, sf_dir):
    """J-12: days before 1999, then all, known days with other prices, undated days twice."""
    from rentalmart.plans import facts
    return _appended(spark, "fct_calendar", [*adapters.calendar_batches(_raw_calendar(spark, sf_dir)), *_later_days(spark, sf_dir)],
                     staging.stg_calendar, facts.fct_calendar, facts.read_fct_calendar)


@register("fct_calendar_stream")
def q_fct_calendar_stream(spark, sf_dir):
    """J-12 delivered by Structured Streaming: each batch lands as files, then one
    availableNow run appends what arrived."""
    from rentalmart.plans import facts
    from rentalmart.session import discard, discard_at_exit, fresh_path
    from rentalmart.sources.schemas import RAW_CALENDAR
    from rentalmart.streaming.delivery import deliver
    landing, target = fresh_path(spark, "landing"), fresh_path(spark, "fct_calendar")
    checkpoint = fresh_path(spark, "checkpoint")
    batches = [*adapters.calendar_batches(_raw_calendar(spark, sf_dir)), *_later_days(spark, sf_dir)]
    for i, b in enumerate(batches):
        b.write.mode("overwrite").parquet(f"{landing}/batch={i}")
        deliver(spark, landing, RAW_CALENDAR, staging.stg_calendar, facts.fct_calendar,
                target, checkpoint, options={"recursiveFileLookup": "true"})
    for path in (landing, checkpoint):
        discard(spark, path)
    discard_at_exit(spark, target)
    return facts.read_fct_calendar(spark, target)


# ---------------------------------------------------------------- J-15 .. J-29: reports
def _report(name: str, build):
    @register(name)
    def q(spark, sf_dir):
        return build(spark, sf_dir)
    q.__doc__ = build.__doc__
    return q


def _reports():
    from rentalmart.plans import reports as R
    _report("market_summary", lambda s, d: R.market_summary(_dim_listing(s, d)))
    _report("listings_per_host", lambda s, d: R.listings_per_host(_dim_listing(s, d)))
    _report("top_segments", lambda s, d: R.top_segments(
        marts.pricing_analysis(_dim_listing(s, d))))
    _report("top_segments_shown", lambda s, d: R.top_segments(
        marts.pricing_analysis(_dim_listing(s, d)), shown=R.TOP_SEGMENTS_SHOWN))
    _report("price_rows", lambda s, d: R.price_rows(_dim_listing(s, d)))
    _report("price_box", lambda s, d: R.price_box(_dim_listing(s, d)))
    _report("occupancy_trend", lambda s, d: R.occupancy_trend(_monthly(s, d)))
    _report("hosts_by_tier", lambda s, d: R.hosts_by_tier(_dim_host(s, d)))
    _report("superhost_compare", lambda s, d: R.superhost_compare(_dim_host(s, d)))
    _report("review_volume", lambda s, d: R.review_volume(_fct_reviews(s, d)))
    _report("top_reviewed", lambda s, d: R.top_reviewed(_dim_listing(s, d)))
    _report("room_breakdown", lambda s, d: R.room_breakdown(_dim_listing(s, d)))
    _report("neighbourhood_gap", lambda s, d: R.neighbourhood_gap(_dim_listing(s, d)))
    _report("quarterly_occupancy", lambda s, d: R.quarterly_occupancy(_monthly(s, d)))
    _report("superhost_profile", lambda s, d: R.superhost_profile(_dim_host(s, d)))
    _report("superhost_premium", lambda s, d: R.superhost_premium(
        R.superhost_profile(_dim_host(s, d))))


_reports()


# ---------------------------------------------------------------- J-30 .. J-36: quality
def _raw_models(spark, sf_dir):
    return {"raw_listings": _raw_listings(spark, sf_dir),
            "raw_reviews": _raw_reviews(spark, sf_dir),
            "raw_calendar": _raw_calendar(spark, sf_dir),
            "raw_neighbourhoods": _raw_neighbourhoods(spark, sf_dir)}


@register("not_null")
def q_not_null(spark, sf_dir):
    """J-30: the 11 declared not-null tests, failures per column."""
    from rentalmart.plans import quality
    return quality.generic_tests(_raw_models(spark, sf_dir), ["not_null"]).drop("test")


@register("unique")
def q_unique(spark, sf_dir):
    """J-31: the 5 declared unique tests, duplicated values per column."""
    from rentalmart.plans import quality
    return quality.generic_tests(_raw_models(spark, sf_dir), ["unique"]).drop("test")


@register("non_positive_price")
def q_non_positive_price(spark, sf_dir):
    """J-32"""
    from rentalmart.plans import quality
    return quality.non_positive_price(_dim_listing(spark, sf_dir))


@register("bad_review_dates")
def q_bad_review_dates(spark, sf_dir):
    """J-33"""
    from rentalmart.plans import quality
    return quality.bad_review_dates(_fct_reviews(spark, sf_dir), AS_OF)


@register("quality_probe")
def q_quality_probe(spark, sf_dir):
    """J-34"""
    from rentalmart.plans import quality
    return quality.quality_probe(_dim_listing(spark, sf_dir), _fct_reviews(spark, sf_dir),
                                 _fct_calendar(spark, sf_dir))


@register("source_freshness")
def q_source_freshness(spark, sf_dir):
    """J-35"""
    from rentalmart.plans import quality
    return quality.all_source_freshness(_raw_models(spark, sf_dir), SOURCES_AS_OF)


@register("source_freshness_from_files")
def q_source_freshness_from_files(spark, sf_dir):
    """J-35 over the loaded raw tables, by the statistics of their files."""
    from rentalmart.operators import versions
    from rentalmart.plans import quality
    from rentalmart.session import discard_at_exit, fresh_path
    paths = {}
    for table in quality.SOURCE_FRESHNESS:
        paths[table] = fresh_path(spark, table)
        versions.replace(spark, _raw_models(spark, sf_dir)[table].hint("rebalance"), paths[table])
        discard_at_exit(spark, paths[table])
    return quality.source_freshness_from_files(spark, paths, SOURCES_AS_OF)


@register("mart_freshness")
def q_mart_freshness(spark, sf_dir):
    """J-36: listings (last scrape), reviews and calendar."""
    from rentalmart.plans import quality
    reviews = _fct_reviews(spark, sf_dir)
    marts_now = quality.all_mart_freshness(_stg_listings(spark, sf_dir), reviews, _fct_calendar(spark, sf_dir), AS_OF)
    return marts_now.unionByName(quality.mart_freshness(reviews.where("false"), "review_date", AS_OF, "Reviews (none)"))


# ---------------------------------------------------------------- J-37, J-38
@register("load_raw")
def q_load_raw(spark, sf_dir):
    """J-37: land the four inputs as CSV files and load them to raw Parquet tables: the load
    report, with each loaded table's sum of its first whole-number column and the characters
    in its text columns."""
    from rentalmart.session import discard, discard_at_exit, fresh_path
    from rentalmart.sources import csv
    raw = _raw_inputs(spark, sf_dir)
    landing, out = fresh_path(spark, "landing-csv"), fresh_path(spark, "raw")
    frames = {"raw_listings": raw.listings, "raw_reviews": raw.reviews,
              "raw_calendar": raw.calendar, "raw_neighbourhoods": raw.neighbourhoods}
    for table, df in frames.items():
        csv.write_csv(df, f"{landing}/{table}")
    report = csv.load_raw(spark, {t: f"{landing}/{t}" for t in frames}, out)
    discard(spark, landing)
    discard_at_exit(spark, out)
    content = None
    for table in frames:
        loaded = csv.read_raw(spark, out, table)
        key = next((f"sum(`{c}`)" for c, kind in loaded.dtypes if kind == "bigint"), "0")
        chars = " + ".join(f"coalesce(sum(length(`{c}`)), 0)" for c, kind in loaded.dtypes if kind == "string")
        one = loaded.selectExpr(f"CAST({key} AS BIGINT) AS key_sum", f"CAST({chars} AS BIGINT) AS text_chars") \
            .withColumn("table", F.lit(table))
        content = one if content is None else content.unionByName(one)
    return report.join(content, "table")


@register("build_all")
def q_build_all(spark, sf_dir):
    """J-38: build all models, run the tests and the quality gate; the step log."""
    from rentalmart.plans.pipeline import run_pipeline
    from rentalmart.session import discard_at_exit, fresh_path
    warehouse = fresh_path(spark, "warehouse")
    steps = run_pipeline(spark, _raw_inputs(spark, sf_dir), warehouse, AS_OF, raise_on_failure=False)
    discard_at_exit(spark, warehouse)
    return steps
