"""The quality probe goes on when a table fails, and its minimums can fail a check."""
import datetime as dt

from rentalmart.plans import quality


def tables(spark):
    listings = spark.createDataFrame([(1.0, 3, "A"), (0.0, 0, "B")], "price double, number_of_reviews int, neighbourhood string")
    reviews = spark.createDataFrame([(1,)], "review_id long")
    calendar = spark.createDataFrame([(dt.date(2024, 1, 2),)], "calendar_date date")
    return listings, reviews, calendar


def status(df):
    return {r.check: r.status for r in df.collect()}


def test_a_missing_table_fails_its_check_only(spark):
    listings, reviews, calendar = tables(spark)
    got = status(quality.quality_probe(listings, None, calendar))
    assert [c for c, s in got.items() if s == "FAIL"] == ["Total reviews"] and len(got) == 5


def test_a_broken_table_is_recorded_with_its_error(spark):
    listings, reviews, calendar = tables(spark)
    rows = quality.quality_probe(listings, reviews, calendar.withColumnRenamed("calendar_date", "day")).collect()
    bad = [r for r in rows if r.status == "FAIL"]
    assert [r.check for r in bad] == ["Calendar date range"] and "calendar_date" in bad[0].result


def test_minimums(spark):
    got = status(quality.quality_probe(*tables(spark), min_values={"Neighbourhoods": 3, "Total reviews": 1}))
    assert got["Neighbourhoods"] == "FAIL" and got["Total reviews"] == "PASS"


def test_a_corrupt_file_fails_its_own_checks_only(spark, scratch):
    """The error comes up while the checks run, not while they are planned."""
    listings, reviews, calendar = tables(spark)
    reviews.write.parquet(f"{scratch}/reviews")
    listings.write.parquet(f"{scratch}/listings")
    schemas = {n: spark.read.parquet(f"{scratch}/{n}").schema for n in ("reviews", "listings")}
    with open(f"{scratch}/reviews/part-x.parquet", "w") as f:
        f.write("not parquet")
    broken = spark.read.schema(schemas["reviews"]).parquet(f"{scratch}/reviews")
    rows = quality.quality_probe(spark.read.schema(schemas["listings"]).parquet(f"{scratch}/listings"), broken, calendar).collect()
    assert {r.check for r in rows if r.status == "FAIL"} == {"Total reviews"} and len(rows) == 5
    assert next(r.result for r in rows if r.status == "FAIL")


def test_a_column_that_fails_at_run_time_fails_the_checks_that_read_it(spark):
    from pyspark.sql import functions as F
    listings, reviews, calendar = tables(spark)
    bad = listings.withColumn("price", F.raise_error(F.lit("no price")).cast("double"))
    got = status(quality.quality_probe(bad, reviews, calendar))
    assert [c for c, s in got.items() if s == "FAIL"] == ["Listings with price > 0"]


def test_declared_tests_count_what_single_tests_count(spark):
    from rentalmart.plans import staging
    from rentalmart.sources.schemas import RAW_CALENDAR, RAW_LISTINGS, RAW_NEIGHBOURHOODS, RAW_REVIEWS

    def rows(schema, column, values):
        at = [f.name for f in schema.fields].index(column)
        return spark.createDataFrame([tuple(v if k == at else None for k in range(len(schema))) for v in values], schema)
    raw = {"raw_listings": rows(RAW_LISTINGS, "id", [1, 1, 2, None, None, None, 3, 3, 3]),
           "raw_reviews": rows(RAW_REVIEWS, "id", [5, 5, None]),
           "raw_neighbourhoods": rows(RAW_NEIGHBOURHOODS, "neighbourhood", []),
           "raw_calendar": rows(RAW_CALENDAR, "listing_id", [1, None, None])}
    models = {**raw, "stg_listings": staging.stg_listings(raw["raw_listings"]),
              "stg_reviews": staging.stg_reviews(raw["raw_reviews"]), "stg_calendar": staging.stg_calendar(raw["raw_calendar"])}
    got = sorted((r.test, r.model, r.column, r.failures) for r in quality.generic_tests(raw).collect())
    want = [("not_null", m, r.column, r.failures) for m, cols in quality.NOT_NULL_TESTS.items()
            for r in quality.not_null(models[m], cols, m).collect()]
    want += [("unique", m, c, quality.unique(models[m], c, m).first().failures)
             for m, cols in quality.UNIQUE_TESTS.items() for c in cols]
    assert got == sorted(want) and ("unique", "raw_listings", "id", 2) in got
    assert ("not_null", "raw_listings", "id", 3) in got and ("not_null", "stg_calendar", "listing_id", 2) in got


def test_freshness_from_file_statistics(spark, scratch):
    """The newest date comes from the files' footers: the aggregate is pushed, no column is read."""
    from rentalmart.operators import versions
    days = spark.createDataFrame([(k, dt.date(2024, 1, 1) + dt.timedelta(days=k)) for k in range(90)], "id long, date date")
    versions.replace(spark, days.repartition(5), f"{scratch}/t")
    newest = quality.newest_in_files(spark, f"{scratch}/t", "date")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(date)]" in plan
    assert newest.first()[0] == dt.date(2024, 3, 30) == versions.read(spark, f"{scratch}/t").agg({"date": "max"}).first()[0]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_source_freshness_from_files_equals_the_scan(spark, scratch):
    from rentalmart.operators import versions
    raw = {s: spark.createDataFrame([(dt.date(2024, 5, k + 1),) for k in range(n)], f"{col} date")
           for (s, (col, _, _)), n in zip(quality.SOURCE_FRESHNESS.items(), (9, 0, 4))}
    for s, df in raw.items():
        versions.replace(spark, df, f"{scratch}/{s}")
    got = quality.source_freshness_from_files(spark, {s: f"{scratch}/{s}" for s in raw}, "2024-07-01")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.all_source_freshness(raw, "2024-07-01").collect()))
