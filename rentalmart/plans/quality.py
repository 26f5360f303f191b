"""Data tests, quality probe and freshness monitors (J-30..J-36).

A test returns its violations as a DataFrame (no rows = pass), like the reference's test
queries. All checks of one table run as one aggregate pass; uniqueness is a grouped count
(combined map-side, so a hot value costs one partial row per task). Time-dependent checks
take ``as_of`` (a fixed date makes reruns reproducible; None means CURRENT_DATE).

Fixed values (defaults that must equal the reference's):
  source freshness warn / error days: listings 180 / 365, reviews 90 / 180,
  calendar 30 / 60; mart freshness limit 365 days, 999 days when the table is empty;
  earliest valid review date 2010-01-01.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalmart.operators import versions
from rentalmart.plans import staging

EARLIEST_REVIEW = "2010-01-01"
MART_STALE_DAYS = 365
EMPTY_AGE_DAYS = 999
PROBE_ERRORS = (PySparkException, Py4JJavaError, ValueError)  # what a check may fail of

SOURCE_FRESHNESS = {  # source -> (loaded_at column, warn days, error days)
    "raw_listings": ("last_scraped", 180, 365),
    "raw_reviews": ("date", 90, 180),
    "raw_calendar": ("date", 30, 60),
}

NOT_NULL_TESTS = {  # model -> columns declared not_null
    "raw_listings": ["id"],
    "raw_reviews": ["id"],
    "raw_neighbourhoods": ["neighbourhood"],
    "stg_listings": ["listing_id", "host_id"],
    "stg_reviews": ["review_id", "listing_id", "review_date"],
    "stg_calendar": ["listing_id", "calendar_date", "is_available"],
}

UNIQUE_TESTS = {  # model -> columns declared unique
    "raw_listings": ["id"],
    "raw_reviews": ["id"],
    "raw_neighbourhoods": ["neighbourhood"],
    "stg_listings": ["listing_id"],
    "stg_reviews": ["review_id"],
}

STAGED_FROM = {  # raw table -> (staged model, its columns as expressions over the raw one)
    "raw_listings": ("stg_listings", staging.STG_LISTINGS_EXPRS),
    "raw_reviews": ("stg_reviews", staging.STG_REVIEWS_EXPRS),
    "raw_neighbourhoods": None,
    "raw_calendar": ("stg_calendar", staging.STG_CALENDAR_EXPRS),
}


def _lit_date(d) -> Column:
    """A fixed snapshot date, or the session's CURRENT_DATE when ``d`` is None."""
    return F.current_date() if d is None else F.lit(str(d)).cast("date")


def not_null(df: DataFrame, cols: list[str], model: str = "") -> DataFrame:
    """J-30: NULL count per column, all columns in one aggregate pass.

    One row per column: (model, column, failures); failures > 0 means the test fails.
    """
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}")
                      for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, failures)") \
        .select(F.lit(model).alias("model"), "column", F.col("failures").cast("long"))


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """J-31: values of ``col`` that occur more than once (NULLs are not checked)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            .select(F.col(col).cast("string").alias("value"), "n"))


def unique(df: DataFrame, col: str, model: str = "") -> DataFrame:
    """J-31 as a test result: (model, column, failures = number of duplicated values)."""
    return (unique_violations(df, col).agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit(model).alias("model"), F.lit(col).alias("column"), "failures"))


def non_positive_price(dim_listing: DataFrame) -> DataFrame:
    """J-32: listings whose price is zero or negative."""
    return dim_listing.where(F.col("price") <= 0).select("listing_id", "price")


def bad_review_dates(fct_reviews: DataFrame, as_of=None) -> DataFrame:
    """J-33: reviews dated after ``as_of`` (default: today) or before 2010-01-01."""
    d = F.col("review_date")
    return (fct_reviews.where((d > _lit_date(as_of)) | (d < _lit_date(EARLIEST_REVIEW)))
            .select("review_id", "review_date"))


def _tuple_text(*parts: Column) -> Column:
    """Text of a one- or two-value result row, formatted as the reference prints it."""
    def one(c: Column) -> Column:
        return F.coalesce(c, F.lit("None"))
    if len(parts) == 1:
        return F.concat(F.lit("("), one(parts[0]), F.lit(",)"))
    return F.concat(F.lit("("), one(parts[0]), F.lit(", "), one(parts[1]), F.lit(")"))


def _date_text(c: Column) -> Column:
    return F.concat(F.lit("datetime.date("), F.year(c).cast("string"), F.lit(", "),
                    F.month(c).cast("string"), F.lit(", "), F.dayofmonth(c).cast("string"),
                    F.lit(")"))


def probe_checks() -> list[tuple[str, str, list[Column], Callable[..., Column]]]:
    """(table, check, aggregates, text of the result)."""
    one = lambda v: _tuple_text(v.cast("string"))
    return [
        ("listings", "Listings with price > 0", [F.count_if(F.col("price") > 0)], one),
        ("listings", "Listings with reviews", [F.count_if(F.col("number_of_reviews") > 0)], one),
        ("listings", "Neighbourhoods", [F.countDistinct("neighbourhood")], one),
        ("reviews", "Total reviews", [F.count(F.lit(1))], one),
        ("calendar", "Calendar date range", [F.min("calendar_date"), F.max("calendar_date")],
         lambda lo, hi: _tuple_text(_date_text(lo), _date_text(hi)))]


def probe_values(df: DataFrame, checks: list[tuple]) -> DataFrame:
    """One row with text<i> and v<i> (the first aggregate) of each check of a table."""
    values = df.agg(*[v.alias(f"v{i}_{k}") for i, c in enumerate(checks) for k, v in enumerate(c[2])])
    return values.select(
        *[c[3](*[F.col(f"v{i}_{k}") for k in range(len(c[2]))]).alias(f"text{i}") for i, c in enumerate(checks)],
        *[F.col(f"v{i}_0").alias(f"v{i}") for i in range(len(checks))])


def quality_probe(dim_listing: DataFrame | None, fct_reviews: DataFrame | None,
                  fct_calendar: DataFrame | None, min_values: dict[str, int] | None = None) -> DataFrame:
    """J-34: the five runtime checks as (check, result, status).

    The checks run when this is called, one aggregate per table; what fails is caught, so a
    table that is missing (None), lacks a column or has a file that cannot be read fails its
    own checks with the error's text and the others go on. After an error a table's checks
    run one by one, so that only those fail that need what is broken. A check passes when it
    evaluates (as in the reference); ``min_values`` optionally turns a count below a minimum
    into FAIL.
    """
    mins = min_values or {}
    tables = {"listings": dim_listing, "reviews": fct_reviews, "calendar": fct_calendar}
    found: dict[str, tuple[str, str]] = {}

    def run(df: DataFrame | None, checks) -> None:
        if df is None:
            raise ValueError("table is missing")
        row = probe_values(df, checks).first()
        for i, c in enumerate(checks):
            low = c[1] in mins and row[f"v{i}"] < mins[c[1]]
            found[c[1]] = (row[f"text{i}"], "FAIL" if low else "PASS")

    checks = probe_checks()
    for table, df in tables.items():
        own = [c for c in checks if c[0] == table]
        try:
            run(df, own)
        except PROBE_ERRORS:
            for c in own:
                try:
                    run(df, [c])
                except PROBE_ERRORS as exc:
                    found[c[1]] = (_first_line(exc), "FAIL")
    return _session(*tables.values()).createDataFrame(
        [(c[1], *found[c[1]]) for c in checks], "check string, result string, status string")


def _first_line(exc: Exception) -> str:
    """The error's message; of a failed job, what it failed of."""
    text = str(getattr(exc, "java_exception", None) or exc)
    return next((line for line in text.splitlines() if line.strip()), type(exc).__name__)


def _session(*frames: DataFrame | None):
    return next((df.sparkSession for df in frames if df is not None), None) or SparkSession.active()


def source_freshness(df: DataFrame, col: str, warn_days: int, error_days: int, as_of=None,
                     source: str = "") -> DataFrame:
    """J-35: pass / warn / error by the age of the newest ``col`` value.

    Age may be negative for forward-looking dates (calendar), which counts as fresh. An
    empty table has no age and is an error.
    """
    newest = df.agg(F.max(F.col(col)).alias("max_loaded_at"))
    age = F.datediff(_lit_date(as_of), F.col("max_loaded_at"))
    return newest.select(
        F.lit(source).alias("source"), "max_loaded_at", age.alias("age_days"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age > error_days, "error").when(age > warn_days, "warn").otherwise("pass")
        .alias("status"))


def newest_in_files(spark: SparkSession, path: str, col: str) -> DataFrame:
    """max_loaded_at of the table in folder ``path`` (``versions``), from the statistics in its
    files' footers: the aggregate is pushed into the Parquet reader, no column is read.

    The reader does that in a session of its own with the same context, whose settings
    for it do not touch the caller's. It falls back to reading the column by itself where a file
    has no statistics.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return versions.read(reader, path).agg(F.max(col).alias("max_loaded_at"))


def source_freshness_from_files(spark: SparkSession, paths: dict[str, str], as_of=None) -> DataFrame:
    """J-35 for raw tables by folder, without a scan (``newest_in_files``)."""
    rows = []
    for source, (col, warn, err) in SOURCE_FRESHNESS.items():
        newest = newest_in_files(spark, paths[source], col).first()[0]  # one value
        df = spark.createDataFrame([(newest,)], "d date")
        rows.append(source_freshness(df, "d", warn, err, as_of, source))
    return union_all(rows)


def mart_freshness(df: DataFrame, col: str, as_of=None, name: str = "",
                   limit_days: int = MART_STALE_DAYS) -> DataFrame:
    """J-36: OK / STALE by days since the newest ``col`` value (999 when empty)."""
    newest = df.agg(F.max(F.col(col)).alias("max_date"))
    days = F.coalesce(F.datediff(_lit_date(as_of), F.col("max_date")), F.lit(EMPTY_AGE_DAYS))
    return newest.select(F.lit(name).alias("name"), "max_date", days.alias("days_ago"),
                         F.when(days < limit_days, "OK").otherwise("STALE").alias("status"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def generic_tests(raw: dict[str, DataFrame], tests: list[str] = ("not_null", "unique")) -> DataFrame:
    """J-30, J-31: all declared tests of the raw tables and their staged forms, as (model,
    column, test, failures), with one scan and one aggregate per raw table.

    Tests without a unique one are counted as they are. Otherwise every tested column of a
    row gives a (column, value) pair; pairs are counted (combined map-side, so a hot value
    costs one partial row per task), and the counts say what is NULL and what occurs twice.
    """
    out = []
    for table, stage in STAGED_FROM.items():
        columns = {}  # (model, column) -> (expression, its tests)
        for model, exprs in ((table, None), (stage and stage[0], stage and dict(e.rsplit(" AS ", 1)[::-1] if " AS " in e else (e, e)
                                                                                for e in stage[1]))):
            for test, declared in (("not_null", NOT_NULL_TESTS), ("unique", UNIQUE_TESTS)):
                for c in declared.get(model, []) if test in tests else []:
                    columns.setdefault((model, c), (exprs[c] if exprs else c, []))[1].append(test)
        if not columns:
            continue
        keys = [*columns]
        if any("unique" in wanted for _, wanted in columns.values()):
            # a value that is only tested for NULL counts as one value
            pairs = ", ".join(f"struct({k} AS k, {f'CAST({e} AS STRING)' if 'unique' in t else f'IF(({e}) IS NULL, NULL, 0)'} AS v)"
                              for k, (e, t) in enumerate(columns.values()))
            counts = (raw[table].selectExpr(f"explode(array({pairs})) AS p").groupBy("p.k", "p.v").agg(F.count(F.lit(1)).alias("n"))
                      .groupBy("k").agg(F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("not_null"),
                                        F.count_if(F.col("v").isNotNull() & (F.col("n") > 1)).alias("unique")))
        else:
            nulls = raw[table].selectExpr(*[f"count_if(({e}) IS NULL) AS c{k}" for k, (e, _) in enumerate(columns.values())])
            counts = nulls.selectExpr(f"stack({len(keys)}, {', '.join(f'{k}, c{k}' for k in range(len(keys)))}) AS (k, not_null)") \
                .withColumn("unique", F.lit(None).cast("long"))
        declared = [(k, m, c, t) for k, ((m, c), (_, wanted)) in enumerate(columns.items()) for t in wanted]
        results = raw[table].sparkSession.createDataFrame(declared, "k int, model string, column string, test string")
        # an empty table has no pairs and no failures
        out.append(results.join(counts, "k", "left").select(
            "model", "column", "test", F.coalesce(F.when(F.col("test") == "unique", F.col("unique")).otherwise(F.col("not_null")),
                                                  F.lit(0)).cast("long").alias("failures")))
    return union_all(out)


def all_source_freshness(raw: dict[str, DataFrame], as_of=None) -> DataFrame:
    return union_all([source_freshness(raw[s], col, warn, err, as_of, s)
                      for s, (col, warn, err) in SOURCE_FRESHNESS.items()])


def all_mart_freshness(listings: DataFrame, reviews: DataFrame, calendar: DataFrame, as_of=None) -> DataFrame:
    """J-36 for the staged listings and the two facts."""
    return union_all([mart_freshness(listings, "last_scraped_date", as_of, "Listings (last_scraped)"),
                      mart_freshness(reviews, "review_date", as_of, "Reviews (most recent)"),
                      mart_freshness(calendar, "calendar_date", as_of, "Calendar (latest date)")])
