"""End-to-end build: models -> tests -> quality gate (J-38).

Staging and intermediate models stay lazy DataFrames (views in the reference); marts are
written as Parquet tables under ``warehouse`` (a folder in the cluster's shared storage,
e.g. below ``spark.checkpoint.dir``). Downstream marts read the written tables, which cuts
the lineage at every materialisation boundary, so a lost executor only recomputes the
stage it was running. The two facts are appended incrementally; running the pipeline
again with the same inputs appends nothing.

The step log is a small driver-side list (one row per model or test), returned as a
DataFrame. A failing test stops the run before the quality gate, like the reference's
task chain; ``raise_on_failure=False`` records the failure and continues instead.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalmart.operators import versions
from rentalmart.operators.incremental import is_table_name
from rentalmart.plans import facts, marts, quality, staging
from rentalmart.session import discard
from rentalmart.sources.adapters import RawInputs


class PipelineFailed(RuntimeError):
    pass


@dataclass
class Warehouse:
    """Where marts go: Parquet folders under ``root``, or - with ``database`` - catalog
    tables ``<database>.<name>`` whose database is located under ``root``."""
    root: str
    database: str | None = None
    buckets: int | None = None  # of tables by listing; needs a database
    steps: list[tuple[str, str, str]] = field(default_factory=list)

    def path(self, name: str) -> str:
        if self.database:
            return f"{self.database}.{name}"
        return f"{self.root.rstrip('/')}/{name}"

    def log(self, step: str, status: str, detail: str = "") -> None:
        self.steps.append((step, status, detail))


def ensure_database(spark: SparkSession, wh: Warehouse) -> None:
    if wh.database:
        location = f"{wh.root.rstrip('/')}/{wh.database}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {wh.database} LOCATION '{location}'")


def write_table(spark: SparkSession, df: DataFrame, target: str,
                sort_by: list[str] | None = None) -> DataFrame:
    """Full refresh of a mart; returns the written table.

    The new content is written first and then takes the old one's place in one step, so that
    a failed refresh leaves the mart as it was (a folder: ``versions``; a catalog table: its
    location moves to the new files).
    """
    if sort_by:  # min/max stats per file prune later scans; files sized by bytes, and what
        # makes ``df`` (a join, say) and the sort are not held in memory by the same task
        df = df.hint("rebalance", *sort_by).sortWithinPartitions(*sort_by)
    if not is_table_name(target):
        return versions.replace(spark, df, target)
    database, name = target.split(".") if "." in target else (spark.catalog.currentDatabase(), target)
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    folder = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    try:
        df.write.parquet(folder)
    except Exception:
        discard(spark, folder)
        raise
    shape = [(f.name, f.dataType) for f in versions.as_stored(df.schema).fields]
    if spark.catalog.tableExists(target):
        row = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {target}").collect()}
        if row.get("Type") == "EXTERNAL" and [(f.name, f.dataType) for f in spark.table(target).schema.fields] == shape:
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(target)
            discard(spark, row["Location"])
            return spark.table(target)
        spark.sql(f"DROP TABLE {target}")  # other columns: a new table
    spark.catalog.createTable(target, folder, "parquet")
    return spark.table(target)


def write_bucketed(spark: SparkSession, df: DataFrame, table: str, buckets: int) -> DataFrame:
    """Full refresh of a catalog table that is bucketed by listing, so that joins and
    aggregates by listing over such tables need no shuffle.

    Rows are dealt to tasks by bucket; a large bucket is split over several tasks and files,
    which does not change what bucket they are in.
    """
    bucket = F.pmod(F.hash("listing_id"), F.lit(buckets))
    df.withColumn("_bucket", bucket).hint("rebalance", "_bucket").drop("_bucket") \
        .write.mode("overwrite").format("parquet").bucketBy(buckets, "listing_id").saveAsTable(table)
    return spark.table(table)


def build_models(spark: SparkSession, raw: RawInputs, wh: Warehouse) -> dict[str, DataFrame]:
    stg_l = staging.stg_listings(raw.listings)
    stg_r = staging.stg_reviews(raw.reviews)
    stg_c = staging.stg_calendar(raw.calendar)
    ensure_database(spark, wh)
    if wh.buckets:  # staged once, by listing
        stg_l, stg_r, stg_c = (write_bucketed(spark, df, wh.path(name), wh.buckets) for name, df in (
            ("stg_listings", stg_l), ("stg_reviews", stg_r), ("stg_calendar", stg_c)))
    elif wh.database:  # staging models are views, as in the reference
        stg_l.createOrReplaceTempView("stg_listings")
        stg_r.createOrReplaceTempView("stg_reviews")
        stg_c.createOrReplaceTempView("stg_calendar")
    out: dict[str, DataFrame] = {"raw_listings": raw.listings, "raw_reviews": raw.reviews,
                                 "raw_calendar": raw.calendar,
                                 "raw_neighbourhoods": raw.neighbourhoods,
                                 "stg_listings": stg_l, "stg_reviews": stg_r,
                                 "stg_calendar": stg_c}
    dim_l = marts.dim_listing(marts.listings_enriched(stg_l, stg_r, stg_c))
    dim_l = (write_bucketed(spark, dim_l, wh.path("dim_listing"), wh.buckets) if wh.buckets
             else write_table(spark, dim_l, wh.path("dim_listing")))
    wh.log("dim_listing", "OK")
    out["dim_listing"] = dim_l
    out["dim_host"] = write_table(spark, marts.dim_host(marts.host_metrics(stg_l)),
                                  wh.path("dim_host"))
    wh.log("dim_host", "OK")
    out["dim_neighbourhood"] = write_table(spark, marts.dim_neighbourhood(stg_l),
                                           wh.path("dim_neighbourhood"))
    wh.log("dim_neighbourhood", "OK")
    r = facts.fct_reviews(spark, stg_r, wh.path("fct_reviews"))
    wh.log("fct_reviews", "OK", r.mode)
    c = facts.fct_calendar(spark, stg_c, wh.path("fct_calendar"), wh.buckets)
    wh.log("fct_calendar", "OK", c.mode)
    out["fct_reviews"] = facts.read_fct_reviews(spark, wh.path("fct_reviews"))
    out["fct_calendar"] = facts.read_fct_calendar(spark, wh.path("fct_calendar"))
    out["monthly_occupancy"] = write_table(
        spark, marts.monthly_occupancy(out["fct_calendar"], dim_l),
        wh.path("monthly_occupancy"), sort_by=["month"])
    wh.log("monthly_occupancy", "OK")
    out["pricing_analysis"] = write_table(spark, marts.pricing_analysis(dim_l),
                                          wh.path("pricing_analysis"))
    wh.log("pricing_analysis", "OK")
    return out


def run_tests(models: dict[str, DataFrame], as_of, wh: Warehouse) -> bool:
    """Generic and singular tests; each logs PASS or FAIL with its failure count."""
    results = quality.union_all([
        quality.generic_tests(models).select(F.concat_ws(".", "model", "column", "test").alias("test"), "failures"),
        quality.non_positive_price(models["dim_listing"])
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit("assert_listing_price_positive").alias("test"), "failures"),
        quality.bad_review_dates(models["fct_reviews"], as_of)
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit("assert_review_date_valid").alias("test"), "failures"),
    ])
    ok = True
    for row in results.collect():  # one row per declared test (18), not per data row
        passed = row["failures"] == 0
        ok &= passed
        wh.log(row["test"], "PASS" if passed else "FAIL", f"{row['failures']} failures")
    return ok


def run_pipeline(spark: SparkSession, raw: RawInputs, warehouse: str, as_of=None,
                 raise_on_failure: bool = True, database: str | None = None,
                 buckets: int | None = None) -> DataFrame:
    """Build every model, run the tests, then the quality gate. Returns the step log.

    ``as_of``: the date the review-date test compares with (default: CURRENT_DATE).

    ``database``: write the marts as catalog tables of that database (located under
    ``warehouse``) instead of plain Parquet folders; ``buckets``: with the staged tables, the
    listing dimension and the calendar fact in that many buckets by listing.
    """
    if buckets and not database:
        raise ValueError("buckets need a database")
    wh = Warehouse(warehouse, database, buckets)
    models = build_models(spark, raw, wh)
    tests_ok = run_tests(models, as_of, wh)
    if not tests_ok and raise_on_failure:
        raise PipelineFailed(f"tests failed: {[s for s in wh.steps if s[1] == 'FAIL']}")
    probe = quality.quality_probe(models["dim_listing"], models["fct_reviews"],
                                  models["fct_calendar"])
    for row in probe.collect():  # five checks
        wh.log(f"quality: {row['check']}", row["status"], row["result"])
    if any(s[1] == "FAIL" for s in wh.steps if s[0].startswith("quality")) \
            and raise_on_failure:
        raise PipelineFailed("quality checks failed")
    return spark.createDataFrame(wh.steps, "step string, status string, detail string")
