"""Plan-shape assertions on every registered job: no nested-loop or cartesian join, no
Python UDF; scans read only the columns a job needs."""
import pytest

from pyspark.sql import DataFrameWriter

from rentalmart.registry import REGISTRY


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_nested_loop_cartesian_or_python(spark, name, monkeypatch):
    """Of the returned plan and, for jobs that write, of every plan that they write."""
    from conftest import SF_SMALL
    plans = []
    for method in ("save", "parquet", "csv", "saveAsTable"):
        def spy(self, *a, _write=getattr(DataFrameWriter, method), **k):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            return _write(self, *a, **k)
        monkeypatch.setattr(DataFrameWriter, method, spy)
    plans.append(REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                    "ArrowEvalPython"):
            assert bad not in plan, f"{name}: {bad}"
    if name in {"load_raw", "build_all", "fct_calendar", "fct_calendar_stream", "fct_reviews"}:
        assert len(plans) > 2


def test_pricing_and_box_scan_the_listing_chain_once(spark):
    from conftest import SF_SMALL
    for name in ("pricing_analysis", "top_segments", "price_box"):
        plan = REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert sum("o_totalprice" in x for x in plan.split("Relation")[1:]) == 1, name


def test_quality_probe_scans_each_table_once(spark):
    from conftest import SF_SMALL
    from rentalmart import registry
    from rentalmart.plans import quality
    checks = [c for c in quality.probe_checks() if c[0] == "listings"]
    plan = quality.probe_values(registry._dim_listing(spark, SF_SMALL), checks)._jdf.queryExecution().optimizedPlan().toString()
    assert len(checks) == 3 and sum("o_totalprice" in x for x in plan.split("Relation")[1:]) == 1


@pytest.mark.parametrize("name, tables", [("not_null", ["orders", "events", "lineitem"]),
                                          ("unique", ["orders", "events"])])
def test_declared_tests_scan_each_table_once(spark, name, tables):
    from conftest import SF_SMALL
    plan = REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    for table in tables:
        assert sum(f"/{table}.parquet" in line for line in scans) == 1, table


@pytest.mark.parametrize("name", ["monthly_occupancy", "occupancy_trend", "quarterly_occupancy", "review_volume",
                                  "bad_review_dates", "quality_probe", "mart_freshness"])
def test_building_a_report_writes_nothing(spark, name, monkeypatch):
    from conftest import SF_SMALL

    def refuse(self, *a, **k):
        raise AssertionError("a report writes")
    for method in ("save", "parquet", "saveAsTable"):
        monkeypatch.setattr(DataFrameWriter, method, refuse)
    assert REGISTRY[name](spark, SF_SMALL).columns


def test_column_pruning_reaches_the_scan(spark):
    from conftest import SF_SMALL
    plan = REGISTRY["review_volume"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    # reviews only need the review date inputs: no props (comments) column is read
    assert "props" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_pricing_plan_eliminates_unused_review_join(spark):
    from conftest import SF_SMALL
    plan = REGISTRY["pricing_analysis"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "events" not in plan  # review stats are not used by the mart


def test_monthly_occupancy_aggregates_days_before_the_join(spark):
    """The calendar reaches the join as (listing, month) partial sums, never as raw days."""
    from conftest import SF_SMALL
    plan = REGISTRY["monthly_occupancy"](spark, SF_SMALL)._jdf.queryExecution() \
        .optimizedPlan().toString()
    join_at = plan.index("Join Inner")
    below = plan[join_at:]
    # the calendar branch below the join is an Aggregate keyed by listing and month
    assert "Aggregate [listing_id" in below and "trunc(calendar_date" in below


def test_incremental_fact_uses_an_anti_join(spark, scratch):
    import datetime as dt
    from decimal import Decimal

    from rentalmart.plans import facts
    rows = [(1, dt.date(2024, 1, 1), True, Decimal("1.00"), None, 1, 2)]
    schema = ("listing_id long, calendar_date date, is_available boolean, "
              "price decimal(10,2), adjusted_price decimal(10,2), minimum_nights int, "
              "maximum_nights int")
    t = f"{scratch}/f"
    facts.fct_calendar(spark, spark.createDataFrame(rows, schema), t)
    captured = []
    from pyspark.sql import DataFrameWriter
    orig = DataFrameWriter.save

    def spy(self, *a, **k):
        captured.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return orig(self, *a, **k)
    DataFrameWriter.save = spy
    try:
        facts.fct_calendar(spark, spark.createDataFrame(rows, schema), t)
    finally:
        DataFrameWriter.save = orig
    assert captured and "LeftAnti" in captured[-1]
    assert "calendar_month" in captured[-1]
