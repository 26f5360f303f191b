"""The first update of kept sums adds them up once, and finding its months reads no day."""
import datetime as dt
from decimal import Decimal

from rentalmart.operators import versions
from rentalmart.plans import facts, maintained
from test_semantics import CAL


def test_first_update_adds_up_once_and_months_read_no_day(spark, scratch, monkeypatch):
    days = spark.createDataFrame([(k % 3, dt.date(2024, 1 + k % 2, 1 + k), False, Decimal(k), None, 1, 2) for k in range(20)], CAL)
    facts.fct_calendar(spark, days, f"{scratch}/f")
    plans, write = [], versions.replace_parts

    def spy(s, df, *a):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(s, df, *a)
    monkeypatch.setattr(versions, "replace_parts", spy)
    maintained.update_month_parts(spark, f"{scratch}/f", f"{scratch}/p")
    assert plans[0].count("Aggregate [") == 1
    now = versions.current(spark, f"{scratch}/f")
    assert sorted(maintained._months(maintained._rows(spark, f"{scratch}/f", now, None))) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
