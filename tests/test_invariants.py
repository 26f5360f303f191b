"""Cross-job invariants at sf0.001."""
from pyspark.sql import functions as F

import __spark_entry__ as E

Q = E.queries()


def test_available_plus_booked_is_days(spark):
    from conftest import SF_SMALL
    m = Q["monthly_occupancy"](spark, SF_SMALL)
    assert m.where("available_days + booked_days <> days_in_month").count() == 0


def test_dim_listing_has_one_row_per_staged_listing(spark):
    from conftest import SF_SMALL
    assert Q["dim_listing"](spark, SF_SMALL).count() == Q["stg_listings"](spark, SF_SMALL).count()


def test_monthly_days_cover_known_calendar_days(spark):
    from conftest import SF_SMALL
    m = Q["monthly_occupancy"](spark, SF_SMALL).agg(F.sum("days_in_month")).first()[0]
    cal = Q["stg_calendar"](spark, SF_SMALL)
    lst = Q["stg_listings"](spark, SF_SMALL).select("listing_id")
    assert m == cal.join(lst, "listing_id").count()
