"""Hot keys: one listing holds a third of all calendar days, one host a third of all
listings. Results are checked against a brute-force pandas computation of the same rules."""
import datetime as dt
import random
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from rentalmart.plans import marts
from test_semantics import CAL, listings


def _calendar_rows(n=6000):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        lid = 1 if i % 3 == 0 else rnd.randint(2, 60)  # listing 1 is hot
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))
        avail = rnd.choice([True, False, False, None])
        price = None if rnd.random() < 0.2 else Decimal(rnd.randint(1000, 90000)) / 100
        rows.append((lid, day, avail, price, None, 1, 30))
    return rows


def test_monthly_and_listing_stats_with_a_hot_listing(spark):
    rows = _calendar_rows()
    cal = spark.createDataFrame(rows, CAL)
    lst = listings(spark, [(i, None if i % 7 == 0 else Decimal(100 * i), None, None, "A", "R")
                           for i in range(1, 61)])
    got = {(r.month, r.listing_id): r for r in marts.monthly_occupancy(cal, lst).collect()}

    pdf = pd.DataFrame(rows, columns=["listing_id", "d", "avail", "price", "adj", "mn", "mx"])
    lp = {i: (None if i % 7 == 0 else Decimal(100 * i)) for i in range(1, 61)}
    pdf["month"] = pdf["d"].map(lambda x: x.replace(day=1))
    for (m, lid), g in pdf.groupby(["month", "listing_id"]):
        r = got[(m, lid)]
        booked = int((g["avail"] != True).sum())  # noqa: E712 - NULL counts as booked
        vals = [p if p is not None else lp[lid] for p, a in zip(g["price"], g["avail"])
                if a is False]
        vals = [v for v in vals if v is not None]
        assert (r.days_in_month, r.booked_days) == (len(g), booked)
        revenue = sum(vals, Decimal(0)) if vals or any(a is not False for a in g["avail"]) \
            else None
        assert r.estimated_revenue == revenue
        if vals:
            assert abs(r.avg_price - float(sum(vals)) / len(vals)) < 0.006
        else:
            assert r.avg_price is None
    assert len(got) == pdf.groupby(["month", "listing_id"]).ngroups

    stats = {r.listing_id: r for r in marts.calendar_stats(cal).collect()}
    hot = pdf[pdf["listing_id"] == 1]
    assert stats[1].total_days == len(hot) == 2000
    assert stats[1].available_days == int((hot["avail"] == True).sum())  # noqa: E712


def test_host_metrics_with_a_hot_host(spark):
    rows = [(i, Decimal(10 + i % 50), None, None, "A", "R") for i in range(1, 3001)]
    lst = listings(spark, rows)
    # make host 7 own every third listing; all other listings have hosts of their own
    lst = lst.withColumn(
        "host_id", F.expr("CASE WHEN listing_id % 3 = 0 THEN 7 ELSE 10000 + listing_id END"))
    hot = [r for r in marts.host_metrics(lst).collect() if r.host_id == 7]
    assert len(hot) == 1 and hot[0].num_listings == 1000
    want = sum(Decimal(10 + i % 50) for i in range(3, 3001, 3)) / 1000
    assert abs(hot[0].avg_listing_price - float(want)) < 0.006
