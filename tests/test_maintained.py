"""Marts kept up to date from changes equal marts made anew, and only what changed is rewritten."""
import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest

from rentalmart.operators import versions
from rentalmart.plans import facts, maintained, marts

CAL = ("listing_id long, calendar_date date, is_available boolean, price decimal(10,2), "
       "adjusted_price decimal(10,2), minimum_nights int, maximum_nights int")
DIM = ("listing_id long, neighbourhood string, room_type string, price decimal(10,2), review_scores_rating decimal(4,1), "
       "occupancy_rate_pct double, reviews_per_month decimal(5,2), minimum_nights int")


def days(spark, rnd, n, months):
    rows = [(rnd.randint(1, 12), None if rnd.random() < 0.05 else dt.date(2024, rnd.choice(months), rnd.randint(1, 28)),
             rnd.choice([True, False, False, None]), rnd.choice([None, Decimal(rnd.randint(100, 9999)) / 100]), None, 1, 2)
            for _ in range(n)]
    return spark.createDataFrame(rows, CAL)


def dims(spark, rnd, ids):
    return spark.createDataFrame([
        (k, rnd.choice(["A", "B", None]), rnd.choice(["x", "y"]), rnd.choice([None, Decimal(0), Decimal(rnd.randint(100, 2000)) / 100]),
         rnd.choice([None, Decimal(rnd.randint(500, 1000)) / 10]), rnd.choice([None, float(rnd.randint(0, 1000)) / 10]),
         rnd.choice([None, Decimal(rnd.randint(0, 900)) / 100]), rnd.choice([None, rnd.randint(1, 9)])) for k in ids], DIM)


def content(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def paths(scratch):
    return [f"{scratch}/{n}" for n in ("fct_calendar", "month_parts", "monthly")]


def rebuilt(spark, fact, listings):
    return content(marts.monthly_occupancy(facts.read_fct_calendar(spark, fact), listings))


@pytest.mark.parametrize("seed", [1, 2])
def test_monthly_equals_a_rebuild_after_random_batches(spark, scratch, seed):
    rnd = random.Random(seed)
    fact, parts, mart = paths(scratch)
    listings = dims(spark, rnd, range(1, 11))  # two listings of the calendar are unknown
    for k in range(4):
        facts.fct_calendar(spark, days(spark, rnd, 60, [1, 2, 3] if k == 0 else [k, k + 3]), fact)
        before = versions.current(spark, mart)
        months = maintained.update_monthly(spark, fact, listings, parts, mart)
        assert content(maintained.read_monthly(spark, mart)) == rebuilt(spark, fact, listings)
        after = versions.current(spark, mart)
        if k:
            same = set(before.folders) & set(after.folders)
            assert months and {f for f in before.folders if f.rpartition("/")[2] not in
                               {versions.part_name(maintained.MONTH, m) for m in months}} == same
            assert {m and m.month for m in months} <= {None, k, k + 3}
        assert maintained.update_monthly(spark, fact, listings, parts, mart) == []


def test_an_update_that_failed_half_way_is_made_up_for(spark, scratch, monkeypatch):
    rnd = random.Random(5)
    fact, parts, mart = paths(scratch)
    listings = dims(spark, rnd, range(1, 13))
    facts.fct_calendar(spark, days(spark, rnd, 50, [1, 2]), fact)
    maintained.update_monthly(spark, fact, listings, parts, mart)
    facts.fct_calendar(spark, days(spark, rnd, 50, [2, 3]), fact)

    def die(*a):
        raise KeyboardInterrupt
    monkeypatch.setattr(maintained, "_write_months", die)
    with pytest.raises(KeyboardInterrupt):
        maintained.update_monthly(spark, fact, listings, parts, mart)
    monkeypatch.undo()
    facts.fct_calendar(spark, days(spark, rnd, 50, [5]), fact)
    months = maintained.update_monthly(spark, fact, listings, parts, mart)
    assert {m.month for m in months if m} == {2, 3, 5}
    assert content(maintained.read_monthly(spark, mart)) == rebuilt(spark, fact, listings)


def test_changed_listings_reprice_without_the_days(spark, scratch):
    rnd = random.Random(6)
    fact, parts, mart = paths(scratch)
    facts.fct_calendar(spark, days(spark, rnd, 80, [1, 2]), fact)
    maintained.update_monthly(spark, fact, dims(spark, rnd, range(1, 13)), parts, mart)
    changed = dims(spark, rnd, range(1, 9))
    maintained.reprice_monthly(spark, changed, parts, mart)
    assert content(maintained.read_monthly(spark, mart)) == rebuilt(spark, fact, changed)


def test_a_fact_made_anew_is_applied_anew(spark, scratch):
    rnd = random.Random(7)
    fact, parts, mart = paths(scratch)
    listings = dims(spark, rnd, range(1, 13))
    facts.fct_calendar(spark, days(spark, rnd, 40, [1, 2]), fact)
    maintained.update_monthly(spark, fact, listings, parts, mart)
    kept = versions.read(spark, fact).where("listing_id < 5")
    versions.replace(spark, kept, fact)
    assert maintained.update_monthly(spark, fact, listings, parts, mart) is None
    assert content(maintained.read_monthly(spark, mart)) == rebuilt(spark, fact, listings)


def test_two_writers_conflict(spark, scratch):
    t = f"{scratch}/parts"
    one = spark.createDataFrame([(1, 0)], "x int, p int")
    base = versions.replace_parts(spark, one, t, "p", [0], None)
    versions.replace_parts(spark, one, t, "p", [0], base)
    with pytest.raises(versions.ConflictError):
        versions.replace_parts(spark, one, t, "p", [0], base)
    with pytest.raises(ValueError):
        versions.replace_parts(spark, one, t, "p", [5], versions.current(spark, t))
    assert versions.replace_parts(spark, one.where("false"), t, "p", [0], versions.current(spark, t)).folders == {}
    assert versions.read(spark, t).collect() == []


@pytest.mark.parametrize("seed", [3, 4])
def test_pricing_equals_a_rebuild_after_changes(spark, scratch, seed):
    rnd = random.Random(seed)
    counts, now = f"{scratch}/counts", {r.listing_id: r for r in dims(spark, rnd, range(120)).collect()}
    frame = lambda rows: spark.createDataFrame([*rows], DIM)
    maintained.build_price_counts(spark, frame(now.values()), counts)
    for k in range(3):
        old = [now[i] for i in rnd.sample(sorted(now), 25)]
        gone, changed = old[:8], old[8:]
        fresh = dims(spark, rnd, [r.listing_id for r in changed] + [1000 * (k + 1) + j for j in range(10)]).collect()
        parts = maintained.change_price_counts(spark, frame(old), frame(fresh), counts)
        for r in gone:
            del now[r.listing_id]
        now |= {r.listing_id: r for r in fresh}
        assert parts and len(parts) < maintained.PARTS
        want = marts.pricing_analysis(frame(now.values()))
        assert content(maintained.pricing(spark, counts)) == content(want)
    assert maintained.change_price_counts(spark, frame(fresh), frame(fresh), counts) == []


def test_changes_scan_no_other_listings(spark, scratch):
    """The stored parts that are read are the changed segments'."""
    rnd = random.Random(9)
    counts = f"{scratch}/counts"
    rows = [(k, f"n{k % 40}", "x", Decimal(k % 50 + 1), None, None, None, None) for k in range(400)]
    maintained.build_price_counts(spark, spark.createDataFrame(rows, DIM), counts)
    before = versions.current(spark, counts)
    changed = spark.createDataFrame([rows[5]], DIM)
    parts = maintained.change_price_counts(spark, changed, changed.withColumn("price", changed.price + rnd.randint(1, 5)), counts)
    after = versions.current(spark, counts)
    assert len(parts) == 1 and len(set(before.folders) - set(after.folders)) == 1
