"""Randomised check of the incremental append against a plain model of its rules:
a batch appends exactly its rows whose key is not yet in the table (first version wins),
duplicates inside one batch are all kept, and re-appending known keys changes nothing."""
import collections
import datetime as dt
import random
from decimal import Decimal

from rentalmart.plans import facts

CAL = ("listing_id long, calendar_date date, is_available boolean, price decimal(10,2), "
       "adjusted_price decimal(10,2), minimum_nights int, maximum_nights int")


def test_random_batches_follow_the_append_rules(spark, scratch):
    rnd = random.Random(5)
    target = f"{scratch}/fct"
    model: list[tuple] = []
    for b in range(4):
        rows = []
        for _ in range(rnd.randint(20, 60)):
            key = (rnd.randint(1, 15), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 90)))
            rows.append((*key, rnd.choice([True, False]), Decimal(rnd.randint(1, 999)), None,
                         1, 2))
        seen = {(r[0], r[1]) for r in model}
        model += [r for r in rows if (r[0], r[1]) not in seen]  # in-batch duplicates kept
        facts.fct_calendar(spark, spark.createDataFrame(rows, CAL), target)
        got = collections.Counter(
            (r.listing_id, r.calendar_date, r.is_available, r.price)
            for r in facts.read_fct_calendar(spark, target).collect())
        want = collections.Counter((r[0], r[1], r[2], r[3]) for r in model)
        assert got == want, f"batch {b}"
