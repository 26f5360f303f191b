"""Business semantics that are easy to get wrong, on tiny frames."""
import datetime as dt
from decimal import Decimal

from rentalmart.plans import marts, reports
from rentalmart.plans.staging import STG_LISTINGS_COLUMNS

D = dt.date
CAL = ("listing_id long, calendar_date date, is_available boolean, price decimal(10,2), "
       "adjusted_price decimal(10,2), minimum_nights int, maximum_nights int")


def cal(spark, rows):
    return spark.createDataFrame(
        [(lid, d, a, None if p is None else Decimal(p), None, 1, 30) for lid, d, a, p in rows],
        CAL)


def listings(spark, rows):
    """rows: (listing_id, price, rating, superhost, neighbourhood, room_type)"""
    base = {c: None for c in STG_LISTINGS_COLUMNS}
    out = []
    for lid, price, rating, sh, hood, room in rows:
        r = dict(base, listing_id=lid, host_id=lid % 2, price=price, review_scores_rating=rating,
                 host_is_superhost=sh, neighbourhood=hood, room_type=room,
                 number_of_reviews=1, availability_365=10, minimum_nights=2,
                 reviews_per_month=Decimal("1.00"))
        out.append(tuple(r[c] for c in STG_LISTINGS_COLUMNS))
    schema = ("listing_id long, host_id long, last_scraped_date date, listing_name string, "
              "neighbourhood string, latitude double, longitude double, property_type string, "
              "room_type string, accommodates int, bathrooms decimal(4,1), bathrooms_text string, "
              "bedrooms int, beds int, amenities string, price decimal(10,2), minimum_nights int, "
              "maximum_nights int, has_availability boolean, availability_365 int, "
              "number_of_reviews int, number_of_reviews_ltm int, first_review_date date, "
              "last_review_date date, review_scores_rating decimal(14,1), "
              "review_scores_accuracy int, review_scores_cleanliness int, "
              "review_scores_checkin int, review_scores_communication int, "
              "review_scores_location int, review_scores_value int, instant_bookable boolean, "
              "host_listings_count int, reviews_per_month decimal(5,2), host_name string, "
              "host_since date, host_location string, host_response_time string, "
              "host_response_rate string, host_acceptance_rate string, "
              "host_is_superhost boolean, host_neighbourhood string, "
              "host_total_listings_count int, host_has_profile_pic boolean, "
              "host_identity_verified boolean")
    return spark.createDataFrame(out, schema)


def test_b1_b2_listing_stats_use_available_days_and_null_is_not_available(spark):
    c = cal(spark, [(1, D(2024, 1, 1), True, "10.00"), (1, D(2024, 1, 2), None, "20.00"),
                    (1, D(2024, 1, 3), False, "30.00"), (1, D(2024, 1, 4), False, None)])
    r = marts.calendar_stats(c).first()
    assert (r.available_days, r.total_days, r.occupancy_rate_pct) == (1, 4, 25.0)
    assert r.avg_price == 25.0  # NULL availability counts as not available: (20 + 30) / 2


def test_b2_b7_monthly_uses_booked_days_null_excluded_and_price_fallback(spark):
    c = cal(spark, [(1, D(2024, 1, 1), True, "10.00"), (1, D(2024, 1, 2), None, "20.00"),
                    (1, D(2024, 1, 3), False, "30.00"), (1, D(2024, 1, 4), False, None),
                    (9, D(2024, 1, 4), False, "5.00")])  # unknown listing: dropped
    lst = listings(spark, [(1, Decimal("100.00"), None, None, "A", "Room")])
    r = marts.monthly_occupancy(c, lst).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.days_in_month, r.booked_days, r.available_days) == (4, 3, 1)
    assert r.occupancy_rate_pct == 75.0
    assert r.avg_price == 65.0  # (30 + fallback 100) / 2; the NULL-availability day is out
    assert r.estimated_revenue == Decimal("130.00")
    assert r.avg_daily_rate == 43.33


def test_monthly_revenue_null_only_when_every_term_is_null(spark):
    c = cal(spark, [(1, D(2024, 2, 1), False, None)])
    lst = listings(spark, [(1, None, None, None, "A", "Room")])
    r = marts.monthly_occupancy(c, lst).first()
    assert r.estimated_revenue is None and r.avg_price is None and r.avg_daily_rate is None


def test_b3_b4_null_price_is_luxury_null_rating_is_unrated(spark):
    lst = listings(spark, [(1, None, None, None, "A", "Room"),
                           (2, Decimal("4999.99"), Decimal("69.9"), None, "A", "Room")])
    r = {x.listing_id: x for x in marts.listings_enriched(
        lst, spark.createDataFrame([], "listing_id long, review_date date"),
        cal(spark, [])).collect()}
    assert (r[1].price_tier, r[1].rating_category) == ("Luxury", "Unrated")
    assert (r[2].price_tier, r[2].rating_category) == ("Budget", "Fair")
    assert r[1].total_reviews == 0 and r[1].occupancy_rate_pct is None


def test_b4_b5_b6_host_tiers_and_superhost_labels(spark):
    lst = listings(spark, [(2, Decimal("10.00"), None, None, "A", "Room")])
    h = marts.dim_host(marts.host_metrics(lst)).first()
    assert (h.host_tier, h.host_rating_tier) == ("Single-listing Host", "Needs Improvement")
    prof = reports.superhost_profile(marts.dim_host(marts.host_metrics(lst))).first()
    assert prof.type == "Regular"  # NULL superhost flag


def test_b6_host_with_differing_attributes_gives_two_rows(spark):
    lst = listings(spark, [(2, Decimal("10.00"), None, True, "A", "Room"),
                           (4, Decimal("10.00"), None, False, "A", "Room")])
    assert marts.host_metrics(lst).count() == 2  # same host_id 0, superhost flag differs


def test_b12_top_bottom_labels_stay_with_their_branch(spark):
    lst = listings(spark, [(i, Decimal(10 * i), None, None, f"N{i}", "Room")
                           for i in range(1, 4)])
    rows = reports.neighbourhood_gap(lst, n=5).collect()
    assert [r.type for r in rows].count("Top") == 3 and len(rows) == 6


def test_superhost_premium_is_null_when_a_side_is_missing(spark):
    lst = listings(spark, [(2, Decimal("10.00"), None, None, "A", "Room")])
    r = reports.superhost_premium(reports.superhost_profile(
        marts.dim_host(marts.host_metrics(lst)))).first()
    assert r.price_pct is None and r.rating_diff is None


def test_b9_probe_passes_by_default_and_fails_below_an_optional_minimum(spark):
    from rentalmart.plans import quality
    lst = listings(spark, [(1, Decimal("10.00"), None, None, "A", "Room")])
    rev = spark.createDataFrame([(1, D(2024, 1, 1))], "review_id long, review_date date")
    c = cal(spark, [(1, D(2024, 1, 1), True, "10.00")])
    default = {r.check: r for r in quality.quality_probe(lst, rev, c).collect()}
    assert {r.status for r in default.values()} == {"PASS"}
    assert default["Total reviews"].result == "(1,)"
    assert default["Calendar date range"].result == \
        "(datetime.date(2024, 1, 1), datetime.date(2024, 1, 1))"
    strict = {r.check: r.status for r in quality.quality_probe(
        lst, rev, c, min_values={"Total reviews": 2}).collect()}
    assert strict["Total reviews"] == "FAIL" and strict["Neighbourhoods"] == "PASS"


def test_top_segments_display_keeps_the_first_of_the_top(spark):
    lst = listings(spark, [(i, Decimal(10 * i), None, None, f"N{i % 9}", f"R{i % 4}")
                           for i in range(1, 400)])
    pricing = marts.pricing_analysis(marts.dim_listing(marts.listings_enriched(
        lst, spark.createDataFrame([], "listing_id long, review_date date"), cal(spark, []))))
    top = [r.avg_price for r in reports.top_segments(pricing, 50).collect()]
    shown = [r.avg_price for r in reports.top_segments(pricing, 50, shown=20).collect()]
    assert shown == top[:20] and top == sorted(top, reverse=True)
