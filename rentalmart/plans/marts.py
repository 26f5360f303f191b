"""Enrichment, dimensions and the two analytical marts (J-04..J-10, J-13, J-14).

Scale notes (the calendar is the big input: listings x days):

* Every aggregate is algebraic (count / sum / min / max), so Spark combines partially on
  the map side; a listing or host that holds a third of all rows still ships one partial
  row per map task, never its raw rows.
* ``listings_enriched`` joins listings to two aggregates keyed by ``listing_id``; both are
  unique per key after aggregation, so neither join can fan out or skew.
* ``monthly_occupancy`` aggregates calendar days to (listing, month) *before* the join to
  listings, carrying exact decimal partial sums plus the number of booked days without a
  nightly price; the listing-price fallback is applied after the join (exact in decimal).
  The join input is therefore at most listings x months rows, whatever the skew.
* Percentiles in ``pricing_analysis`` are exact: listings are counted per segment and price
  first, and running counts over a segment's distinct prices give every order statistic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentalmart.functions.bands import (DEFAULT_BANDS, Bands, host_rating_tier_sql,
                                        host_tier_sql, price_tier_sql, rating_category_sql)
from rentalmart.operators.quantiles import quantile_sql, ranked
from rentalmart.functions.numeric import (avg_double_sql, avg_of_sums_sql, avg_rounded_sql,
                                          count_not_true_sql, count_true_sql, pct_sql,
                                          round_half_sql)
from rentalmart.plans.staging import STG_LISTINGS_COLUMNS

# What tells a host apart, and the columns of the listing dimension.
HOST_KEYS = ["host_id", "host_name", "host_since", "host_location", "host_response_time",
             "host_response_rate", "host_acceptance_rate", "host_is_superhost",
             "host_neighbourhood", "host_total_listings_count"]

DIM_LISTING_COLUMNS = [
    "listing_id", "host_id", "host_name", "listing_name", "neighbourhood", "latitude",
    "longitude", "property_type", "room_type", "accommodates", "bathrooms", "bedrooms",
    "beds", "amenities", "price", "minimum_nights", "maximum_nights", "has_availability",
    "availability_365", "number_of_reviews", "number_of_reviews_ltm", "first_review_date",
    "last_review_date", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_location", "review_scores_value", "instant_bookable",
    "reviews_per_month", "total_reviews", "avg_calendar_price", "available_days",
    "total_days", "occupancy_rate_pct", "price_tier", "rating_category",
]

MIN_GROUP_SIZE = 5
QUARTILES = (0.25, 0.5, 0.75)


def _x(*exprs: str) -> list[F.Column]:
    """SQL expressions (with aliases) as Columns, one ``expr`` call each."""
    return [F.expr(e) for e in exprs]


def review_stats(reviews: DataFrame) -> DataFrame:
    """J-04: reviews per listing with first and last review date."""
    return reviews.groupBy("listing_id").agg(*_x(
        "count(1) AS total_reviews",
        "min(review_date) AS first_review",
        "max(review_date) AS last_review"))


def calendar_stats(calendar: DataFrame) -> DataFrame:
    """J-05: per listing, average price of non-available days and availability counts.

    ``occupancy_rate_pct`` here is the share of *available* days (the monthly mart uses
    booked days under the same name). A NULL availability counts as not available.
    """
    not_available_price = "CASE WHEN is_available THEN NULL ELSE price END"
    return (calendar.groupBy("listing_id")
            .agg(*_x(f"{avg_double_sql(not_available_price, 2)} AS avg_price",
                     f"{count_true_sql('is_available')} AS available_days",
                     "count(1) AS total_days"))
            .selectExpr("*", f"{pct_sql('available_days', 'total_days', 1)} "
                             "AS occupancy_rate_pct"))


def listings_enriched(listings: DataFrame, reviews: DataFrame, calendar: DataFrame,
                      bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """J-06: staged listings + review and calendar stats + price tier + rating category."""
    r = review_stats(reviews)
    cs = calendar_stats(calendar)
    joined = listings.join(r, "listing_id", "left").join(cs, "listing_id", "left")
    return joined.selectExpr(
        *STG_LISTINGS_COLUMNS,
        "coalesce(total_reviews, CAST(0 AS BIGINT)) AS total_reviews",
        "first_review", "last_review",
        "avg_price AS avg_calendar_price",
        "available_days", "total_days", "occupancy_rate_pct",
        f"{price_tier_sql('price', bands)} AS price_tier",
        f"{rating_category_sql('review_scores_rating', bands)} AS rating_category",
    )


def host_metrics(listings: DataFrame) -> DataFrame:
    """J-07: one row per distinct combination of the ten host attributes (NULLs group)."""
    return listings.groupBy(*HOST_KEYS).agg(*_x(
        "count(1) AS num_listings",
        f"{round_half_sql(avg_double_sql('price', 2), 2)} AS avg_listing_price",
        f"{round_half_sql(avg_double_sql('review_scores_rating', 1), 1)} AS avg_review_score",
        "sum(CAST(number_of_reviews AS BIGINT)) AS total_reviews_received",
        f"{round_half_sql(avg_double_sql('reviews_per_month', 2), 2)} AS avg_reviews_per_month",
        f"{round_half_sql(avg_double_sql('availability_365'), 0)} AS avg_availability_days"))


def dim_listing(enriched: DataFrame) -> DataFrame:
    """J-08: the listing dimension (39 columns of the enriched listing)."""
    return enriched.select(*DIM_LISTING_COLUMNS)


def dim_host(metrics: DataFrame, bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """J-09: host metrics + host tier + host rating tier."""
    return metrics.selectExpr(
        "*",
        f"{host_tier_sql('host_is_superhost', 'num_listings', bands)} AS host_tier",
        f"{host_rating_tier_sql('avg_review_score', bands)} AS host_rating_tier")


def dim_neighbourhood(listings: DataFrame) -> DataFrame:
    """J-10: one row per non-null neighbourhood.

    The source joins the distinct neighbourhoods to their own aggregate; both sides have
    the same filter and key set, so one aggregate gives the same rows with one shuffle.
    """
    return (listings.where("neighbourhood IS NOT NULL")
            .groupBy("neighbourhood")
            .agg(*_x("count(1) AS num_listings",
                     f"{round_half_sql(avg_double_sql('price', 2), 2)} AS avg_price",
                     f"{round_half_sql(avg_double_sql('review_scores_rating', 1), 1)} "
                     "AS avg_review_score",
                     f"{round_half_sql(avg_double_sql('availability_365'), 0)} "
                     "AS avg_availability_days")))


def calendar_month_parts(calendar: DataFrame) -> DataFrame:
    """Calendar days -> (listing_id, month) partial sums used by ``monthly_occupancy``.

    ``booked`` = availability not true (NULL counts as booked). Of the booked days, only
    those explicitly not available (FALSE) carry a price into the averages: the ones with
    a nightly price are summed here, the ones without are counted and later priced at the
    listing price. ``n_zero`` counts the days that contribute 0 to revenue.
    """
    return (calendar
            .selectExpr("listing_id", "trunc(calendar_date, 'month') AS month",
                        "is_available", "price")
            .groupBy("listing_id", "month")
            .agg(*_x("count(1) AS days_in_month",
                     f"{count_not_true_sql('is_available')} AS booked_days",
                     "sum(CASE WHEN NOT is_available THEN price END) AS priced_sum",
                     "count_if(NOT is_available AND price IS NOT NULL) AS n_priced",
                     "count_if(NOT is_available AND price IS NULL) AS n_unpriced",
                     "count_if(is_available IS NULL OR is_available) AS n_zero")))


def monthly_occupancy(calendar: DataFrame, listings: DataFrame) -> DataFrame:
    """J-13: occupancy, average nightly price and revenue per listing and month.

    Inner join: calendar days of unknown listings are dropped. ``occupancy_rate_pct`` is
    the share of *booked* days. Nightly price falls back to the listing price.
    """
    return monthly_from_parts(calendar_month_parts(calendar), listings)


#: The columns of ``calendar_month_parts`` that add up.
MONTH_SUMS = ["days_in_month", "booked_days", "priced_sum", "n_priced", "n_unpriced", "n_zero"]


def monthly_from_parts(parts: DataFrame, listings: DataFrame) -> DataFrame:
    """J-13 from the partial sums, one row per (listing, month).

    Listings that repeat with the same neighbourhood and room type are counted, and their
    prices summed, before the join. So every joined row is a group of the result, and the
    wide rows need no aggregate after the join (its hash maps held a task's whole output).
    """
    dims = listings.groupBy("listing_id", "neighbourhood", "room_type").agg(*_x(
        "count(1) AS copies", "sum(price) AS price_sum", "count(price) AS n_prices"))
    monthly = parts.join(dims, "listing_id").selectExpr(
        "month", "listing_id", "neighbourhood", "room_type",
        "days_in_month * copies AS days_in_month", "booked_days * copies AS booked_days",
        "coalesce(priced_sum, 0) * copies + coalesce(n_unpriced * price_sum, 0) AS value_sum",
        "n_priced * copies + n_unpriced * n_prices AS value_n",
        "n_zero * copies AS n_zero")
    revenue = ("CASE WHEN value_n + n_zero > 0 THEN "
               "CAST(round(value_sum, 2) AS DECIMAL(38,2)) END")
    avg_price = ("CASE WHEN value_n > 0 THEN CAST(value_sum * 100 AS DOUBLE) "
                 "/ CAST(value_n * 100 AS DOUBLE) END")
    return (monthly
            .selectExpr("*", f"{revenue} AS estimated_revenue")
            .selectExpr(
                "month", "listing_id", "neighbourhood", "room_type",
                "CAST(days_in_month AS BIGINT) AS days_in_month",
                "CAST(booked_days AS BIGINT) AS booked_days",
                "CAST(days_in_month - booked_days AS BIGINT) AS available_days",
                f"{pct_sql('booked_days', 'days_in_month', 1)} AS occupancy_rate_pct",
                f"{round_half_sql(avg_price, 2)} AS avg_price",
                "estimated_revenue",
                round_half_sql("CAST(estimated_revenue AS DOUBLE) / "
                               "CAST(nullif(booked_days, 0) AS DOUBLE)", 2)
                + " AS avg_daily_rate"))


def pricing_analysis(listings: DataFrame, min_n: int = MIN_GROUP_SIZE) -> DataFrame:
    """J-14: price statistics per (neighbourhood, room_type) with at least ``min_n``
    positively priced listings, sorted by the two keys (NULL keys last).

    One pass: listings are counted per segment and price, with the exact sums of the averaged
    columns; quartiles and averages follow from that table. PERCENTILE_CONT of money
    truncates to whole cents.
    """
    return pricing_from_counts(price_counts(listings), min_n)


SEGMENT = ["neighbourhood", "room_type"]
# What is averaged over a segment, and its decimals.
AVERAGED = {"price": ("price", 2), "rating": ("review_scores_rating", 1),
            "occupancy": ("CAST(occupancy_rate_pct AS DECIMAL(24,1))", 1),
            "monthly": ("reviews_per_month", 2), "nights": ("minimum_nights", 0)}
#: The columns of ``price_counts`` that add up.
PRICE_SUMS = ["c", *[f"{n}_sum" for n in AVERAGED], *[f"{n}_n" for n in AVERAGED]]


def price_counts(listings: DataFrame) -> DataFrame:
    """Per segment and price (``value``): listings (c), and sums and counts of what is averaged."""
    return (listings.where("price > 0").groupBy(*SEGMENT, F.expr("price AS value"))
            .agg(*_x("count(1) AS c", *[f"sum({e}) AS {n}_sum" for n, (e, _) in AVERAGED.items()],
                     *[f"count({e}) AS {n}_n" for n, (e, _) in AVERAGED.items()])))


def pricing_from_counts(counts: DataFrame, min_n: int = MIN_GROUP_SIZE) -> DataFrame:
    """J-14 from the counts of each segment's prices."""
    keys, averaged = SEGMENT, AVERAGED
    cents = "CAST(value * 100 AS BIGINT)"
    quartiled = ranked(counts, keys, "value").selectExpr(
        "*", *[f"floor({quantile_sql(cents, q, keys)}) / 100.0D AS q{k}" for k, q in enumerate(QUARTILES)])

    def average(name: str, n: int) -> str:
        return round_half_sql(avg_of_sums_sql(f"{name}_sum", f"{name}_n", averaged[name][1]), n)

    return (quartiled.groupBy(*keys).agg(*_x(
                "sum(c) AS num_listings", f"{average('price', 2)} AS avg_price",
                "round(min(value), 2) AS min_price", "max(q0) AS p25_price", "max(q1) AS median_price",
                "max(q2) AS p75_price", "round(max(value), 2) AS max_price",
                f"{average('rating', 1)} AS avg_review_score", f"{average('occupancy', 1)} AS avg_occupancy_pct",
                f"{average('monthly', 2)} AS avg_reviews_per_month", f"{average('nights', 0)} AS avg_min_nights"))
            .where(f"num_listings >= {int(min_n)}")
            .orderBy(F.asc_nulls_last("neighbourhood"), F.asc_nulls_last("room_type")))
