"""Report queries over the marts (J-15..J-29).

Every report is an aggregate or a top-k over a dimension or mart, so the result is bounded
by the number of groups (or by ``n``); nothing is collected to the driver. Derived metrics
the source computed in Python after fetching (listings per host, labels, the superhost
premium) are columns of the same query here. Orderings get a deterministic tie-breaker
(the group key) and spell NULL placement out (the reference engine sorts NULLs last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentalmart.functions.bands import host_type_sql
from rentalmart.functions.numeric import (avg_double_sql, avg_rounded_sql, ratio_sql,
                                          round_half_sql)
from rentalmart.operators.quantiles import quantile_sql, ranked

PRICE_CAP = 100000
TOP_SEGMENTS = 50
TOP_SEGMENTS_SHOWN = 20
TOP_REVIEWED = 10
GAP_N = 5


def _x(*exprs: str) -> list[F.Column]:
    return [F.expr(e) for e in exprs]


def _r(e: str, n: int, alias: str) -> str:
    return f"{round_half_sql(e, n)} AS {alias}"


def market_summary(dim_listing: DataFrame) -> DataFrame:
    """J-15: one row of market KPIs."""
    return dim_listing.agg(*_x(
        "count(1) AS total_listings",
        "count(DISTINCT host_id) AS total_hosts",
        _r(avg_double_sql("price", 2), 0, "avg_price"),
        _r(avg_double_sql("review_scores_rating", 1), 1, "avg_rating"),
        _r(avg_rounded_sql("occupancy_rate_pct", 1), 1, "avg_occupancy")))


def listings_per_host(dim_listing: DataFrame) -> DataFrame:
    """J-16: J-15 plus listings per host (NULL when there are no hosts)."""
    return market_summary(dim_listing).selectExpr(
        "*", _r(ratio_sql("total_listings", "total_hosts"), 1, "listings_per_host"))


def top_segments(pricing: DataFrame, n: int = TOP_SEGMENTS,
                 shown: int | None = None) -> DataFrame:
    """J-17: the ``n`` priciest (neighbourhood, room type) segments; ``shown`` keeps the
    first rows of those for display (the reference charts the first 20 of 50)."""
    top = (pricing
           .select("neighbourhood", "room_type", "num_listings", "avg_price",
                   "median_price", "p25_price", "p75_price", "avg_review_score")
           .orderBy(F.desc_nulls_last("avg_price"), F.asc_nulls_last("neighbourhood"),
                    F.asc_nulls_last("room_type"))
           .limit(n))
    return top.limit(min(n, shown)) if shown is not None else top


def price_rows(dim_listing: DataFrame, cap: float = PRICE_CAP) -> DataFrame:
    """J-18: listing prices inside (0, cap), the input of the price distribution."""
    return (dim_listing.where(f"price > 0 AND price < {cap}")
            .select("price", "room_type", "neighbourhood"))


def price_box(dim_listing: DataFrame, cap: float = PRICE_CAP) -> DataFrame:
    """J-19: box-plot summary per room type: quartiles (linear interpolation), 1.5 IQR
    fences and the number of outliers. Computed where the data lives instead of shipping
    every price to a chart library."""
    keys = ["room_type"]
    counts = (price_rows(dim_listing, cap).groupBy("room_type", F.expr("CAST(price * 100 AS BIGINT) AS cents"))
              .agg(F.expr("count(1) AS c")))
    fenced = (ranked(counts, keys, "cents")
              .selectExpr("*", *[f"{quantile_sql('cents', q, keys)} / 100.0D AS {name}"
                                 for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
              .selectExpr("*", "q1 - 1.5D * (q3 - q1) AS lower_fence", "q3 + 1.5D * (q3 - q1) AS upper_fence"))
    return fenced.groupBy("room_type").agg(*_x(
        "sum(c) AS n", *[f"max({c}) AS {c}" for c in ("q1", "median", "q3", "lower_fence", "upper_fence")],
        "sum(IF(cents / 100.0D < lower_fence OR cents / 100.0D > upper_fence, c, 0)) AS n_outliers"))


def occupancy_trend(monthly: DataFrame) -> DataFrame:
    """J-20: average occupancy and price per month and room type (priced months only)."""
    return (monthly.where("avg_price IS NOT NULL")
            .groupBy("month", "room_type")
            .agg(*_x(_r(avg_rounded_sql("occupancy_rate_pct", 1), 1, "avg_occupancy"),
                     _r(avg_rounded_sql("avg_price", 2), 0, "avg_price")))
            .orderBy(F.asc_nulls_last("month"), F.asc_nulls_last("room_type")))


def hosts_by_tier(dim_host: DataFrame) -> DataFrame:
    """J-21: host rows per rating tier."""
    return dim_host.groupBy("host_rating_tier").agg(F.expr("count(1) AS count"))


def superhost_compare(dim_host: DataFrame) -> DataFrame:
    """J-22: superhost vs regular (a NULL flag counts as regular); averages over hosts."""
    return (dim_host.groupBy(F.expr(f"{host_type_sql('host_is_superhost')} AS host_type"))
            .agg(*_x(_r(avg_rounded_sql("avg_listing_price", 2), 0, "avg_price"),
                     _r(avg_rounded_sql("avg_review_score", 1), 1, "avg_rating"),
                     _r(avg_double_sql("total_reviews_received"), 0, "avg_reviews"))))


def review_volume(fct_reviews: DataFrame) -> DataFrame:
    """J-23: reviews per month."""
    return (fct_reviews.groupBy(F.expr("trunc(review_date, 'month') AS month"))
            .agg(F.expr("count(1) AS review_count"))
            .orderBy(F.asc_nulls_last("month")))


def top_reviewed(dim_listing: DataFrame, n: int = TOP_REVIEWED) -> DataFrame:
    """J-24: the ``n`` most reviewed listings (ties broken by listing id)."""
    return (dim_listing
            .orderBy(F.desc_nulls_last("number_of_reviews"), F.asc("listing_id"))
            .limit(n)
            .select("listing_name", "number_of_reviews", "price", "review_scores_rating",
                    "neighbourhood", "room_type"))


def room_breakdown(dim_listing: DataFrame) -> DataFrame:
    """J-25: per room type, listings and averages; by (rounded) price, highest first."""
    return (dim_listing.where("price > 0")
            .groupBy("room_type")
            .agg(*_x("count(1) AS n",
                     _r(avg_double_sql("price", 2), 0, "price"),
                     _r(avg_double_sql("review_scores_rating", 1), 1, "rating"),
                     _r(avg_rounded_sql("occupancy_rate_pct", 1), 1, "occ"),
                     _r(avg_double_sql("minimum_nights"), 0, "min_nights")))
            .orderBy(F.desc_nulls_last("price"), F.asc_nulls_last("room_type")))


def neighbourhood_gap(dim_listing: DataFrame, n: int = GAP_N) -> DataFrame:
    """J-26: the ``n`` priciest and ``n`` cheapest neighbourhoods, labelled Top / Bottom.

    A NULL neighbourhood is a group of its own here. Each branch is labelled before the
    union, so the labels never depend on how many rows a branch returned.
    """
    by_hood = (dim_listing.where("price > 0")
               .groupBy("neighbourhood")
               .agg(*_x(_r(avg_double_sql("price", 2), 0, "price"), "count(1) AS n")))
    top = (by_hood.orderBy(F.desc_nulls_last("price"), F.asc_nulls_last("neighbourhood"))
           .limit(n).selectExpr("'Top' AS type", "neighbourhood", "price", "n"))
    bottom = (by_hood.orderBy(F.asc_nulls_last("price"), F.asc_nulls_last("neighbourhood"))
              .limit(n).selectExpr("'Bottom' AS type", "neighbourhood", "price", "n"))
    return top.unionByName(bottom)


def quarterly_occupancy(monthly: DataFrame) -> DataFrame:
    """J-27: average occupancy and price per quarter (no NULL-price filter)."""
    return (monthly.groupBy(F.expr("trunc(month, 'quarter') AS q"))
            .agg(*_x(_r(avg_rounded_sql("occupancy_rate_pct", 1), 1, "occ"),
                     _r(avg_rounded_sql("avg_price", 2), 0, "price")))
            .orderBy(F.asc_nulls_last("q")))


def superhost_profile(dim_host: DataFrame) -> DataFrame:
    """J-28: host rows, price, rating, reviews and reviews per month by host type."""
    return (dim_host.groupBy(F.expr(f"{host_type_sql('host_is_superhost')} AS type"))
            .agg(*_x("count(1) AS n",
                     _r(avg_rounded_sql("avg_listing_price", 2), 0, "price"),
                     _r(avg_rounded_sql("avg_review_score", 1), 1, "rating"),
                     _r(avg_double_sql("total_reviews_received"), 0, "reviews"),
                     _r(avg_rounded_sql("avg_reviews_per_month", 2), 2, "rvpm"))))


def superhost_premium(profile: DataFrame) -> DataFrame:
    """J-29: superhost premium in one row, from the *rounded* J-28 values.

    price_pct = (superhost price / regular price - 1) * 100, review_pct likewise for
    reviews, rating_diff = superhost rating - regular rating; NULL when a side is missing.
    """
    sides = [f"max(CASE WHEN type = '{label}' THEN {col} END) AS {pre}_{col}"
             for col in ("price", "reviews", "rating")
             for label, pre in (("Superhost", "s"), ("Regular", "r"))]
    return profile.agg(*_x(*sides)).selectExpr(
        f"({ratio_sql('s_price', 'r_price')} - 1.0D) * 100.0D AS price_pct",
        f"({ratio_sql('s_reviews', 'r_reviews')} - 1.0D) * 100.0D AS review_pct",
        "s_rating - r_rating AS rating_diff",
        "s_price", "r_price", "s_reviews", "r_reviews", "s_rating", "r_rating")
