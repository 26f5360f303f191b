"""Staging: typed, renamed projections of the raw inputs (J-01..J-03).

Pure narrow projections: no shuffle, and Catalyst prunes any column a consumer does not
use down to the Parquet scan. Strict casts raise on bad input (ANSI mode), exactly where
the reference's casts are strict; money uses TRY_CAST semantics. Each model is a single
``selectExpr``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rentalmart.functions.numeric import money_sql, score_sql, to_int_sql

SUB_SCORES = ["accuracy", "cleanliness", "checkin", "communication", "location", "value"]


def _boolean(c: str) -> str:
    return f"CAST({c} AS BOOLEAN) AS {c}"


STG_LISTINGS_EXPRS = [
    "CAST(id AS BIGINT) AS listing_id",
    "CAST(host_id AS BIGINT) AS host_id",
    "CAST(last_scraped AS DATE) AS last_scraped_date",
    "name AS listing_name",
    "coalesce(neighbourhood_cleansed, neighbourhood) AS neighbourhood",
    "CAST(latitude AS DOUBLE) AS latitude",
    "CAST(longitude AS DOUBLE) AS longitude",
    "property_type",
    "room_type",
    f"{to_int_sql('accommodates')} AS accommodates",
    "CAST(bathrooms AS DECIMAL(4,1)) AS bathrooms",
    "bathrooms_text",
    f"{to_int_sql('bedrooms')} AS bedrooms",
    f"{to_int_sql('beds')} AS beds",
    "amenities",
    f"{money_sql('price')} AS price",
    f"{to_int_sql('minimum_nights')} AS minimum_nights",
    f"{to_int_sql('maximum_nights')} AS maximum_nights",
    _boolean("has_availability"),
    f"{to_int_sql('availability_365')} AS availability_365",
    f"{to_int_sql('number_of_reviews')} AS number_of_reviews",
    f"{to_int_sql('number_of_reviews_ltm')} AS number_of_reviews_ltm",
    "CAST(first_review AS DATE) AS first_review_date",
    "CAST(last_review AS DATE) AS last_review_date",
    f"{score_sql('review_scores_rating', 1)} AS review_scores_rating",
    *[f"CAST({score_sql(f'review_scores_{s}', 0)} AS INT) AS review_scores_{s}"
      for s in SUB_SCORES],
    _boolean("instant_bookable"),
    f"{to_int_sql('calculated_host_listings_count')} AS host_listings_count",
    "CAST(reviews_per_month AS DECIMAL(5,2)) AS reviews_per_month",
    "host_name",
    "CAST(host_since AS DATE) AS host_since",
    "host_location",
    "host_response_time",
    "host_response_rate",
    "host_acceptance_rate",
    _boolean("host_is_superhost"),
    "host_neighbourhood",
    f"{to_int_sql('host_total_listings_count')} AS host_total_listings_count",
    _boolean("host_has_profile_pic"),
    _boolean("host_identity_verified"),
]

STG_LISTINGS_COLUMNS = [e.rsplit(" AS ", 1)[-1] for e in STG_LISTINGS_EXPRS]

STG_REVIEWS_EXPRS = [
    "CAST(id AS BIGINT) AS review_id",
    "CAST(listing_id AS BIGINT) AS listing_id",
    "CAST(date AS DATE) AS review_date",
    "CAST(reviewer_id AS BIGINT) AS reviewer_id",
    "reviewer_name",
    "comments",
]

STG_CALENDAR_EXPRS = [
    "CAST(listing_id AS BIGINT) AS listing_id",
    "CAST(date AS DATE) AS calendar_date",
    "CAST(available AS BOOLEAN) AS is_available",
    f"{money_sql('price')} AS price",
    f"{money_sql('adjusted_price')} AS adjusted_price",
    f"{to_int_sql('minimum_nights')} AS minimum_nights",
    f"{to_int_sql('maximum_nights')} AS maximum_nights",
]


def stg_listings(raw: DataFrame) -> DataFrame:
    """J-01: one row per listing, 45 typed columns."""
    return raw.selectExpr(*STG_LISTINGS_EXPRS)


def stg_reviews(raw: DataFrame) -> DataFrame:
    """J-02: one row per review."""
    return raw.selectExpr(*STG_REVIEWS_EXPRS)


def stg_calendar(raw: DataFrame) -> DataFrame:
    """J-03: one row per listing and day (duplicates are kept, as in the source)."""
    return raw.selectExpr(*STG_CALENDAR_EXPRS)
