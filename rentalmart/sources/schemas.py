"""Declared schemas of the four landed inputs (listings, reviews, calendar, neighbourhoods).

CSV type inference is not equal across engines (``t``/``f`` columns, small ids), so the
raw files are always read with these explicit schemas. Numbers that the models later cast
to INT are read as DOUBLE, because the source rounds a double (half to even) when it
casts, and text such as ``2.5`` must not fail the read.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField,
                               StructType)


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(name, typ, True) for name, typ in cols])


S, D, L, DT = StringType(), DoubleType(), LongType(), DateType()

RAW_LISTINGS = _schema(
    ("id", L), ("host_id", L), ("last_scraped", DT), ("name", S),
    ("neighbourhood_cleansed", S), ("neighbourhood", S), ("latitude", D), ("longitude", D),
    ("property_type", S), ("room_type", S), ("accommodates", D), ("bathrooms", D),
    ("bathrooms_text", S), ("bedrooms", D), ("beds", D), ("amenities", S), ("price", S),
    ("minimum_nights", D), ("maximum_nights", D), ("has_availability", S),
    ("availability_365", D), ("number_of_reviews", D), ("number_of_reviews_ltm", D),
    ("first_review", DT), ("last_review", DT), ("review_scores_rating", D),
    ("review_scores_accuracy", D), ("review_scores_cleanliness", D),
    ("review_scores_checkin", D), ("review_scores_communication", D),
    ("review_scores_location", D), ("review_scores_value", D), ("instant_bookable", S),
    ("calculated_host_listings_count", D), ("reviews_per_month", D), ("host_name", S),
    ("host_since", DT), ("host_location", S), ("host_response_time", S),
    ("host_response_rate", S), ("host_acceptance_rate", S), ("host_is_superhost", S),
    ("host_neighbourhood", S), ("host_total_listings_count", D),
    ("host_has_profile_pic", S), ("host_identity_verified", S),
)

RAW_REVIEWS = _schema(
    ("listing_id", L), ("id", L), ("date", DT), ("reviewer_id", L), ("reviewer_name", S),
    ("comments", S),
)

RAW_CALENDAR = _schema(
    ("listing_id", L), ("date", DT), ("available", S), ("price", S), ("adjusted_price", S),
    ("minimum_nights", D), ("maximum_nights", D),
)

RAW_NEIGHBOURHOODS = _schema(("neighbourhood_group", S), ("neighbourhood", S))

# table name -> (file name, schema)
RAW_TABLES = {
    "raw_listings": ("listings.csv", RAW_LISTINGS),
    "raw_reviews": ("reviews.csv", RAW_REVIEWS),
    "raw_calendar": ("calendar.csv", RAW_CALENDAR),
    "raw_neighbourhoods": ("neighbourhoods.csv", RAW_NEIGHBOURHOODS),
}
