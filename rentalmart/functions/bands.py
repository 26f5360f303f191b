"""Banding expressions (searched CASE) with their thresholds as parameters.

Fixed values (defaults that must equal the reference's for equal results):
  price tiers:        < 5000 Budget, < 15000 Mid-range, < 30000 Premium, else Luxury
  rating categories:  >= 95 Excellent, >= 85 Great, >= 70 Good, not null Fair, else Unrated
  host tiers:         superhost Superhost, >= 5 Power Host, >= 2 Multi-listing Host,
                      else Single-listing Host
  host rating tiers:  >= 95 Elite, >= 85 Highly Rated, >= 70 Average,
                      else Needs Improvement
  host type label:    superhost Superhost, else Regular

Each band is one SQL CASE.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Bands:
    price: tuple[float, float, float] = (5000, 15000, 30000)
    rating: tuple[float, float, float] = (95, 85, 70)
    host_listings: tuple[int, int] = (5, 2)


DEFAULT_BANDS = Bands()


def price_tier_sql(price: str, bands: Bands = DEFAULT_BANDS) -> str:
    """NULL price falls through to Luxury, as in the reference."""
    low, mid, high = bands.price
    return (f"CASE WHEN {price} < {low} THEN 'Budget' WHEN {price} < {mid} THEN 'Mid-range' "
            f"WHEN {price} < {high} THEN 'Premium' ELSE 'Luxury' END")


def rating_category_sql(score: str, bands: Bands = DEFAULT_BANDS) -> str:
    top, great, good = bands.rating
    return (f"CASE WHEN {score} >= {top} THEN 'Excellent' WHEN {score} >= {great} THEN 'Great' "
            f"WHEN {score} >= {good} THEN 'Good' WHEN {score} IS NOT NULL THEN 'Fair' "
            f"ELSE 'Unrated' END")


def host_tier_sql(is_superhost: str, num_listings: str, bands: Bands = DEFAULT_BANDS) -> str:
    power, multi = bands.host_listings
    return (f"CASE WHEN {is_superhost} THEN 'Superhost' "
            f"WHEN {num_listings} >= {power} THEN 'Power Host' "
            f"WHEN {num_listings} >= {multi} THEN 'Multi-listing Host' "
            f"ELSE 'Single-listing Host' END")


def host_rating_tier_sql(score: str, bands: Bands = DEFAULT_BANDS) -> str:
    """NULL average score falls through to Needs Improvement (unlike rating_category)."""
    top, great, good = bands.rating
    return (f"CASE WHEN {score} >= {top} THEN 'Elite' WHEN {score} >= {great} "
            f"THEN 'Highly Rated' WHEN {score} >= {good} THEN 'Average' "
            f"ELSE 'Needs Improvement' END")


def host_type_sql(is_superhost: str) -> str:
    """A NULL superhost flag counts as Regular."""
    return f"CASE WHEN {is_superhost} THEN 'Superhost' ELSE 'Regular' END"
