"""Engine-parity rules of the numeric helpers (T1-T4, T7, SC-1/2, SC-13)."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rentalmart.functions import numeric as N


def one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("x,n,want", [
    (1.005, 2, 1.0), (1.255, 2, 1.25), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13),
    (12.35, 1, 12.4), (None, 1, None)])
def test_round_half_matches_scaled_double_rounding(spark, x, n, want):
    assert one(spark, F.expr(N.round_half_sql("x", n)), x, "x double") == want


@pytest.mark.parametrize("x,want", [(2.5, 2), (1.5, 2), (0.5, 0), (3.49, 3), (-1.5, -2)])
def test_to_int_rounds_half_to_even(spark, x, want):
    assert one(spark, F.expr(N.to_int_sql("x")), x, "x double") == want


@pytest.mark.parametrize("text,want", [
    ("$1,234.50", Decimal("1234.50")), ("$0.00", Decimal("0.00")), ("N/A", None),
    (None, None), ("", None), ("$12.345", Decimal("12.35")), ("1e3", Decimal("1000.00"))])
def test_money_parses_or_is_null(spark, text, want):
    assert one(spark, F.expr(N.money_sql("x")), text, "x string") == want


def test_avg_of_decimal_uses_unscaled_quotient(spark):
    # 11829.82 / 3: dividing the already scaled double would give ...333 instead of ...335
    df = spark.createDataFrame([(Decimal("3943.27"),), (Decimal("3943.27"),),
                                (Decimal("3943.28"),)], "p decimal(10,2)")
    got = df.agg(F.expr(N.avg_double_sql("p", 2)).alias("a")).first()["a"]
    assert got == 1182982 / 300


def test_pct_guards_zero_denominator(spark):
    df = spark.createDataFrame([(3, 0), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(F.expr(N.pct_sql("a", "b", 1))).collect()] == [None, 33.3]


def test_score_quantized_before_rescale(spark):
    # 4.76 -> 4.8 -> 96.0 (steps of 2 points)
    assert one(spark, F.expr(N.score_sql("x", 1)), 4.76, "x double") == Decimal("96.0")


def test_cents_percentile_truncates(spark):
    from rentalmart.plans.marts import pricing_analysis
    df = spark.createDataFrame([(Decimal(v),) for v in ["1.00", "3.01", "3.02", "4.00"]], "price decimal(10,2)").selectExpr(
        "'a' AS neighbourhood", "'b' AS room_type", "price", "CAST(NULL AS DECIMAL(5,1)) AS review_scores_rating",
        "1.5D AS occupancy_rate_pct", "CAST(NULL AS DECIMAL(5,2)) AS reviews_per_month", "2 AS minimum_nights")
    r = pricing_analysis(df, min_n=1).first()
    assert (r.p25_price, r.median_price, r.p75_price) == (2.5, 3.01, 3.26)  # 2.5075 -> 2.50, 3.2650 -> 3.26
    assert r.avg_price == 2.76 and r.avg_occupancy_pct == 1.5 and r.avg_review_score is None
