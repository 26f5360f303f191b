"""Randomised parity of the numeric helpers with the reference's engine (T1, T4, SC-1/2)."""
import random

import pytest

from rentalmart.functions import numeric as N


@pytest.fixture(scope="module")
def doubles():
    rnd = random.Random(11)
    xs = [rnd.randint(-2_000_000, 2_000_000) / 1000 for _ in range(1500)]   # 3-decimal ties
    xs += [rnd.randint(-200_000, 200_000) / 100 + 0.005 for _ in range(500)]  # .xx5 cases
    xs += [rnd.uniform(-1e6, 1e6) for _ in range(500)]
    xs += [k + 0.5 for k in range(-20, 20)]
    return xs


@pytest.mark.parametrize("n", [0, 1, 2])
def test_round_half_equals_reference_round(spark, duck, doubles, n):
    want = [r[0] for r in duck.execute(
        f"SELECT round(x, {n}) FROM unnest(?) WITH ORDINALITY AS t(x, i) ORDER BY i",
        [doubles]).fetchall()]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(doubles)], "i int, x double")
    got = [r[0] for r in df.selectExpr("i", f"{N.round_half_sql('x', n)} AS r")
           .orderBy("i").select("r").collect()]
    assert got == want


def test_int_cast_equals_reference(spark, duck, doubles):
    xs = [x for x in doubles if abs(x) < 1e6]
    want = [r[0] for r in duck.execute(
        "SELECT CAST(x AS INTEGER) FROM unnest(?) WITH ORDINALITY AS t(x, i) ORDER BY i",
        [xs]).fetchall()]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r[0] for r in df.selectExpr("i", f"{N.to_int_sql('x')} AS r")
           .orderBy("i").select("r").collect()]
    assert got == want


def test_money_parse_equals_reference(spark, duck):
    texts = ["$1,234.50", "$0.00", "N/A", "", " ", "$12.345", "$12.355", "1e3", "$-5.00",
             "$99,999,999.99", "$100,000,000.00", "abc", "$1,2,3.4", "12.", ".5", None]
    want = [r[0] for r in duck.execute(
        "SELECT TRY_CAST(REPLACE(REPLACE(x, '$', ''), ',', '') AS DECIMAL(10,2)) "
        "FROM unnest(?) WITH ORDINALITY AS t(x, i) ORDER BY i", [texts]).fetchall()]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = [r[0] for r in df.selectExpr("i", f"{N.money_sql('x')} AS r")
           .orderBy("i").select("r").collect()]
    assert got == want
