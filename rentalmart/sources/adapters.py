"""Adapters: the shared TPC-H-like test tables -> the four raw rental inputs.

Used by tests, the bench and the oracle comparison only; production jobs start from the
landed CSV files (``sources.csv``). Every listing attribute is a fixed function of the order
key (and its customer / nation / region), so another engine can build identical rows; the
independent SQL form lives in ``oracle/sql.py``.

Mapping: listing = ``orders`` (+ ``customer``, ``nation``, ``region``), host = customer,
neighbourhood = nation name with the region name as fallback, calendar day = ``lineitem``
row, review = ``events`` row, neighbourhood list = ``nation``.

All joins here are many-to-one onto dimension tables whose size is fixed by the TPC-H
definition (25 nations, 5 regions) or keyed joins that AQE plans by measured size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the test tables each adapter reads (so the Parquet scan prunes the rest).
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
LINEITEM_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_returnflag", "l_linestatus", "l_shipdate"]
EVENTS_COLS = ["event_id", "ts", "user_id", "props"]


def _table(spark: SparkSession, sf_dir: str, name: str,
           cols: list[str] | None = None) -> DataFrame:
    """The test table as a lazy scan of the columns it needs."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def tenth_money_sql(x: str) -> str:
    """x / 10 as DECIMAL(10,2), computed in decimals so no engine rounds a double tie."""
    return (f"CAST(round(CAST({x} AS DECIMAL(12,2)) * CAST(0.1 AS DECIMAL(2,1)), 2) "
            f"AS DECIMAL(10,2))")


def money_text_sql(x: str) -> str:
    """amount -> ``$12,345.60``."""
    return f"concat('$', format_number({tenth_money_sql(x)}, 2))"


def _flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 't' ELSE 'f' END"


def _score(offset: int) -> str:
    return (f"CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS DOUBLE) "
            f"ELSE CAST(300 + (o_orderkey + {offset}) % 201 AS DOUBLE) / 100 END")


LISTING_EXPRS = [
    "o_orderkey AS id",
    "o_custkey AS host_id",
    "CAST(o_orderdate AS DATE) AS last_scraped",
    "concat('Listing ', CAST(o_orderkey AS STRING)) AS name",
    "CASE WHEN o_orderkey < 30 THEN 'HAMLET' WHEN o_orderkey % 11 = 0 THEN NULL ELSE n_name END "
    "AS neighbourhood_cleansed",
    "CASE WHEN o_orderkey % 121 = 0 THEN NULL ELSE r_name END AS neighbourhood",
    "CAST(35 + n_nationkey / 100 AS DOUBLE) AS latitude",
    "CAST(139 + n_nationkey / 100 AS DOUBLE) AS longitude",
    "o_orderstatus AS property_type",
    "o_orderpriority AS room_type",
    "CAST(1 + o_orderkey % 6 AS DOUBLE) AS accommodates",
    "CAST((o_orderkey % 7) * 0.5 AS DOUBLE) AS bathrooms",
    "CASE WHEN o_orderkey % 2 = 0 THEN '1 bath' ELSE '1.5 baths' END AS bathrooms_text",
    "CAST((o_orderkey % 9) * 0.5 AS DOUBLE) AS bedrooms",
    "CAST((o_orderkey % 7) * 0.5 AS DOUBLE) AS beds",
    "CASE WHEN o_orderkey % 2 = 0 THEN '[\"Wifi\", \"Kitchen\"]' ELSE '[\"Wifi\"]' END "
    "AS amenities",
    "CASE WHEN o_orderkey % 37 = 0 THEN 'N/A' WHEN o_orderkey % 41 = 0 THEN NULL "
    "WHEN o_orderkey % 43 = 0 THEN '$0.00' WHEN o_orderkey % 499 = 0 THEN '$99,000.00' "
    f"WHEN o_orderkey % 503 = 0 THEN '$150,000.00' ELSE {money_text_sql('o_totalprice')} END AS price",
    "CAST(1 + o_orderkey % 30 AS DOUBLE) AS minimum_nights",
    "CAST(30 + o_orderkey % 335 AS DOUBLE) AS maximum_nights",
    f"{_flag('o_orderkey % 2 = 0')} AS has_availability",
    "CAST(o_orderkey % 366 AS DOUBLE) AS availability_365",
    "CAST((o_orderkey * 7) % 300 AS DOUBLE) AS number_of_reviews",
    "CAST((o_orderkey * 3) % 60 AS DOUBLE) AS number_of_reviews_ltm",
    "date_sub(CAST(o_orderdate AS DATE), CAST(o_orderkey % 400 AS INT)) AS first_review",
    "CAST(o_orderdate AS DATE) AS last_review",
    f"{_score(0)} AS review_scores_rating",
    f"{_score(1)} AS review_scores_accuracy",
    f"{_score(2)} AS review_scores_cleanliness",
    f"{_score(3)} AS review_scores_checkin",
    f"{_score(4)} AS review_scores_communication",
    f"{_score(5)} AS review_scores_location",
    f"{_score(6)} AS review_scores_value",
    f"{_flag('o_orderkey % 3 = 0')} AS instant_bookable",
    "CAST(1 + c_custkey % 10 AS DOUBLE) AS calculated_host_listings_count",
    "CAST(o_orderkey % 997 AS DOUBLE) / 100 AS reviews_per_month",
    "c_name AS host_name",
    "date_add(DATE'2008-01-01', CAST(c_custkey % 4000 AS INT)) AS host_since",
    "c_mktsegment AS host_location",
    "CASE WHEN c_custkey % 3 = 0 THEN 'within an hour' WHEN c_custkey % 3 = 1 "
    "THEN 'within a day' ELSE NULL END AS host_response_time",
    "CASE WHEN c_custkey % 10 = 0 AND o_orderkey % 2 = 0 THEN '80%' ELSE '90%' END "
    "AS host_response_rate",
    "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '95%' END AS host_acceptance_rate",
    "CASE WHEN c_custkey % 4 = 0 THEN 't' WHEN c_custkey % 4 = 3 THEN NULL ELSE 'f' END "
    "AS host_is_superhost",
    "n_name AS host_neighbourhood",
    "CAST(c_custkey % 50 AS DOUBLE) AS host_total_listings_count",
    "'t' AS host_has_profile_pic",
    f"{_flag('c_custkey % 2 = 0')} AS host_identity_verified",
]


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders", ORDERS_COLS)
    c = _table(spark, sf_dir, "customer", CUSTOMER_COLS)
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region are fixed-size (25 and 5 rows): broadcasting them is bounded.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    df = (o.join(c, o.o_custkey == c.c_custkey)
          .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    return df.selectExpr(*LISTING_EXPRS)


def _calendar_exprs() -> list[str]:
    money = money_text_sql("l_extendedprice")
    return [
        "IF(orphan, -1 - l_orderkey, l_orderkey) AS listing_id",
        "CAST(l_shipdate AS DATE) AS date",
        "CASE WHEN orphan THEN NULL WHEN l_returnflag = 'N' THEN 't' WHEN l_returnflag = 'A' AND "
        "l_linestatus = 'O' AND l_linenumber = 1 THEN NULL ELSE 'f' END AS available",
        f"CASE WHEN orphan OR l_linenumber = 7 THEN NULL ELSE {money} END AS price",
        f"CASE WHEN l_linenumber IN (6, 7) THEN NULL ELSE {money} END AS adjusted_price",
        "CAST(l_quantity AS DOUBLE) AS minimum_nights",
        "CAST(l_quantity + 30 AS DOUBLE) AS maximum_nights",
    ]


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar day per line item, plus orphan days of unknown listings."""
    li = _table(spark, sf_dir, "lineitem", LINEITEM_COLS)
    # one scan: every row gives its known day, and some an orphan day too
    both = li.withColumn("orphan", F.expr(
        "explode(if(l_orderkey % 500 = 0, array(false, true), array(false)))"))
    return both.selectExpr(*_calendar_exprs())


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per event; some come twice and some have no id."""
    ev = _table(spark, sf_dir, "events", EVENTS_COLS).withColumn(
        "copy", F.expr("explode(if(event_id % 1009 = 0, array(1, 2), array(1)))"))
    return ev.selectExpr(
        "user_id AS listing_id",
        "CASE WHEN event_id % 1013 = 0 THEN NULL ELSE event_id END AS id",
        "CASE WHEN event_id % 997 = 0 THEN DATE'2009-12-31' "
        "WHEN event_id % 991 = 0 THEN DATE'2099-01-01' "
        "ELSE date_add(CAST(ts AS DATE), CAST(event_id % 720 AS INT)) END AS date",
        "CAST(event_id % 5000 AS BIGINT) AS reviewer_id",
        "concat('User ', CAST(event_id % 5000 AS STRING)) AS reviewer_name",
        "props AS comments",
    )


def raw_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .selectExpr("r_name AS neighbourhood_group", "n_name AS neighbourhood"))


@dataclass
class RawInputs:
    listings: DataFrame
    reviews: DataFrame
    calendar: DataFrame
    neighbourhoods: DataFrame


def raw_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    return RawInputs(raw_listings(spark, sf_dir), raw_reviews(spark, sf_dir),
                     raw_calendar(spark, sf_dir), raw_neighbourhoods(spark, sf_dir))


# Incremental batches (FIXTURES): batch 1 is a prefix in time / an even-id subset of the
# same source, batch 2 is everything; the calendar then gets days without a date, twice, and
# the reviews known ids again with another month and text: all of these append nothing new.
CALENDAR_BATCH1_BEFORE = "1999-01-01"


def calendar_batches(raw_cal: DataFrame) -> list[DataFrame]:
    return [raw_cal.where(f"date < DATE'{CALENDAR_BATCH1_BEFORE}'"), raw_cal]


def review_batches(raw_rev: DataFrame) -> list[DataFrame]:
    return [raw_rev.where("id % 2 = 0"), raw_rev]


def undated_days(raw_cal: DataFrame) -> DataFrame:
    """Days whose date is missing (a NULL key part)."""
    return raw_cal.where("listing_id % 700 = 0").withColumn("date", F.lit(None).cast("date"))


def moved_reviews(raw_rev: DataFrame) -> DataFrame:
    """Every review again, with its date in another month and another text."""
    return (raw_rev.withColumn("date", F.add_months("date", 2))
            .withColumn("comments", F.lit("changed")))
