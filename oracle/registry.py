"""Oracle statements keyed like ``rentalmart.registry.REGISTRY``.

``portable`` wraps a statement so DECIMAL outputs become DOUBLE and integer sums (HUGEINT
in the oracle engine) become BIGINT, matching the Spark query boundary.
"""

from __future__ import annotations

from oracle.sql import HOST_TYPE, band, query, ravg

ORACLE: dict[str, str] = {}


def portable(sql: str, doubles=(), bigints=()) -> str:
    repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
    repl += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) AS portable_q"


def add(name: str, final: str, deps=(), doubles=(), bigints=()) -> None:
    ORACLE[name] = portable(query(final, *deps), doubles, bigints)


STG_LISTINGS_DEC = ("bathrooms", "price", "review_scores_rating", "reviews_per_month")
CAL_DEC = ("price", "adjusted_price")
ENRICHED_BIG = ("available_days",)

add("stg_listings", "SELECT * FROM stg_listings", ["stg_listings"], STG_LISTINGS_DEC)
add("stg_reviews", "SELECT * FROM stg_reviews", ["stg_reviews"])
add("stg_calendar", "SELECT * FROM stg_calendar", ["stg_calendar"], CAL_DEC)
add("review_stats", "SELECT * FROM review_stats", ["review_stats"])
add("calendar_stats", "SELECT * FROM calendar_stats", ["calendar_stats"], (),
    ENRICHED_BIG)
add("listings_enriched", "SELECT * FROM int_listings_enriched", ["int_listings_enriched"],
    STG_LISTINGS_DEC, ENRICHED_BIG)
add("host_metrics", "SELECT * FROM int_host_metrics", ["int_host_metrics"], (),
    ("total_reviews_received",))
add("dim_listing", "SELECT * FROM dim_listing", ["dim_listing"], STG_LISTINGS_DEC,
    ENRICHED_BIG)
add("dim_host", "SELECT * FROM dim_host", ["dim_host"], (), ("total_reviews_received",))
add("dim_neighbourhood", "SELECT * FROM dim_neighbourhood", ["dim_neighbourhood"])
for _name in ("monthly_occupancy", "monthly_occupancy_kept"):  # the second is the same mart, kept up to date
    add(_name, "SELECT * FROM monthly_occupancy", ["monthly_occupancy"],
        ("estimated_revenue",), ("booked_days", "available_days"))
for _name in ("pricing_analysis", "pricing_analysis_kept"):  # the second is the same mart, kept up to date
    add(_name, "SELECT * FROM pricing_analysis", ["pricing_analysis"],
        ("min_price", "p25_price", "median_price", "p75_price", "max_price"))

# ---------------------------------------------------------------- incremental facts
AS_OF = "DATE '2025-09-30'"

# Batch after batch; a row is appended when no row with its keys (NULL equals NULL) is there.
add("fct_reviews", """
WITH one AS (SELECT * FROM stg_reviews WHERE review_id % 2 = 0),
two AS (SELECT * FROM one UNION ALL
        SELECT * FROM stg_reviews s WHERE NOT EXISTS (
          SELECT 1 FROM one WHERE one.review_id IS NOT DISTINCT FROM s.review_id)),
moved AS (SELECT * REPLACE (CAST(review_date + INTERVAL 2 MONTH AS DATE) AS review_date, 'changed' AS comments)
          FROM stg_reviews)
SELECT * FROM two UNION ALL
SELECT * FROM moved s WHERE NOT EXISTS (SELECT 1 FROM two WHERE two.review_id IS NOT DISTINCT FROM s.review_id)
""", ["stg_reviews"])

_FCT_CAL = """
WITH one AS (SELECT * FROM fct_calendar WHERE calendar_date < DATE '1999-01-01'),
two AS (SELECT * FROM one UNION ALL
        SELECT * FROM fct_calendar s WHERE NOT EXISTS (
          SELECT 1 FROM one WHERE one.listing_id IS NOT DISTINCT FROM s.listing_id
          AND one.calendar_date IS NOT DISTINCT FROM s.calendar_date)),
undated AS (SELECT * REPLACE (CAST(NULL AS DATE) AS calendar_date, CAST(NULL AS VARCHAR) AS cal_key)
            FROM fct_calendar WHERE listing_id % 700 = 0)
SELECT * FROM two UNION ALL
SELECT * FROM undated s WHERE NOT EXISTS (
  SELECT 1 FROM two WHERE two.listing_id IS NOT DISTINCT FROM s.listing_id
  AND two.calendar_date IS NOT DISTINCT FROM s.calendar_date)
"""
add("fct_calendar", _FCT_CAL, ["fct_calendar"], CAL_DEC)
add("fct_calendar_stream", _FCT_CAL, ["fct_calendar"], CAL_DEC)

# ---------------------------------------------------------------- reports
# The formulas and names of the reports from here on are their contract.
_KPIS = f"""count(*) AS total_listings,
  count(DISTINCT host_id) AS total_hosts,
  round(avg(price), 0) AS avg_price,
  round(avg(review_scores_rating), 1) AS avg_rating,
  round({ravg("occupancy_rate_pct", 1)}, 1) AS avg_occupancy"""

add("market_summary", f"SELECT {_KPIS} FROM dim_listing", ["dim_listing"])

add("listings_per_host", f"""
SELECT k.*, round(k.total_listings / k.total_hosts, 1) AS listings_per_host
FROM (SELECT {_KPIS} FROM dim_listing) AS k""", ["dim_listing"])

add("top_segments", """
SELECT neighbourhood, room_type, num_listings, avg_price, median_price, p25_price,
       p75_price, avg_review_score
FROM pricing_analysis
ORDER BY avg_price DESC NULLS LAST, neighbourhood NULLS LAST, room_type NULLS LAST
LIMIT 50""", ["pricing_analysis"], ("median_price", "p25_price", "p75_price"))

add("top_segments_shown", """
SELECT neighbourhood, room_type, num_listings, avg_price, median_price, p25_price,
       p75_price, avg_review_score
FROM pricing_analysis
ORDER BY avg_price DESC NULLS LAST, neighbourhood NULLS LAST, room_type NULLS LAST
LIMIT 20""", ["pricing_analysis"], ("median_price", "p25_price", "p75_price"))

add("price_rows", """
SELECT price, room_type, neighbourhood FROM dim_listing WHERE price > 0 AND price < 100000
""", ["dim_listing"], ("price",))

add("price_box", """
WITH kept AS (
  SELECT CAST(price * 100 AS BIGINT) AS cents, room_type FROM dim_listing
  WHERE price > 0 AND price < 100000),
quart AS (
  SELECT room_type, count(*) AS n,
         quantile_cont(cents, 0.25) / 100.0 AS q1,
         quantile_cont(cents, 0.5) / 100.0 AS median,
         quantile_cont(cents, 0.75) / 100.0 AS q3
  FROM kept GROUP BY room_type),
fence AS (
  SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence
  FROM quart)
SELECT f.room_type, f.n, f.q1, f.median, f.q3, f.lower_fence, f.upper_fence,
       count(k.cents) AS n_outliers
FROM fence f
LEFT JOIN kept k ON k.room_type IS NOT DISTINCT FROM f.room_type
  AND (k.cents / 100.0 < f.lower_fence OR k.cents / 100.0 > f.upper_fence)
GROUP BY ALL""", ["dim_listing"])

add("occupancy_trend", f"""
SELECT month, room_type,
       round({ravg("occupancy_rate_pct", 1)}, 1) AS avg_occupancy,
       round({ravg("avg_price", 2)}, 0) AS avg_price
FROM monthly_occupancy
WHERE avg_price IS NOT NULL
GROUP BY month, room_type
ORDER BY month, room_type""", ["monthly_occupancy"])

add("hosts_by_tier", """
SELECT host_rating_tier, count(*) AS count FROM dim_host GROUP BY host_rating_tier""", ["dim_host"])

_HOST_TYPE = band(HOST_TYPE)

add("superhost_compare", f"""
SELECT {_HOST_TYPE} AS host_type,
       round({ravg("avg_listing_price", 2)}, 0) AS avg_price,
       round({ravg("avg_review_score", 1)}, 1) AS avg_rating,
       round(avg(total_reviews_received), 0) AS avg_reviews
FROM dim_host GROUP BY host_type""", ["dim_host"])

add("review_volume", """
SELECT CAST(date_trunc('month', review_date) AS DATE) AS month, count(*) AS review_count
FROM fct_reviews GROUP BY month ORDER BY month""", ["fct_reviews"])

add("top_reviewed", """
SELECT listing_name, number_of_reviews, price, review_scores_rating, neighbourhood, room_type
FROM dim_listing
ORDER BY number_of_reviews DESC NULLS LAST, listing_id
LIMIT 10""", ["dim_listing"], ("price", "review_scores_rating"))

add("room_breakdown", f"""
SELECT room_type, count(*) AS n,
       round(avg(price), 0) AS price,
       round(avg(review_scores_rating), 1) AS rating,
       round({ravg("occupancy_rate_pct", 1)}, 1) AS occ,
       round(avg(minimum_nights), 0) AS min_nights
FROM dim_listing WHERE price > 0
GROUP BY room_type
ORDER BY ROUND(AVG(price), 0) DESC NULLS LAST, room_type NULLS LAST""", ["dim_listing"])

_HOOD = """SELECT neighbourhood, round(avg(price), 0) AS price, count(*) AS n
  FROM dim_listing WHERE price > 0 GROUP BY neighbourhood"""

add("neighbourhood_gap", f"""
WITH hood AS ({_HOOD})
SELECT * FROM (SELECT 'Top' AS type, * FROM hood
               ORDER BY price DESC NULLS LAST, neighbourhood NULLS LAST LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'Bottom' AS type, * FROM hood
               ORDER BY price NULLS LAST, neighbourhood NULLS LAST LIMIT 5)""",
    ["dim_listing"])

add("quarterly_occupancy", f"""
SELECT CAST(date_trunc('quarter', month) AS DATE) AS q,
       round({ravg("occupancy_rate_pct", 1)}, 1) AS occ,
       round({ravg("avg_price", 2)}, 0) AS price
FROM monthly_occupancy GROUP BY q ORDER BY q""", ["monthly_occupancy"])

_PROFILE = f"""
SELECT {_HOST_TYPE} AS type,
       count(*) AS n,
       round({ravg("avg_listing_price", 2)}, 0) AS price,
       round({ravg("avg_review_score", 1)}, 1) AS rating,
       round(avg(total_reviews_received), 0) AS reviews,
       round({ravg("avg_reviews_per_month", 2)}, 2) AS rvpm
FROM dim_host GROUP BY type"""
add("superhost_profile", _PROFILE, ["dim_host"])

add("superhost_premium", f"""
WITH p AS ({_PROFILE}),
s AS (SELECT * FROM p WHERE type = 'Superhost'),
r AS (SELECT * FROM p WHERE type = 'Regular'),
one AS (SELECT 1 AS k)
SELECT (s.price / r.price - 1) * 100 AS price_pct,
       (s.reviews / r.reviews - 1) * 100 AS review_pct,
       s.rating - r.rating AS rating_diff,
       s.price AS s_price, r.price AS r_price, s.reviews AS s_reviews,
       r.reviews AS r_reviews, s.rating AS s_rating, r.rating AS r_rating
FROM one LEFT JOIN s ON true LEFT JOIN r ON true""", ["dim_host"])

# ---------------------------------------------------------------- tests and checks
_NN = [("raw_listings", "id"), ("raw_reviews", "id"), ("raw_neighbourhoods", "neighbourhood"),
       ("stg_listings", "listing_id"), ("stg_listings", "host_id"),
       ("stg_reviews", "review_id"), ("stg_reviews", "listing_id"),
       ("stg_reviews", "review_date"), ("stg_calendar", "listing_id"),
       ("stg_calendar", "calendar_date"), ("stg_calendar", "is_available")]
_NN_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS model, '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) "
    f"AS failures FROM {t}" for t, c in _NN)
add("not_null", _NN_SQL, ["raw_neighbourhoods", "stg_listings", "stg_reviews", "stg_calendar"])

_UQ = [("raw_listings", "id"), ("raw_reviews", "id"), ("raw_neighbourhoods", "neighbourhood"),
       ("stg_listings", "listing_id"), ("stg_reviews", "review_id")]
_UQ_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS model, '{c}' AS \"column\", (SELECT COUNT(*) FROM (SELECT {c} FROM {t} "
    f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)) AS failures" for t, c in _UQ)
add("unique", _UQ_SQL, ["raw_neighbourhoods", "stg_listings", "stg_reviews"])

add("non_positive_price", "SELECT listing_id, price FROM dim_listing WHERE price <= 0",
    ["dim_listing"], ("price",))

add("bad_review_dates", f"""
SELECT review_id, review_date FROM fct_reviews
WHERE review_date > {AS_OF} OR review_date < '2010-01-01'""", ["fct_reviews"])


def _py_date(c: str) -> str:
    return (f"'datetime.date(' || year({c}) || ', ' || month({c}) || ', ' || day({c}) "
            f"|| ')'")


_PROBE_SQL = f"""
SELECT 'Listings with price > 0' AS "check",
  '(' || CAST(COUNT(*) FILTER (WHERE price > 0) AS VARCHAR) || ',)' AS result,
  'PASS' AS status FROM dim_listing
UNION ALL
SELECT 'Listings with reviews', '(' || CAST(COUNT(*) FILTER (WHERE number_of_reviews > 0)
  AS VARCHAR) || ',)', 'PASS' FROM dim_listing
UNION ALL
SELECT 'Neighbourhoods', '(' || CAST(COUNT(DISTINCT neighbourhood) AS VARCHAR) || ',)',
  'PASS' FROM dim_listing
UNION ALL
SELECT 'Total reviews', '(' || CAST(COUNT(*) AS VARCHAR) || ',)', 'PASS' FROM fct_reviews
UNION ALL
SELECT 'Calendar date range', '(' || {_py_date('lo')} || ', ' || {_py_date('hi')} || ')',
  'PASS'
FROM (SELECT MIN(calendar_date) AS lo, MAX(calendar_date) AS hi FROM fct_calendar)"""
add("quality_probe", _PROBE_SQL, ["dim_listing", "fct_reviews", "fct_calendar"])

_SRC = [("raw_listings", "last_scraped", 180, 365), ("raw_reviews", "date", 90, 180),
        ("raw_calendar", "date", 30, 60)]
_SOURCES = "\nUNION ALL\n".join(f"""
SELECT '{t}' AS source, max_loaded_at, age_days,
  CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_days > {err} THEN 'error'
       WHEN age_days > {warn} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT MAX({c}) AS max_loaded_at,
        CAST(date_diff('day', MAX({c}), DATE '1999-02-15') AS INTEGER) AS age_days FROM {t})"""
    for t, c, warn, err in _SRC)
for _name in ("source_freshness", "source_freshness_from_files"):
    add(_name, _SOURCES, ["raw_listings", "raw_reviews", "raw_calendar"])

_MARTS = [("Listings (last_scraped)", "stg_listings", "last_scraped_date"),
          ("Reviews (most recent)", "fct_reviews", "review_date"),
          ("Calendar (latest date)", "fct_calendar", "calendar_date"),
          ("Reviews (none)", "(SELECT * FROM fct_reviews WHERE false)", "review_date")]
add("mart_freshness", "\nUNION ALL\n".join(f"""
SELECT '{n}' AS name, max_date, days_ago,
  CASE WHEN days_ago < 365 THEN 'OK' ELSE 'STALE' END AS status
FROM (SELECT MAX({c}) AS max_date,
        COALESCE(CAST(date_diff('day', MAX({c}), {AS_OF}) AS INTEGER), 999) AS days_ago
      FROM {t})""" for n, t, c in _MARTS), ["stg_listings", "fct_reviews", "fct_calendar"])

# Each raw table's columns, its key column and its text columns.
_RAW = [("raw_listings", 46, "id", ["name", "neighbourhood_cleansed", "neighbourhood", "property_type", "room_type",
         "bathrooms_text", "amenities", "price", "has_availability", "instant_bookable", "host_name", "host_location",
         "host_response_time", "host_response_rate", "host_acceptance_rate", "host_is_superhost", "host_neighbourhood",
         "host_has_profile_pic", "host_identity_verified"]),
        ("raw_reviews", 6, "listing_id", ["reviewer_name", "comments"]),
        ("raw_calendar", 7, "listing_id", ["available", "price", "adjusted_price"]),
        ("raw_neighbourhoods", 2, None, ["neighbourhood_group", "neighbourhood"])]
add("load_raw", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows, {n} AS cols, false AS skipped, "
    f"CAST({f'SUM({key})' if key else 0} AS BIGINT) AS key_sum, "
    f"CAST({' + '.join(f'COALESCE(SUM(LENGTH({c})), 0)' for c in text)} AS BIGINT) AS text_chars FROM {t}"
    for t, n, key, text in _RAW), [t for t, *_ in _RAW])

# The end-to-end step log on a fresh warehouse: every model built (facts by full load),
# one row per declared test with its failure count, then the five quality probes.
_BUILT = ", ".join(f"('{m}', 'OK', '{d}')" for m, d in [
    ("dim_listing", ""), ("dim_host", ""), ("dim_neighbourhood", ""), ("fct_reviews", "full"),
    ("fct_calendar", "full"), ("monthly_occupancy", ""), ("pricing_analysis", "")])


def _test_rows(sql: str, suffix: str) -> str:
    return (f"SELECT model || '.' || \"column\" || '.{suffix}' AS step, "
            f"CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"CAST(failures AS VARCHAR) || ' failures' AS detail FROM ({sql})")


def _singular(name: str, where_sql: str) -> str:
    return (f"SELECT '{name}' AS step, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"CAST(n AS VARCHAR) || ' failures' AS detail FROM ({where_sql})")


add("build_all", "\nUNION ALL\n".join([
    f"SELECT * FROM (VALUES {_BUILT}) AS built(step, status, detail)",
    _test_rows(_NN_SQL, "not_null"),
    _test_rows(_UQ_SQL, "unique"),
    _singular("assert_listing_price_positive",
              "SELECT count(*) AS n FROM dim_listing WHERE price <= 0"),
    _singular("assert_review_date_valid",
              f"SELECT count(*) AS n FROM fct_reviews "
              f"WHERE review_date > {AS_OF} OR review_date < '2010-01-01'"),
    f"SELECT 'quality: ' || \"check\" AS step, status, result AS detail FROM ({_PROBE_SQL})",
]), ["raw_neighbourhoods", "stg_listings", "stg_reviews", "stg_calendar", "dim_listing",
     "fct_reviews", "fct_calendar"])
