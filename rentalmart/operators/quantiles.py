"""Exact grouped quantiles (PERCENTILE_CONT) from counts of distinct values.

Spark's built-in ``percentile`` keeps every distinct value of a group in one buffer. Here the
rows are first counted per (group, value), combined map-side and dealt by the value too, so a
group that holds a third of all rows is spread over all reducers. Running counts over a
group's distinct values then say which value has which rank: a sorted stream per group that
can spill, as long as the group has distinct values, whatever its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def ranked(counts: DataFrame, keys: list[str], value: str, count: str = "c") -> DataFrame:
    """``counts`` (one row per ``keys`` and ``value``) with ``n``, the rows of the group, and
    ``upto``, those up to and including the value."""
    group = f"PARTITION BY {', '.join(keys)}"
    return counts.selectExpr(
        "*", f"sum({count}) OVER ({group}) AS n",
        f"sum({count}) OVER ({group} ORDER BY {value} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto")


def quantile_sql(value: str, q: float, keys: list[str], count: str = "c") -> str:
    """The quantile of the group as a window expression over a ``ranked`` table: linear
    interpolation between the two neighbouring order statistics."""
    pos = f"((n - 1) * {float(q)!r}D)"

    def at(rank: str) -> str:
        return (f"max(CASE WHEN {rank} >= upto - {count} AND {rank} < upto THEN {value} END) "
                f"OVER (PARTITION BY {', '.join(keys)})")

    low, high = at(f"floor({pos})"), at(f"ceil({pos})")
    return (f"CASE WHEN {low} = {high} THEN CAST({low} AS DOUBLE) "
            f"ELSE (ceil({pos}) - {pos}) * {low} + ({pos} - floor({pos})) * {high} END")
