"""Joining rows with one row per group, where a few groups may hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_PARTS = 4096  # a group with more than this part of all rows is hot; so there are fewer hot groups


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, n_rows: int,
                how: str = "inner", parts: int = HOT_PARTS) -> DataFrame:
    """``rows`` joined with ``groups`` (one row per ``keys``, ``size`` = how many of the
    ``n_rows`` rows have them), null-safely; with ``how="left"`` rows without a group stay.

    Hot groups (less than ``parts`` of them, as each has more than that part of the rows) are
    broadcast, so their rows stay where they are; the rows of all others are shuffled by key,
    where no key has more than that part.
    """
    names = [f"group_{k}" for k in keys]
    renamed = groups.withColumnsRenamed(dict(zip(keys, names)))
    hot = F.col(size) * parts > n_rows
    values = [c for c in renamed.columns if c not in names]
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    first = rows.join(F.broadcast(renamed.where(hot).withColumn("is_hot", F.lit(True))), same, "left").drop(*names)
    rest = first.where("is_hot is null").drop("is_hot", *values)
    columns = [*rows.columns, *values]
    return (first.where("is_hot").select(*columns)
            .unionByName(rest.join(renamed.where(~hot), same, how).select(*columns)))
