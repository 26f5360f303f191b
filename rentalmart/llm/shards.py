"""Sharding: minimax contiguous partition.

Rows that share a ``position`` form one atomic group; groups are ordered by position. The
smallest capacity for which a greedy left-to-right fill needs at most ``n_shards`` shards is
found by binary search, and the sequence is cut there. A group larger than an even share of
what is left gets a shard of its own (first shards), and the search runs over the rest, so
that one hot group does not leave the other shards empty.

The greedy check needs prefix sums of group sizes, of which there may be billions. The
driver only ever holds sums over position ranges (at most ``RANGES`` per round): treating
ranges as divisible gives a lower bound on the capacity, treating them as atomic an upper
one, and only the ranges in which a cut may still fall are split further. When both bounds
meet, the cuts are exact. Ranges halve down to single positions, so it always ends.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

RANGES = 1 << 16  # ranges asked for in a round; what the driver holds is a small multiple
CELL_ROWS = 5000  # rows numbered together when slots are given


def _fluid(prefix, atomic, cap, n):
    """Cut masses of a greedy fill that may cut inside ranges; None if an atomic range
    exceeds ``cap``. Stops after n cuts."""
    at, out, total = 0, [], prefix[-1]
    while at < total and len(out) < n:
        to = at + cap
        if to < total:
            j = bisect_right(prefix, to) - 1
            if prefix[j] != to and atomic[j]:
                to = prefix[j]
                if to <= at:
                    return None
        at = min(to, total)
        out.append(at)
    return out


def _whole(prefix, cap, n):
    """Cut masses of a greedy fill that never cuts a range; stays where a range does not fit."""
    at, out, total = 0, [], prefix[-1]
    while at < total and len(out) < n:
        at = max(at, prefix[bisect_right(prefix, at + cap) - 1])
        out.append(at)
    return out


def _least(low, high, feasible):
    while low < high:
        mid = (low + high) // 2
        if feasible(mid):
            high = mid
        else:
            low = mid + 1
    return low


def plan(sized: DataFrame, n_shards: int, ranges: int = RANGES) -> tuple[list[int], list[int]]:
    """(positions that get the first shards to themselves, first positions of the later
    shards but one). ``sized`` has ``position`` long and ``size`` long."""
    width = 64 - max(1, ranges.bit_length() - 1)

    def sums(df, bits):
        return [tuple(r) for r in df.groupBy(F.shiftright("position", bits).alias("id"))
                .agg(F.min("position"), F.max("position"), F.sum("size")).collect()]

    # id, least and largest position, mass, bits
    known = [(lo, hi, mass, i, width) for i, lo, hi, mass in sums(sized, width)]
    while True:
        known.sort()
        solo, rest, shards = [], list(known), n_shards
        mass = sum(x[2] for x in rest)
        for x in sorted((x for x in rest if x[0] == x[1]), key=lambda x: (-x[2], x[0])):
            if shards > 1 and x[2] * shards > mass:
                solo.append(x[0])
                mass, shards = mass - x[2], shards - 1
        rest = [x for x in rest if x[0] not in set(solo)] if solo else rest
        atomic = [x[0] == x[1] for x in rest]
        prefix = list(accumulate((x[2] for x in rest), initial=0))
        if not rest or mass == 0:
            return solo, []
        heavy = {j for j, x in enumerate(rest) if not atomic[j] and x[2] * shards > mass}
        least = _least(-(-mass // shards), mass,
                       lambda c: (f := _fluid(prefix, atomic, c, shards)) is not None and f[-1] == mass)
        most = _least(least, mass, lambda c: _whole(prefix, c, shards)[-1] == mass)
        if least == most and not heavy:
            cuts = _whole(prefix, most, shards)
            return solo, [rest[bisect_left(prefix, c)][0] for c in cuts if c < mass]
        split = set(heavy)
        low, high = _whole(prefix, least, shards), _fluid(prefix, atomic, most, shards)
        low += [low[-1]] * (len(high) - len(low))
        for a, b in zip(low, high):
            first, last = bisect_right(prefix, a) - 1, bisect_left(prefix, b)
            split.update(j for j in range(max(first, 0), min(last + 1, len(rest))) if not atomic[j])
        old = [x for j, x in enumerate(rest) if j in split]
        finest = min(x[4] for x in old)
        old = [x for x in old if x[4] == finest]
        bits = max(0, finest - max(1, (ranges // len(old)).bit_length()))
        ids = sized.sparkSession.createDataFrame([(x[3],) for x in old], "range_id long")
        # at most a few times RANGES longs
        inside = sized.join(F.broadcast(ids), F.shiftright("position", finest) == F.col("range_id"), "left_semi")
        gone = {(x[3], x[4]) for x in old}
        known = [x for x in known if (x[3], x[4]) not in gone]
        known += [(lo, hi, mass, i, bits) for i, lo, hi, mass in sums(inside, bits)]


def shard_of(position: Column, solo: list[int], firsts: list[int]) -> Column:
    out = F.lit(len(solo))
    for first in firsts:
        out = out + (position >= F.lit(first)).cast("int")
    for k, p in reversed(list(enumerate(solo))):
        out = F.when(position == F.lit(p), k).otherwise(out)
    return out.cast("int")


def with_slots(df: DataFrame, n_rows: int, id_col: str, tie: list[str]) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in cells of bounded size."""
    cells = max(1, -(-n_rows // CELL_ROWS))
    df = df.withColumn("cell", F.pmod(F.xxhash64(id_col, *tie), F.lit(cells)))
    counts = df.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "cell").orderBy(id_col, *tie)
    return (df.join(starts, ["shard", "cell"])
            .withColumn("slot", F.col("start") + F.row_number().over(order) - 1)
            .drop("cell", "start"))


def minimax_shards(docs: DataFrame, n_shards: int, *, text_col: str = "text", id_col: str = "doc_id",
                   overhead: int = 16, ranges: int = RANGES) -> DataFrame:
    """Every row of ``docs`` with its shard and slot; rows with equal texts stay together.

    Columns: the id, size (UTF-8 bytes + ``overhead``; a null text has no bytes),
    text_crc32 (a null or empty text: 0), shard, slot. Groups are ordered by a hash of the
    text, so a row's shard follows from its own text and the cuts, without a join. All null
    texts are one group, empty texts another. Null ids and repeated rows are kept, one slot
    each; other columns are ignored; an empty table gives an empty result.
    """
    text = F.col(text_col)
    sized = stored(docs.select(
        F.col(id_col), F.xxhash64(text, text.isNull()).alias("position"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32")), "sharding")
    solo, firsts = plan(sized.select("position", "size"), n_shards, ranges)
    placed = sized.withColumn("shard", shard_of(F.col("position"), solo, firsts)).drop("position")
    return with_slots(placed, sized.count(), id_col, ["size", "text_crc32"])
