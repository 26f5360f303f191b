"""Filter interaction audit: what each filter removes, in every order of the filters.

Every filter keeps, per part, sorted posting lists of the ids that fail it. An id is the
row's own number, so repeated documents count as often as they occur, and lists are cut into
ranges of ids, so that a list is short however large its part is. Inside a range the lists
of every set of filters are united by a galloping k-way merge. What a filter removes after
others is the difference of two unions; sizes are summed over the ranges, and each order of
the filters reads its steps off these sums. The same merges over the lists' good and toxic
ids give the losses.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hot_groups import join_groups

MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 2
# Fixed: characters that the symbol filter looks for.
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Filters that look at one text; DUPLICATE looks at all texts.
FILTERS, DUPLICATE = "ABCD", "E"
RANGE_IDS = 1 << 15  # ids of a range
ALL, GOOD, TOXIC = "all", "good", "toxic"


def failing(text: bytes, n_chars: int) -> int:
    """Bits of the filters (of ``FILTERS``, in order) that a text fails."""
    words = text.split()  # bytes: at ASCII white space only
    n_upper = len(text) - len(text.translate(None, UPPER))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * n_upper > MAX_UPPER_PERCENT * n_chars) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def measured(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, part, failed (bits) and a 128-bit hash of the text (h1, h2), for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            bits = [*map(failing, texts, batch.column("n_chars").to_pylist())]
            hashes = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("part"), pa.array(bits, pa.int32()),
                 pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy())], names=["id", "part", "failed", "h1", "h2"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    lean = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.length(text).alias("n_chars"), text.cast("binary").alias("text"))
    return lean.mapInArrow(run, "id long, part string, failed int, h1 long, h2 long")


def with_repeats(rows: DataFrame) -> DataFrame:
    """Sets DUPLICATE's bit in ``failed`` where a row with a smaller id has the same text."""
    same = ["h1", "h2"]
    groups = stored(rows.groupBy(*same).agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
                    .where("copies > 1"), "text_groups")
    found = join_groups(rows, groups, same, "copies", rows.count(), "left")
    return found.select("id", "part", "row",
                        F.expr(f"failed | if(id > first_id, {1 << len(FILTERS)}, 0)").alias("failed"))


def postings(rows: DataFrame, range_ids: int = RANGE_IDS) -> DataFrame:
    """part, range, n (its rows) and lists: per kind (all, good and toxic ids) and filter the
    ids that fail it, ascending. ``rows`` has part, row, failed, good and toxic."""
    lists = []
    for kind, counted in ((ALL, F.lit(True)), (GOOD, F.col("good")), (TOXIC, F.col("toxic"))):
        for k, letter in enumerate(FILTERS + DUPLICATE):
            fails = (F.col("failed").bitwiseAND(F.lit(1 << k)) != 0) & counted
            ids = F.sort_array(F.collect_list(F.when(fails, F.col("row"))))  # nulls are not collected
            lists.append(F.struct(F.lit(kind).alias("kind"), F.lit(letter).alias("filter"), ids.alias("ids")))
    return (rows.groupBy("part", F.expr(f"row div {range_ids}").alias("range"))
            .agg(F.count("*").alias("n"), F.array(*lists).alias("lists")))


def gallop(ids: Sequence[int], value: int, at: int) -> int:
    """The first place from ``at`` on whose id is not below ``value``: steps that double,
    then a binary search in the last one."""
    step, n = 1, len(ids)
    while at + step < n and ids[at + step] < value:
        at += step
        step *= 2
    return bisect_left(ids, value, at, min(n, at + step + 1))


def union_size(lists: Sequence[Sequence[int]]) -> int:
    """How many different ids sorted lists hold: the list with the least head gallops to the
    next list's head, and what it passes is counted at once."""
    heads = sorted((ids[0], k, 0) for k, ids in enumerate(lists) if ids)
    total = 0
    while len(heads) > 1:
        value, k, at = heads[0]
        ids, limit = lists[k], heads[1][0]
        if value == limit:
            to = at + 1  # the other list counts it
        else:
            to = gallop(ids, limit, at)
            total += to - at
        heads.pop(0)
        if to < len(ids):
            head = (ids[to], k, to)
            heads.insert(bisect_left(heads, head), head)
    return total + sum(len(lists[k]) - at for _, k, at in heads)


def union_sizes(lists: DataFrame) -> DataFrame:
    """part, kind, filters (a set, as sorted letters) and size: how many ids of the part fail
    one of them, summed over the ranges of ``postings``; the empty set has all rows."""
    letters = FILTERS + DUPLICATE
    sets = [s for n in range(1, len(letters) + 1) for s in combinations(letters, n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n, own in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "lists"))):
                found: dict[str, dict[str, list[int]]] = {}
                for x in own:
                    if x["ids"]:
                        found.setdefault(x["kind"], {})[x["filter"]] = x["ids"]
                rows = [(ALL, "", n)] + [(kind, "".join(s), union_size([ids[x] for x in s if x in ids]))
                                         for kind, ids in found.items() for s in sets]
                kinds, filters, counts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.string()), pa.array(kinds, pa.string()),
                     pa.array(filters, pa.string()), pa.array(counts, pa.int64())], names=["part", "kind", "filters", "size"])

    return (lists.select("part", "n", "lists").mapInArrow(run, "part string, kind string, filters string, size long")
            .groupBy("part", "kind", "filters").agg(F.sum("size").alias("size")))


def _steps() -> list[dict]:
    """Every step of every order: its filter (letter), and the filters before it, up to it and
    apart from it, as sorted letters."""
    letters = FILTERS + DUPLICATE
    return [{"filter_order": "".join(order), "step": k + 1, "letter": letter, "before": "".join(sorted(order[:k])),
             "after": "".join(sorted(order[:k + 1])), "others": letters.replace(letter, "")}
            for order in permutations(letters) for k, letter in enumerate(order)]


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source", range_ids: int = RANGE_IDS) -> DataFrame:
    """One row per part, order of the filters and step, with the columns part, filter_order,
    step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    A null part counts as the empty one, a null text as empty. Rows count one by one, repeated
    ones too. A row without an id fails no duplicate filter and has no label; a document is good
    (toxic) if a label row with its id says so, and no other label counts. Other columns are ignored; an empty table gives
    an empty result.
    """
    letters = FILTERS + DUPLICATE
    rows = stored(measured(docs, id_col, text_col, part_col).withColumn("row", F.monotonically_increasing_id()), "measured")
    marks = (labels.groupBy(F.col(id_col).cast("long").alias("label_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    labelled = with_repeats(rows).join(marks, F.col("id") == F.col("label_id"), "left")
    sizes = union_sizes(postings(labelled, range_ids))
    # one row per part, with the union sizes by kind and set (three times 32 at most)
    parts = sizes.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat("kind", F.lit(" "), "filters"), "size"))).alias("sizes"))

    def size(kind: str, filters) -> Column:
        return F.coalesce(F.try_element_at("sizes", F.concat(F.lit(f"{kind} "), filters)), F.lit(0).cast("long"))

    weights = {k: factorial(k) * factorial(len(letters) - 1 - k) for k in range(len(letters))}

    def shapley(letter: str):
        rest = letters.replace(letter, "")
        out = F.lit(0).cast("long")
        for n in range(len(rest) + 1):
            for s in combinations(rest, n):
                least = size(ALL, F.lit("".join(s))) if s else F.lit(0).cast("long")
                out = out + F.lit(weights[n]) * (size(ALL, F.lit("".join(sorted([*s, letter])))) - least)
        return out

    shares = F.create_map(*[x for letter in letters for x in (F.lit(letter), shapley(letter))])
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order string, step int, letter string, "
                                                     "before string, after string, others string>>")  # 600, fixed
    every = F.lit(letters)
    before = F.when(F.col("before") == "", F.lit(0).cast("long")).otherwise(size(ALL, F.col("before")))
    after = size(ALL, F.col("after"))
    return (parts.withColumn("shares", shares).withColumn("s", F.explode(steps)).select("part", "sizes", "shares", "s.*").select(
        "part", "filter_order", "step",
        (size(ALL, F.lit("")) - after).alias("kept"),
        (after - before).alias("removed"),
        (size(ALL, F.col("letter")) + before - after).alias("redundant"),
        (size(ALL, every) - size(ALL, F.col("others"))).alias("unique_fails"),
        (size(GOOD, F.col("after")) - size(GOOD, F.col("before"))).alias("good_lost"),
        (size(TOXIC, F.col("after")) - size(TOXIC, F.col("before"))).alias("toxic_lost"),
        F.try_element_at("shares", F.col("letter")).alias("shapley")))
