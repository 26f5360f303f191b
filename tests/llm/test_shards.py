import random
from collections import defaultdict

import pytest

from rentalmart.llm import shards
from tests.llm.conftest import ODD


def least_capacity(sizes, n):
    """Brute force: the smallest capacity for a contiguous partition of ``sizes``."""
    def needed(cap):
        shards_used, room = 0, 0
        for s in sizes:
            if s > cap:
                return len(sizes) + n + 1
            if s > room:
                shards_used, room = shards_used + 1, cap
            room -= s
        return shards_used
    return next(c for c in range(max(sizes), sum(sizes) + 1) if needed(c) <= n)


def planned(spark, groups, n, ranges):
    df = spark.createDataFrame([(p, s) for p, ss in groups.items() for s in ss], "position long, size long")
    solo, firsts = shards.plan(df, n, ranges)
    loads = defaultdict(int)
    for p, ss in groups.items():
        loads[("solo", p) if p in solo else sum(p >= f for f in firsts)] += sum(ss)
    return solo, firsts, loads


@pytest.mark.parametrize("seed,ranges", [(1, 4), (2, 8), (3, 64), (4, 1 << 16)])
def test_capacity_is_the_least(spark, seed, ranges):
    r = random.Random(seed)
    groups = {r.randrange(-2**63, 2**63): [r.randint(1, 40) for _ in range(r.randint(1, 2))] for _ in range(120)}
    solo, firsts, loads = planned(spark, groups, 7, ranges)
    assert not solo
    assert max(loads.values()) == least_capacity([sum(groups[p]) for p in sorted(groups)], 7)
    assert len(firsts) <= 6


def test_hot_group_gets_a_shard_and_the_rest_is_even(spark):
    r = random.Random(5)
    groups = {r.randrange(-2**63, 2**63): [10] for _ in range(400)} | {77: [10] * 200}
    solo, _, loads = planned(spark, groups, 10, 16)
    assert solo == [77]
    rest = sorted(v for k, v in loads.items() if k != ("solo", 77))
    assert len(rest) == 9 and rest[-1] == 450


def test_operator_on_odd_texts(spark, docs_of):
    docs = docs_of(ODD + [(None, "no id"), (3, "one")])
    rows = shards.minimax_shards(docs, 4).collect()
    assert len(rows) == len(ODD) + 2
    slots, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    texts = {k: t for k, t in enumerate(ODD)}
    for r in rows:
        if r.doc_id is not None:
            by_text[texts[r.doc_id]].add(r.shard)
            assert r.size == 16 + len((texts[r.doc_id] or "").encode())
    assert all(len(s) == 1 for s in by_text.values())


def test_empty_table(docs_of):
    assert shards.minimax_shards(docs_of([]), 4).collect() == []
