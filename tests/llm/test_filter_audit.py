import re
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rentalmart.llm import filter_audit
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    out = []
    for i, text, _ in rows:
        t = text or ""
        w = WORD.findall(t)
        out.append({x for x, bad in (
            ("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)), ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)),
            ("D", bool(re.search(r"[#$%&*|]", t))), ("E", i is not None and first[t] < i)) if bad})
    return out


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    failed, out = fails(rows), []
    for part in {s or "" for _, _, s in rows}:
        own = [(i, f) for (i, _, s), f in zip(rows, failed) if (s or "") == part]
        total, steps = Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for k, x in enumerate(order):
                gone = [i for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                total[x] += len(gone)
                steps.append((x, ["".join(order), k + 1, len(left), len(gone), sum(x in f for _, f in own) - len(gone),
                                  sum(f == {x} for _, f in own), sum(i in good for i in gone), sum(i in toxic for i in gone)]))
        out += [(part, *s, total[x]) for x, s in steps]
    return sorted(out)


LONG = " ".join(f"word{k}" for k in range(250))
TEXTS = [*ODD, LONG, LONG + " #", LONG.upper(), LONG, "a " * 300, "Ab " * 300, f"{LONG} $", LONG + " ", "é" * 98 + "AB"]
ROWS = [(k, t, ["s0", "s1", None, ""][0 if k % 3 else k % 4]) for k, t in enumerate(TEXTS * 3)]
ROWS += [(None, LONG, "s0"), (None, None, None), (0, LONG, "s9"), (5, "x", "s0"), (5, "x", "s0"), (-1, LONG, "far")]
LABELS = [(k, k % 2, (k // 2) % 2) for k in range(40)] + [(0, 1, None), (1, 0, 0), (None, 1, 1), (3, None, 1)]


@pytest.fixture
def tables(spark):
    def make(rows, labels):
        docs = spark.createDataFrame([(i, t, s, 1, 2, "x", 3) for i, t, s in rows],
                                     "doc_id long, text string, source string, part int, row int, failed string, good int")
        return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return make


@pytest.mark.parametrize("range_ids", [3, 1 << 15])
def test_equals_brute_force(tables, range_ids):
    out = filter_audit.audit(*tables(ROWS, LABELS), range_ids=range_ids)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in out.collect()) == brute(ROWS, LABELS)


def test_nothing_fails_and_empty_tables(tables):
    rows = [(1, LONG, "s"), (2, LONG + " more", "s")]
    assert sorted(tuple(r) for r in filter_audit.audit(*tables(rows, [])).collect()) == brute(rows, [])
    assert filter_audit.audit(*tables([], LABELS)).collect() == []


def test_lists_are_sorted_and_short(tables, spark):
    rows = spark.createDataFrame([("p", k, k % 32, k % 2 == 0, False) for k in range(100)],
                                 "part string, row long, failed int, good boolean, toxic boolean")
    found = filter_audit.postings(rows, 16).collect()
    assert sum(r.n for r in found) == 100 and len(found) == 7
    for r in found:
        for x in r.lists:
            assert x.ids == sorted(x.ids) and len(x.ids) <= 16
            assert all(k // 16 == r.range for k in x.ids)


@given(st.lists(st.lists(st.integers(0, 60), unique=True).map(sorted), max_size=5))
def test_union_size(lists):
    assert filter_audit.union_size(lists) == len({x for ids in lists for x in ids})


@given(st.lists(st.integers(0, 99), unique=True).map(sorted), st.integers(0, 100), st.integers(0, 5))
def test_gallop(ids, value, at):
    at = min(at, len(ids))
    want = next((k for k in range(at, len(ids)) if ids[k] >= value), len(ids))
    assert filter_audit.gallop(ids, value, at) == want
