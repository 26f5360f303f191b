import random
import re
from collections import defaultdict

import numpy as np
import pytest

from rentalmart.llm import components, ngram_join
from rentalmart.llm.shingles import Shingler
from tests.llm.conftest import ODD

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall((text or "").encode().lower())
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    """id -> (set size, least id reachable) over all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            both = len(s & t)
            if both and 100 * both >= percent * len(s | t):
                lo, hi = sorted((root(a), root(b)))
                up[hi] = lo
    return {i: (len(s), root(i)) for i, s in sets}


def corpus(seed, families=12, members=9):
    """Families of edited copies with similarities around the threshold, and lone texts."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for _ in range(families):
        base = [r.choice(words) for _ in range(r.choice([3, 5, 8, 15, 40, 90, 200]))]
        for _ in range(members):
            text = list(base if r.random() < 0.7 else rows[-1].split() if rows else base)
            for _ in range(r.randint(0, max(1, len(text) // 18))):
                text[r.randrange(len(text))] = r.choice(words)
            if r.random() < 0.2:
                text += [r.choice(words) for _ in range(r.randint(1, 3))]
            rows.append(" ".join(text))
    rows += [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(30)]
    ids = r.sample(range(10_000), len(rows))
    return [*zip(ids, rows)]


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_equal_brute_force(docs_of, seed, k, percent):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           ngram_join.similar(docs_of(rows), k=k, percent=percent).collect()}
    assert got == brute(rows, k, percent)


@pytest.mark.parametrize("texts", [1, 10])
def test_small_leaves_hot_cells_and_large_families(docs_of, monkeypatch, texts):
    for name, value in (("LEAF", 2), ("HOT", 3), ("SAMPLE", 1), ("SEEN", 1), ("FAMILY_TEXTS", texts),
                        ("COMMON", 2)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(4, families=6, members=14)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar(docs_of(rows)).collect()}
    assert got == brute(rows, 4, 85)


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_tree_links_equal_brute_force(monkeypatch, leaf):
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    rows = sorted(corpus(9, families=10, members=12))
    s = Shingler(4)
    want = {i: c for i, (_, c) in brute(rows, 4, 85).items() if c != i}
    assert {b: a for a, b in ngram_join.tree_links([i for i, _ in rows], [s.of(t) for _, t in rows], 85)} == want


@pytest.mark.parametrize("share", [None, 0.0, 0.5, 0.95, 1.0])
def test_matching_sets_share_a_cell(share):
    """The pigeonhole: any pair at the threshold has a cell in common, at every size and
    whatever shingles count as common."""
    r = np.random.default_rng(0)
    common = None if share is None else np.packbits(r.random(1 << 12) < share, bitorder="little")
    cells = ngram_join.Cells(85, common)
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        lost = int(r.integers(0, max(1, n // 12) + 1))
        b = np.unique(np.concatenate([a[lost:], r.integers(0, 2**63, int(r.integers(0, lost + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 85 * (len(a) + len(b) - both):
            assert set(cells.of(a)) & set(cells.of(b))


def test_bound_is_never_below_the_overlap():
    r = random.Random(3)
    s = Shingler(4)
    for _ in range(50):
        x, y = (s.of(" ".join(r.choice("abcdefg") for _ in range(60))) for _ in range(2))
        assert np.minimum(ngram_join.point(x), ngram_join.point(y)).sum() >= len(np.intersect1d(x, y))


def test_odd_texts(docs_of):
    rows = [*enumerate(ODD)]
    out = ngram_join.similar(docs_of([*rows, (None, "a b c d e f g h i j"), (3, "one")])).collect()
    assert len(out) == len(rows) + 2
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert got.pop(None)[1] is None
    assert got == brute(rows, 4, 85)


def test_empty_table(docs_of):
    assert ngram_join.similar(docs_of([])).collect() == []


def test_components(spark):
    r = random.Random(8)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)]
    pairs += [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)] + [(5, 5), (None, 7)]
    up = defaultdict(lambda: None)

    def root(i):
        while up[i] is not None:
            i = up[i]
        return i
    for a, b in pairs:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            if x != y:
                up[y] = x
    r.shuffle(pairs)
    got = {x.id: x.component for x in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {i for p in pairs if None not in p and p[0] != p[1] for i in p}
    assert got == {i: root(i) for i in nodes}
