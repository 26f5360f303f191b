import hashlib
import random
import re
import struct

import pytest
from xxhash import xxh64_intdigest

from rentalmart.llm import fingerprints
from tests.llm.conftest import ODD


def edited(rows):
    """Brute force: (id, text) in descending id order -> id: edited text."""
    rows = sorted(rows, reverse=True)
    out = {}
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        out[i] = t[:len(t) - half] + after[:half]
    return out


@pytest.mark.parametrize("range_rows", [1, 3, 1000])
def test_edited_texts_across_ranges(docs_of, range_rows):
    r = random.Random(range_rows)
    rows = [(i, " ".join(r.choice(["ab", "cd", "é", "🙂"]) for _ in range(r.randint(0, 40)))) for i in
            {*range(20), *(r.randrange(10**12) for _ in range(20)), -5}]
    got = {x.doc_id: x.edited_sha256 for x in fingerprints.fingerprints(docs_of(rows), range_rows=range_rows).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in edited(rows).items()}


def test_likeness_follows_similarity(docs_of):
    r = random.Random(1)
    words = [f"w{k}" for k in range(4000)]
    texts = []
    for share in (0.0, 0.5, 0.9, 1.0):
        a = [r.choice(words) for _ in range(1500)]
        cut = int(1500 * share)
        texts += [" ".join(a), " ".join(a[:cut] + [r.choice(words) for _ in range(1500 - cut)])]
    rows = {x.doc_id: x for x in fingerprints.fingerprints(docs_of(texts)).collect()}
    near = [rows[k].near_next for k in (1, 3, 5, 7)]  # the next in descending order is the one before
    want = [0.0, 1 / 3, 0.9 / 1.1, 1.0]
    assert all(abs(a - b) < 0.13 for a, b in zip(near, want)) and near[3] == 1.0


def spark_hash(*values):
    """Spark's xxhash64: each value hashed with the hash of those before it as seed; signed."""
    h = 42
    for v in values:
        h = xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), h & (2**64 - 1))
    return h - 2**64 if h >= 2**63 else h


def brute(text):
    """One-permutation MinHash with optimal densification, bin by bin."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return ""
    if len(words) < fingerprints.WORDS:
        hashes = [spark_hash(" ".join(words))]
    else:
        hashes = [spark_hash(*words[k:k + fingerprints.WORDS]) for k in range(len(words) - fingerprints.WORDS + 1)]
    least = {}
    for h in hashes:
        b, value = divmod(h & (2**63 - 1), 2**56)
        least[b] = min(least.get(b, value), value)
    bins = sorted(least)
    out = []
    for b in range(fingerprints.BINS):
        if b not in least:  # the non-empty bin that comes first in this bin's own order
            out.append(least[min(bins, key=lambda o: (spark_hash(b, o) & ~127) | bins.index(o))])
        else:
            out.append(least[b])
    return "".join("%x" % (v & 15) for v in out)


def test_fingerprints_equal_brute_force(docs_of):
    r = random.Random(9)
    texts = [t or "" for t in ODD] + [" ".join(r.choice(["ab", "cd", "é", "🙂", "w"]) + str(r.randrange(50)) for _ in range(n))
                                      for n in (4, 5, 6, 30, 100, 300, 2000)]
    got = {x.doc_id: x.fingerprint for x in fingerprints.fingerprints(docs_of(texts)).collect()}
    assert got == {k: brute(t) for k, t in enumerate(texts)}


def test_densification_borrows_from_real_bins(spark):
    df = spark.createDataFrame([("a b c d e f g h",), ("one",), ("",)], "text string")
    rows = [r.fp for r in fingerprints.with_fingerprint(df, "text", "fp").collect()]
    assert len(rows[0]) == len(rows[1]) == fingerprints.BINS and rows[2] == ""
    assert len(set(rows[1])) == 1 and len(set(rows[0])) <= 4


def test_odd_texts(docs_of):
    rows = fingerprints.fingerprints(docs_of(ODD + [(None, "no id"), (3, "one")])).collect()
    assert len(rows) == len(ODD) + 2
    by = {r.doc_id: r for r in rows}
    assert by[5].fingerprint == by[6].fingerprint and by[0].fingerprint == "" and by[0].n_chars == 0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_lone_row_and_empty_table(docs_of):
    lone = fingerprints.fingerprints(docs_of([(9, "a b c d")])).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0
    assert lone[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()[:64] or lone[0].n_chars == 7
    assert fingerprints.fingerprints(docs_of([])).collect() == []


def test_no_python_in_the_plan(docs_of):
    plan = fingerprints.fingerprints(docs_of(ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
