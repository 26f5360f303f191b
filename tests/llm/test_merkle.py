import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from rentalmart.llm import merkle
from tests.llm.conftest import ODD

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, rank int, tree int, `a b` int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(level, arity):
    """All levels from the given one up to a single node."""
    levels = [level]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[k:k + arity]) for k in range(0, len(low), arity)])
    return levels


def path(levels, at, arity):
    """(own place among its run, the run's others) per level, from the bottom up."""
    out = []
    for level in levels[:-1]:
        start = at - at % arity
        run = level[start:start + arity]
        out.append((at - start, run[:at - start] + run[at - start + 1:]))
        at //= arity
    return out


def brute(rows, changed, arity):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    order = lambda r: ((r[0] is not None, r[0] or 0), leaf_of(r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = [climb([leaf_of(r) for r in sorted(by_lang[x], key=order)], arity) for x in langs]
    top = climb([t[-1][0] for t in trees], arity)
    out = []
    for k, (x, levels) in enumerate(zip(langs, trees)):
        for at, row in enumerate(sorted(by_lang[x], key=order)):
            steps = path(levels, at, arity) + path(top, k, arity)
            node = leaf_of(changed(row))
            for digit, others in steps:
                node = h(*others[:digit], node, *others[digit:])
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0], h(*[o for _, others in steps for o in others]),
                        node, node == top[-1][0]))
    return out


def tamper(row):
    i, source, lang, n, text = row
    return (i, source, lang, n + 1 if n is not None and i is not None and zlib.crc32(str(i).encode()) % 7 == 0 else n, text)


def checked(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.checked(docs, {"n_chars": F.when(hit, F.col("n_chars") + 1)})


@pytest.mark.parametrize("arity, levels", [(2, 10), (2, 2), (3, 1)])
def test_equals_brute_force(spark, monkeypatch, arity, levels):
    rows = [(k * 3 % 211, f"s{k % 3}", ["en", "fr", None, "éa", "z"][0 if k % 3 else k % 5], k if k % 9 else None, t)
            for k, t in enumerate(ODD * 9)]
    rows += [(500, None, "only", 5, "alone"), (None, None, None, None, None), (None, "s", "en", 1, "-"), *rows[:3], rows[0]]
    monkeypatch.setattr(merkle.manifest, "__defaults__", (arity, levels))
    got = [tuple(r) for r in checked(spark, rows).collect()]
    assert Counter(got) == Counter(brute(rows, tamper, arity))
    assert {r[6] for r in got} == {True, False}


def test_a_hot_language_of_equal_rows_is_cut_into_packs(spark):
    rows = [(7, "s", "en", 1, "t")] * 300 + [(k, "s", "fr", 1, "t") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    digests = docs.select("doc_id", "lang", merkle.leaf_digest([F.col(c) for c in docs.columns]).alias("digest"))
    known = merkle.manifest(digests, "lang", ["doc_id"], 2, 3)
    assert len(known.packs) == 3 and known.packs[0].select(F.max(F.size("records"))).first()[0] == 7
    assert known.packs[0].select("digest").distinct().count() < known.packs[0].count()
    wanted = known.leaves.where("rank in (0, 171, 299)").select("tree", "rank")
    for r in merkle.proofs(known, wanted).collect():
        assert merkle.fold(bytes(r.digest), r.digits, [bytes(o) for o in r.others]) == known.root


def test_every_change_of_a_field_is_found(spark):
    rows = [(k, "s", "en", 5, f"text {k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    back = merkle.checked(docs, {"text": F.when(F.col("doc_id") == 11, F.lit("text 12")),
                                 "source": F.when(F.col("doc_id") == 3, F.lit(""))})
    assert {r.doc_id for r in back.where("not verified").collect()} == {3, 11}


def test_one_row_and_empty_table(spark):
    row = (4, "s", "en", 1, "t")
    assert [tuple(r) for r in checked(spark, [row]).collect()] == brute([row], tamper, 2)
    assert checked(spark, []).collect() == []
