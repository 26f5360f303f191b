import re
from collections import Counter
from math import isclose, log

import pytest
from pyspark.sql import functions as F

from rentalmart.llm import quality_rules
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    n = Counter(grams)
    covered = {p for k, g in enumerate(grams) if n[g] > 1 for p in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_base_counts_equal_brute_force(docs_of, spark):
    texts = ODD + ["a b c d e x a b c d e y z a b c d e", "p q r s t p q r s t", "# $ | a<b>c & %", "u v\nu v\n u v\nu v"]
    out = quality_rules.quality_rules(docs_of(texts), spark.createDataFrame([(1,)], "doc_id long"))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect()}
    assert got == {k: base(t) for k, t in enumerate(texts)}
    assert "a b" in out.columns and out.columns.count("kept") == 1


def test_score_is_the_mean_log_ratio(docs_of, spark):
    texts = ["alpha beta gamma", "alpha beta delta", "zz** yy** xx**", None]
    good = spark.createDataFrame([(0,), (1,), (1,), (None,)], "doc_id long")
    buckets = 1 << 20  # wide enough for no two n-grams to meet
    got = {r.doc_id: r.llr for r in quality_rules.quality_rules(docs_of(texts), good, buckets=buckets).collect()}

    def grams(t):
        w = [x[-3:] for x in WORD.findall(t or "")]
        return w + [*zip(w, w[1:])]
    target, raw = Counter(g for t in texts[:2] for g in grams(t)), Counter(g for t in texts for g in grams(t))
    t_all, r_all, prior = sum(target.values()), sum(raw.values()), quality_rules.PRIOR
    for k, t in enumerate(texts):
        p_raw = [raw[g] / r_all for g in grams(t)]
        want = [log((target[g] + prior * p) / (t_all + prior)) - log(p) for g, p in zip(grams(t), p_raw)]
        assert isclose(got[k], sum(want) / max(1, len(want)), abs_tol=1e-9)


def test_symbols_are_rejected_and_prose_is_kept(docs_of, spark):
    prose = [f"the reading thing and the other nation was standing near a table number {k} for hours" for k in range(40)]
    junk = [f"ab{k}*** cd{k}&&& ef{k}$$$ gh{k}### ij{k}%%% kl{k}*** mn{k}&&& op{k}$$$ qr{k}### st{k}%%% uv{k}***" for k in range(10)]
    docs = docs_of(prose + junk)
    good = spark.createDataFrame([(k,) for k in range(20)], "doc_id long")
    kept = {r.doc_id for r in quality_rules.quality_rules(docs, good).where("kept").collect()}
    assert kept == set(range(40))


def test_no_trusted_documents_and_empty_table(docs_of, spark):
    nobody = spark.createDataFrame([], "doc_id long")
    rows = quality_rules.quality_rules(docs_of(["a b c d e f g h i j k", "a b"]), nobody).collect()
    assert [(r.llr, r.kept) for r in sorted(rows, key=lambda r: r.doc_id)] == [(0.0, True), (0.0, False)]
    assert quality_rules.quality_rules(docs_of([]), nobody).collect() == []


def test_every_trusted_document_counts(docs_of, spark):
    texts = [f"alpha beta gamma number{k}" for k in range(20)] + [f"zz** yy** xx** number{k}" for k in range(20)]
    most = spark.range(300_000).select(F.col("id").alias("doc_id")).where("doc_id < 20 or doc_id >= 40")
    few = spark.createDataFrame([(k,) for k in range(20)], "doc_id long")
    llr = [sorted((r.doc_id, r.llr) for r in quality_rules.quality_rules(docs_of(texts), good).collect()) for good in (few, most)]
    assert llr[0] == llr[1] and llr[0][0][1] > llr[0][39][1]


@pytest.mark.parametrize("bitmaps", [quality_rules.BITMAPS, 0])
def test_documents_are_marked_exactly(spark, bitmaps):
    edges = [0, 1, 7, 8, 9, 32_767, 32_768, 32_769, 65_536, 65_537, 1 << 40, (1 << 62) + 5]
    ids = sorted({s * k for k in edges for s in (1, -1)})
    trusted = set(ids[::2]) | {-7, 8}
    docs = spark.createDataFrame([(k,) for k in [*ids, *ids[:3], None]], "id long")
    good = spark.createDataFrame([(k,) for k in [*trusted, 8, None, 12_345]], "id long")
    got = [(r.id, r.trusted) for r in quality_rules.with_trust(docs, good, "id", bitmaps).collect()]
    assert sorted(got, key=str) == sorted([(k, k in trusted) for k in [*ids, *ids[:3], None]], key=str)
