import re
import zlib
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rentalmart.llm import quality_rules
from rentalmart.llm.common import read
from rentalmart.llm.queries import tokenizer
from tests.llm import test_line_dedup, test_quality_rules
from tests.llm.conftest import ODD
from tests.llm.test_fingerprints import spark_hash
from tests.llm.test_ngram_join import brute as near_groups

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LIBRARY = Tokenizer.from_str(tokenizer("byte_bpe_50k.json"))


def ruled(texts, good):
    """id -> (fails the base rule, mean log ratio), with the production buckets."""
    def grams(t):
        w = [x[-quality_rules.TAIL:] for x in WORD.findall(t or "")]
        return [spark_hash(x) % quality_rules.BUCKETS for x in w] + [spark_hash(*p) % quality_rules.BUCKETS for p in zip(w, w[1:])]
    all_grams = {i: grams(t) for i, t in texts.items()}
    target, raw = Counter(g for i in good if i in texts for g in all_grams[i]), Counter(g for x in all_grams.values() for g in x)
    t, r, prior = sum(target.values()), sum(raw.values()), quality_rules.PRIOR
    ratio = {g: log((target[g] * r / raw[g] + prior) / (t + prior)) if t else 0.0 for g in raw}
    return {i: (test_quality_rules.base(texts[i])[-1], sum(ratio[g] for g in x) / max(1, len(x))) for i, x in all_grams.items()}


def check_packing(pieces, texts):
    """Each id of a text lies in one piece; sequences are gapless and at most 1024 tokens."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
    assert set(of_doc) == set(texts)
    for i, own in of_doc.items():
        ids = [*LIBRARY.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            piece = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert r.start == at and r.ids_crc32 == zlib.crc32(piece) and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    for own in of_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def check_stage(name, before, rows, good, bad):
    """What a stage must make of its input (id -> text, and id -> source)."""
    texts, sources = before
    kept = {r.doc_id: r.text for r in rows}
    if name == "quality_classifier":
        assert len(good & set(texts) - set(kept)) <= 1 and len(bad & set(kept)) <= 1
        assert all(kept[i] == texts[i] for i in kept)
    elif name == "quality_rules":
        want = ruled(texts, good)
        for i, (failed, score) in want.items():
            if failed or abs(score - quality_rules.THRESHOLD) > 1e-9:
                assert (i in kept) == (not failed and score >= quality_rules.THRESHOLD), i
    elif name == "line_dedup":
        want = test_line_dedup.brute([(i, t, sources[i]) for i, t in texts.items()], 10)
        assert {i: t for i, t in kept.items() if t is not None} == want and set(kept) == set(texts)
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    else:
        groups = near_groups([*texts.items()], 5, 80)
        assert set(kept) == {i for i, (_, root) in groups.items() if root == i}


def test_stages_on_their_own_input(spark):
    """Every stage against a brute-force version of what it must do to its own input."""
    docs = read(spark, SF, "documents")
    good = {r.doc_id for r in read(spark, SF, "labels").where("quality = 1").collect()}
    bad = {r.doc_id for r in read(spark, SF, "labels").where("quality = 0").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "line_dedup", "ngram_join", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        before = {r.doc_id: r.text for r in rows}, {r.doc_id: r.source for r in rows}
        after = stage(spark, docs, SF)
        found = after.collect()
        if name == "packing":
            check_packing(found, before[0])
            continue
        assert after.columns == docs.columns
        check_stage(name, before, found, good, bad)
        docs = spark.createDataFrame(found, after.schema)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[1:], ids=[n for n, _ in corpus_pipeline.STAGES[1:]])
def test_odd_texts_and_boilerplate_in_a_stage(spark, docs_of, name, stage):
    """Nulls, empty and long texts, ties, copies and notices on many sites."""
    lines = [f"opening of text {k} stands here\nA notice that is on all of the sites\nclosing of text {k} comes last" for k in range(30)]
    texts = [*ODD, *lines, *(lines[:3] * 2), " ".join(f"w{k}" for k in range(3000)), " ".join(f"w{k}" for k in range(2990))]
    docs = docs_of([(k, t, f"site{k % 12}") for k, t in enumerate(texts)])
    good = {r.doc_id for r in read(spark, SF, "labels").where("quality = 1").collect()}
    rows = stage(spark, docs, SF).collect()
    before = dict(enumerate(texts)), {k: f"site{k % 12}" for k in range(len(texts))}
    if name == "packing":
        check_packing(rows, before[0])
    else:
        check_stage(name, before, rows, good, set())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables_and_repeated_rows_in_a_stage(spark, docs_of, name, stage):
    assert stage(spark, docs_of([]), SF).collect() == []
    text = "the reading of the other nation was standing near the table and ending there for the hours of it"
    rows = stage(spark, docs_of([(5, text, "s")] * 4 + [(None, text, None)]), SF).collect()
    ids = [r.doc_id for r in rows]
    if name in ("line_dedup", "ngram_join"):  # one document, whose rows stay together
        assert sorted(ids, key=str) == [5, 5, 5, 5, None]
    elif name == "packing":
        assert {*ids} == {5, None}
    else:
        assert ids.count(5) in (0, 4)


def test_run_returns_the_packed_documents(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())
