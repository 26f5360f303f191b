import random
from math import exp
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentalmart.llm import classifier, stats
from rentalmart.llm.common import read
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def plain_score(model, row):
    """Brute force: the rule ensemble evaluated rule by rule."""
    total = model.intercept
    for conditions, weight in model.rules:
        total += weight * all((row[n] > c) == above for n, above, c in conditions)
    for n, low, high, weight in model.linear:
        total += weight * min(max(row[n], low), high)
    return 1 / (1 + exp(-total))


def test_held_out_accuracy(spark):
    docs, labels = read(spark, SF, "documents").select("doc_id", "text"), read(spark, SF, "labels")
    got = classifier.quality_scores(docs, labels)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == docs.count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_compiled_rules_equal_brute_force(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5) | (x[:, 2] > 1.2)).astype(float)
    model = classifier.fit(x, y, ["a", "b", "c"])
    assert model.rules and any(len(c) > 1 for c, _ in model.rules)
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], "a double, b double, c double")
    got = df.withColumn("s", model.expression()).collect()
    assert all(abs(g.s - plain_score(model, g.asDict())) < 1e-9 for g in got)
    assert np.mean([(g.s > 0.5) == bool(t) for g, t in zip(got, y)]) > 0.93


def test_statistics(docs_of):
    text = "AB cd!! cd!! | x# 12"
    r = classifier.with_statistics(docs_of([text]).select("text"), "text").first()
    assert (r.n_words, r.upper, r.digits, r.bangs, r.bars, r.symbols, r.longest) == (6, 2 / 15, 2 / 15, 4 / 6, 1 / 6, 2 / 6, 4.0)


def test_labels_of_held_out_rows_are_never_used(docs_of, spark):
    r = random.Random(1)
    texts = [("junk** " if k % 2 else "clean ") * r.randint(5, 30) for k in range(60)]
    honest = [(k, 1 - k % 2) for k in range(60)]
    turned = [(k, (1 - q) if crc32(str(k).encode()) % 5 == 0 else q) for k, q in honest]
    a, b = ([(x.doc_id, x.score) for x in classifier.quality_scores(docs_of(texts), spark.createDataFrame(ls, "doc_id long, quality int"))
            .orderBy("doc_id").collect()] for ls in (honest, turned))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(5, 1), (6, 1)], [(0, None), (None, 1)], [(5, 1), (5, 1), (7, 0), (8, 0), (9, 1)]])
def test_odd_texts_and_labels(docs_of, spark, labels):
    docs = docs_of(ODD + [(None, "no id"), (3, "one")]).withColumn("score", F.lit("clash"))
    out = classifier.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = out.collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[5] == by[6] and by[0] == by[11] == by[1]
    assert classifier.quality_scores(docs_of([]), spark.createDataFrame(labels, "doc_id long, quality int")).collect() == []


def test_every_statistic_is_finite(docs_of):
    rows = classifier.with_statistics(docs_of(ODD).select("text"), "text").collect()
    assert all(r[c] is not None and np.isfinite(r[c]) for r in rows for c in stats.SHAPE)
