import random
import sys
from collections import Counter, defaultdict
from math import exp, isclose, log, tanh

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentalmart.llm import pseudo_lm
from tests.llm.conftest import ODD


def sentences(seed, n):
    """Texts in which every third word follows from its two neighbours."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = []
        for _ in range(30):
            a = r.randrange(8)
            w += [f"left{a}", f"mid{a}", f"right{a}"]
        out.append(" ".join(w))
    return out


def random_network(n, seed=0):
    r = np.random.default_rng(seed)
    net = pseudo_lm.Network.start(r.integers(0, 50, n * n))
    for part in (net.out, net.member):
        part[:] = r.normal(0, 0.5, part.shape)
    net.place[:] = r.normal(1, 0.5, net.place.shape)
    return net


def brute(net, classes):
    """Masked log-probabilities of classes, position by position in plain Python."""
    n, out = len(net.bias), []

    def log_softmax(z, k):
        return z[k] - log(sum(exp(x) for x in z))
    for t in range(len(classes)):
        around = [p for p in range(t - pseudo_lm.WINDOW, t + pseudo_lm.WINDOW + 1) if p != t]
        h = [0.0] * pseudo_lm.WIDTH
        for j, p in enumerate(around):
            c = classes[p] if 0 <= p < len(classes) else n * n
            for d in range(pseudo_lm.WIDTH):
                h[d] += float(net.embed[c, d]) * float(net.place[j, d])
        h = [tanh(x) for x in h]
        group, own = divmod(classes[t], n)
        z = [sum(h[d] * float(net.out[d, c]) for d in range(pseudo_lm.WIDTH)) + float(net.bias[c]) for c in range(n)]
        y = [sum(h[d] * float(net.member[group, d, c]) for d in range(pseudo_lm.WIDTH)) + float(net.lean[group, c]) for c in range(n)]
        out.append(log_softmax(z, group) + log_softmax(y, own))
    return out


def brute_scores(texts, net, sizes, n_head):
    """All of a score but for the training: shares of words in classes, and the memory."""
    split = [(t or "").lower().split() for t in texts]
    n = Counter(w for t in split for w in t)
    head = sorted(n, key=lambda w: (-n[w], w))[:n_head]
    rank = {w: k for k, w in enumerate(head)}
    cls = {w: rank[w] if rank.get(w, sizes.frequent) < sizes.frequent else sizes.ending(w.encode()) for w in n}
    of_class, of_bucket = Counter(), Counter()
    for w, k in n.items():
        of_class[cls[w]] += k
        if w not in rank:
            of_bucket[sizes.bucket(w.encode())] += k
    share = {w: (n[w] if w in rank else of_bucket[sizes.bucket(w.encode())]) / of_class[cls[w]] for w in n}
    pad, places = sizes.classes, defaultdict(Counter)
    for t in split:
        c = [pad, *(cls[w] for w in t), pad]
        for k, w in enumerate(t):
            if w not in rank:
                places[tuple(c[k:k + 3])][w] += 1
    out = []
    for t in split:
        c = [pad, *(cls[w] for w in t), pad]
        total = sum(brute(net, [cls[w] for w in t]))
        for k, w in enumerate(t):
            p = share[w]
            if w not in rank:
                seen = places[tuple(c[k:k + 3])]
                if sum(seen.values()) > 1:
                    p = (seen[w] - 1 + len(seen) * p) / (sum(seen.values()) - 1 + len(seen))
            total += log(p)
        out.append(total)
    return out


def test_network_equals_brute_force():
    r = np.random.default_rng(0)
    net = random_network(5)
    texts = [r.integers(0, 25, n).astype(np.int32) for n in (1, 0, 2, 3, 11)]
    around, own = pseudo_lm.contexts(texts, 25)
    got = net.log_probabilities(around, own, step=4)
    assert np.allclose(got, [x for t in texts for x in brute(net, t.tolist())], atol=1e-4)
    assert isclose(sum(exp(brute(net, [3, c, 9])[1]) for c in range(25)), 1, abs_tol=1e-6)


def test_scores_equal_brute_force(docs_of, monkeypatch):
    """Classes, shares and memory over a corpus with copies, rare words in equal places, odd texts."""
    r = random.Random(5)
    words = [f"w{k}{e}" for k in range(400) for e in ("an", "is")]
    texts = [" ".join(r.choice(words[:r.choice([20, 800])]) for _ in range(r.randint(1, 40))) for _ in range(60)]
    texts += texts[:10] + [None, "", "One two", "one TWO three " * 4]
    n = 16
    net = random_network(n, 3)
    monkeypatch.setattr(pseudo_lm, "HEAD", 200)
    monkeypatch.setattr(pseudo_lm, "BUCKETS", 1 << 20)
    monkeypatch.setattr(pseudo_lm, "trained", lambda lines, counts, rounds: net)
    got = {x.doc_id: x for x in pseudo_lm.scores(docs_of(texts)).collect()}
    want = brute_scores(texts, net, pseudo_lm.Sizes(n), 200)
    assert [got[k].n_tokens for k in range(len(texts))] == [len((t or "").split()) for t in texts]
    assert np.allclose([got[k].log_likelihood for k in range(len(texts))], want, atol=1e-2)


def test_gradient_step_lowers_the_loss():
    net = pseudo_lm.Network.start(np.ones(256))
    classes = np.tile(np.array([3, 90, 227], dtype=np.int32), 200)
    (around, own), sums = pseudo_lm.contexts([classes], 256), [np.zeros_like(p) for p in net.parts()]
    before = net.log_probabilities(around, own).mean()
    for _ in range(20):
        net.learn(around, own, sums, 0.1)
    assert net.log_probabilities(around, own).mean() > before + 2
    again = pseudo_lm.Network.load(net.dump(), 16)
    assert all(np.array_equal(a, b) for a, b in zip(net.parts(), again.parts()))


def test_gradients_equal_differences():
    """The step's gradients (with a rate that leaves them readable) against finite differences."""
    net = random_network(4, 7)
    classes = np.random.default_rng(2).integers(0, 16, 12).astype(np.int32)
    around, own = pseudo_lm.contexts([classes], 16)
    moved = pseudo_lm.Network.load(net.dump(), 4)
    moved.learn(around, own, [np.full_like(p, 1e12) for p in net.parts()], 1e6)  # part -= grad
    for k, (a, b) in enumerate(zip(net.parts(), moved.parts())):
        at = np.unravel_index(np.argmax(np.abs(a - b)), a.shape)
        grad, step, loss = float((a - b)[at]), 1e-2, []
        for s in (step, -step):
            other = pseudo_lm.Network.load(net.dump(), 4)
            other.parts()[k][at] += s
            loss.append(-other.log_probabilities(around, own).mean())
        assert isclose(grad, (loss[0] - loss[1]) / (2 * step), rel_tol=0.05, abs_tol=1e-3), k


def test_both_sides_beat_unigrams_and_shuffles(docs_of):
    texts = sentences(1, 300)
    shuffled = [" ".join(random.Random(k).sample(t.split(), 90)) for k, t in enumerate(texts[:40])]
    got = {r.doc_id: r.mean_log_prob for r in pseudo_lm.scores(docs_of(texts + shuffled), rounds=4).collect()}
    plain, mixed = np.mean([got[k] for k in range(40)]), np.mean([got[300 + k] for k in range(40)])
    assert plain > log(1 / 24) + 0.5 and plain > mixed + 0.5


def test_texts_that_occur_twice_score_apart(docs_of, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "HEAD", 300)
    r = random.Random(11)
    common = [f"c{k}" for k in range(300)]
    def text():
        return " ".join(r.choice(common) if r.random() < 0.7 else "".join(r.choice("abcdefgh") for _ in range(7)) for _ in range(60))
    once, twice = [text() for _ in range(150)], [text() for _ in range(20)]
    got = {x.doc_id: x.mean_log_prob for x in pseudo_lm.scores(docs_of(once + twice + twice)).collect()}
    assert min(got[k] for k in range(150, 190)) > max(got[k] for k in range(150)) + 0.5


def test_many_workers_are_averaged_in_a_tree(docs_of, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "FAN", 2)
    rows = pseudo_lm.scores(docs_of(sentences(2, 100)).repartition(7), rounds=2).collect()
    assert np.mean([r.mean_log_prob for r in rows]) > log(1 / 24)


def test_repeated_rows_are_spread(docs_of, spark):
    """A third of all rows with one id and text: every task trains on its own part of the table."""
    texts = sentences(3, 60)
    rows = [*enumerate(texts)] + [(7, texts[0])] * 30
    got = pseudo_lm.scores(docs_of(rows)).collect()
    same = [r.log_likelihood for r in got if r.doc_id == 7 and r.n_tokens == 90]
    assert len(got) == 90 and len(same) == 31


def test_classes_grow_with_the_corpus():
    sides = [pseudo_lm.side(n) for n in (0, 10**4, 10**7, 10**9, 10**12)]
    assert sides == sorted(sides) and sides[0] == 16 and sides[-1] > 4 * sides[2]
    for n in sides:
        sizes = pseudo_lm.Sizes(n)
        assert sizes.frequent + sizes.endings == n * n
        found = {sizes.ending(f"word{a}{b}".encode()) for a in "abcdefgh" for b in "abcdefgh"}
        assert min(found) >= sizes.frequent and max(found) < sizes.classes
        assert 0 <= sizes.bucket(b"word") < sizes.endings * sizes.buckets


def test_shares_of_a_class_add_up(docs_of, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "HEAD", 20)
    texts = [" ".join(f"w{k * j % 700}" for j in range(50)) for k in range(60)]
    counts = pseudo_lm.counted(docs_of(texts), "text")
    sizes, total = counts.sizes, np.zeros(counts.sizes.classes)
    for k, w in enumerate(counts.head):
        total[k if k < sizes.frequent else sizes.ending(w.encode())] += exp(counts.head_share[k])
    used = {sizes.bucket(w.encode()) for t in texts for w in t.split() if w not in counts.head}
    for b in used:
        total[sizes.frequent + b // sizes.buckets] += exp(counts.bucket_share[b])
    assert np.allclose(total[counts.classes > 0], 1, atol=1e-4) and counts.tokens == 3000


@pytest.mark.parametrize("extra", [[], ["a b c"] * 3])
def test_odd_texts(docs_of, extra):
    rows = pseudo_lm.scores(docs_of(ODD + extra + [(None, "no id")])).collect()
    assert len(rows) == len(ODD) + len(extra) + 1
    by = {r.doc_id: r for r in rows}
    assert (by[0].n_tokens, by[0].log_likelihood, by[0].mean_log_prob) == (0, 0.0, 0.0) and by[7].n_tokens == 30_000
    assert isclose(by[5].log_likelihood, by[6].log_likelihood, rel_tol=1e-5) and all(np.isfinite(r.log_likelihood) for r in rows)


def test_a_text_longer_than_a_chunk(docs_of, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "CHUNK", 100)
    monkeypatch.setattr(pseudo_lm, "PIECE", 30)
    long = " ".join(f"w{k % 70}" for k in range(1000))
    one = {r.doc_id: r.n_tokens for r in pseudo_lm.scores(docs_of([long, "a b", None, long])).collect()}
    assert one == {0: 1000, 1: 2, 2: 0, 3: 1000}


def test_empty_table(docs_of):
    assert pseudo_lm.scores(docs_of([])).collect() == []


def test_a_step_makes_few_calls_for_a_group():
    """What is not a matrix product is done once a batch and not once for each group of classes (F1)."""
    net, r, calls = random_network(32), np.random.default_rng(4), [0]
    around, own = pseudo_lm.contexts([r.integers(0, 1024, 4096).astype(np.int32)], 1024)
    sums = [np.zeros_like(p) for p in net.parts()]

    def seen(frame, event, arg):
        calls[0] += event in ("call", "c_call")
    sys.setprofile(seen)
    try:
        net.learn(around, own, sums, 0.1)
    finally:
        sys.setprofile(None)
    assert calls[0] < 16 * 32


def test_words_are_counted_before_the_shuffle(docs_of, monkeypatch):
    """A row for each different word of a piece goes to Spark, not one for each token (F1)."""
    plans, kept = [], pseudo_lm.stored
    monkeypatch.setattr(pseudo_lm, "stored", lambda df, name: plans.append((name, df._jdf.queryExecution().toString())) or kept(df, name))
    counts = pseudo_lm.counted(docs_of(ODD + ["one two"]), "text")
    assert "Generate" not in dict(plans)["word_counts"] and counts.head[:2] == ["x", "line"] and "" not in counts.head


def test_large_weights_do_not_overflow():
    net = random_network(4, 1)
    net.member *= 400
    net.out *= 400
    classes = np.random.default_rng(3).integers(0, 16, 40).astype(np.int32)
    around, own = pseudo_lm.contexts([classes], 16)
    got = net.log_probabilities(around, own)
    z = np.abs(net.member).sum()
    assert z > pseudo_lm.SAFE and np.isfinite(got).all() and got.min() < -pseudo_lm.SAFE
    net.learn(around, own, [np.zeros_like(p) for p in net.parts()], 0.1)
    assert all(np.isfinite(p).all() for p in net.parts())


def test_splitting_equals_python(monkeypatch):
    monkeypatch.setattr(pseudo_lm, "PIECE", 12)
    texts = [" a  b ", "", "\x0bé\tü\r\n\x0c", " ", "x\x1cy\x85\u2003z q", "a" * 50, "end"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    some = list(pseudo_lm.pieces(batch))
    assert [t for p in some for t in p.column("text").to_pylist()] == texts and len(some) > 3
    for column in [batch.column("text"), *(p.column("text") for p in some)]:
        found, n = pseudo_lm.split(column)
        want = [t.encode().split() for t in column.to_pylist()]
        assert n.tolist() == [len(w) for w in want] and [w.encode() for w in found.to_pylist()] == [w for t in want for w in t]


def test_words_by_array_equal_one_by_one():
    sizes, found = pseudo_lm.Sizes(20), ["a", "é", "word", "🙂🙂🙂", "ß", "worden", "word"]
    endings, buckets, hashes = sizes.others(pa.array(found))
    assert endings.tolist() == [sizes.ending(w.encode()) for w in found] and buckets.tolist() == [sizes.bucket(w.encode()) for w in found]
    assert hashes[2] == hashes[6] and len(set(hashes.tolist())) == 6
    assert [len(x) for x in sizes.others(pa.array([], pa.string()))] == [0, 0, 0]
    got = pseudo_lm.bytes_of(np.array([1, 2, 3], "<u2"), np.array([0, 2, 0, 1]))
    assert got.to_pylist() == [b"", b"\1\0\2\0", b"", b"\3\0"]
