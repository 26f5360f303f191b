import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from rentalmart.llm import packing
from rentalmart.llm.queries import tokenizer
from tests.llm.conftest import ODD

SPEC = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(SPEC)


def checked(rows, texts, library, window):
    """Every id lies in exactly one piece; windows are full but the last, without gaps."""
    own = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in texts.items()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = own[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(own[r.doc_id]) and len(ids) == r.length > 0
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and list(ids) == list(r.ids)
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    for i, ids in own.items():
        assert [s for s, _ in sorted(pieces[i])] == [sum(n for _, n in sorted(pieces[i])[:k]) for k in range(len(pieces[i]))]
        assert sum(n for _, n in pieces[i]) == len(ids)
    for w, parts in windows.items():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) == window or w == max(windows)
    assert sorted(windows) == list(range(len(windows)))
    return windows


def test_odd_texts(docs_of, library):
    rows = packing.pack(docs_of(ODD + ["special <|endoftext|> token"]), SPEC).collect()
    checked(rows, {**dict(enumerate(ODD)), len(ODD): "special <|endoftext|> token"}, library, 1024)


def test_proportions_hold_in_every_window(docs_of, library):
    texts = [(k, f"some words of text number {k} " * (1 + k % 7), "big" if k % 3 else f"s{k % 4}") for k in range(400)]
    rows = packing.pack(docs_of(texts), SPEC, window=256, least=16, span=8).collect()
    checked(rows, {i: t for i, t, _ in texts}, library, 256)
    by_window, all_tokens = defaultdict(Counter), Counter()
    for r in rows:
        by_window[r.sequence_id][r.queue] += r.length
        all_tokens[r.queue] += r.length
    total, served = sum(all_tokens.values()), Counter()
    for w in sorted(by_window)[:-1]:
        served.update(by_window[w])
        for q, n in all_tokens.items():  # deficits stay bounded, over spans too
            assert abs(served[q] - n / total * 256 * (w + 1)) <= 4 * 16 + 16
    assert len(by_window) > 16


def test_null_source_ids_and_empty_table(docs_of, spark, library):
    docs = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (None, "c", "")], "doc_id long, text string, source string")
    rows = packing.pack(docs, SPEC).collect()
    assert Counter(r.doc_id for r in rows) == {1: 2, None: 1} and {r.sequence_id for r in rows} == {0}
    assert packing.pack(docs_of([]), SPEC).collect() == []


def test_fill_carries_deficits():
    queues = [[(0, 0, 1000)], [(1, 0, 30), (2, 0, 30)], [(3, 0, 6)]]
    out = packing.fill(queues, 5, 100, 10)
    assert sum(n for _, _, n, _ in out) == 1066 and [at for *_, at in out] == [sum(n for _, _, n, _ in out[:k]) for k in range(len(out))]
    assert packing.fill([], 0, 100, 10) == []
