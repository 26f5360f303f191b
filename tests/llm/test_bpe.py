import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rentalmart.llm import bpe, bpe_job
from rentalmart.llm.encoders import ByteLevelEncoder
from rentalmart.llm.queries import tokenizer
from tests.llm.conftest import ODD

WORD_SPEC, BYTE_SPEC = tokenizer("word_bpe_49k.json"), tokenizer("byte_bpe_50k.json")
LIBRARY, BYTE_LIBRARY = Tokenizer.from_str(WORD_SPEC), Tokenizer.from_str(BYTE_SPEC)
ENCODER, DECODER, BYTES = bpe.Encoder(WORD_SPEC), bpe.Decoder(WORD_SPEC), ByteLevelEncoder(BYTE_SPEC)
TEXTS = ["Don't I'LL x'sS ŞΣΑΣ İi", "a<|endoftext|>b<|startoftext|> <|ENDOFTEXT|>", "日本語 한국어 🙂👨‍👩‍👧", "\x1c a\x1d ​z\x85q",
         "é ﬁ ½ ²3 ٣", "inthereanar" * 1500, "!!!###***" * 300]


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODER.ids(text) == ids
    assert DECODER.text(ids) == "".join(DECODER.stream(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert np.frombuffer(BYTES.ids(text), "<u2").tolist() == BYTE_LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [t for t in ODD if t is not None] + TEXTS)
def test_equals_the_library(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_equals_the_library_on_any_text(text):
    same(text.encode("utf-8", "ignore").decode())


def test_long_words_stream_in_bounded_memory():
    r = random.Random(2)
    word = "".join(r.choice("etaoinshrdlucmf") for _ in range(20_000))
    assert [*ENCODER.word(word)] == LIBRARY.encode(word, add_special_tokens=False).ids
    taken = 0

    def letters():
        nonlocal taken
        for c in word:
            taken += 1
            yield c
    stream, out = ENCODER.word(letters()), 0
    for k in range(2000):
        out += len(LIBRARY.id_to_token(next(stream)))
        assert taken - out <= 2 * (ENCODER.longest + ENCODER.ahead) + 1


def test_lookahead_of_small_merge_lists():
    assert bpe.lookahead([]) == 0
    assert bpe.lookahead([("a", "b")]) == 1
    assert bpe.lookahead([("b", "c"), ("a", "b")]) == 2  # "a b" waits for a c behind it


def test_byte_level_decoder_is_incremental():
    decoder = bpe.Decoder(BYTE_SPEC)
    text = "naïve 日本 🙂 end"
    ids = BYTE_LIBRARY.encode(text, add_special_tokens=False).ids
    parts = [*decoder.stream(ids)]
    assert "".join(parts) == text and len(parts) == len(ids) + 1
    assert "".join(decoder.stream(ids[:-3][:5])).count("�") <= 1


def test_jobs(docs_of):
    docs = docs_of(ODD + [(None, "no id")])
    ids = {r.doc_id: list(r.ids) for r in bpe_job.encode(docs, WORD_SPEC).collect()}
    texts = {r.doc_id: r.text for r in bpe_job.decode(bpe_job.encode(docs, WORD_SPEC), WORD_SPEC).collect()}
    for r in bpe_job.digests(docs, WORD_SPEC).collect():
        want = LIBRARY.encode("no id" if r.doc_id is None else ODD[r.doc_id] or "", add_special_tokens=False).ids
        assert ids[r.doc_id] == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert texts[r.doc_id] == LIBRARY.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe_job.digests(docs_of([]), WORD_SPEC).collect() == []


def test_digests_decode_piece_by_piece(monkeypatch):
    monkeypatch.setattr(bpe_job.Decoder, "text", None)  # the whole-text way
    sha = lambda text: hashlib.sha256("".join(DECODER.stream(ENCODER.ids(text))).encode()).hexdigest()
    texts = ["é ü ß 🙂 end", "word " * 10_000]
    monkeypatch.setattr(bpe_job, "_lean", lambda docs, *_: Once(docs))
    rows = bpe_job.digests(texts, WORD_SPEC)
    assert rows == [sha(t) for t in texts]


class Once:
    """Runs a mapInArrow function in this process, for one batch of texts."""

    def __init__(self, texts):
        self.batch = pa.RecordBatch.from_arrays([pa.array([*range(len(texts))]), pa.array(texts)], names=["id", "text"])

    def mapInArrow(self, run, schema):
        return next(run(iter([self.batch]))).column("decoded_sha256").to_pylist()


def test_a_long_text_is_encoded_and_decoded_in_bounded_memory():
    """A million words: neither words nor ids nor the decoded text are held."""
    import tracemalloc
    r = random.Random(4)
    some = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    text = " ".join(r.choice(some) for _ in range(1_000_000))
    encoder, decoder = bpe.Encoder(WORD_SPEC), bpe.Decoder(WORD_SPEC)
    [*encoder.pieces(" ".join(some))]  # the words' own ids are remembered
    ids_sha, text_sha, state, n = hashlib.sha256(), hashlib.sha256(), decoder.start(), 0
    tracemalloc.start()
    for ids in encoder.pieces(text):
        n += len(ids) // 4
        ids_sha.update(ids)
        text_sha.update(state.feed(memoryview(ids).cast("I")).encode())
    text_sha.update(state.end().encode())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < len(text) + 3_000_000  # the lower-cased text, and a little
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert n == len(want) > 1_000_000 and ids_sha.digest() == hashlib.sha256(np.array(want, "<u4").tobytes()).digest()
    assert text_sha.digest() == hashlib.sha256(LIBRARY.decode(want, skip_special_tokens=False).encode()).digest()


@pytest.mark.parametrize("text", ["a<|startoftext|><|endoftext|>", "[X] b [X]", "[X]", "no"])
def test_other_special_tokens(text):
    """Special tokens are told by the file, not by how they look."""
    import json
    spec = json.loads(WORD_SPEC)
    spec["added_tokens"].append({**spec["added_tokens"][0], "id": len(spec["model"]["vocab"]) + 2, "content": "[X]"})
    own = json.dumps(spec)
    assert bpe.Encoder(own).ids(text) == Tokenizer.from_str(own).encode(text, add_special_tokens=False).ids
