"""The transducers over a table of texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Decoder, Encoder


def encode(docs: DataFrame, spec: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ids (int array). A null text is encoded as an empty one: no ids.
    Repeated rows and null ids stay; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(spec)
        for batch in batches:
            ids = [encoder.ids(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return _lean(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, ids array<int>")


def decode(encoded: DataFrame, spec: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id and text. Null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(spec)
        for batch in batches:
            texts = ["".join(decoder.stream(ids or ())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    lean = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return lean.mapInArrow(run, f"`{id_col}` long, text string")


def digests(docs: DataFrame, spec: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit numbers)
    and decoded_sha256 (the UTF-8 text that the ids decode to). Ids are hashed and decoded as
    they come, so neither the words, the ids nor the decoded text of a row is ever whole. Defined as ``encode`` and ``decode`` are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(spec), Decoder(spec)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for text in batch.column("text").to_pylist():
                count, ids_sha, text_sha, state = 0, hashlib.sha256(), hashlib.sha256(), decoder.start()
                for ids in encoder.pieces(text):
                    count += len(ids) // 4
                    ids_sha.update(ids)
                    text_sha.update(state.feed(memoryview(ids).cast("I")).encode())
                text_sha.update(state.end().encode())
                n.append(count)
                of_ids.append(ids_sha.hexdigest())
                of_text.append(text_sha.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                                             names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return _lean(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _lean(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
