"""LM scoring: masked pseudo-likelihood with a bidirectional window network.

Each token is predicted from the ``WINDOW`` tokens before and after it; the sum of the
conditional log-probabilities is the text's pseudo-log-likelihood. What the model gathers
grows with the corpus:

* Word classes. The most frequent words are classes of their own, all other words fall into
  classes by their ending. There are ``side(tokens)`` squared of them, about the square root
  of the number of tokens. The network gives p(class | both sides) in two steps, a group of
  classes and a class of the group, so a token costs twice the side and not its square.
* The words of a class. p(word | class) is the word's share of the class in the corpus: exact
  for the HEAD most frequent words, by hash buckets for the others.
* A memory of rare words in their places. For every occurrence of a word outside the head,
  the corpus is asked how often its neighbours' classes and its own stand around such a word
  elsewhere, and how often around this very word: p(word | class, neighbours) is that share,
  smoothed towards p(word | class) by the number of different words there (Witten-Bell). The
  occurrence itself is left out, so a text that stands alone gains nothing from itself.

All documents are counted and trained on. The network is trained in numpy inside tasks: texts
are written once as classes, every task goes over its part of that table from the same
weights, and the weights of all tasks are averaged in a tree of fixed fan-in; this is a
round. No text, however long or often repeated, has to be in one place for that. Words are
counted and looked up a piece of text at a time, each different word of it once. The memory
is two aggregations by 64-bit keys; only keys that occur again are joined back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import drop, stored
from .hot_groups import join_groups

WINDOW = 2  # tokens on either side
WIDTH = 24
SIDE, GROWTH = 16, 2.83  # least groups of classes; they grow as the fourth root of the tokens
HEAD = 1 << 17  # words whose counts are kept exactly
BUCKETS = 1 << 17  # counts of other words by hash, over all ending classes
ROUNDS, RATE = 1, 0.1
BATCH, LARGEST, DOUBLED = 256, 4096, 64  # tokens of a first step, of the largest, steps until they double
CHUNK, PIECE = 500_000, 1 << 22  # tokens that a task holds as arrays, bytes of text that it looks up at once
SAFE = 80  # logits up to this need no shift before 32-bit exp()
FAN = 16  # sets of weights that are averaged together
BITS = 1 << 25  # of the bitmap of places that occur again: 4 MB at any size of input
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def side(tokens: int) -> int:
    """Groups of classes, and classes of a group."""
    return max(SIDE, int(tokens ** 0.25 / GROWTH))


@dataclass(frozen=True)
class Sizes:
    """Of the classes for a corpus."""

    side: int

    @property
    def classes(self) -> int:
        return self.side ** 2

    @property
    def endings(self) -> int:
        return self.classes // 4

    @property
    def frequent(self) -> int:
        return self.classes - self.endings

    @property
    def buckets(self) -> int:
        return max(16, BUCKETS // self.endings)

    def ending(self, word: bytes) -> int:
        return self.frequent + xxh3_64_intdigest(word.decode("utf-8", "replace")[-2:].encode()) % self.endings

    def bucket(self, word: bytes) -> int:
        return (self.ending(word) - self.frequent) * self.buckets + xxh3_64_intdigest(word) % self.buckets

    def others(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ending, bucket, hash) of each word."""
        last = pc.utf8_slice_codeunits(found, -2).dictionary_encode()
        by_last = np.array([self.ending(x.encode()) for x in last.dictionary.to_pylist()], dtype=np.int64)
        endings = by_last[last.indices.to_numpy()]
        hashes = np.fromiter(map(xxh3_64_intdigest, found.cast(pa.binary()).to_pylist()), np.uint64, len(found))
        return endings, (endings - self.frequent) * self.buckets + (hashes % np.uint64(self.buckets)).astype(np.int64), hashes


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about PIECE bytes of text, one row at least."""
    ends, a = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, PIECE + (ends[a - 1] if a else 0), side="right")))
        yield batch.slice(a, b - a)
        a = b


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts, at ASCII white space only; their number in each text)."""
    lists = pc.ascii_split_whitespace(texts)
    found, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(pc.binary_length(found), 0)  # white space at a text's ends gives empty ones
    if not pc.all(real).as_py():
        n = np.bincount(np.repeat(np.arange(len(n)), n)[real.to_numpy(zero_copy_only=False)], minlength=len(n))
        found = found.filter(real)
    return found, n


def bytes_of(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """The bytes of ``values``, n of them to a row."""
    ends = np.concatenate([[0], np.cumsum(n)]) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    return x ^ (x >> np.uint64(29))


def contexts(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(the classes around each position of the texts, 2 * WINDOW columns, ``pad`` beyond a
    text's ends; the classes at the positions)."""
    gap = np.full(WINDOW, pad, dtype=np.int32)
    pieces = [gap]
    for t in texts:
        pieces += [t, gap]
    line, lengths = np.concatenate(pieces), np.array([len(t) for t in texts], dtype=np.int64)
    at = np.arange(lengths.sum()) + np.repeat(WINDOW * (1 + np.arange(len(texts))), lengths)
    return np.stack([line[at + j] for j in range(-WINDOW, WINDOW + 1) if j], axis=1), line[at]


@dataclass
class Network:
    embed: np.ndarray  # classes + 1 x WIDTH, the last for what lies beyond a text's ends
    place: np.ndarray  # 2 WINDOW x WIDTH
    out: np.ndarray  # WIDTH x side: groups
    bias: np.ndarray  # side
    member: np.ndarray  # side x WIDTH x side: the classes of each group
    lean: np.ndarray  # side x side

    @staticmethod
    def shapes(n: int) -> list[tuple[int, ...]]:
        return [(n * n + 1, WIDTH), (2 * WINDOW, WIDTH), (WIDTH, n), (n,), (n, WIDTH, n), (n, n)]

    @staticmethod
    def start(class_counts: np.ndarray) -> Network:
        """The class shares of the corpus, whatever the neighbours."""
        n = int(len(class_counts) ** 0.5)
        p = ((class_counts + 1) / (class_counts.sum() + len(class_counts))).reshape(n, n)
        shapes = Network.shapes(n)
        return Network(np.random.default_rng(0).normal(0, 0.3, shapes[0]).astype("f4"), np.ones(shapes[1], "f4"),
                       np.zeros(shapes[2], "f4"), np.log(p.sum(axis=1)).astype("f4"),
                       np.zeros(shapes[4], "f4"), np.log(p / p.sum(axis=1, keepdims=True)).astype("f4"))

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.place, self.out, self.bias, self.member, self.lean]

    def dump(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.parts()]).astype("<f4").tobytes()

    @staticmethod
    def load(raw: bytes, n: int) -> Network:
        flat, out, at = np.frombuffer(raw, "<f4").copy(), [], 0
        for shape in Network.shapes(n):
            out.append(flat[at:at + int(np.prod(shape))].reshape(shape))
            at += int(np.prod(shape))
        return Network(*out)

    def tables(self) -> list[np.ndarray]:
        """What each class adds to the hidden layer, by its place beside the token."""
        return [self.embed * place for place in self.place]

    def layers(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the groups and of each group's classes, the biases as their last row."""
        return np.vstack([self.out, self.bias]), np.concatenate([self.member, self.lean[:, None]], axis=1)

    @staticmethod
    def hidden(tables: list[np.ndarray], around: np.ndarray) -> np.ndarray:
        """Of positions whose neighbours' classes are the columns of ``around``; a last column
        of ones meets the biases."""
        h = tables[0].take(around[0], axis=0)
        for table, classes in zip(tables[1:], around[1:]):
            h += table.take(classes, axis=0)
        out = np.ones((len(h), WIDTH + 1), "f4")
        np.tanh(h, out=out[:, :WIDTH])
        return out

    @staticmethod
    def _shifted(z: np.ndarray, *weights: np.ndarray) -> np.ndarray:
        """Logits of these weights so that exp() is finite and its sums are not zero, in place.
        Hidden values are 1 at most, so most weights are too small for that to take a shift."""
        if max(np.abs(w).sum(axis=-2).max() for w in weights) > SAFE:
            z -= z.max(axis=1, keepdims=True)
        return z

    @staticmethod
    def _in_groups(h: np.ndarray, members: np.ndarray, groups: list[tuple[int, slice]]) -> np.ndarray:
        """Logits of the classes of each position's group."""
        z = np.empty((len(h), members.shape[2]), "f4")
        for k, rows in groups:
            np.matmul(h[rows], members[k], out=z[rows])
        return z

    def log_probabilities(self, around: np.ndarray, classes: np.ndarray, step: int = 8192) -> np.ndarray:
        """log p(class | both sides) of each position."""
        out, n = np.empty(len(classes)), len(self.bias)
        tables, (top, members) = self.tables(), self.layers()
        ones = np.ones(n, "f4")
        for a in range(0, len(classes), step):
            order, groups = _by_group(classes[a:a + step] // n)
            group, own = np.divmod(classes[a:a + step][order], n)
            h = self.hidden(tables, around[a:a + step][order].T.astype(np.intp))
            at, found = np.arange(len(order)), np.zeros(len(order))
            for z, k in ((self._shifted(h @ top, top), group), (self._shifted(self._in_groups(h, members, groups), members), own)):
                found += z[at, k]
                found -= np.log(np.exp(z, out=z) @ ones)
            out[a + order] = found
        return out

    def learn(self, around: np.ndarray, classes: np.ndarray, sums: list[np.ndarray], rate: float) -> None:
        """One adaptive gradient step on a batch."""
        size, n = len(classes), len(self.bias)
        order, groups = _by_group(classes // n)
        group, own = np.divmod(classes[order], n)
        around = around[order].T.astype(np.intp)
        top, members = self.layers()
        h = self.hidden(self.tables(), around)
        at, ones = np.arange(size), np.ones(n, "f4")

        def less_own(z: np.ndarray, k: np.ndarray) -> np.ndarray:
            """The loss's gradient by the logits, in place."""
            np.exp(z, out=z)
            z *= (1 / (size * (z @ ones)))[:, None]
            z[at, k] -= np.float32(1 / size)
            return z

        p = less_own(self._shifted(h @ top, top), group)
        q = less_own(self._shifted(self._in_groups(h, members, groups), members), own)
        d_top, d_members, back = h.T @ p, np.zeros_like(members), np.empty((size, WIDTH), "f4")
        for k, rows in groups:
            np.matmul(h[rows].T, q[rows], out=d_members[k])
            np.matmul(q[rows], self.member[k].T, out=back[rows])
        back += p @ self.out.T
        h = np.ascontiguousarray(h[:, :WIDTH])
        back *= 1 - h * h
        # the sums of ``back`` over each class in each place; both gradients of the products follow from them
        d_place, d_embed, met = np.empty_like(self.place), np.zeros_like(self.embed), np.zeros(len(self.embed), bool)
        for j, neighbours in enumerate(around):
            order = _order(neighbours, len(self.embed))
            starts = np.flatnonzero(np.diff(neighbours[order], prepend=-1))
            some = neighbours[order[starts]]
            pairs = back.take(order, axis=0).view(np.complex64)  # two numbers a step
            of_class = np.add.reduceat(pairs, starts, axis=0).view("f4")
            d_place[j] = np.einsum("cw,cw->w", of_class, self.embed[some])
            d_embed[some] += of_class * self.place[j]
            met[some] = True
        some = np.flatnonzero(met)
        d_embed = d_embed[some]
        sums[0][some] += d_embed * d_embed
        self.embed[some] -= rate * d_embed / (np.sqrt(sums[0][some]) + 1e-6)
        for k, grad in ((1, d_place), (2, d_top[:-1]), (3, d_top[-1]), (4, d_members[:, :-1]), (5, d_members[:, -1])):
            sums[k] += grad * grad
            self.parts()[k][...] -= rate * grad / (np.sqrt(sums[k]) + 1e-6)


def _order(values: np.ndarray, end: int) -> np.ndarray:
    """The stable order of values below ``end``; short ones are sorted by digits, far faster."""
    return np.argsort(values.astype(np.uint16) if end <= 1 << 16 else values, kind="stable")


def _by_group(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """(an order of the rows by group; each group that occurs, its rows in that order)."""
    order = _order(group, 1 << 16)  # there are fewer groups
    of = group[order]
    starts = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
    return order, [(int(of[a]), slice(a, b)) for a, b in zip(starts, [*starts[1:], len(of)])]


@dataclass
class Counts:
    """Of the corpus: its tokens, the head words, log p(word | class) of these and of the
    buckets, and the tokens of each class."""

    sizes: Sizes
    tokens: int
    head: list[str]
    head_share: np.ndarray
    bucket_share: np.ndarray
    classes: np.ndarray


def lowered(text_col: str) -> Column:
    return F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text")


def counted(docs: DataFrame, text_col: str) -> Counts:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                words, n = split(some.column("text"))[0].value_counts().flatten()
                yield pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

    by_word = stored(docs.select(lowered(text_col)).mapInArrow(count, "word string, n long")
                     .groupBy("word").agg(F.sum("n").alias("count")), "word_counts")
    tokens = by_word.agg(F.sum("count")).first()[0] or 0
    sizes = Sizes(side(tokens))
    top = by_word.orderBy(F.desc("count"), "word").limit(max(HEAD, sizes.frequent)).collect()
    head = [r[0] for r in top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = sizes.others(batch.column("word"))[1]
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), batch.column("count")], names=["bucket", "n"])

    in_bucket = np.zeros(sizes.endings * sizes.buckets)
    for bucket, n in by_word.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        in_bucket[bucket] = n  # one row per bucket
    n_head = np.array([r[1] for r in top], dtype=np.float64)
    cls, own_buckets, _ = sizes.others(pa.array(head, pa.string()))
    np.subtract.at(in_bucket, own_buckets, n_head)  # what remains are the other words
    cls[:sizes.frequent] = np.arange(min(sizes.frequent, len(head)))
    classes = np.zeros(sizes.classes)
    np.add.at(classes, cls, n_head)
    classes[sizes.frequent:] += in_bucket.reshape(sizes.endings, -1).sum(axis=1)
    log_share = lambda n, of: np.log(np.maximum(n, 1) / np.maximum(of, 1)).astype("f4")
    drop(by_word)
    return Counts(sizes, tokens, head, log_share(n_head, classes[cls]),
                  log_share(in_bucket, np.repeat(classes[sizes.frequent:], sizes.buckets)), classes)


def tokenized(docs: DataFrame, counts: Counts) -> DataFrame:
    """``docs`` (row, id, text) as row, id, n, classes (of the tokens), share (the sum of log
    p(word | class)) and rare: key1 (class and neighbours' classes), key2 (the same with the
    word) and share of each rare word."""
    # of bounded size; plain values, as a broadcast class would have to be installed on executors
    given = docs.sparkSession.sparkContext.broadcast((counts.head, counts.head_share, counts.bucket_share))
    sizes = counts.sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_share, bucket_share = given.value
        head, pad = pa.array(head, pa.string()), sizes.classes
        head_cls = sizes.others(head)[0]
        head_cls[:sizes.frequent] = np.arange(min(sizes.frequent, len(head)))
        for batch in (x for whole in batches for x in pieces(whole)):
            found, n = split(batch.column("text"))
            coded = found.dictionary_encode()  # what follows is looked up once for each different word
            at = coded.indices.to_numpy()
            known = pc.fill_null(pc.index_in(coded.dictionary.cast(pa.string()), value_set=head), -1).to_numpy()
            is_rare = known < 0
            endings, buckets, hashes = sizes.others(coded.dictionary.filter(pa.array(is_rare)))
            cls_of, share_of, hash_of = np.empty(len(known), np.int64), np.empty(len(known), np.float32), np.zeros(len(known), np.uint64)
            cls_of[~is_rare], share_of[~is_rare] = head_cls[known[~is_rare]], head_share[known[~is_rare]]
            cls_of[is_rare], share_of[is_rare], hash_of[is_rare] = endings, bucket_share[buckets], hashes
            cls, row = cls_of[at], np.repeat(np.arange(len(n)), n)
            line = np.full(len(cls) + len(n) + 1, pad, np.uint64)
            line[np.arange(len(cls)) + row + 1] = cls
            rare = np.flatnonzero(is_rare[at])
            place, own = rare + row[rare], at[rare]
            key1 = mixed(mixed(mixed(line[place]) * _ODD[1] + line[place + 1]) * _ODD[2] + line[place + 2])
            table = np.empty(len(place), dtype=[("key1", "<u8"), ("key2", "<u8"), ("share", "<f4")])
            table["key1"], table["key2"], table["share"] = key1, mixed(key1 + mixed(hash_of[own])), share_of[own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(n, pa.int64()), bytes_of(cls.astype("<i4" if pad > 0xFFFF else "<u2"), n),
                 pa.array(np.bincount(row, share_of[at], len(n)), pa.float64()), bytes_of(table, np.bincount(row[rare], minlength=len(n)))],
                names=["row", "id", "n", "classes", "share", "rare"])

    return docs.mapInArrow(run, "row long, id long, n long, classes binary, share double, rare binary")


def _chunks(batch: pa.RecordBatch, pad: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(rows, their classes) of a batch, about CHUNK tokens at a time; rows without tokens too."""
    kind = "<i4" if pad > 0xFFFF else "<u2"
    rows, texts, held = [], [], 0
    for k, raw in enumerate(batch.column("classes").to_pylist()):
        rows.append(k)
        texts.append(np.frombuffer(raw, kind).astype(np.int32))
        held += len(texts[-1])
        if held >= CHUNK:
            yield rows, texts
            rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def trained(lines: DataFrame, counts: Counts, rounds: int) -> Network:
    """The network after ``rounds`` passes over all of ``lines``."""
    n, network = counts.sizes.side, Network.start(counts.classes)
    pad, spark = counts.sizes.classes, lines.sparkSession

    def work(raw, rate: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net = Network.load(raw.value, n)
            sums, worker, seen, steps = [np.zeros_like(p) for p in net.parts()], TaskContext.get().partitionId(), 0, 0
            for batch in batches:
                for _, texts in _chunks(batch, pad):
                    around, own = contexts(texts, pad)
                    order = np.random.default_rng(worker + seen).permutation(len(own))
                    at = 0
                    while at < len(order):
                        some = order[at:at + min(LARGEST, BATCH << steps // DOUBLED)]
                        net.learn(around[some], own[some], sums, rate)
                        at, steps = at + len(some), steps + 1
                    seen += len(own)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([worker], pa.int64()), pa.array([seen], pa.int64()),
                                                  pa.array([net.dump()], pa.binary())], names=["worker", "n", "weights"])
        return run

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(frame["weights"].iloc[0]) // 4)
        for w, k in zip(frame["weights"], frame["n"]):
            total += np.frombuffer(w, "<f4").astype("f8") * (k / frame["n"].sum())
        return pd.DataFrame({"worker": [frame["worker"].min()], "n": [frame["n"].sum()], "weights": [total.astype("<f4").tobytes()]})

    types = "worker long, n long, weights binary"
    for k in range(rounds if counts.tokens else 0):
        raw = spark.sparkContext.broadcast(network.dump())
        weights = stored(lines.select("classes").mapInArrow(work(raw, RATE / (1 + k)), types), "lm_weights")
        sets = weights.count()
        while sets > FAN:
            sets = -(-sets // FAN)
            weights = weights.groupBy(F.pmod(F.xxhash64("worker"), F.lit(sets))).applyInPandas(mean, types)
        network = Network.load(mean(weights.toPandas())["weights"][0], n)  # FAN rows at most
    return network


def remembered(lines: DataFrame) -> DataFrame:
    """row and gain: what the memory adds to the log-likelihood of the rows that have rare words
    in places that occur again."""
    place = F.pmod(F.col("key1"), F.lit(BITS)) + 1  # bitmaps count from 1

    kind = [("key1", "<i8"), ("key2", "<i8"), ("share", "<f4")]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.frombuffer(b"".join(batch.column("rare").to_pylist()), kind)
            yield pa.RecordBatch.from_arrays([pa.array(table["key1"].copy())], names=["key1"])

    def rare(only: bytes):
        sent = lines.sparkSession.sparkContext.broadcast(only)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            marks = np.frombuffer(sent.value, np.uint8)
            for batch in batches:
                raws = batch.column("rare").to_pylist()
                table = np.frombuffer(b"".join(raws), kind)
                at = np.mod(table["key1"], BITS)
                hit = np.flatnonzero((marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                rows = np.repeat(batch.column("row").to_numpy(), [len(r) // 20 for r in raws])[hit]
                yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(table[k][hit]) for k, _ in kind)],
                                                 names=["row", "key1", "key2", "share"])

        return lines.select("row", "rare").mapInArrow(run, "row long, key1 long, key2 long, share float")

    again = lines.select("rare").mapInArrow(keys, "key1 long").groupBy("key1").agg(F.count("*").alias("n")).where("n > 1")
    bits = np.zeros(BITS // 8, np.uint8)
    for bucket, some in (again.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
                         .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()):  # BITS bits at most
        at = (bucket - 1) * 4096
        bits[at:at + len(some)] = np.frombuffer(bytes(some), np.uint8)
    met = stored(rare(bits.tobytes()), "lm_places")
    # a place's different words: their occurrences are counted already, so this is never a hot group of rows
    words_of = Window.partitionBy("key1")
    known = (met.groupBy("key1", "key2").agg(F.count("*").alias("n2"))
             .withColumn("n1", F.sum("n2").over(words_of)).withColumn("kinds", F.count("*").over(words_of)).where("n1 > 1"))
    known = stored(known, "lm_words")
    found = join_groups(met, known.withColumn("size", F.col("n2")), ["key1", "key2"], "size", met.count())
    share = F.exp("share")
    gain = F.log((F.col("n2") - 1 + F.col("kinds") * share) / (F.col("n1") - 1 + F.col("kinds"))) - F.col("share")
    return found.groupBy("row").agg(F.sum(gain).alias("gain"))


def scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per row: the id, n_tokens, log_likelihood (natural log, summed over all tokens) and
    mean_log_prob.

    Words are lower-cased. A null text or one without words has no tokens and zero for both.
    Repeated rows stay and count in the corpus each; equal texts have equal scores (up to the
    rounding of 32-bit numbers). Other columns are ignored; an empty table gives an empty result.
    """
    counts = counted(docs, text_col)
    lean = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), lowered(text_col))
    lines = stored(tokenized(lean, counts), "lm_tokens")
    network = trained(lines, counts, rounds).dump()
    side_, pad = counts.sizes.side, counts.sizes.classes
    given = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.load(given.value, side_)
        for batch in batches:
            total = batch.column("share").to_numpy().copy()
            for rows, texts in _chunks(batch, pad):
                around, own = contexts(texts, pad)
                some = np.array([len(t) for t in texts])
                if len(own):
                    starts = (np.cumsum(some) - some)[some > 0]
                    total[np.array(rows)[some > 0]] += np.add.reduceat(net.log_probabilities(around, own), starts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("n"), pa.array(total)],
                                             names=["row", "id", "n_tokens", "base"])

    base = lines.select("row", "id", "n", "classes", "share").mapInArrow(run, "row long, id long, n_tokens long, base double")
    gains = remembered(lines).withColumnRenamed("row", "gain_row")
    return (base.join(gains, F.col("row") == F.col("gain_row"), "left")
            .withColumn("log_likelihood", F.col("base") + F.coalesce("gain", F.lit(0.0)))
            .select(F.col("id").alias(id_col), "n_tokens", "log_likelihood",
                    (F.col("log_likelihood") / F.greatest("n_tokens", F.lit(1))).alias("mean_log_prob")))
