"""N-gram Jaccard join: a count-vector R-tree over hashed shingles.

A text is the set of its k-word shingles. Shingles are hashed into groups, and a text becomes
the point of its group counts; two texts can share at most the sum over the groups of the
smaller count. With a similarity of at least t, sets of sizes m and n share at least
t/(1+t) (m+n) shingles, so a box of points whose coordinate maxima do not give a query that
much is passed over whole, and so is a point.

The tree's upper levels are keys, so that descending them is an equi-join that Spark can
deal out. Level one is the size class (sizes within a factor 1.5; a text also looks into the
larger classes that its matches can be in). In a class whose sets differ in at most D
elements, the groups are dealt into D+1+s blocks: at least s+1 blocks of a matching pair are
equal, and of those the largest is among the D+1 largest blocks of either text. So level two
is the block, and level three the point's coordinates in that block (as a hash of its
members, the finest grouping). Texts that meet in such a cell are candidates; none is missed.

Shingles that very many texts have (told from a sample, as a bitmap of fixed size) carry no
weight in this: their blocks are keys only where two texts have nothing else in common.

Cells are joined without pairing all their members: each member meets its cell's least id,
and the components of these meetings are families that hold every link. A family of bounded
size is one group: its points are packed into leaves with boxes, leaves whose boxes pass the
bound are compared point by point, and what passes again is verified on the shingles, unless
the two are connected already. A larger family (copies that are a third of all rows, say) is
never gathered: every member meets the member that it shares most cells with, verified links
give components, and only cells in which different components are left go on, as joins of
members with leaves and of leaves with their members. No link between different texts is
lost. Hashes are 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import drop, stored
from .components import components
from .shingles import Shingler, mixed

K, PERCENT = 4, 85
GROUPS = 256  # coordinates of a point in the bound
FAMILY_TEXTS, FAMILY_HASHES = 20_000, 16_000_000  # of a family that is handled as one group: 128 MB
SPREAD = 1.5  # sizes of a class
SEEN = 200_000  # sets that a task remembers, to find copies early
HOT, SAMPLE = 65_536, 64  # rows of a cell from which it is salted; one text in SAMPLE tells
HOT_CELLS, SALTS = 1 << 16, 64  # cells handled apart, at most; parts of each
ROUNDS = 6  # of dealing groups into blocks
COMMON = 3  # texts of the sample that have a shingle, from which it is common
CELL, TEXT, COPY, ALONE = range(4)  # kinds of rows
_ROUND = np.uint64(0xD1B54A32D192ED03)
BITS = 1 << 25  # of the filter for texts that are candidates: 4 MB at any size of input
LEAF = 64  # members of a leaf, about


class Cells:
    """Cell keys of a set of hashes. ``percent`` is the least similarity in hundredths.

    Shingles that very many texts have (``common``, a bitmap by the hash's low bits; a pair
    agrees on it, so what it holds changes no result) do not count in a block's size: a block
    of a passage that stands everywhere is no sign of likeness. A matching pair may have
    nothing but such blocks, or empty ones, in common. Then each of the two has more of them
    than the spare ones, and both deal their groups out anew, up to ROUNDS; in the last round
    these blocks are keys too.
    """

    def __init__(self, percent: int, common: np.ndarray | None = None):
        self.percent, self.common = percent, common
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * SPREAD)))
        self.edges: dict[int, tuple] = {}

    def _class(self, c: int) -> tuple:
        if c not in self.edges:
            largest = self.starts[c + 1] - 1
            differ = (100 - self.percent) * 2 * largest // (100 + self.percent)
            spare = (differ + 1) // 8
            m = differ + 1 + spare
            bounds = np.array([(k << 64) // m for k in range(1, m)], dtype=np.uint64)
            self.edges[c] = (m, spare, bounds)
        return self.edges[c]

    def of(self, h: np.ndarray) -> np.ndarray:
        n = len(h)
        c = int(np.searchsorted(self.starts, n, side="right")) - 1
        out = []
        dealt = [(h, self._sums(h), self._rare(h))]
        while c < len(self.starts) - 1 and n * 100 >= self.percent * self.starts[c] or not out:
            m, spare, bounds = self._class(c)
            for r in range(ROUNDS):
                if r == len(dealt):
                    again = mixed(h ^ mixed(np.array([r], np.uint64) + _ROUND))
                    order = np.argsort(again)
                    again = again[order]
                    rare = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.diff(dealt[0][2])[order])])
                    dealt.append((again, self._sums(again), rare))
                own, sums, rare = dealt[r]
                at = np.concatenate([[0], np.searchsorted(own, bounds), [n]])
                size, weight = np.diff(at), np.diff(rare[at])
                kept = np.argpartition(weight * m + np.arange(m), spare)[spare:] if spare else np.arange(m)
                last = int((weight == 0).sum()) <= spare or r == ROUNDS - 1
                if r < ROUNDS - 1:
                    kept = kept[weight[kept] > 0]
                low, high = at[kept], at[kept + 1]
                where = (np.uint64(r) << np.uint64(56)) + (np.uint64(c) << np.uint64(40)) + kept.astype(np.uint64)
                out.append(mixed(mixed(sums[high] - sums[low] + size[kept].astype(np.uint64)) + mixed(where + np.uint64(1))))
                if last:
                    break
            c += 1
        return np.concatenate(out).view(np.int64)

    def _rare(self, h: np.ndarray) -> np.ndarray:
        """How many shingles before each place are not common."""
        rare = np.ones(len(h), np.int64)
        if self.common is not None:
            at = h & np.uint64(len(self.common) * 8 - 1)
            rare = 1 - ((self.common[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(np.int64)
        return np.concatenate([np.zeros(1, np.int64), np.cumsum(rare)])

    @staticmethod
    def _sums(h: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h), dtype=np.uint64)])


def common_shingles(docs: DataFrame, k: int) -> bytes:
    """The bitmap of the shingles that COMMON texts or more of a sample have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            places = [shingler.of(t) & np.uint64(BITS - 1) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(places).astype(np.int64) if places else np.empty(0, np.int64))],
                                             names=["place"])

    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    places = sample.mapInArrow(run, "place long").groupBy("place").count().where(f"count >= {COMMON}").select((F.col("place") + 1).alias("p"))
    return _bitmap(places).tobytes()


def _bitmap(places: DataFrame) -> np.ndarray:
    """The bits at the places ``p`` (from 1 to BITS), merged before they reach the driver."""
    bitmap = np.zeros(BITS // 8, dtype=np.uint8)
    rows = (places.groupBy(F.bitmap_bucket_number("p").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())  # BITS bits at most
    for bucket, bits in rows:
        at = (bucket - 1) * 4096
        bitmap[at:at + len(bits)] |= np.frombuffer(bytes(bits), np.uint8)
    return bitmap


def described(docs: DataFrame, k: int, percent: int, common: bytes, hot: np.ndarray | None = None) -> DataFrame:
    """cell, salt, id, n and kind: the cells of every text (kind CELL), and one row of its own
    (kind TEXT, COPY or ALONE) whose cell is a hash of its whole set. ``docs`` has id and text.

    A copy of an earlier text of the task (COPY) and a text without words or id (ALONE, in a
    cell by itself) have no cells. Rows of the cells in ``hot`` (ascending) are salted.
    """
    known = docs.sparkSession.sparkContext.broadcast(np.empty(0, np.int64) if hot is None else hot)
    frequent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, keys, seen = Shingler(k), Cells(percent, np.frombuffer(frequent.value, np.uint8)), set()
        for batch in batches:
            ids = batch.column("id")
            found, ns, kinds = [], [], []
            for place, (i, text) in enumerate(zip(ids.to_pylist(), batch.column("text").to_pylist())):
                h = shingler.of(text)
                ns.append(len(h))
                if i is None or not len(h):
                    found.append(mixed(np.array([place], np.uint64) + np.uint64(hash(i) & 0xFFFFFFFF)).view(np.int64))
                    kinds.append(ALONE)
                    continue
                digest = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
                own = np.frombuffer(digest[:8], np.int64)
                if digest in seen:
                    found.append(own)
                    kinds.append(COPY)
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(digest)
                found.append(np.concatenate([own, keys.of(h)]))
                kinds.append(TEXT)
            if not found:
                continue
            each = np.array([*map(len, found)])
            cell, first = np.concatenate(found), np.cumsum(each) - each
            kind = np.full(len(cell), CELL, np.int32)
            kind[first] = kinds
            n = np.zeros(len(cell), np.int64)
            n[first] = ns
            ids = ids.take(pa.array(np.repeat(np.arange(len(each)), each)))
            salt = np.zeros(len(cell), np.int32)
            if len(known.value):
                at = np.searchsorted(known.value, cell)
                at[at == len(known.value)] = 0
                met = (known.value[at] == cell) & (kind != ALONE)
                dealt = mixed(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)) % np.uint64(SALTS)
                salt[met] = 1 + dealt[met].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(salt), ids, pa.array(n), pa.array(kind)],
                                             names=["cell", "salt", "id", "n", "kind"])

    return docs.mapInArrow(run, "cell long, salt int, id long, n long, kind int")


def hot_cells(docs: DataFrame, k: int, percent: int, common: bytes) -> np.ndarray:
    """The cells of many texts, told from a sample of the texts; less than HOT_CELLS."""
    cells = described(docs.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0), k, percent, common).groupBy("cell").count()
    counted = stored(cells.where(f"count >= {max(2, HOT // SAMPLE)}"), "hot_cells")
    least = counted.orderBy(F.desc("count")).select("count").offset(HOT_CELLS).first()
    if least:
        counted = counted.where(F.col("count") > least[0])
    return np.sort(np.array([r.cell for r in counted.select("cell").collect()], np.int64))


def shared_cells(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """cell, salt, id, n, kind and hub: the members of every cell with two ids or more, with
    the least id of the cell (of its salt), and the rows of all texts; ``own`` is the least id
    of a text's set that has cells."""
    cell, common = Window.partitionBy("cell", "salt"), common_shingles(docs, k)
    return (described(docs, k, percent, common, hot_cells(docs, k, percent, common))
            .withColumn("hub", F.min("id").over(cell)).withColumn("last", F.max("id").over(cell))
            .withColumn("own", F.min(F.when(F.col("kind") == TEXT, F.col("id"))).over(cell))
            .where(f"kind != {CELL} or hub != last or salt > 0").drop("last"))


def sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id and hashes of the texts whose id is in ``ids`` (and of a few others: a filter of
    BITS bits stands for the ids, so that no text has to be shuffled)."""
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64("id"), F.lit(BITS)) + 1
    bitmap = _bitmap(ids.select(place.alias("p")))
    wanted = spark.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bits = Shingler(k), np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            p = batch.column("p").to_numpy(zero_copy_only=False)
            hit = np.flatnonzero((bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1)
            some = batch.take(pa.array(hit))
            hashes = [shingler.of(t).tobytes() for t in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(hashes, pa.binary())], names=["id", "hashes"])

    lean = docs.where("id is not null").select("id", (place - 1).alias("p"), "text")
    return lean.mapInArrow(run, "id long, hashes binary")


def point(h: np.ndarray) -> np.ndarray:
    """The group counts of a set."""
    return np.bincount((h & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS).astype(np.uint32)


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def tree_links(ids: list[int], hashes: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(least id, id) of every member of a family that links reach, by an R-tree self-join."""
    order = sorted(range(len(ids)), key=lambda i: (len(hashes[i]), ids[i]))
    sets, sizes = [hashes[i] for i in order], np.array([len(hashes[i]) for i in order])
    points = np.stack([point(h) for h in sets])
    points = points.astype(np.min_scalar_type(int(points.max(initial=0))))
    starts = range(0, len(sets), LEAF)
    boxes = np.stack([points[s:s + LEAF].max(axis=0) for s in starts])
    root = np.arange(len(sets))
    # sorted by size, a leaf's partners are the leaves up to the largest size that can match
    reach = np.searchsorted(sizes * percent, 100 * sizes, side="right")

    def enough(left, right, m, n):
        most = np.minimum(left[:, None, :], right[None, :, :]).sum(axis=2, dtype=np.int64)
        return (100 + percent) * most >= percent * (m[:, None] + n[None, :])

    for k, s in enumerate(starts):
        e = min(s + LEAF, len(sets))
        last = -(-int(reach[e - 1]) // LEAF)
        low = sizes[[j * LEAF for j in range(k, last)]]  # the least size in each leaf
        passed = enough(boxes[k:k + 1], boxes[k:last], sizes[s:s + 1], low)[0]
        for j in (np.flatnonzero(passed) + k).tolist():
            a, b = j * LEAF, min(j * LEAF + LEAF, len(sets))
            near = enough(points[s:e], points[a:b], sizes[s:e], sizes[a:b])
            near &= root[s:e, None] != root[None, a:b]
            for x, y in np.argwhere(near).tolist():
                x, y = x + s, y + a
                if x < y and root[x] != root[y] and alike(sets[x], sets[y], percent):
                    root[root == root[y]] = root[x]
    least: dict[int, int] = {}
    for i, r in zip(order, root.tolist()):
        least[r] = min(least.get(r, ids[i]), ids[i])
    return [(least[r], ids[i]) for i, r in zip(order, root.tolist()) if least[r] != ids[i]]


def family_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is linked in each family; ``members`` has family, id
    and hashes."""

    def run(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(h.as_buffer(), np.uint64) for h in table["hashes"]]  # views
        found = tree_links(table["id"].to_pylist(), hashes, percent)
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.select("family", "id", "hashes").groupBy("family").applyInArrow(run, "a long, b long")


def verified(pairs: DataFrame, hashes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    b = hashes.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    a = hashes.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def with_points(hashes: DataFrame) -> DataFrame:
    """id, n and vector (the point as little-endian 32-bit counts) of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(h, np.uint64) for h in batch.column("hashes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([*map(len, found)], pa.int64()),
                 pa.array([point(h).astype("<u4").tobytes() for h in found], pa.binary())], names=["id", "n", "vector"])

    return hashes.select("id", "hashes").mapInArrow(run, "id long, n long, vector binary")


def _bounded(percent: int, left: str, right: str, m: str, n: str, out: list[str], schema: str, df: DataFrame) -> DataFrame:
    """Rows whose summed coordinate minima of vectors ``left`` and ``right`` can reach the
    overlap that sizes ``m`` and ``n`` (the least possible) call for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, GROUPS) for c in (left, right))
                most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                sizes = sum(batch.column(c).to_numpy(zero_copy_only=False) for c in (m, n))
                batch = batch.filter(pa.array((100 + percent) * most >= percent * sizes))
            yield batch.select(out)

    return df.mapInArrow(run, schema)


def crossing(cells: DataFrame, points: DataFrame, group: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a cell and pass the bound.
    ``group``: id, component of the ids that have links so far."""
    members = (cells.select("cell", "id").distinct().join(group, "id", "left")
               .withColumn("component", F.coalesce("component", "id")))
    mixed_cells = (members.groupBy("cell")
                   .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"),
                        F.expr("bit_xor(xxhash64(id))").alias("x"), F.expr("bit_xor(xxhash64(id, 1))").alias("y"))
                   .where("low != high").groupBy("size", "x", "y").agg(F.min("cell").alias("cell")))  # equal cells once
    members = stored(members.join(mixed_cells.select("cell", "size"), "cell").join(points, "id")
                     .withColumn("leaf", F.xxhash64(F.floor(F.log("n") / F.lit(0.02)),
                                                    F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / LEAF)))), "crossing")

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by leaf; one box is open at a time."""
        key, low, high, top = None, 0, 0, None
        def row(rows):
            columns = [*zip(*rows)] or [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 5, pa.binary()))],
                names=["cell", "component", "leaf", "low", "high", "box"])
        for batch in batches:
            rows = []
            for *own, n, vector in zip(*(batch.column(c).to_pylist() for c in ("cell", "component", "leaf", "n", "vector"))):
                vector = np.frombuffer(vector, "<u4")
                if own != key:
                    if key:
                        rows.append((*key, low, high, top.tobytes()))
                    key, low, high, top = own, n, n, vector
                else:
                    low, high, top = min(low, n), max(high, n), np.maximum(top, vector)
            yield row(rows)
        if key:
            yield row([(*key, low, high, top.tobytes())])

    leaves = (members.repartition("cell", "component", "leaf").sortWithinPartitions("cell", "component", "leaf")
              .select("cell", "component", "leaf", "n", "vector")
              .mapInArrow(box, "cell long, component long, leaf long, low long, high long, box binary"))
    queries = members.select("cell", F.col("component").alias("own"), F.col("id").alias("a"), F.col("n").alias("m"),
                             F.col("vector").alias("query"))
    descended = _bounded(percent, "query", "box", "m", "low", ["cell", "component", "leaf", "a", "m", "query"],
                         "cell long, component long, leaf long, a long, m long, query binary",
                         queries.join(leaves, "cell").where(
                             f"own < component and 100 * high >= {percent} * m and 100 * m >= {percent} * low")
                         .select("cell", "component", "leaf", "a", "m", "query", "low", "box"))
    met = (descended.join(members.select("cell", "component", "leaf", F.col("id").alias("b"), "n", "vector"),
                          ["cell", "component", "leaf"])
           .where(f"100 * n >= {percent} * m and 100 * m >= {percent} * n").select("a", "b", "m", "n", "query", "vector"))
    return _bounded(percent, "query", "vector", "m", "n", ["a", "b"], "a long, b long", met).distinct()


def large_family_links(cells: DataFrame, hashes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the texts of ``cells``, without gathering a family."""
    nearest = (cells.where("id != hub").groupBy("id", "hub").agg(F.count("*").alias("shared"))
               .groupBy("id").agg(F.max(F.struct("shared", (-F.col("hub")).alias("minus"))).alias("best"))
               .select((-F.col("best.minus")).alias("a"), F.col("id").alias("b")))
    links = stored(verified(nearest, hashes, percent), "near_links")
    group = stored(components(links), "near_components")
    return links.unionByName(verified(crossing(cells, with_points(hashes), group, percent), hashes, percent))


def similar(docs: DataFrame, *, k: int = K, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_shingles and component_id, the least id that links reach (the own
    id without any).

    Two texts link when 100 * intersection >= ``percent`` * union of their ``k``-word
    shingle sets. A null text has the empty set, which links with nothing. Rows with equal
    ids are one node, each row stays; a null id has no component and links with nothing.
    Other columns are ignored; an empty table gives an empty result.
    """
    lean = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    members = stored(shared_cells(lean, k, percent), "shared_cells")
    texts = members.where(f"kind != {CELL}").select("id", "n")
    # the salts of a hot cell meet at their least ids
    salts = (members.where("salt > 0").groupBy("cell", "salt").agg(F.min("hub").alias("id"), (F.min("kind") != CELL).alias("whole"))
             .withColumn("hub", F.min("id").over(Window.partitionBy("cell"))).where("id != hub"))  # SALTS rows a cell at most
    cells = members.where(f"kind = {CELL}").select("cell", "id", "hub")
    meetings = cells.where("id != hub").select("hub", "id").unionByName(salts.where("not whole").select("hub", "id"))
    copies = (members.where(f"kind in ({TEXT}, {COPY}) and id != hub").select("hub", "id")
              .unionByName(salts.where("whole").select("hub", "id")))
    family = components(meetings.select(F.col("hub").alias("a"), F.col("id").alias("b"))).withColumnRenamed("component", "family")
    # one text of equal ones is compared with others
    again = members.where(f"kind = {TEXT} and id != own").select("id").distinct()
    family = stored(family.join(again, "id", "left_anti"), "families")
    size = (texts.join(family, "id").groupBy("family").agg(F.count("*").alias("texts"), F.sum("n").alias("hashes")))
    large = stored(size.where((F.col("texts") > FAMILY_TEXTS) | (F.col("hashes") > FAMILY_HASHES)).select("family"), "large_families")
    # always a shuffle of the sets, as at scale the ids are too many to broadcast
    hashes = sets(lean, family.select("id"), k).join(family.hint("merge"), "id")
    links = family_links(hashes.join(large, "family", "left_anti"), percent).unionByName(
        copies.select(F.col("hub").alias("a"), F.col("id").alias("b")))
    if not large.isEmpty():
        of_large = stored(hashes.join(large, "family", "left_semi"), "shingle_sets")
        links = links.unionByName(large_family_links(cells.join(of_large.select("id").distinct(), "id", "left_semi")
                                                     .select("cell", "id", "hub"), of_large, percent))
    group = stored(components(links), "near_components")
    return (texts.join(group, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))
