"""Merkle dataset manifest: a content-addressed DAG, and proofs by descending it.

Every row is a leaf, the hash of its fields. Per key (a language, say) the leaves are ordered
and united level by level, ``ARITY`` neighbours at a time, until one node is left, the key's
subroot; the subroots are united likewise to the root. The manifest stores what a digest
stands for: records of digest to children, packed by subtree of ``LEVELS`` levels, each pack
under the digest of its top. Equal subtrees are stored once.

A leaf is requested by its rank. The descent starts at the root: the digits of the rank (base
``ARITY``) select a child at every level, and the unselected children are collected. It goes
one layer of packs at a time: all requests that pass through a node share the way to it, so
a layer's requests are the distinct tops of the next one, looked up by digest. The segments
of a path come top down and are reversed at the end, which gives the siblings from the leaf up.

Ranks come from one range-partitioned sort of lean rows (ids and digests, no texts): the place
inside a written partition plus the rows of the partitions before it. A pack has at most
``ARITY ** LEVELS`` nodes, so no task holds more of a key than that, however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hot_groups import join_groups

ARITY, LEVELS = 2, 10
SORTED_ROWS = 1 << 20  # rows of a sorted partition, about
SIZE = 32  # bytes of a digest
_RECORDS = "array<struct<digest binary, children array<binary>>>"


def leaf_digest(fields: list[Column]) -> Column:
    """The hash of a row's fields: `-` for a null, else its UTF-8 byte count, `:` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                                     for t in texts]), 256))


def united(children: list[bytes]) -> bytes:
    return sha256(b"".join(children).hex().encode()).digest()


def fold(digest: bytes, digits: list[int], others: list[bytes]) -> bytes:
    """The root that a leaf's digest and its path (from the leaf up) lead to."""
    for digit, rest in zip(digits, others):
        at = SIZE * digit
        digest = united([rest[:at], digest, rest[at:]])
    return digest


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``position``, their place from 0 in ``order`` (nulls first); rows alike
    in it are placed in any order, also over several partitions."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SORTED_ROWS))
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = stored(tied.repartitionByRange(n, *order, "tie").sortWithinPartitions(*order, "tie").drop("tie")
                    .withColumn("place", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("place", 33)
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count("*")).collect())  # one row a partition
    starts = accumulate((c for _, c in counts), initial=0)
    before = spark.createDataFrame([(p, s) for (p, _), s in zip(counts, starts)], "part long, start long")
    return (placed.join(F.broadcast(before), part == F.col("part"))
            .withColumn("position", F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("place", "part", "start"))


@dataclass
class Manifest:
    """leaves: what was given, with tree (of its key) and rank; trees: tree, size (leaves),
    its place among the trees and its subroot; packs: by layer (from the leaves up) digest,
    height and records; top: the packs of the tree of subroots; root: its digest, None
    without any leaf."""

    leaves: DataFrame
    trees: DataFrame
    packs: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None
    arity: int
    levels: int


def packed(nodes: DataFrame, size: int, arity: int, levels: int) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, digest of its last node; the packs by layer). ``nodes`` has tree, size (nodes
    of the tree), rank and digest; ``size`` is the largest of the sizes."""
    block = arity ** levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, heights, records = [], [], []
            for whole, members in zip(batch.column("size").to_pylist(), batch.column("members").to_pylist()):
                level, height, found = [m["digest"] for m in members], 0, []
                while len(level) > 1 if whole <= block else height < levels:
                    runs = [level[k:k + arity] for k in range(0, len(level), arity)]
                    level = [united(r) for r in runs]
                    found += [{"digest": d, "children": r} for d, r in zip(level, runs)]
                    height += 1
                tops.append(level[0])
                heights.append(height)
                records.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("size"), batch.column("block"), pa.array(tops, pa.binary()),
                 pa.array(heights, pa.int32()),
                 pa.array(records, pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])))],
                names=["tree", "size", "rank", "digest", "height", "records"])

    done, layers = nodes.where("size = 1").select("tree", "digest"), []
    while size > 1:
        groups = (nodes.where("size > 1").groupBy("tree", "size", F.expr(f"rank div {block}").alias("block"))
                  .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("members")))
        layer = stored(groups.mapInArrow(run, f"tree long, size long, rank long, digest binary, height int, records {_RECORDS}"),
                       "merkle_packs")
        nodes = layer.select("tree", F.expr(f"(size + {block - 1}) div {block}").alias("size"), "rank", "digest")
        done = done.unionByName(nodes.where("size = 1").select("tree", "digest"))
        layers.append(layer)
        size = -(-size // block)
    return done, layers


def manifest(rows: DataFrame, key: str, order: list[str], arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """The manifest of ``rows``, which have ``key``, the columns of ``order`` and ``digest``."""
    spark = rows.sparkSession
    placed = ranked(rows, [key, *order, "digest"])
    trees = stored(placed.groupBy(key).agg(F.min("position").alias("tree"), F.count("*").alias("size")), "merkle_trees")
    n, largest = trees.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    leaves = stored(join_groups(placed, trees, [key], "size", n)
                    .withColumn("rank", F.col("position") - F.col("tree")).drop("position"), "merkle_leaves")
    subroots, packs = packed(leaves.select("tree", "size", "rank", "digest"), largest, arity, levels)
    order_of_trees = ranked(subroots.select("tree", F.col("digest").alias("subroot")), ["tree"])
    known = stored(order_of_trees.join(trees, "tree").withColumnRenamed("position", "place")
                   .withColumn("forest", F.lit(0).cast("long")), "merkle_subroots")  # the key of the tree of subroots
    n_trees = known.count()
    last, top = packed(known.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("size"),
                                    F.col("place").alias("rank"), F.col("subroot").alias("digest")), n_trees, arity, levels)
    root = last.first()
    return Manifest(leaves.drop("size"), known, packs, top, bytes(root.digest) if root else None, arity, levels)


def descended(starts: DataFrame, wanted: DataFrame, packs: list[DataFrame], arity: int, levels: int) -> DataFrame:
    """tree, rank, digest, digits and others (top down) of every node in ``wanted`` (tree,
    rank). ``starts`` has per tree its size, the digest of its top and the path to it."""
    block = arity ** levels
    out = ["tree", "rank", "digest", "digits", "others"]
    types = "tree long, rank long, digest binary, digits array<int>, others array<binary>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                children = {r["digest"]: r["children"] for r in row["records"]}
                found = []
                for place in row["places"]:
                    digest, digits, others = row["digest"], [*row["digits"]], [*row["others"]]
                    for k in range(row["height"] - 1, -1, -1):
                        digit, kids = place // arity ** k % arity, children[digest]
                        digits.append(digit)
                        others.append(b"".join(kids[:digit] + kids[digit + 1:]))
                        digest = kids[digit]
                    found.append((row["tree"], row["block"] * block + place, digest, digits, others))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()),
                                                                  pa.list_(pa.binary())))], names=out)

    carried = None
    for k in range(len(packs) - 1, -1, -1):
        enters = F.col("size") > block ** k
        if k < len(packs) - 1:
            enters = enters & (F.col("size") <= block ** (k + 1))
        here = starts.where(enters).select("tree", F.lit(0).cast("long").alias("block"), "digest", "digits", "others")
        if carried is not None:
            here = here.unionByName(carried.withColumnRenamed("rank", "block"))
        need = (wanted.groupBy("tree", F.expr(f"rank div {block ** (k + 1)}").alias("block"))
                .agg(F.collect_set(F.expr(f"rank div {block ** k} % {block}")).alias("places")))  # a block's at most
        store = packs[k].select("digest", "height", "records").dropDuplicates(["digest"])
        carried = here.join(need, ["tree", "block"]).join(store, "digest").mapInArrow(run, types)
    alone = starts.where("size = 1").join(wanted.where("rank = 0"), "tree", "left_semi").select(
        "tree", F.lit(0).cast("long").alias("rank"), "digest", "digits", "others")
    return alone if carried is None else alone.unionByName(carried)


def proofs(known: Manifest, wanted: DataFrame) -> DataFrame:
    """Per leaf in ``wanted`` (tree, rank; each once): digest, digits (its place among its
    parent's children) and others (their digests, left to right, in one), from the leaf up to
    the root."""
    none = [F.array().cast("array<int>").alias("digits"), F.array().cast("array<binary>").alias("others")]
    trees = known.trees
    begin = trees.limit(1).select(F.col("forest").alias("tree"), F.lit(trees.count()).cast("long").alias("size"),
                                  F.lit(known.root).cast("binary").alias("digest"), *none)
    asked = trees.join(wanted.select("tree").distinct(), "tree", "left_semi").select(
        F.col("forest").alias("tree"), F.col("place").alias("rank"))
    to_trees = descended(begin, asked, known.top, known.arity, known.levels)
    starts = stored(to_trees.drop("tree").join(trees.select(F.col("place").alias("rank"), "tree", "size"), "rank").drop("rank"),
                    "merkle_starts")
    found = descended(starts, wanted, known.packs, known.arity, known.levels)
    return found.withColumns({"digits": F.reverse("digits"), "others": F.reverse("others")})


def folded(paths: DataFrame, claims: list[str]) -> DataFrame:
    """``paths`` (with digits and others) with proof (the hash of all others, from the leaf
    up) and, for each digest column in ``claims``, the root that it leads to as <name>_root."""
    out = [*[c for c in paths.columns if c not in ("digits", "others")]]
    types = {c: paths.schema[c].dataType.simpleString() for c in out}
    types |= {"proof": "binary"} | {f"{c}_root": "binary" for c in claims}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digits, others = batch.column("digits").to_pylist(), batch.column("others").to_pylist()
            added = [pa.array([united(o) for o in others], pa.binary())]
            for c in claims:
                added.append(pa.array([None if x is None else fold(x, d, o)
                                       for x, d, o in zip(batch.column(c).to_pylist(), digits, others)], pa.binary()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in out], *added], names=[*types])

    return paths.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in types.items()))


def checked(docs: DataFrame, tampered: dict[str, Column], *, id_col: str = "doc_id", key_col: str = "lang",
            fields: list[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """The manifest of ``docs``, and a check of rows against it that may have been changed since.

    ``tampered`` has the changed values of fields (null: the field is as it was) of the rows as
    they come back. Per row: the id, leaf, subroot, root, proof_sha256, folded_root (from the
    row as it came back, up its path in the manifest) and verified, all digests as lowercase hex.

    Nulls in any field are hashed as such; rows with a null key are a tree of their own, the
    first. Rows with equal ids are ordered by their digest; repeated rows are a leaf each. A row
    alone in its tree is its subroot, a tree alone the root; a leaf without siblings has the hash
    of the empty text as proof. Other columns are ignored; an empty table gives an empty result.
    """
    field = {c: F.col(f"`{c}`") for c in fields}
    back = {c: F.coalesce(tampered[c], field[c]) if c in tampered else field[c] for c in fields}
    changed = F.lit(False)
    for c in tampered:
        changed = changed | tampered[c].isNotNull()
    digest = leaf_digest([*field.values()])
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(key_col).alias("key"), digest.alias("digest"),
                              F.when(changed, leaf_digest([*back.values()])).alias("claimed")), "merkle_rows")
    known = manifest(rows, "key", ["id"])
    paths = (proofs(known, known.leaves.select("tree", "rank")).select("tree", "rank", "digits", "others")
             .join(known.leaves.select("tree", "rank", "id", "digest", F.coalesce("claimed", "digest").alias("claimed")),
                   ["tree", "rank"]))
    out = folded(paths, ["claimed"])
    subroots = known.trees.select(F.col("tree").alias("group_tree"), "subroot", "size")
    root = F.lit(known.root).cast("binary")
    joined = join_groups(out, subroots.withColumnRenamed("group_tree", "tree"), ["tree"], "size", rows.count())
    return joined.select(
        F.col("id").alias(id_col), F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        F.lower(F.hex(root)).alias("root"), F.lower(F.hex("proof")).alias("proof_sha256"),
        F.lower(F.hex("claimed_root")).alias("folded_root"), (F.col("claimed_root") == root).alias("verified"))
