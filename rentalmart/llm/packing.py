"""Packing: mixture-controlled windows by deficit round-robin over source queues.

Every source is a queue of tokens, its documents one after the other. A window of ``window``
tokens is filled from all queues in their target proportions (each source's share of all
tokens, so that all queues run dry together). A source earns its share of every window as
credit and is served, in turn, when the credit is worth at least ``least`` tokens; what it
earned but did not get (its deficit) is carried to the next window.

The work is cut into spans of ``SPAN`` windows that Spark deals out. How far a queue has been
served when a span begins follows from its total alone: its share of all earlier spans,
rounded down to whole ``least`` tokens; the rest is the deficit that it carries into the
span. So each span is independent of the others, no queue passes through one task, and a
source that holds a third of all rows is spread over all spans. Windows continue across
spans without padding; only the very last one may be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .encoders import ByteLevelEncoder

WINDOW = 1024
SPAN = 256  # windows filled by one group
LEAST = 64  # tokens for which a source is served
END = 0  # the id after every document


def tokenized(docs: DataFrame, spec: str, id_col: str, text_col: str, queue_col: str, end: int = END) -> DataFrame:
    """id, queue, part, start (tokens before it in its queue, within the part), n, ids
    (little-endian bytes, the end id included). A part is a task of the scan: the table is
    written by whole tasks, so starts stay right when a task is run again."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, used = ByteLevelEncoder(spec), TaskContext.get().partitionId(), {}
        last = end.to_bytes(encoder.width, "little")
        for batch in batches:
            queues = batch.column("queue").to_pylist()
            ids = [encoder.ids(t) + last for t in batch.column("text").to_pylist()]
            n = [len(x) // encoder.width for x in ids]
            starts = []
            for q, k in zip(queues, n):
                starts.append(used.get(q, 0))
                used[q] = starts[-1] + k
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("queue"), pa.array([part] * len(n), pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["id", "queue", "part", "start", "n", "ids"])

    lean = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(queue_col).cast("string"), F.lit("")).alias("queue"))
    return lean.mapInArrow(encode, "id long, queue string, part int, start long, n long, ids binary")


def fill(queues: list[list], offset: int, window: int, least: int) -> list[tuple]:
    """Fill windows from ``queues``, each a list of (document, start, length) in order;
    ``offset`` tokens of the first window are taken already. Returns (document, start,
    length, tokens of the span before it), in packed order."""
    left = [sum(p[2] for p in q) for q in queues]
    total = sum(left)
    share = [x / total for x in left] if total else []
    credit, head, done = [0.0] * len(queues), [[0, 0] for _ in queues], [0] * len(queues)
    out, at, turn = [], 0, 0

    def serve(s: int, n: int) -> int:
        nonlocal at
        left[s] -= n
        credit[s] -= n
        while n:
            k, used = head[s]
            doc, start, length = queues[s][k]
            take = min(n, length - used)
            out.append((doc, start + used, take, at))
            at += take
            n -= take
            head[s] = [k, used + take] if used + take < length else [k + 1, 0]
        return 0

    while at < total:
        end = min(total, at + window - (offset + at) % window)
        room = end - at
        for s in range(len(queues)):
            credit[s] += share[s] * room
        for k in range(len(queues)):
            s = (turn + k) % len(queues)
            n = min(int(credit[s]), left[s], end - at)
            if n >= least or (n and n == left[s]):
                serve(s, n)
        turn += 1
        while at < end:  # nobody else has earned enough: whoever has the largest deficit
            s = max((s for s in range(len(queues)) if left[s]), key=lambda s: (credit[s], -s))
            serve(s, min(left[s], end - at, max(least, int(credit[s]))))
    return out


def pack(docs: DataFrame, spec: str, *, id_col: str = "doc_id", text_col: str = "text", queue_col: str = "source",
         window: int = WINDOW, least: int = LEAST, span: int = SPAN, end: int = END) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    queue, ids (int array).

    ``spec`` is the text of a tokenizers file. A null or empty text is the end id alone.
    Rows with a null source share the queue of the empty name. Repeated rows are packed each.
    Null ids are kept. Other columns are ignored; an empty table gives an empty result.
    """
    doc_tokens = stored(tokenized(docs, spec, id_col, text_col, queue_col, end), "packing_tokens")
    by_part = doc_tokens.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("queue").orderBy("part")
    starts = stored(by_part.select(
        "queue", "part",
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy("queue")).alias("total")), "packing_starts")
    tokens = starts.where("base = 0").agg(F.sum("total")).first()[0] or 0
    spans = max(1, tokens // (window * span))
    width = ByteLevelEncoder(spec).width

    # first token of a queue in span j, in whole ``least`` tokens; all of it before the end
    def first(j: str) -> str:
        return f"""if({j} >= {spans}, total, cast(
            ((cast({j} as decimal(20, 0)) * total + {spans - 1}) div {spans}) div {least} as bigint) * {least})"""

    def span_of(k: str) -> str:
        return f"cast((cast(least(({k}) div {least} * {least} + {least - 1}, total - 1) as decimal(20, 0)) * {spans}) div total as bigint)"

    pieces = (
        doc_tokens.join(starts, ["queue", "part"])
        .withColumn("at", F.col("base") + F.col("start"))
        .withColumn("span", F.expr(f"explode(sequence({span_of('at')}, {span_of('at + n - 1')}))"))
        .withColumn("low", F.expr(f"greatest(at, {first('span')})"))
        .withColumn("high", F.expr(f"least(at + n, {first('span + 1')})"))
        .where("high > low"))
    sizes = pieces.groupBy("span").agg(F.sum(F.expr("high - low")).alias("size"))
    # spans are summed in blocks, so that no window runs over all of them
    blocks = sizes.withColumn("block", F.expr("span div 4096"))
    per_block = blocks.groupBy("block").agg(F.sum("size").alias("size"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.select("block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before_block"))
    inside = Window.partitionBy("block").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    before = (blocks.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(per_block, "block")
              .select("span", (F.col("before") + F.col("before_block")).alias("before")))
    rows = pieces.join(before, "span").select(
        "span", "before", "queue", F.col("at").alias("doc_at"), "low", F.col("id").alias("doc"),
        F.expr("low - at").alias("start"), F.expr("high - low").alias("length"), F.col("n").alias("doc_tokens"),
        F.expr(f"substring(ids, cast((low - at) * {width} + 1 as int), cast((high - low) * {width} as int))").alias("ids"))
    kind = "<u2" if width == 2 else "<u4"

    def fill_span(table: pa.Table) -> pa.Table:
        table = table.sort_by([("queue", "ascending"), ("low", "ascending"), ("doc", "ascending")])
        names, lengths = table["queue"].to_pylist(), table["length"].to_pylist()
        queues: dict[str, list] = {}
        for k, (q, n) in enumerate(zip(names, lengths)):
            queues.setdefault(q, []).append((k, 0, n))
        before = table["before"][0].as_py()
        got = np.array(fill([*queues.values()], before % window, window, least), dtype=np.int64)
        ids = np.frombuffer(b"".join(table["ids"].to_pylist()), kind).astype("<i4")
        ends = np.concatenate([[0], np.cumsum(lengths)])
        own, low, size, at = got[:, 0], ends[got[:, 0]] + got[:, 1], got[:, 2], got[:, 3] + before
        packed = np.concatenate([ids[a:a + n] for a, n in zip(low.tolist(), size.tolist())])
        stops = np.concatenate([[0], np.cumsum(size)])
        raw = memoryview(packed.tobytes())
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
        rows = table.take(pa.array(own))
        return pa.table({
            "doc": rows["doc"], "start": pa.array(rows["start"].to_numpy() + got[:, 1]), "length": pa.array(size),
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": rows["doc_tokens"],
            "sequence_id": pa.array(at // window), "offset": pa.array(at % window), "queue": rows["queue"],
            "ids": pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(packed, pa.int32()))})

    return rows.groupBy("span").applyInArrow(
        fill_span, "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                   "offset long, queue string, ids array<int>").withColumnRenamed("doc", id_col)
