"""The CSV parser is called once a record, and lines are joined in whole batches."""
import datetime as dt
import random

import pyarrow as pa

from rentalmart.sources import csv, records
from rentalmart.sources.schemas import RAW_REVIEWS


def test_header_check_calls_the_parser_once(spark, scratch):
    with open(f"{scratch}/r.csv", "w") as f:
        f.write("listing_id,id,date,reviewer_id,reviewer_name,comments\n1,2,2024-01-01,3,a,\"b\nc\"\n")
    df = csv.read_csv(spark, f"{scratch}/r.csv", RAW_REVIEWS)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert max(line.count("from_csv(") for line in plan.splitlines()) == 1
    assert [tuple(r) for r in df.collect()] == [(1, 2, dt.date(2024, 1, 1), 3, "a", "b\nc")]


def _one_by_one(lines):
    """What ``_joined`` is to give for (file, start, line, quotes, starts_open) rows."""
    out, key, held, begun = [], None, [], True

    def put(kind):
        text = "\n".join(held)
        if kind or text not in ("", "\r"):
            out.append((*key, sum(r[:2] == key for r in out), kind, text))
    for file, start, line, quotes, starts_open in lines:
        if (file, start) != key:
            if held:
                put(1 if begun else 3)
            key, held, is_open, begun = (file, start), [], starts_open, not starts_open
        held.append(line)
        is_open ^= bool(quotes & 1)
        if not is_open:
            put(0 if begun else 2)
            held, begun = [], True
    if held:
        put(1 if begun else 3)
    return out


def test_joined_batches_equal_line_by_line():
    for seed in range(60):
        rnd = random.Random(seed)
        rows = []
        for file in ("f", "g"):
            for start in range(rnd.randint(1, 4)):
                is_open = rnd.random() < 0.4
                for _ in range(rnd.randint(1, 12)):
                    line = rnd.choice(["", "\r", "a,b", 'x"', '"', 'é""', "c\r"])
                    rows.append((file, start, line, line.count('"'), is_open))
        cuts = sorted(rnd.sample(range(len(rows) + 1), min(len(rows), 3)))
        batches = [pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in part], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_()))],
            names=["file", "start", "line", "quotes", "starts_open"])
            for part in (rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]))]
        got = [tuple(r.values()) for b in records._joined(iter(batches)) for r in b.to_pylist()]
        assert got == _one_by_one(rows), seed
