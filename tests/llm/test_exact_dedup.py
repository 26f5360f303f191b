import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from rentalmart.llm import exact_dedup, hot_groups
from tests.llm.conftest import ODD


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for i, text in rows:
        same = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        out.append((i, min(groups[same])[3], len(groups[same]), sha256(same.encode()).hexdigest(), len(text or "")))
    return sorted(out, key=str)


ROWS = [*enumerate(ODD)] + [(100 + k, f"copy{' ' * (k % 4)}of one text") for k in range(40)] + [
    (7, "on e two three"), (None, "one"), (None, "o n e"), (200, "one"), (3, "one"), (201, " "), (202, "ONE")]


@pytest.mark.parametrize("hashed", [
    exact_dedup.content_hash,
    lambda t: [F.length(t).cast("long") % 2, F.lit(5).cast("long")],  # nearly everything collides
], ids=["md5", "colliding"])
@pytest.mark.parametrize("parts", [1, 4096])
def test_equals_brute_force(docs_of, monkeypatch, hashed, parts):
    monkeypatch.setattr(hot_groups.join_groups, "__defaults__", ("inner", parts))
    rows = exact_dedup.exact_dedup(docs_of(ROWS), hashed=hashed).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256, r.n_chars) for r in rows), key=str) == brute(ROWS)
    kept = [r for r in rows if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_repeated_rows_keep_exactly_one(docs_of):
    rows = exact_dedup.exact_dedup(docs_of([(1, "same text")] * 5)).collect()
    assert sorted(r.kept for r in rows) == [False] * 4 + [True] and {r.group_size for r in rows} == {5}


def test_empty_table(docs_of):
    out = exact_dedup.exact_dedup(docs_of([]))
    assert out.collect() == [] and out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_chars"]


def test_no_python_in_the_plan(docs_of):
    plan = exact_dedup.exact_dedup(docs_of(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_groups_is_the_plain_join(spark, how):
    rows = spark.createDataFrame([(k, None if k % 5 == 0 else k % 3, k) for k in range(100)], "id int, g int, x int")
    groups = rows.groupBy("g").agg(F.count("*").alias("size"), F.max("id").alias("last")).where("g is null or g < 2")
    got = hot_groups.join_groups(rows, groups, ["g"], "size", 100, how, 4)
    assert got.columns == ["id", "g", "x", "size", "last"]
    want = rows.alias("r").join(groups.alias("q"), F.expr("r.g <=> q.g"), how).select("r.*", "size", "last")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
