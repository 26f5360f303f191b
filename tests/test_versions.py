"""Tables of whole commits, and appends that read only the files their keys may be in."""
import datetime as dt
import os
import random
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rentalmart.operators import incremental, key_filters, versions
from rentalmart.operators.incremental import append_new, read_table
from rentalmart.plans import facts, pipeline


def rows(spark, keys, text="x"):
    return spark.createDataFrame([(k, text) for k in keys], "id long, text string")


def content(spark, path):
    return Counter(tuple(r) for r in versions.read(spark, path).collect())


def test_a_failed_refresh_leaves_the_old_table(spark, scratch):
    t = f"{scratch}/mart"
    versions.replace(spark, rows(spark, [1, 2]), t)
    bad = rows(spark, range(50)).withColumn("text", F.when(F.col("id") == 49, F.raise_error(F.lit("broken"))).otherwise("y"))
    with pytest.raises(Exception, match="broken"):
        pipeline.write_table(spark, bad, t)
    assert content(spark, t) == Counter([(1, "x"), (2, "x")])
    assert len([n for n in os.listdir(t) if n.startswith(versions.DATA)]) == 1


def test_a_refresh_is_one_step_and_readers_keep_their_version(spark, scratch):
    t = f"{scratch}/mart"
    before = versions.replace(spark, rows(spark, [1, 2]), t)
    after = versions.replace(spark, rows(spark, [3]).withColumn("more", F.lit(1)), t)
    assert before.count() == 2 and after.columns == ["id", "text", "more"]
    versions.replace(spark, rows(spark, [4]), t)
    assert content(spark, t) == Counter([(4, "x")])
    assert len([n for n in os.listdir(t) if n.startswith(versions.DATA)]) == 2  # the newest and the one before


def test_refresh_of_a_catalog_table_moves_its_location(spark, scratch):
    db = "swap_" + scratch.rstrip("/").split("/")[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch}/{db}.db'")
    try:
        for k in (1, 2):
            assert pipeline.write_table(spark, rows(spark, [k]), f"{db}.mart").first().id == k
        bad = rows(spark, [7]).withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
        with pytest.raises(Exception, match="broken"):
            pipeline.write_table(spark, bad, f"{db}.mart")
        assert [r.id for r in spark.table(f"{db}.mart").collect()] == [2]
        wider = pipeline.write_table(spark, rows(spark, [3]).withColumn("more", F.lit(1)), f"{db}.mart")
        assert wider.columns == ["id", "text", "more"] and len(os.listdir(f"{scratch}/{db}.db")) <= 2
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_an_append_killed_half_way_is_not_seen(spark, scratch, monkeypatch):
    t = f"{scratch}/fact"
    append_new(spark, rows(spark, [1, 2]), t, ["id"])
    commit = versions.commit

    class Killed(BaseException):
        """Not an error that anything handles."""

    def die(*a):
        raise Killed
    monkeypatch.setattr(versions, "commit", die)
    monkeypatch.setattr(incremental, "discard", lambda *a: None)  # a killed process tidies nothing
    with pytest.raises(Killed):
        append_new(spark, rows(spark, [2, 3]), t, ["id"])
    monkeypatch.undo()
    assert versions.commit is commit and content(spark, t) == Counter([(1, "x"), (2, "x")])
    left = [n for n in os.listdir(t) if n.startswith((versions.DATA, versions.KEYS))]
    assert len(left) == 4
    append_new(spark, rows(spark, [2, 3], "again"), t, ["id"])
    assert content(spark, t) == Counter([(1, "x"), (2, "x"), (3, "again")])
    assert versions.vacuum(spark, t) == []  # too young
    assert len(versions.vacuum(spark, t, 0)) == 2
    assert content(spark, t) == Counter([(1, "x"), (2, "x"), (3, "again")])


@pytest.mark.parametrize("first", [True, False])
def test_two_appends_at_once_leave_no_duplicates(spark, scratch, monkeypatch, first):
    """Both write before either commits; ids 5..9 are in both batches."""
    t = f"{scratch}/fact"
    if not first:
        append_new(spark, rows(spark, [0]), t, ["id"])
    together, commit, waited = threading.Barrier(2, timeout=120), versions.commit, set()

    def both(*a):
        if threading.get_ident() not in waited:
            waited.add(threading.get_ident())
            together.wait()
        return commit(*a)
    monkeypatch.setattr(versions, "commit", both)
    failed = []

    def run(keys, text):
        try:
            append_new(spark, rows(spark, keys, text), t, ["id"])
        except BaseException as exc:  # noqa: BLE001 - shown below
            failed.append(exc)
    threads = [threading.Thread(target=run, args=(keys, text)) for keys, text in (([*range(10), 3], "a"), (range(5, 15), "b"))]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert not failed
    found = content(spark, t)
    assert {k for k, _ in found} == set(range(15))
    per_id = {k: {text for i, text in found if i == k} for k in range(15)}
    assert all(len(texts) == 1 for texts in per_id.values())
    if first:
        assert found[(3, "a")] == 2  # repeated inside its batch: kept
    assert len({tuple(per_id[k]) for k in range(5, 10)}) == 1  # the winner's
    assert versions.current(spark, t).number == (2 if first else 3)
    assert len([n for n in os.listdir(t) if n.startswith(versions.DATA)]) == (2 if first else 3)


def test_two_refreshes_at_once_leave_one_whole_version(spark, scratch):
    t = f"{scratch}/mart"
    threads = [threading.Thread(target=versions.replace, args=(spark, rows(spark, [k] * 3), t)) for k in range(3)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    found = content(spark, t)
    assert len(found) == 1 and set(found.values()) == {3} and versions.current(spark, t).number == 3


def test_new_keys_read_no_old_file(spark, scratch):
    t = f"{scratch}/fact"
    for k in range(4):
        append_new(spark, rows(spark, range(1000 * k, 1000 * k + 1000)), t, ["id"])
    assert append_new(spark, rows(spark, range(9000, 9100)), t, ["id"]).files_read == 0
    one = append_new(spark, rows(spark, [*range(9100, 9200), 2500], "late"), t, ["id"])
    assert one.files_read == 1
    replay = append_new(spark, rows(spark, range(9100), "late"), t, ["id"])
    assert replay.files_read >= 5
    assert versions.read(spark, t).where("text = 'late'").count() == 100 + 9100 - 4100
    assert versions.read(spark, t).count() == versions.read(spark, t).select("id").distinct().count()


def test_reading_nothing_old_shows_in_the_plan(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrameWriter
    t = f"{scratch}/fact"
    append_new(spark, rows(spark, range(100)), t, ["id"])
    plans, save = [], DataFrameWriter.save

    def spy(self, *a, **k):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return save(self, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "save", spy)
    append_new(spark, rows(spark, range(500, 600)), t, ["id"])
    append_new(spark, rows(spark, range(50, 60)), t, ["id"])
    assert "LeftAnti" not in plans[0] and "FileScan" not in plans[0]
    assert "LeftAnti" in plans[1] and "FileScan" in plans[1]


@pytest.mark.parametrize("setting", [("PROBES", 0), ("BITS", 1), ("most", 3)], ids=["all false positives", "few bits", "large batch"])
def test_false_positives_and_large_batches_change_nothing(spark, scratch, monkeypatch, setting):
    name, value = setting
    if name == "most":
        monkeypatch.setattr(key_filters.batch_hashes, "__defaults__", (value,))
    else:
        monkeypatch.setattr(key_filters, name, value)
    rnd, t, model = random.Random(3), f"{scratch}/fact", Counter()
    for b in range(4):
        batch = [rnd.choice([None, *range(40)]) for _ in range(30)]
        seen = {k for k, _ in model}
        model += Counter((k, f"b{b}") for k in batch if k not in seen)
        append_new(spark, rows(spark, batch, f"b{b}"), t, ["id"])
        assert content(spark, t) == model


def test_filters_never_miss_a_key_and_rarely_err(spark, scratch):
    frame = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 != 0, F.col("id") * 7).alias("part"))
    frame.repartition(4).write.parquet(f"{scratch}/data")
    files = spark.read.parquet(f"{scratch}/data")
    filters = key_filters.build(files, ["id", "part"])
    filters.write.parquet(f"{scratch}/keys")
    filters = spark.read.parquet(f"{scratch}/keys")
    assert filters.count() == 4 and filters.agg(F.sum("n")).first()[0] == 20_000
    assert all(len(r.bits) * 8 >= 32 * r.n for r in filters.collect())
    owner = {(r.id, r.part): r.f for r in files.select("id", "part", F.col("_metadata.file_name").alias("f")).collect()}
    for key in [(0, None), (1, 7), (19_999, None)] + [k for k in owner if k[0] % 4999 == 0]:
        batch = spark.createDataFrame([key], "id long, part long")
        found = {r.file for r in key_filters.hit(filters, key_filters.batch_hashes(batch, ["id", "part"])).collect()}
        assert owner[key] in found if key in owner else True
    strangers = spark.range(50_000, 70_000).select("id", F.col("id").alias("part"))
    hashes = key_filters.batch_hashes(strangers, ["id", "part"])
    single = sum(key_filters.hit(filters, hashes[k:k + 2000]).count() for k in range(0, 20_000, 2000))
    assert single <= 4  # of 40 probes of 2000 strange keys


def test_empty_batches_and_empty_tables(spark, scratch):
    for target, append, df in (("r", lambda d, t: append_new(spark, d, t, ["id"]), rows(spark, [])),):
        t = f"{scratch}/{target}"
        assert append(df, t).mode == "full" and versions.read(spark, t).count() == 0
        assert append(df, t).mode == "append" and versions.current(spark, t).number == 1
        append(rows(spark, [1]), t)
        assert content(spark, t) == Counter([(1, "x")])
    cal = spark.createDataFrame([], "listing_id long, calendar_date date")
    t = f"{scratch}/c"
    facts.fct_calendar(spark, cal, t)
    facts.fct_calendar(spark, cal, t)
    assert facts.read_fct_calendar(spark, t).columns == ["listing_id", "calendar_date", "cal_key"]


def test_first_versions_is_what_appending_leaves(spark, scratch):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]
    rnd = random.Random(8)
    batches = [spark.createDataFrame([(rnd.choice([None, 1, 2]), rnd.choice([None, *days]), f"b{b}") for _ in range(60)],
                                     "listing_id long, calendar_date date, note string") for b in range(3)]
    t = f"{scratch}/c"
    for b in batches:
        facts.fct_calendar(spark, b, t)
    loaded = Counter(tuple(r) for r in facts.read_fct_calendar(spark, t).collect())
    assert Counter(tuple(r) for r in facts.calendar_after(batches).collect()) == loaded
    assert read_table(spark, t).columns[-1] == facts.CALENDAR_PART
