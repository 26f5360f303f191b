"""Quoted CSV read by many tasks: the same rows as the one-task read, wherever ranges are cut."""
import gzip
import os
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from rentalmart.sources import csv, records
from rentalmart.sources.schemas import RAW_LISTINGS, RAW_REVIEWS

ERRORS = (PySparkException, Py4JJavaError)
COLUMNS = "listing_id,id,date,reviewer_id,reviewer_name,comments"


@pytest.fixture
def small_ranges(spark):
    """Files are cut every few hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def quoted(x):
    return '"' + x.replace('"', '""') + '"'


def write(path, rows, newline="\n", header=COLUMNS):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(header + newline + "".join(r + newline for r in rows))


def some_rows(n, seed):
    rnd = random.Random(seed)
    texts = ["", "plain", "two\nlines", 'a "quoted" word', "a, b", "\n\n\n", '"', "é\r\n🙂", "x" * 50, "line\n" * 200, 'tail"\n']
    return [f"{k},{k + 7},2024-01-{k % 28 + 1:02d},{k % 5},{quoted(rnd.choice(texts))},{quoted(rnd.choice(texts) + str(k))}"
            for k in range(n)]


def one_task(spark, path):
    return spark.read.options(**csv.CSV_OPTIONS, multiLine=True).csv(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("open_ranges", [100_000, 0], ids=["broadcast", "shuffled"])
def test_equals_the_one_task_read(spark, scratch, small_ranges, newline, open_ranges, monkeypatch):
    monkeypatch.setattr(records.records, "__defaults__", (open_ranges,))
    path = f"{scratch}/reviews.csv"
    write(path, some_rows(120, 3), newline)
    lines = records._lines(spark, path)
    assert lines.rdd.getNumPartitions() > 20
    assert records.ranges(lines).where("starts_open").count() > 3
    got = rows_of(csv.free_text_csv(spark, path, ["id"]))
    assert len(got) == 120 and any("\r\n" in r[4] for r in got)
    if newline == "\r\n":  # where lines end so, the one-task read shortens line breaks in quotes too
        got = [tuple(x and x.replace("\r\n", "\n") for x in r) for r in got]
    assert got == rows_of(one_task(spark, path))


def test_a_field_over_many_ranges_and_blank_lines(spark, scratch, small_ranges):
    path = f"{scratch}/reviews.csv"
    rows = ["", "1,2,2024-01-01,3,a," + quoted("very\nlong\n" * 400), "", "", "2,3,,,,", '3,4,,,"",' + quoted("\n" * 900)]
    write(path, rows)
    assert rows_of(csv.free_text_csv(spark, path, [])) == rows_of(one_task(spark, path))


def test_folder_of_files_with_headers_and_gzip(spark, scratch, small_ranges):
    folder = f"{scratch}/reviews"
    os.mkdir(folder)
    for k in range(3):
        write(f"{folder}/{k}.csv", some_rows(20 * k, k))
    with gzip.open(f"{folder}/z.csv.gz", "wt", newline="") as f:
        f.write(COLUMNS + "\n" + "\n".join(some_rows(10, 9)))
    df = csv.read_csv(spark, folder, RAW_REVIEWS)
    assert df.count() == 0 + 20 + 40 + 10
    assert rows_of(df.select("comments")) == rows_of(one_task(spark, folder).select("comments"))


def test_a_row_like_the_header_is_data(spark, scratch):
    path = f"{scratch}/reviews.csv"
    write(path, ["1,2,2024-01-01,3,a,b", COLUMNS])
    assert [r.id for r in csv.free_text_csv(spark, path, ["id"]).collect()] == ["2", "id"]


def test_other_headers_and_stray_quotes_fail(spark, scratch):
    folder = f"{scratch}/reviews"
    os.mkdir(folder)
    write(f"{folder}/a.csv", some_rows(3, 1))
    write(f"{folder}/b.csv", some_rows(3, 1), header="id,listing_id,date,reviewer_id,reviewer_name,comments")
    with pytest.raises(ERRORS, match="other columns"):
        csv.read_csv(spark, folder, RAW_REVIEWS).collect()
    path = f"{scratch}/stray.csv"
    write(path, ['1,2,2024-01-01,3,a,5" pipe', "2,3,2024-01-01,3,a,b", "3,4,2024-01-01,3,a,b"])
    with pytest.raises(ERRORS):
        csv.read_csv(spark, path, RAW_REVIEWS).collect()


def test_empty_files(spark, scratch):
    path = f"{scratch}/reviews.csv"
    write(path, [])
    assert csv.read_csv(spark, path, RAW_REVIEWS).collect() == []


def test_listings_load_in_many_tasks(spark, scratch, small_ranges):
    """The real listing columns, with line breaks in the amenities, through load_raw."""
    names = [f.name for f in RAW_LISTINGS.fields]
    rows = [",".join(str(k) if n == "id" else quoted(f"[\n  ""wifi"",\n  {k}\n]") if n == "amenities" else "" for n in names)
            for k in range(50)]
    path = f"{scratch}/listings.csv"
    write(path, rows, header=",".join(names))
    report = {r.table: r.rows for r in csv.load_raw(spark, {"raw_listings": path}, f"{scratch}/raw").collect()}
    assert report["raw_listings"] == 50
    loaded = csv.read_raw(spark, f"{scratch}/raw", "raw_listings")
    assert {r.amenities.count("\n") for r in loaded.collect()} == {3} and loaded.agg({"id": "sum"}).first()[0] == 1225
