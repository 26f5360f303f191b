"""CSV landing (J-37): quoted multi-line fields, cast by header name, missing file skipped,
missing column is an error."""
import pytest

from rentalmart.sources import csv
from rentalmart.sources.schemas import RAW_NEIGHBOURHOODS, RAW_REVIEWS


def test_multiline_quotes_and_extra_columns(spark, scratch):
    path = f"{scratch}/reviews.csv"
    with open(path, "w") as f:
        f.write('listing_id,id,date,reviewer_id,reviewer_name,comments,extra\n'
                '1,10,2024-01-02,5,"Ann ""A""","line one\nline two",x\n'
                '2,11,2024-01-03,6,Bob,plain,y\n')
    df = csv.read_csv(spark, path, RAW_REVIEWS)
    rows = sorted(df.collect(), key=lambda r: r.id)
    assert df.columns == [f.name for f in RAW_REVIEWS.fields]
    assert rows[0].reviewer_name == 'Ann "A"' and rows[0].comments == "line one\nline two"
    assert str(rows[1].date) == "2024-01-03"


def test_missing_column_is_an_error(spark, scratch):
    path = f"{scratch}/n.csv"
    with open(path, "w") as f:
        f.write("neighbourhood\nShibuya\n")
    with pytest.raises(csv.MissingColumnError):
        csv.read_csv(spark, path, RAW_NEIGHBOURHOODS)


def test_load_raw_reports_and_skips_missing(spark, scratch):
    path = f"{scratch}/neighbourhoods.csv"
    with open(path, "w") as f:
        f.write("neighbourhood_group,neighbourhood\n,Shibuya\n,Minato\n")
    rep = {r.table: r for r in csv.load_raw(
        spark, {"raw_neighbourhoods": path, "raw_listings": f"{scratch}/nope.csv"},
        f"{scratch}/raw").collect()}
    assert (rep["raw_neighbourhoods"].rows, rep["raw_neighbourhoods"].cols) == (2, 2)
    assert rep["raw_listings"].skipped and rep["raw_reviews"].skipped
    assert csv.read_raw(spark, f"{scratch}/raw", "raw_neighbourhoods").count() == 2


def test_gzip_csv_is_read_directly(spark, scratch):
    import gzip
    path = f"{scratch}/neighbourhoods.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("neighbourhood_group,neighbourhood\n,Shibuya\n,Minato\n")
    assert csv.read_csv(spark, path, RAW_NEIGHBOURHOODS).count() == 2


def test_default_as_of_is_current_date(spark):
    import datetime as dt

    from rentalmart.plans import quality
    df = spark.createDataFrame([(1, dt.date.today() + dt.timedelta(days=3)),
                                (2, dt.date(2015, 1, 1))], "review_id long, review_date date")
    assert [r.review_id for r in quality.bad_review_dates(df).collect()] == [1]
