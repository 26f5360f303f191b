"""Command line: ingest landed CSV, build everything, report freshness."""
from rentalmart.__main__ import main
from rentalmart.sources import adapters, csv


def test_ingest_build_freshness(spark, scratch, capsys):
    from conftest import SF_SMALL
    raw = adapters.raw_inputs(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    for name, df in [("listings.csv", raw.listings), ("reviews.csv", raw.reviews),
                     ("calendar.csv", raw.calendar),
                     ("neighbourhoods.csv", raw.neighbourhoods)]:
        csv.write_csv(df, f"{landing}/{name}")
    assert main(["ingest", "--landing", landing, "--raw", f"{scratch}/raw"]) == 0
    assert csv.read_raw(spark, f"{scratch}/raw", "raw_calendar").count() == raw.calendar.count()
    # the fixtures contain failing tests: the gate stops the build ...
    assert main(["build", "--raw", f"{scratch}/raw", "--warehouse", f"{scratch}/wh",
                 "--as-of", "2025-09-30"]) == 1
    # ... unless told to keep going
    assert main(["build", "--raw", f"{scratch}/raw", "--warehouse", f"{scratch}/wh",
                 "--as-of", "2025-09-30", "--keep-going"]) == 0
    assert main(["freshness", "--raw", f"{scratch}/raw", "--as-of", "2025-09-30"]) == 0
    out = capsys.readouterr().out
    assert "raw_listings" in out and "pricing_analysis" in out


def test_one_database_name_for_all_commands(spark, scratch, capsys):
    from conftest import SF_SMALL
    raw = adapters.raw_inputs(spark, SF_SMALL)
    for name, df in [("listings.csv", raw.listings), ("reviews.csv", raw.reviews), ("calendar.csv", raw.calendar),
                     ("neighbourhoods.csv", raw.neighbourhoods)]:
        csv.write_csv(df, f"{scratch}/landing/{name}")
    same = ["--raw", f"{scratch}/raw", "--database", "cli_marts"]
    try:
        assert main(["ingest", "--landing", f"{scratch}/landing", *same]) == 0
        assert main(["build", "--warehouse", f"{scratch}/wh", "--as-of", "2025-09-30", "--keep-going", *same]) == 0
        assert main(["freshness", "--as-of", "2025-09-30", *same]) == 0
        out = capsys.readouterr().out
        assert "raw_calendar" in out and "Reviews (most recent)" in out
    finally:
        for db in ("cli_marts", "cli_marts_raw"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_csv_is_preferred_and_other_names_are_not_read(spark, scratch):
    import gzip
    for name, text in (("neighbourhoods.csv", ",A\n,B\n"), ("neighbourhoods.csv.bak", ",C\n")):
        with open(f"{scratch}/{name}", "w") as f:
            f.write("neighbourhood_group,neighbourhood\n" + text)
    with gzip.open(f"{scratch}/neighbourhoods.csv.gz", "wt") as f:
        f.write("neighbourhood_group,neighbourhood\n,D\n")
    with gzip.open(f"{scratch}/calendar.csv.gz", "wt") as f:
        f.write("listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n1,2024-01-01,t,$1.00,,1,2\n")
    assert main(["ingest", "--landing", scratch, "--raw", f"{scratch}/raw"]) == 0
    assert sorted(r.neighbourhood for r in csv.read_raw(spark, f"{scratch}/raw", "raw_neighbourhoods").collect()) == ["A", "B"]
    assert csv.read_raw(spark, f"{scratch}/raw", "raw_calendar").count() == 1
