"""The batch jobs, end to end, from the reference's kind of tables and from the star schema."""

import glob

import pytest

import __spark_entry__ as entry
from regiocast import jobs
from regiocast.registry import COVERAGE_START_AFTER, MONTHLY_START_AFTER, TARGET_DATE
from regiocast.sources import schemas, tables

from conftest import SF_SMOKE


def _csv_rows(spark, path):
    files = sorted(glob.glob(f"{path}/part-*.csv"))
    return [tuple(r) for f in files for r in spark.read.option("header", True).csv(f).collect()]


@pytest.fixture()
def feeds(spark, scratch):
    """Parquet with every column a string and names of its own."""
    frames = {
        "summary": tables.summary(spark, SF_SMOKE, qualified=True).selectExpr("date AS data", "region AS area", "total AS totale"),
        "plain": tables.summary(spark, SF_SMOKE).selectExpr("date AS data", "region AS area", "total AS totale"),
        "centers": tables.centers(spark, SF_SMOKE).selectExpr("region AS area", "'x' AS indirizzo"),
        "doses": tables.doses(spark, SF_SMOKE).selectExpr("date AS data", "'S' AS f", "region AS area", "age AS fascia", "women + 5 AS uomini", "women AS donne"),
        "population": tables.population(spark, SF_SMOKE).selectExpr("region AS area", "population AS totale"),
    }
    for name, df in frames.items():
        df.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in df.columns]).write.parquet(f"{scratch}/{name}")
    return scratch


def test_monthly_mean(spark, feeds):
    args = ["--out", f"{feeds}/q1", "--start-after", MONTHLY_START_AFTER]
    out = jobs.main(["monthly-mean", "--summary", f"{feeds}/plain", "--centers", f"{feeds}/centers", *args])
    back = [tuple(r) for r in spark.read.schema(schemas.MONTHLY_MEAN).option("header", True).csv(out).collect()]
    want = [tuple(r) for r in entry.queries()["monthly_mean_per_center"](spark, SF_SMOKE).collect()]
    assert sorted(back) == sorted(want)
    rows = _csv_rows(spark, out)  # part files concatenated in name order are globally sorted
    assert rows == sorted(rows, key=lambda r: (r[0], r[1]))


def test_top_regions(spark, feeds):
    args = ["top-regions", "--doses", f"{feeds}/doses", "--start-after", MONTHLY_START_AFTER]
    # daily sums are points of one day, so the feed at line-item grain gives the registered result
    rows = _csv_rows(spark, jobs.main([*args, "--out", f"{feeds}/rdd"]))
    want = [tuple(map(str, r)) for r in entry.queries()["top_regions_by_forecast"](spark, SF_SMOKE).collect()]
    assert rows == want
    rows = _csv_rows(spark, jobs.main([*args, "--out", f"{feeds}/sql", "--variant", "sql"]))
    assert len(rows) == entry.queries()["top_regions_by_forecast_rounded"](spark, SF_SMOKE).count()
    keys = [(r[0][6:] + r[0][3:5] + r[0][:2], r[2], int(r[3]), r[1]) for r in rows]  # dd-MM-yyyy, forecast ascending
    assert keys == sorted(keys) and all(len(r[0]) == 10 and r[0][2] == "-" for r in rows)
    one = _csv_rows(spark, jobs.main([*args, "--out", f"{feeds}/one", "--min-points", "1", "--n", "1", "--rounding", "half_up"]))
    assert len(one) == len({(r[0], r[1]) for r in one})


def test_coverage(spark, feeds):
    args = ["--algorithm", "bisecting", "--k", "2", "--start-after", COVERAGE_START_AFTER]
    tables_args = ["--summary", f"{feeds}/summary", "--population", f"{feeds}/population"]
    path = jobs.main(["coverage", *tables_args, *args, "--out", f"{feeds}/q3", "--target-date", TARGET_DATE])
    assert path.endswith("/bisecting/2")
    rows = _csv_rows(spark, path)
    assert [r[1] for r in rows] == sorted(r[1] for r in rows) and {r[3] for r in rows} == {"0", "1"}
    want = {r.region: r.percent for r in entry.queries()["coverage_percent"](spark, SF_SMOKE).collect()}
    assert {r[1]: float(r[2]) for r in rows} == want
    # the SQL variant: the same rows in one file
    path = jobs.main(["coverage", *tables_args, *args, "--out", f"{feeds}/q3sql", "--target-date", TARGET_DATE, "--variant", "sql"])
    (part,) = glob.glob(f"{path}/part-*.csv")
    assert [tuple(r) for r in spark.read.option("header", True).csv(part).collect()] == rows
    # without a target day: tomorrow
    path = jobs.main(["coverage", "--sf-dir", SF_SMOKE, *args, "--out", f"{feeds}/q3b", "--points", "daily"])
    assert {r[0] for r in _csv_rows(spark, path)} == {str(spark.sql("SELECT current_date() + 1").first()[0])}


def test_inputs_are_required(capsys):
    with pytest.raises(SystemExit):
        jobs.main(["coverage", "--summary", "x", "--algorithm", "kmeans", "--k", "2", "--out", "y", "--start-after", "2020-1-1"])
    assert "--population" in capsys.readouterr().err


def test_land_batch_and_stream(spark, scratch):
    rows = [("2021-01-05", "A", "3"), ("2021-13-1", "A", "4"), ("x", "A", "5")]
    spark.createDataFrame(rows, "date string, region string, total string").write.option("header", True).csv(f"{scratch}/feed")
    args = ["land", "--table", "summary", "--src", f"{scratch}/feed", "--on-bad", "quarantine", "--by-month"]
    out = jobs.main([*args, "--out", f"{scratch}/table"])
    assert (spark.read.parquet(out).count(), spark.read.parquet(f"{out}_rejected").count()) == (1, 2)
    jobs.main([*args, "--out", f"{scratch}/table", "--lenient-dates"])
    assert (spark.read.parquet(out).count(), spark.read.parquet(f"{out}_rejected").count()) == (2, 1)
    for _ in range(2):  # the second run finds no new file
        out = jobs.main([*args, "--out", f"{scratch}/stream", "--stream"])
    assert (spark.read.parquet(out).count(), spark.read.parquet(f"{out}_rejected").count()) == (1, 2)
    with pytest.raises(ValueError, match="no date"):
        jobs.main(["land", "--table", "centers", "--src", "x", "--out", "y", "--by-month"])


def test_single_file(spark, scratch):
    out = jobs.main(["monthly-mean", "--sf-dir", SF_SMOKE, "--start-after", MONTHLY_START_AFTER, "--out", f"{scratch}/one", "--single-file"])
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines[0] == "date,region,mean_vacc_center" and len(lines) > 2
    assert lines[1:] == sorted(lines[1:], key=lambda line: line.split(",")[:2])
