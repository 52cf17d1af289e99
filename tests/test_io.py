import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from regiocast.functions.dates import lenient_date_sql
from regiocast.plans.monthly_mean import monthly_mean_per_center
from regiocast.sources import schemas
from regiocast.sources.landing import land, read_after, read_landed, rejected_rows, sorted_out, type_columns
from regiocast.sources.sinks import clusters_path, read_csv, write_csv

D = dt.date


def test_type_columns_casts_and_renames(spark):
    raw = spark.createDataFrame([("2021-1-5", "A / X", "12")], "c0 string, c1 string, c2 string")
    (row,) = type_columns(raw, schemas.SUMMARY).collect()
    assert tuple(row) == (D(2021, 1, 5), "A / X", 12)


def test_type_columns_fail_and_quarantine(spark):
    raw = spark.createDataFrame([("2021-01-05", "A", "12"), ("2021-01-06", "A", "x1")], "a string, b string, c string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        type_columns(raw, schemas.SUMMARY, on_bad="fail").collect()
    with pytest.raises((PySparkException, Py4JJavaError)):  # whatever columns are used afterwards
        type_columns(raw, schemas.SUMMARY, on_bad="fail").groupBy("region").count().collect()
    kept = type_columns(raw, schemas.SUMMARY, on_bad="quarantine").collect()
    assert [r.total for r in kept] == [12]
    assert [tuple(r) for r in rejected_rows(raw, schemas.SUMMARY).collect()] == [("2021-01-06", "A", "x1", "total")]
    nulls = spark.createDataFrame([("2021-01-05", "A", None)], "a string, b string, c string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        type_columns(nulls, schemas.SUMMARY, on_bad="fail").collect()


def test_csv_landing_and_sorted_sink(spark, scratch):
    src = f"{scratch}/feed"
    raw = spark.createDataFrame(
        [("2021-02-01", "B", "5"), ("2021-01-01", "A", "7"), ("2021-01-01", "B", "1")], "date string, region string, total string"
    )
    raw.write.option("header", True).csv(src)
    landed = land(spark, src, f"{scratch}/landed", schemas.SUMMARY_RAW, schemas.SUMMARY, partition_by=None)
    assert landed.schema == schemas.SUMMARY
    out = f"{scratch}/out"
    write_csv(landed, out, sort_by=["date", "region"], single_file=True)
    back = read_csv(spark, out, schemas.SUMMARY).collect()
    assert [(r.date, r.region) for r in back] == [(D(2021, 1, 1), "A"), (D(2021, 1, 1), "B"), (D(2021, 2, 1), "B")]
    assert clusters_path("/x/", "kmeans", 3) == "/x/kmeans/3"


def test_women_are_the_sixth_column(spark, scratch):
    """By name where the feed has our names, by position otherwise; from CSV and from string Parquet."""
    row = ("2021-02-01", "S", "A", "20-29", "111", "999")
    foreign = "data string, fornitore string, area string, fascia string, uomini string, donne string"
    shuffled = "women string, region string, date string, age string, men string, supplier string"
    feeds = {
        "position": spark.createDataFrame([row], foreign),
        "name": spark.createDataFrame([("999", "A", "2021-02-01", "20-29", "111", "S")], shuffled),
    }
    for name, feed in feeds.items():
        feed.write.option("header", True).csv(f"{scratch}/{name}")
        (got,) = land(spark, f"{scratch}/{name}", f"{scratch}/{name}_out", schemas.DOSES_RAW, schemas.DOSES).collect()
        assert tuple(got) == (D(2021, 2, 1), "S", "A", "20-29", 999)
        (got,) = type_columns(feed, schemas.DOSES, raw_schema=schemas.DOSES_RAW).collect()
        assert got.women == 999
    with pytest.raises(ValueError, match="at least 6"):
        type_columns(feeds["position"].drop("donne"), schemas.DOSES, raw_schema=schemas.DOSES_RAW)


def test_quarantined_rows_are_accounted_for(spark, scratch):
    feed = spark.createDataFrame([("2021-01-01", "A", "1"), ("not-a-date", "A", "2"), ("2021-01-02", None, "x")], "date string, region string, total string")
    feed.write.option("header", True).csv(f"{scratch}/feed")
    landed = land(spark, f"{scratch}/feed", f"{scratch}/out", schemas.SUMMARY_RAW, schemas.SUMMARY, on_bad="quarantine")
    rejected = spark.read.parquet(f"{scratch}/out_rejected").collect()
    assert landed.count() == 1 and {r._reason for r in rejected} == {"date", "region,total"}


def test_quarantine_reads_the_feed_once(spark, scratch):
    """One scan and one Python-free plan for good and rejected rows; months and lenient dates as asked."""
    rows = [("2021-01-31", "A", "1"), ("2021-2-30", "A", "2"), ("2021-13-1", "B", "3"), ("x", "B", "4"), ("2021-3-1", None, "?")]
    feed = spark.createDataFrame(rows, "date string, region string, total string")
    plan = sorted_out(feed, schemas.SUMMARY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    feed.write.option("header", True).csv(f"{scratch}/feed")
    landed = land(spark, f"{scratch}/feed", f"{scratch}/out", schemas.SUMMARY_RAW, schemas.SUMMARY, on_bad="quarantine", month_of="date", lenient_dates=True)
    assert sorted((r.date, r.region, r.total) for r in landed.collect()) == [(D(2021, 1, 31), "A", 1), (D(2021, 3, 2), "A", 2), (D(2022, 1, 1), "B", 3)]
    rejected = spark.read.parquet(f"{scratch}/out_rejected").collect()
    assert sorted((r.date, r._reason) for r in rejected) == [("2021-3-1", "region,total"), ("x", "date")]
    assert {f for f in os.listdir(f"{scratch}/out") if f.startswith("month=")} == {"month=2021-01-01", "month=2021-03-01", "month=2022-01-01"}
    assert not [f for f in os.listdir(scratch) if f.startswith(".")]  # nothing staged is left


def test_only_good_or_only_bad_rows(spark, scratch):
    for name, value in (("good", "1"), ("bad", "x")):
        spark.createDataFrame([("2021-01-01", "A", value)], "date string, region string, total string").write.option("header", True).csv(f"{scratch}/{name}")
        landed = land(spark, f"{scratch}/{name}", f"{scratch}/{name}_out", schemas.SUMMARY_RAW, schemas.SUMMARY, on_bad="quarantine")
        assert (landed.count(), spark.read.parquet(f"{scratch}/{name}_out_rejected").count()) == ((1, 0) if name == "good" else (0, 1))


def test_a_failing_job_leaves_the_old_tables(spark, scratch):
    good = spark.createDataFrame([("2021-01-01", "A", "1")], "date string, region string, total string")
    bad = spark.createDataFrame([("2021-01-02", "A", "x")], "date string, region string, total string")
    good.write.option("header", True).csv(f"{scratch}/good")
    bad.write.option("header", True).csv(f"{scratch}/bad")
    table, report = f"{scratch}/table", f"{scratch}/report"
    write_csv(land(spark, f"{scratch}/good", table, schemas.SUMMARY_RAW, schemas.SUMMARY), report, sort_by=["date"])
    with pytest.raises((PySparkException, Py4JJavaError)):
        land(spark, f"{scratch}/bad", table, schemas.SUMMARY_RAW, schemas.SUMMARY)
    for single in (False, True):
        with pytest.raises((PySparkException, Py4JJavaError)):
            write_csv(type_columns(bad, schemas.SUMMARY), report, sort_by=["date"], single_file=single)
    assert spark.read.parquet(table).count() == 1 and read_csv(spark, report, schemas.SUMMARY).count() == 1
    write_csv(type_columns(good, schemas.SUMMARY).selectExpr("date", "region", "total + 1 AS total"), report)
    assert [r.total for r in read_csv(spark, report, schemas.SUMMARY).collect()] == [2]
    assert not [f for f in os.listdir(scratch) if f.startswith(".")]


def test_single_file_is_in_order_and_joined_from_parallel_parts(spark, scratch):
    rows = spark.range(5000).selectExpr("(id * 7919) % 5000 AS n", "concat('a,\"', id, '\"') AS text").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv(rows, f"{scratch}/one", sort_by=["n DESC"], single_file=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    (name,) = [f for f in os.listdir(f"{scratch}/one") if not f.startswith((".", "_"))]
    with open(f"{scratch}/one/{name}") as lines:
        assert next(lines) == "n,text\n"
        assert [int(line.split(",")[0]) for line in lines] == list(range(4999, -1, -1))
    write_csv(rows.limit(0), f"{scratch}/none", single_file=True)
    assert open(f"{scratch}/none/part-00000.csv").read() == "n,text\n"
    assert read_csv(spark, f"{scratch}/one", rows.schema).orderBy("n").collect() == rows.orderBy("n").collect()


def test_months_before_the_bound_are_not_opened(spark, scratch):
    spark.createDataFrame([(f"2021-{m:02d}-{d:02d}", "A", "1") for m in range(1, 7) for d in (1, 15)], "date string, region string, total string").write.option(
        "header", True
    ).csv(f"{scratch}/feed")
    land(spark, f"{scratch}/feed", f"{scratch}/out", schemas.SUMMARY_RAW, schemas.SUMMARY, month_of="date")
    late = read_after(spark, f"{scratch}/out", schemas.SUMMARY, "2021-4-10")
    centers = spark.createDataFrame([("A",)], "region string")
    means = monthly_mean_per_center(late, centers, "2021-4-10")
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "month#" in plan.split("PartitionFilters")[1][:120]
    assert [(r.date, round(r.mean_vacc_center * 100, 2)) for r in means.collect()] == [(D(2021, 4, 1), 3.33), (D(2021, 5, 1), 6.45), (D(2021, 6, 1), 6.67)]
    assert read_landed(spark, f"{scratch}/out", schemas.SUMMARY).count() == 12


def test_lenient_dates_roll_over(spark):
    cases = {"2021-1-5": D(2021, 1, 5), "2021-13-1": D(2022, 1, 1), "2021-2-30": D(2021, 3, 2), "2020-0-0": D(2019, 11, 30), "2021-1-400": D(2022, 2, 4), "2021/1/1": None, "": None, "x": None}
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.d for r in rows.selectExpr("t", f"{lenient_date_sql('t')} AS d").collect()} == cases
