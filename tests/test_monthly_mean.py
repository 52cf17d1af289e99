"""Fixture A: monthly mean per centre."""

import datetime as dt

from regiocast.plans.monthly_mean import monthly_mean_per_center

D = dt.date


def test_fixture_a(spark):
    summary = spark.createDataFrame(
        [
            (D(2020, 12, 31), "A", 100),
            (D(2021, 1, 1), "A", 31),
            (D(2021, 1, 2), "A", 31),
            (D(2021, 2, 10), "A", 56),
            (D(2021, 1, 5), "B", 10),
        ],
        "date date, region string, total bigint",
    )
    centers = spark.createDataFrame([("A",), ("A",), ("C",)], "region string")
    rows = monthly_mean_per_center(summary, centers, "2020-12-31").collect()
    assert [tuple(r) for r in rows] == [(D(2021, 1, 1), "A", 1.0), (D(2021, 2, 1), "A", 1.0)]


def test_division_order_is_kept(spark):
    # (sum / days) / centres, in doubles, like the reference
    summary = spark.createDataFrame([(D(2021, 3, 3), "R", 1000)], "date date, region string, total bigint")
    centers = spark.createDataFrame([("R",)] * 7, "region string")
    (row,) = monthly_mean_per_center(summary, centers, "2021-1-31").collect()
    assert row.mean_vacc_center == (1000 / 31) / 7
