"""Fixture C: coverage percent."""

import datetime as dt

from regiocast.plans.coverage import coverage_percent, forecast_at_date

D = dt.date


def _inputs(spark):
    summary = spark.createDataFrame(
        [
            (D(2020, 12, 26), "A / X", 900),
            (D(2020, 12, 27), "A / X", 10),
            (D(2020, 12, 28), "A / X", 20),
            (D(2020, 12, 27), "B", 7),
            (D(2020, 12, 27), "C", 1),
            (D(2020, 12, 28), "C", 1),
            (D(2020, 12, 27), "D", 1),
            (D(2020, 12, 28), "D", 1),
        ],
        "date date, region string, total bigint",
    )
    population = spark.createDataFrame([("A / Y", 600), ("B", 70), ("C", 4)], "region string, population bigint")
    return summary, population


def test_fixture_c(spark):
    summary, population = _inputs(spark)
    rows = coverage_percent(summary, population, "2020-12-26", "2020-12-29").collect()
    assert [tuple(r) for r in rows] == [
        (D(2020, 12, 29), "A", 10.0),
        (D(2020, 12, 29), "B", 10.0),
        (D(2020, 12, 29), "C", 75.0),
    ]


def test_forecast_at_date(spark):
    summary, _ = _inputs(spark)
    pred = {r.region: r.predicted for r in forecast_at_date(summary, "2020-12-26", "2020-12-29").collect()}
    assert pred == {"A": 30, "B": 0, "C": 1, "D": 1}


def test_duplicate_population_rows_do_not_multiply(spark):
    summary, _ = _inputs(spark)
    population = spark.createDataFrame([("A / Y", 300), ("A / Z", 300)], "region string, population bigint")
    rows = coverage_percent(summary, population, "2020-12-26", "2020-12-29").collect()
    assert [(r.region, r.percent) for r in rows] == [("A", 10.0)]
