import datetime as dt

from pyspark.sql import functions as F

from regiocast.functions.arithmetic import floor_div_pos_sql, trunc_div_sql
from regiocast.functions.dates import as_date, date_label, days_in_month, month_start, month_year_label, next_month_start
from regiocast.functions.regions import normalise_region


def test_as_date_is_lenient():
    assert as_date("2021-1-31") == dt.date(2021, 1, 31)
    assert as_date(dt.datetime(2021, 2, 3, 10)) == dt.date(2021, 2, 3)


def test_month_helpers(spark):
    df = spark.createDataFrame([(dt.date(2021, 2, 10),), (dt.date(2020, 2, 29),), (dt.date(2021, 12, 31),)], "d date")
    rows = df.select(
        month_start("d").alias("m"),
        days_in_month("d").alias("n"),
        next_month_start("d").alias("nx"),
        month_year_label("d").alias("label"),
        date_label("d").alias("day"),
    ).collect()
    assert [(r.m, r.n, r.nx, r.label, r.day) for r in rows] == [
        (dt.date(2021, 2, 1), 28, dt.date(2021, 3, 1), "2-2021", "10-02-2021"),
        (dt.date(2020, 2, 1), 29, dt.date(2020, 3, 1), "2-2020", "29-02-2020"),
        (dt.date(2021, 12, 1), 31, dt.date(2022, 1, 1), "12-2021", "31-12-2021"),
    ]


def test_normalise_region(spark):
    df = spark.createDataFrame([("A / X",), ("B",), ("Provincia Autonoma Trento/Other",)], "r string")
    assert [r[0] for r in df.select(normalise_region("r")).collect()] == ["A", "B", "Provincia Autonoma Trento"]


def test_integer_division_directions(spark):
    df = spark.createDataFrame([(-7, 2), (7, 2), (-8, 2), (-1, 4), (0, 3)], "a long, b long")
    rows = df.selectExpr(f"{trunc_div_sql('a', 'b')} AS t", f"{floor_div_pos_sql('a', 'b')} AS f").collect()
    assert [(r.t, r.f) for r in rows] == [(-3, -4), (3, 3), (-4, -4), (0, -1), (0, 0)]


def test_round_is_not_half_up(spark):
    # why the forecast uses floor(x + 1/2): Spark's round() rounds half away from zero
    assert spark.range(1).select(F.round(F.lit(-1.5))).first()[0] == -2.0
