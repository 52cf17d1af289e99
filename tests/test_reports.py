import datetime as dt

from regiocast.plans.reports import category_trend

D = dt.date


def test_a_missing_month_counts_as_none(spark):
    rows = [(D(2021, 1, 5), "A", "20-29", 10), (D(2021, 1, 6), "A", "20-29", 2), (D(2021, 4, 1), "A", "20-29", 5), (D(2021, 2, 1), "A", None, 1), (D(2021, 2, 1), "B", "20-29", 9)]
    doses = spark.createDataFrame(rows, "date date, region string, age string, women long")
    got = [(r.month.month, r.age, r.women, r.change) for r in category_trend(doses, "A").collect()]
    assert got == [(2, None, 1, None), (1, "20-29", 12, None), (2, "20-29", 0, -12), (3, "20-29", 0, 0), (4, "20-29", 5, 5)]
    assert category_trend(doses, "nowhere").collect() == []
