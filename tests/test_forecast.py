"""Fixture B: top regions by next-month forecast, both option sets."""

import datetime as dt

import pytest

from regiocast.plans.forecast import forecast_next_month, top_regions_by_forecast, top_regions_by_forecast_rounded

D = dt.date
MARCH = D(2021, 3, 1)

# (region, [(day of Feb 2021, women), ...]) for age band 20-29
BAND_20 = [
    ("R1", [(1, 10), (2, 20)]),
    ("R2", [(1, 500)]),
    ("R3", [(1, 5), (28, 5)]),
    ("R4", [(1, 5), (10, 5)]),
    ("R5", [(1, 30), (3, 10)]),
    ("R6", [(1, 3), (1, 4), (2, 8)]),
    ("R7", [(1, 1), (2, 1)]),
    ("R8", [(1, 0), (4, 2)]),
]
# age band 30-39, forecasts near zero
BAND_30 = [
    ("R1", [(1, 1), (2, 0), (4, 1), (5, 0)]),
    ("R2", [(1, 1), (3, 0), (5, 1), (7, 0)]),
    ("R3", [(25, 0), (26, 1), (27, 1), (28, 0)]),
    ("R4", [(25, 0), (26, -1), (27, -1), (28, 0)]),
]


def _doses(spark, bands):
    rows = [(D(2021, 1, 31), "R7", "20-29", 9999)]  # not strictly after the start: excluded
    for age, regions in bands:
        for region, points in regions:
            rows += [(D(2021, 2, day), region, age, women) for day, women in points]
    return spark.createDataFrame(rows, "date date, region string, age string, women bigint").repartition(3)


@pytest.fixture(scope="module")
def doses(spark):
    return _doses(spark, [("20-29", BAND_20), ("30-39", BAND_30)])


def _pairs(df, age, col):
    return [(r.region, r[col]) for r in df.where(df.age == age).collect()]


def test_top5_trunc(doses):
    top = top_regions_by_forecast(doses, "2021-1-31", n=5, min_points=2, rounding="trunc")
    assert {r.date for r in top.collect()} == {MARCH}
    assert _pairs(top, "20-29", "vacc_women") == [("R1", 290), ("R6", 35), ("R8", 18), ("R3", 5), ("R4", 5)]


def test_short_groups_are_returned_whole(doses):
    top = top_regions_by_forecast(doses, "2021-1-31", n=20)
    assert len(_pairs(top, "20-29", "vacc_women")) == 7  # R2 has one day only
    assert _pairs(top, "30-39", "vacc_women") == [("R3", 0), ("R4", 0), ("R1", -2), ("R2", -2)]


def test_rounded_variant(doses):
    top = top_regions_by_forecast_rounded(doses, "2021-1-31", n=5)
    assert top.columns == ["date", "region", "age", "predicted"]
    assert _pairs(top, "30-39", "predicted") == [("R3", 1), ("R4", 0), ("R1", -2), ("R2", -2)]
    # a single point has no line: forecast 0, kept when min_points is 1
    assert ("R2", 0) in _pairs(top_regions_by_forecast_rounded(doses, "2021-1-31", n=20), "20-29", "predicted")
    assert dict(_pairs(top, "20-29", "predicted"))["R8"] == 19


def test_forecast_values_trunc_vs_half_up(doses):
    t = {r.region: r.vacc_women for r in forecast_next_month(doses, "2021-1-31").where("age = '20-29'").collect()}
    assert t == {"R1": 290, "R3": 5, "R4": 5, "R5": -250, "R6": 35, "R7": 1, "R8": 18}
