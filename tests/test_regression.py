"""The exact forecast against Python's exact rationals, and its invariances."""

import datetime as dt
from fractions import Fraction
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regiocast.operators.regression import linear_fit, predict_at
from regiocast.plans.coverage import coverage_percent, forecast_at_date
from regiocast.plans.forecast import top_regions_by_forecast


def brute(points, x0, rounding):
    n = len(points)
    sx = sum(x for x, _ in points)
    sy = sum(y for _, y in points)
    sxx = sum(x * x for x, _ in points)
    sxy = sum(x * y for x, y in points)
    d = n * sxx - sx * sx
    if d == 0:
        return 0
    value = Fraction(sy, n) + Fraction(n * sxy - sx * sy, d) * (x0 - Fraction(sx, n))
    if rounding == "trunc":
        return math.trunc(value)
    return math.floor(value + Fraction(1, 2))


groups = st.lists(
    st.lists(st.tuples(st.integers(1, 40), st.integers(-10**6, 10**9)), min_size=1, max_size=12),
    min_size=1,
    max_size=6,
)


@settings(max_examples=15, deadline=None)
@given(groups=groups, x0=st.integers(-50, 3000), rounding=st.sampled_from(["trunc", "half_up"]))
def test_prediction_is_exact(spark, groups, x0, rounding):
    rows = [(g, x, y) for g, pts in enumerate(groups) for x, y in pts]
    df = spark.createDataFrame(rows, "g int, x bigint, y bigint")
    got = {r.g: r.predicted for r in predict_at(linear_fit(df, ["g"], "x", "y"), x0, rounding).collect()}
    assert got == {g: brute(pts, x0, rounding) for g, pts in enumerate(groups)}


def test_exact_line_and_partition_invariance(spark):
    rows = [("a", x, 7 * x - 3) for x in range(1, 30)] + [("b", x, 5) for x in range(3, 9)]
    df = spark.createDataFrame(rows, "g string, x bigint, y bigint")
    one = {r.g: r.predicted for r in predict_at(linear_fit(df.coalesce(1), ["g"], "x", "y"), 100).collect()}
    many = {r.g: r.predicted for r in predict_at(linear_fit(df.repartition(7), ["g"], "x", "y"), 100).collect()}
    assert one == many == {"a": 697, "b": 5}


def test_fit_line_on_doubles(spark):
    from regiocast.operators.regression import fit_line

    rows = [("a", float(x), 0.5 * x + 2.0) for x in range(10)] + [("b", 1.0, 3.0)]
    out = {r.g: r for r in fit_line(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y").collect()}
    assert abs(out["a"].slope - 0.5) < 1e-12 and abs(out["a"].intercept - 2.0) < 1e-12 and out["a"].n == 10
    assert out["b"].slope is None  # one point has no line


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_overflow_fails_and_never_answers_from_a_part(spark, ansi):
    big = 4 * 10**18
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for points in ([(1, big), (2, big), (3, big)], [(4, big), (1, 3), (2, 5)]):  # the sum, or one product, leaves 64 bits
            df = spark.createDataFrame([("g", x, y) for x, y in points], "g string, x bigint, y bigint")
            with pytest.raises(Exception, match="leaves 64 bits"):
                predict_at(linear_fit(df, ["g"], "x", "y"), 4).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("points", ["rows", "daily"])
def test_overflowing_coverage_fails(spark, points):
    start = dt.date(2020, 1, 1)
    for values in ([(1, 6 * 10**18), (2, 6 * 10**18)], [(1, 15), (90, 2 * 10**17), (700, 2 * 10**16)]):  # a sum, one word's products
        df = spark.createDataFrame([(start + dt.timedelta(days=x), "A", y) for x, y in values], "date date, region string, total bigint")
        with pytest.raises(Exception, match="leaves 64 bits"):
            forecast_at_date(df, start, start + dt.timedelta(days=3), points=points).collect()


def test_overflowing_forecast_is_no_low_rank(spark):
    rows = [(dt.date(2021, 2, d), r, "a", v) for r, v in (("big", 6 * 10**18), ("small", 29)) for d in (1, 2)]
    df = spark.createDataFrame(rows, "date date, region string, age string, women bigint")
    with pytest.raises(Exception, match="leaves 64 bits"):
        top_regions_by_forecast(df, "2021-1-31").collect()


def test_points_are_rows_or_days(spark):
    day = [dt.date(2021, 1, d) for d in range(1, 5)]
    df = spark.createDataFrame([(day[1], "A", 10), (day[1], "A", 10), (day[2], "A", 30)], "date date, region string, total bigint")
    for points, want in (("rows", 50), ("daily", 40)):
        (row,) = forecast_at_date(df, day[0], day[3], points=points).collect()
        assert row.predicted == want


def test_target_is_tomorrow_in_the_session_time_zone(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 2), "A", 1)], "date date, region string, total bigint")
    pop = spark.createDataFrame([("A", 10)], "region string, population bigint")
    (row,) = coverage_percent(df, pop, "2021-1-1").collect()
    assert row.date == spark.sql("SELECT current_date() + 1").first()[0]


# The C2 fit keeps the days present as a bit mask instead of summing per day
# first; against brute force: daily sums, then the exact line at day len+1.
month_rows = st.lists(
    st.tuples(st.sampled_from(["R1", "R2"]), st.integers(1, 28), st.integers(-50, 10**6)), min_size=1, max_size=40
)


@settings(max_examples=10, deadline=None)
@given(rows=month_rows, min_points=st.sampled_from([1, 2, 3]), rounding=st.sampled_from(["trunc", "half_up"]))
def test_month_fit_matches_brute_force(spark, rows, min_points, rounding):
    import datetime as dt

    from regiocast.plans.forecast import forecast_next_month

    df = spark.createDataFrame(
        [(dt.date(2021, 2, day), region, "a", women) for region, day, women in rows],
        "date date, region string, age string, women bigint",
    )
    got = {r.region: r.v for r in forecast_next_month(df, "2021-1-31", min_points, rounding, "v").collect()}
    want = {}
    for region in {r for r, _, _ in rows}:
        daily = {}
        for r, day, women in rows:
            if r == region:
                daily[day] = daily.get(day, 0) + women
        if len(daily) >= min_points:
            want[region] = brute(sorted(daily.items()), 29, rounding)
    assert got == want


# The coverage fit keeps each (region, raw name)'s days as 64-bit words, so it
# accepts rows finer than one per day; against brute force over daily points.
cov_rows = st.lists(
    st.tuples(st.sampled_from(["A / X", "A / Y", "B"]), st.integers(1, 300), st.integers(-100, 10**7)),
    min_size=1,
    max_size=40,
)


@settings(max_examples=10, deadline=None)
@given(rows=cov_rows, target=st.integers(1, 2000))
def test_coverage_fit_matches_brute_force(spark, rows, target):
    import datetime as dt

    from regiocast.plans.coverage import forecast_at_date

    start = dt.date(2020, 1, 1)
    df = spark.createDataFrame(
        [(start + dt.timedelta(days=x), raw, total) for raw, x, total in rows],
        "date date, region string, total bigint",
    )
    got = {
        r.region: (r.n, r.predicted)
        for r in forecast_at_date(df, start, start + dt.timedelta(days=target), points="daily").collect()
    }
    points = {}
    for raw, x, total in rows:
        points[(raw, x)] = points.get((raw, x), 0) + total
    want = {}
    for region in {raw.split("/")[0].strip() for raw, _, _ in rows}:
        pts = [(x, y) for (raw, x), y in points.items() if raw.split("/")[0].strip() == region]
        want[region] = (len(pts), brute(pts, target, "trunc"))
    assert got == want


def test_large_groups_fall_back_to_exact_decimals(spark):
    # sum_y * D leaves 64 bits here: the checked long form gives NULL and the
    # decimal form answers, exactly
    pts = [(1, 3 * 10**15 + 7), (2, 10**15), (5, 4 * 10**15 + 1), (31, 2 * 10**15 + 3)]
    df = spark.createDataFrame([("g", x, y) for x, y in pts], "g string, x bigint, y bigint")
    for rounding in ("trunc", "half_up"):
        (row,) = predict_at(linear_fit(df, ["g"], "x", "y"), 32, rounding).collect()
        assert row.predicted == brute(pts, 32, rounding)
