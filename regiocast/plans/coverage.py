"""Forecast per region at a target day, coverage as a percentage of
the population, and clustering of regions by coverage.

The region total (A3) and the regression sums (A7) come from ONE aggregate:
the total is the fit's Sy.  The reference computed them in two passes and
joined them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from regiocast.functions.dates import as_date, sql_date
from regiocast.functions.regions import normalise_region_sql
from regiocast.operators.clustering import cluster
from regiocast.operators.regression import bit_power_sum_sql, checked_sum, fit_aggregates, prediction_sql

NORMALISED = normalise_region_sql("region")


POINTS = ("rows", "daily")


def _target(spark: SparkSession, target_date: str | _dt.date | None) -> _dt.date:
    """The given day, or tomorrow in the session's time zone."""
    if target_date is not None:
        return as_date(target_date)
    return spark.sql("SELECT current_date() + 1").first()[0]


def _sums(start: _dt.date, region: str, points: str) -> str:
    """(region, n, sum_x, sum_y, sum_xy, sum_xx) over ``{summary}``; x = days after ``start``."""
    rows = f"(SELECT region, datediff(date, {sql_date(start)}) AS x, total AS y FROM {{summary}} WHERE date > {sql_date(start)})"
    if points == "rows":
        return f"SELECT {region} AS region, {', '.join(fit_aggregates('x', 'y'))} FROM {rows} GROUP BY {region}"
    s1, s2 = (f"CAST({bit_power_sum_sql('mask', 64, power)} AS BIGINT)" for power in (1, 2))
    first = "try_add(try_multiply(64 * w, cnt), s1)"
    second = "try_add(try_add(try_multiply(try_multiply(4096 * w, w), cnt), try_multiply(128 * w, s1)), s2)"
    return f"""
        SELECT region, CAST(SUM(cnt) AS BIGINT) AS n, {checked_sum(first, "cnt")} AS sum_x, {checked_sum("sy", "sy")} AS sum_y,
               {checked_sum("sxy", "sxy")} AS sum_xy, {checked_sum(second, "cnt")} AS sum_xx
        FROM (SELECT {region} AS region, w, CAST(bit_count(mask) AS BIGINT) AS cnt, {s1} AS s1, {s2} AS s2, sy, sxy
              FROM (SELECT region, x div 64 AS w,
                           bit_or(shiftleft(CAST(1 AS BIGINT), x % 64)) AS mask,
                           {checked_sum("CAST(y AS BIGINT)", "y")} AS sy,
                           {checked_sum("try_multiply(CAST(x AS BIGINT), CAST(y AS BIGINT))", "y")} AS sxy
                    FROM {rows} GROUP BY region, x div 64))
        GROUP BY region"""


def _forecast_sql(start_after: str | _dt.date, target: _dt.date, rounding: str, normalise: bool, points: str) -> str:
    """Fit per region of its points, evaluated at the target day.

    ``rows``: each input row is a point, as in the reference.  ``daily``: rows
    of one raw region on one date add up to one point.  For that each raw
    region keeps the days it has as 64-bit words (``x div 64``, bit
    ``x % 64``), and Sy, Sxy, which are linear in the rows, as plain sums;
    names are normalised on those few rows, not per input row.  With x = 64 w
    + b over the set bits b of word w:  n = sum cnt, Sx = sum (64 w cnt + s1),
    Sxx = sum (4096 w^2 cnt + 128 w s1 + s2), where cnt, s1, s2 are the count,
    sum and sum of squares of the word's bits.  So neither needs a per-day
    aggregate: a scan task's partials are regions, or (regions x words), rows.
    """
    if points not in POINTS:
        raise ValueError(f"points must be one of {POINTS}")
    start = as_date(start_after)
    region = NORMALISED if normalise else "region"
    return f"""
        SELECT region, n, sum_x, sum_y, sum_xy, sum_xx, {prediction_sql(str((target - start).days), rounding)} AS predicted
        FROM ({_sums(start, region, points)})"""


def forecast_at_date(
    summary: DataFrame,
    start_after: str | _dt.date,
    target_date: str | _dt.date | None = None,
    rounding: str = "trunc",
    normalise: bool = True,
    points: str = "rows",
) -> DataFrame:
    """(region, n, sum_x, sum_y, sum_xy, sum_xx, predicted): the line through each
    region's points, at ``target_date`` (default: tomorrow).

    ``points='rows'`` takes each row as a point; ``'daily'`` sums the rows of
    one (date, raw region name) first, so it accepts finer rows (line items).
    x counts days after ``start_after``; the forecast does not depend on the
    origin.
    """
    text = _forecast_sql(start_after, _target(summary.sparkSession, target_date), rounding, normalise, points)
    return summary.sparkSession.sql(text, summary=summary)


def coverage_percent(
    summary: DataFrame,
    population: DataFrame,
    start_after: str | _dt.date,
    target_date: str | _dt.date | None = None,
    ordered: bool = True,
    points: str = "rows",
) -> DataFrame:
    """(date, region, percent): (total so far + forecast) / population * 100, by region.

    Population rows are summed per normalised region, so a region listed
    twice cannot multiply result rows.
    """
    target = _target(summary.sparkSession, target_date)
    order = "ORDER BY p.region" if ordered else ""
    return summary.sparkSession.sql(
        f"""
        SELECT {sql_date(target)} AS date, p.region,
               ((CAST(CAST(p.sum_y AS BIGINT) AS DOUBLE) + CAST(p.predicted AS DOUBLE))
                 / CAST(q.population AS DOUBLE)) * 100.0 AS percent
        FROM ({_forecast_sql(start_after, target, "trunc", True, points)}) p
        JOIN (SELECT {NORMALISED} AS region, SUM(population) AS population
              FROM {{population}} GROUP BY {NORMALISED}) q
          ON p.region = q.region
        {order}""",
        summary=summary,
        population=population,
    )


def coverage_clusters(
    summary: DataFrame,
    population: DataFrame,
    start_after: str | _dt.date,
    target_date: str | _dt.date | None,
    k: int,
    algorithm: str = "kmeans",
    seed: int = 1,
    points: str = "rows",
    fit_partitions: int = 1,
) -> DataFrame:
    """(date, region, percent, prediction): regions clustered by coverage."""
    cov = coverage_percent(summary, population, start_after, target_date, ordered=False, points=points)
    return cluster(cov, ["percent"], k, algorithm, seed, order_by=["region"], fit_partitions=fit_partitions).select(
        "date", "region", "percent", "prediction"
    )
