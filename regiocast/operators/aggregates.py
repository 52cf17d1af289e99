"""Grouped sums and counts (A1-A5).

Every aggregate here is algebraic (sum/count), so Spark plans a partial
aggregate before the shuffle: a hot key is summed map-side and reaches the
exchange as one row per task.  Each operator is one parameterised SQL
statement over its input DataFrame.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from regiocast.functions.dates import sql_after
from regiocast.functions.regions import normalise_region_sql

NORMALISED_REGION = normalise_region_sql("region")


def _sql(df: DataFrame, text: str) -> DataFrame:
    return df.sparkSession.sql(text, t=df)


def sum_by(df: DataFrame, keys: list[str], value: str, alias: str | None = None) -> DataFrame:
    cols = ", ".join(f"`{k}`" for k in keys)
    return _sql(df, f"SELECT {cols}, SUM(`{value}`) AS `{alias or value}` FROM {{t}} GROUP BY {cols}")


def daily_sum(
    doses: DataFrame, start_after: str | _dt.date | None = None, value: str = "women", alias: str = "women"
) -> DataFrame:
    """(A2) Sum per (date, age, region), keeping dates strictly after ``start_after``."""
    return _sql(
        doses,
        f"SELECT date, age, region, SUM({value}) AS {alias} FROM {{t}} {sql_after(start_after)} "
        "GROUP BY date, age, region",
    )


def monthly_sum(summary: DataFrame, start_after: str | _dt.date | None = None, value: str = "total") -> DataFrame:
    """(A1) Sum per (first day of month, region)."""
    return _sql(
        summary,
        f"SELECT trunc(date, 'MM') AS date, region, SUM({value}) AS {value} FROM {{t}} {sql_after(start_after)} "
        "GROUP BY trunc(date, 'MM'), region",
    )


def region_total(summary: DataFrame, start_after: str | _dt.date | None = None, value: str = "total") -> DataFrame:
    """(A3) Sum per normalised region."""
    return _sql(
        summary,
        f"SELECT {NORMALISED_REGION} AS region, SUM({value}) AS {value} FROM {{t}} {sql_after(start_after)} "
        f"GROUP BY {NORMALISED_REGION}",
    )


def center_count(centers: DataFrame) -> DataFrame:
    """(A4) One row per centre in, (region, centers) out."""
    return _sql(centers, "SELECT region, COUNT(1) AS centers FROM {t} GROUP BY region")


def min_points_filter(daily: DataFrame, min_points: int = 2) -> DataFrame:
    """(A5) (month, age, region) groups with at least ``min_points`` days: a HAVING."""
    return _sql(
        daily,
        "SELECT trunc(date, 'MM') AS month, age, region, COUNT(1) AS n_days FROM {t} "
        f"GROUP BY trunc(date, 'MM'), age, region HAVING COUNT(1) >= {int(min_points)}",
    )
