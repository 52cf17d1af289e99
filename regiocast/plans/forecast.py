"""Per month and age band, the regions forecast to vaccinate most women on
the first day of the next month.

Two option sets reproduce the reference's two implementations:
``min_points=2, rounding='trunc'`` (RDD job) and ``min_points=1,
rounding='half_up'`` (SQL job).  Ranking is on the integer forecast, ties
broken by region name.

The fit needs per-day sums, but only through five numbers: Sy and Sxy are
linear in the rows, and the days present (n, Sx, Sxx) are kept as a 31-bit
mask (``bit_or``).  So the whole fit is ONE partial aggregate over the input
rows, with constant state per group - no per-day aggregate and shuffle first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.functions.dates import sql_date
from regiocast.operators.ranking import top_n_per_group
from regiocast.operators.regression import bit_power_sum_sql, checked_sum, prediction_sql


def month_fit_sql(start_after: str | _dt.date, min_points: int) -> str:
    """(month, age, region, n, sum_x, sum_y, sum_xy, sum_xx) over ``{doses}``; x = day of month."""
    having = f"WHERE bit_count(days) >= {int(min_points)}" if min_points > 1 else ""
    return f"""
        SELECT month, age, region,
               CAST(bit_count(days) AS BIGINT) AS n,
               CAST({bit_power_sum_sql("days", 31, 1, offset=1)} AS BIGINT) AS sum_x,
               sum_y, sum_xy,
               CAST({bit_power_sum_sql("days", 31, 2, offset=1)} AS BIGINT) AS sum_xx
        FROM (SELECT trunc(date, 'MM') AS month, age, region,
                     bit_or(shiftleft(CAST(1 AS BIGINT), dayofmonth(date) - 1)) AS days,
                     {checked_sum("CAST(women AS BIGINT)", "women")} AS sum_y,
                     {checked_sum("try_multiply(CAST(dayofmonth(date) AS BIGINT), CAST(women AS BIGINT))", "women")} AS sum_xy
              FROM {{doses}} WHERE date > {sql_date(start_after)}
              GROUP BY trunc(date, 'MM'), age, region)
        {having}"""


def month_fit(doses: DataFrame, start_after: str | _dt.date, min_points: int = 2) -> DataFrame:
    return doses.sparkSession.sql(month_fit_sql(start_after, min_points), doses=doses)


def _forecast_sql(start_after, min_points, rounding, value_col) -> str:
    x0 = "dayofmonth(last_day(month)) + 1"
    return f"""
        SELECT add_months(month, 1) AS date, age, region, {prediction_sql(x0, rounding)} AS {value_col}
        FROM ({month_fit_sql(start_after, min_points)})"""


def forecast_next_month(
    doses: DataFrame,
    start_after: str | _dt.date,
    min_points: int = 2,
    rounding: str = "trunc",
    value_col: str = "vacc_women",
) -> DataFrame:
    """(date = first of next month, age, region, value_col BIGINT)."""
    return doses.sparkSession.sql(_forecast_sql(start_after, min_points, rounding, value_col), doses=doses)


def top_regions_by_forecast(
    doses: DataFrame,
    start_after: str | _dt.date,
    n: int = 5,
    min_points: int = 2,
    rounding: str = "trunc",
    value_col: str = "vacc_women",
    rank_col: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """(date, age, region, value_col[, rank_col]): at most ``n`` rows per (date, age)."""
    predicted = forecast_next_month(doses, start_after, min_points, rounding, value_col)
    top = top_n_per_group(predicted, ["date", "age"], [f"{value_col} DESC", "region"], n, rank_col)
    return top.orderBy("date", "age", F.desc(value_col), "region") if ordered else top


def top_regions_by_forecast_rounded(
    doses: DataFrame, start_after: str | _dt.date, n: int = 5, ordered: bool = True
) -> DataFrame:
    """The SQL job's option set: every group fitted, forecast rounded half up.

    Columns (date, region, age, predicted).
    """
    top = top_regions_by_forecast(
        doses, start_after, n, min_points=1, rounding="half_up", value_col="predicted", ordered=ordered
    )
    return top.select("date", "region", "age", "predicted")
