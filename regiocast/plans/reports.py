"""The two dashboard tables, as report queries.

``region_ranking``: for each region, how often and how high it appears in the
top-n forecast tables.  ``category_trend``: for one region, the monthly total
of each age band and its change from the month before.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from regiocast.functions.dates import sql_date


def region_ranking(top: DataFrame, rank_col: str = "rank", ordered: bool = True) -> DataFrame:
    """(region, appearances, first_places, best_rank, mean_rank) from a ranked top-n table."""
    order = "ORDER BY appearances DESC, first_places DESC, region" if ordered else ""
    return top.sparkSession.sql(
        f"""
        SELECT region, COUNT(1) AS appearances,
               CAST(SUM(CASE WHEN `{rank_col}` = 1 THEN 1 ELSE 0 END) AS BIGINT) AS first_places,
               CAST(MIN(`{rank_col}`) AS BIGINT) AS best_rank, AVG(`{rank_col}`) AS mean_rank
        FROM {{top}} GROUP BY region {order}""",
        top=top,
    )


def category_trend(
    doses: DataFrame, region: str, start_after: str | _dt.date | None = None, ordered: bool = True
) -> DataFrame:
    """(month, age, women, change) for one region, a row for every month from a band's first to its last.

    A month without rows counts 0, so ``change`` is always from the calendar
    month before; it is NULL for a band's first month.  The window is
    partitioned by age band over already-aggregated months, so each window
    partition holds one row per month.
    """
    after = f"AND date > {sql_date(start_after)}" if start_after is not None else ""
    order = "ORDER BY age, month" if ordered else ""
    return doses.sparkSession.sql(
        f"""
        WITH totals AS (
          SELECT trunc(date, 'MM') AS month, age, SUM(women) AS women
          FROM {{doses}} WHERE region = :region {after}
          GROUP BY trunc(date, 'MM'), age),
        spine AS (
          SELECT age, explode(sequence(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM totals GROUP BY age),
        every AS (
          SELECT s.month, s.age, coalesce(t.women, 0) AS women
          FROM spine s LEFT JOIN totals t ON t.age <=> s.age AND t.month = s.month)
        SELECT month, age, women, women - lag(women) OVER (PARTITION BY age ORDER BY month) AS change
        FROM every {order}""",
        args={"region": region},
        doses=doses,
    )
