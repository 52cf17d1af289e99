"""Mean vaccinations per day of a generic centre, per region and month."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from regiocast.functions.dates import sql_date


def monthly_mean_per_center(
    summary: DataFrame, centers: DataFrame, start_after: str | _dt.date, ordered: bool = True
) -> DataFrame:
    """(date = first of month, region, mean_vacc_center), sorted by (date, region).

    mean = (month total / days in the month) / centres, in that order, so the
    doubles are identical to the reference's.  A month still running is
    divided by its full length.  Regions without centres (or without data)
    drop out of the inner join.  Both sides are aggregated before the join
    (months x regions, and regions), so the planner broadcasts one at run time.
    """
    order = "ORDER BY m.date, m.region" if ordered else ""
    return summary.sparkSession.sql(
        f"""
        SELECT m.date, m.region,
               (CAST(m.total AS DOUBLE) / CAST(dayofmonth(last_day(m.date)) AS DOUBLE))
                 / CAST(c.centers AS DOUBLE) AS mean_vacc_center
        FROM (SELECT trunc(date, 'MM') AS date, region, SUM(total) AS total
              FROM {{summary}} WHERE date > {sql_date(start_after)}
              GROUP BY trunc(date, 'MM'), region) m
        JOIN (SELECT region, COUNT(1) AS centers FROM {{centers}} GROUP BY region) c
          ON m.region = c.region
        {order}
        """,
        summary=summary,
        centers=centers,
    )
