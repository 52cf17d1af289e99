"""Independent DuckDB SQL for every SQL-expressible query of the registry.

Tables ``lineitem supplier nation region customer`` are views over the same
Parquet files.  The forecast is evaluated with HUGEINT integer arithmetic
(``//`` truncates toward zero, like Spark's ``div``); a bare
``CAST(double AS BIGINT)`` would round in DuckDB, so it is never used on a
fractional value.
"""

from __future__ import annotations

from regiocast.functions.dates import as_date
from regiocast.registry import (
    CLUSTERS_K,
    COVERAGE_START_AFTER,
    LANDED_START_AFTER,
    MIN_POINTS,
    MONTHLY_START_AFTER,
    SERIES_CHUNK,
    TARGET_DATE,
    TOP_N,
    TREND_REGION,
)

M_START = f"DATE '{as_date(MONTHLY_START_AFTER).isoformat()}'"
L_START = f"DATE '{as_date(LANDED_START_AFTER).isoformat()}'"
C_START = f"DATE '{as_date(COVERAGE_START_AFTER).isoformat()}'"
TARGET = f"DATE '{as_date(TARGET_DATE).isoformat()}'"


def _base(qualified: bool = False) -> str:
    region = "n.n_name || ' / ' || r.r_name" if qualified else "n.n_name"
    join_region = "JOIN region r ON n.n_regionkey = r.r_regionkey" if qualified else ""
    return f"""
sr AS (
  SELECT s.s_suppkey AS suppkey, {region} AS region
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey {join_region}
),
doses AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, sr.region, l.l_returnflag AS age,
         CAST(l.l_quantity AS BIGINT) AS women
  FROM lineitem l JOIN sr ON l.l_suppkey = sr.suppkey
),
summary AS (
  SELECT date, region, CAST(SUM(women) AS BIGINT) AS total FROM doses GROUP BY date, region
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


DAILY = f"""
daily AS (
  SELECT date, age, region, CAST(SUM(women) AS BIGINT) AS women
  FROM doses WHERE date > {M_START} GROUP BY date, age, region
)"""

CENTERS = """
centers AS (
  SELECT n.n_name AS region, COUNT(*) AS centers
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name
)"""

POPULATION = """
population AS (
  SELECT trim(split_part(n.n_name || ' / ' || r.r_name, '/', 1)) AS region, COUNT(*) AS population
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1
)"""


def _month_fit(min_points: int) -> str:
    having = f"HAVING COUNT(*) >= {min_points}" if min_points > 1 else ""
    return f"""
pts AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month, age, region,
         CAST(day(date) AS HUGEINT) AS x, CAST(women AS HUGEINT) AS y
  FROM daily
),
fit AS (
  SELECT month, age, region, COUNT(*) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * y) AS sxy, SUM(x * x) AS sxx,
         CAST(day(last_day(month)) + 1 AS HUGEINT) AS x0
  FROM pts GROUP BY month, age, region {having}
),
calc AS (
  SELECT *, n * sxx - sx * sx AS d FROM fit
),
calc2 AS (
  SELECT *, sy * d + (n * sxy - sx * sy) * (n * x0 - sx) AS num, n * d AS den FROM calc
)"""


TRUNC = "CASE WHEN d = 0 THEN 0 ELSE CAST(num // den AS BIGINT) END"
HALF_UP = (
    "CASE WHEN d = 0 THEN 0 WHEN 2 * num + den >= 0 THEN CAST((2 * num + den) // (2 * den) AS BIGINT) "
    "ELSE CAST(-((2 * den - 1 - (2 * num + den)) // (2 * den)) AS BIGINT) END"
)


def _forecast(min_points: int, rounding: str, value: str) -> str:
    expr = TRUNC if rounding == "trunc" else HALF_UP
    return (
        _month_fit(min_points)
        + f""",
pred AS (
  SELECT CAST(month + INTERVAL 1 MONTH AS DATE) AS date, age, region, {expr} AS {value} FROM calc2
)"""
    )


def _top(value: str) -> str:
    return f"""
top AS (
  SELECT *, row_number() OVER (PARTITION BY date, age ORDER BY {value} DESC, region ASC) AS rnk FROM pred
)"""


COVERAGE_FIT = f"""
s3 AS (
  SELECT trim(split_part(region, '/', 1)) AS region, CAST(date - {C_START} AS HUGEINT) AS x,
         CAST(total AS HUGEINT) AS y
  FROM summary WHERE date > {C_START}
),
fit3 AS (
  SELECT region, COUNT(*) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * y) AS sxy, SUM(x * x) AS sxx,
         CAST({TARGET} - {C_START} AS HUGEINT) AS x0
  FROM s3 GROUP BY region
),
calc3 AS (SELECT *, n * sxx - sx * sx AS d FROM fit3),
calc4 AS (SELECT *, sy * d + (n * sxy - sx * sy) * (n * x0 - sx) AS num, n * d AS den FROM calc3),
pred3 AS (
  SELECT region, CAST(sy AS BIGINT) AS total,
         CASE WHEN d = 0 THEN 0 ELSE CAST(num // den AS BIGINT) END AS predicted
  FROM calc4
)"""

MONTHLY = f"""
monthly AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS date, region, CAST(SUM(total) AS BIGINT) AS total
  FROM summary WHERE date > {M_START} GROUP BY 1, 2
)"""

TREND_MONTHS = f"""
months AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month, age, CAST(SUM(women) AS BIGINT) AS women
  FROM doses WHERE region = '{TREND_REGION}' AND date > {M_START} GROUP BY 1, 2
)"""

#: K-means of one feature from seeds by key digest, one step a row of the recursion.
STABLE_KMEANS = f"""
points AS MATERIALIZED (SELECT region, percent AS x FROM cov),
seeds AS (
  SELECT list_sort(list(x)) AS c FROM (
    SELECT x, min(md5('1' || chr(1) || region)) AS d FROM points GROUP BY x ORDER BY d, x LIMIT {CLUSTERS_K})
),
steps AS (
  SELECT 0 AS step, c, CAST(NULL AS DOUBLE[]) AS before FROM seeds
  UNION ALL
  SELECT step + 1, (
    SELECT list_sort(list(m)) FROM (
      SELECT CAST(SUM(CAST(x AS DECIMAL(28, 12))) AS DOUBLE) / COUNT(*) AS m
      FROM (SELECT x, list_position(list_transform(s.c, lambda v: (x - v) * (x - v)), list_min(list_transform(s.c, lambda v: (x - v) * (x - v)))) AS k FROM points)
      GROUP BY k)), c
  FROM steps s WHERE step < 100 AND c IS DISTINCT FROM before
),
done AS (SELECT c FROM steps ORDER BY step DESC LIMIT 1)"""

C1 = _with(_base(), MONTHLY, CENTERS) + """
SELECT m.date, m.region,
       (CAST(m.total AS DOUBLE) / CAST(day(last_day(m.date)) AS DOUBLE)) / CAST(c.centers AS DOUBLE) AS mean_vacc_center
FROM monthly m JOIN centers c ON m.region = c.region
ORDER BY m.date, m.region"""

C2 = _with(_base(), DAILY, _forecast(MIN_POINTS, "trunc", "vacc_women"), _top("vacc_women")) + f"""
SELECT date, age, region, vacc_women FROM top WHERE rnk <= {TOP_N}
ORDER BY date, age, vacc_women DESC, region"""

C2_ROUNDED = _with(_base(), DAILY, _forecast(1, "half_up", "predicted"), _top("predicted")) + f"""
SELECT date, region, age, predicted FROM top WHERE rnk <= {TOP_N}
ORDER BY date, age, predicted DESC, region"""

C3 = _with(_base(qualified=True), COVERAGE_FIT, POPULATION) + f"""
SELECT {TARGET} AS date, p.region,
       ((CAST(p.total AS DOUBLE) + CAST(p.predicted AS DOUBLE)) / CAST(q.population AS DOUBLE)) * 100.0 AS percent
FROM pred3 p JOIN population q ON p.region = q.region
ORDER BY p.region"""

ORACLE_SQL: dict[str, str] = {
    "date_after_filter": _with(_base()) + f"SELECT date, region, total FROM summary WHERE date > {M_START}",
    "sql_view_filter": _with(_base(), DAILY) + "SELECT date, age, region, women FROM daily",
    "string_cast_sum": _with(_base()) + "SELECT region, CAST(SUM(total) AS BIGINT) AS total FROM summary GROUP BY region",
    "month_bucket": _with(_base()) + f"""
SELECT m AS month, CAST(day(last_day(m)) AS BIGINT) AS days_in_month,
       CAST(m + INTERVAL 1 MONTH AS DATE) AS next_month,
       strftime(m, '%Y-%m') AS month_label,
       strftime(CAST(m + INTERVAL 1 MONTH AS DATE), '%d-%m-%Y') AS next_label,
       CAST(month(m) AS VARCHAR) || '-' || CAST(year(m) AS VARCHAR) AS month_year,
       rows
FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS m, COUNT(*) AS rows
      FROM summary WHERE date > {M_START} GROUP BY 1)""",
    "region_normalise": _with(_base(qualified=True))
    + "SELECT DISTINCT region AS raw_region, trim(split_part(region, '/', 1)) AS region FROM summary",
    "struct_flatten": _with(_base(), MONTHLY) + "SELECT date, region, total FROM monthly",
    "monthly_sum": _with(_base(), MONTHLY) + "SELECT date, region, total FROM monthly",
    "daily_sum": _with(_base(), DAILY) + "SELECT date, age, region, women FROM daily",
    "region_total": _with(_base(qualified=True)) + f"""
SELECT trim(split_part(region, '/', 1)) AS region, CAST(SUM(total) AS BIGINT) AS total
FROM summary WHERE date > {C_START} GROUP BY 1""",
    "center_count": _with(CENTERS) + "SELECT region, centers FROM centers",
    "region_join": _with(_base(qualified=True)) + f"""
SELECT t.region, t.total, p.population
FROM (SELECT trim(split_part(region, '/', 1)) AS region, CAST(SUM(total) AS BIGINT) AS total
      FROM summary WHERE date > {C_START} GROUP BY 1) t
JOIN (SELECT trim(split_part(n.n_name || ' / ' || r.r_name, '/', 1)) AS region, COUNT(*) AS population
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY n.n_name, r.r_name) p
ON t.region = p.region""",
    "min_points_filter": _with(_base(), DAILY) + f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, age, region, COUNT(*) AS n_days
FROM daily GROUP BY 1, 2, 3 HAVING COUNT(*) >= {MIN_POINTS}""",
    "rare_key_anti_join": _with(_base(), DAILY) + f"""
SELECT date, age, region, women FROM daily d
WHERE (SELECT COUNT(*) FROM daily e
       WHERE date_trunc('month', e.date) = date_trunc('month', d.date)
         AND e.age = d.age AND e.region = d.region) >= {MIN_POINTS}""",
    "linear_fit": _with(_base(), DAILY, _month_fit(MIN_POINTS)) + f"""
SELECT month, age, region, n, CAST(sx AS BIGINT) AS sum_x, CAST(sy AS BIGINT) AS sum_y,
       CAST(sxy AS BIGINT) AS sum_xy, CAST(sxx AS BIGINT) AS sum_xx, {TRUNC} AS predicted
FROM calc2""",
    "forecast_next_month": _with(_base(), DAILY, _forecast(MIN_POINTS, "trunc", "vacc_women"))
    + "SELECT date, age, region, vacc_women FROM pred",
    "forecast_next_month_rounded": _with(_base(), DAILY, _forecast(1, "half_up", "predicted"))
    + "SELECT date, age, region, predicted FROM pred",
    "forecast_at_date": _with(_base(qualified=True), COVERAGE_FIT) + "SELECT region, predicted FROM pred3",
    "series_collect": _with(_base(), DAILY) + """
SELECT CAST(date_trunc('month', date) AS DATE) AS month, age, region, COUNT(*) AS n_points,
       min(date) AS first_date, arg_min(women, date) AS first_women,
       max(date) AS last_date, arg_max(women, date) AS last_women
FROM daily GROUP BY 1, 2, 3""",
    "monthly_mean_per_center": C1,
    "top_regions_by_forecast": C2,
    "top_regions_by_forecast_rounded": C2_ROUNDED,
    "coverage_percent": C3,
    "region_ranking": _with(_base(), DAILY, _forecast(MIN_POINTS, "trunc", "vacc_women"), _top("vacc_women"))
    + f"""
SELECT region, COUNT(*) AS appearances, CAST(SUM(CASE WHEN rnk = 1 THEN 1 ELSE 0 END) AS BIGINT) AS first_places,
       CAST(MIN(rnk) AS BIGINT) AS best_rank, AVG(rnk) AS mean_rank
FROM top WHERE rnk <= {TOP_N} GROUP BY region
ORDER BY appearances DESC, first_places DESC, region""",
    "category_trend": _with(_base(), TREND_MONTHS) + """
SELECT a.month, a.age, CAST(coalesce(b.women, 0) AS BIGINT) AS women,
       CASE WHEN a.month = a.first THEN NULL ELSE CAST(coalesce(b.women, 0) - coalesce(c.women, 0) AS BIGINT) END AS change
FROM (SELECT age, first, CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS month
      FROM (SELECT age, min(month) AS first, max(month) AS last FROM months GROUP BY age)) a
LEFT JOIN months b ON b.age = a.age AND b.month = a.month
LEFT JOIN months c ON c.age = a.age AND c.month = CAST(a.month - INTERVAL 1 MONTH AS DATE)
ORDER BY a.age, a.month""",
    "csv_roundtrip": C1,
    "sorted_report": _with(_base(), DAILY, _forecast(MIN_POINTS, "trunc", "vacc_women"), _top("vacc_women")) + f"""
SELECT date, age, region, vacc_women, row_number() OVER (ORDER BY date, age, vacc_women DESC, region) AS position
FROM top WHERE rnk <= {TOP_N}""",
    "doses_landing": _with(_base()) + "SELECT date, age, region, CAST(SUM(women) AS BIGINT) AS women FROM doses GROUP BY ALL",
    "single_file_report": f"SELECT *, row_number() OVER (ORDER BY date, region DESC) AS position FROM ({C1})",
    "report_positions": _with(_base(), DAILY)
    + "SELECT date, age, region, women, row_number() OVER (ORDER BY women DESC, date, region, age) AS position FROM daily",
    "series_chunks": _with(_base(), DAILY) + f"""
SELECT age, region, chunk, COUNT(*) AS n_points, min(date) AS first_date, max(date) AS last_date,
       arg_max(women, date) AS last_women, CAST(SUM(women) AS BIGINT) AS women
FROM (SELECT *, (row_number() OVER (PARTITION BY age, region ORDER BY date) - 1) // {SERIES_CHUNK} AS chunk FROM daily)
GROUP BY age, region, chunk""",
    "stream_landing_by_header": _with(_base()) + "SELECT date, age, region, CAST(SUM(women) AS BIGINT) AS women FROM doses GROUP BY ALL",
    "landing_quarantine": _with(_base()) + """
SELECT region, reason, COUNT(*) AS n_rows, CASE WHEN reason = '' THEN CAST(SUM(women) AS BIGINT) END AS total
FROM (SELECT *, concat_ws(',', CASE WHEN women % 11 = 3 THEN 'date' END, CASE WHEN women % 7 = 2 THEN 'total' END) AS reason FROM doses)
GROUP BY region, reason""",
    "landed_month_pruning": C1.replace(M_START, L_START),
    "region_clusters_stable": f"WITH RECURSIVE cov AS ({C3}),{STABLE_KMEANS}"
    + """
SELECT region, x AS percent,
       list_position(list_transform(c, lambda v: (x - v) * (x - v)), list_min(list_transform(c, lambda v: (x - v) * (x - v)))) - 1 AS prediction
FROM points, done""",
    # the percentages are derived here; of the labels the oracle states what must hold for them
    "region_clusters_kmeans": f"SELECT region, percent, true AS nearest, CAST({CLUSTERS_K} AS BIGINT) AS n_clusters FROM ({C3})",
    "region_clusters_bisecting": f"SELECT region, percent, true AS interval, CAST({CLUSTERS_K} AS BIGINT) AS n_clusters FROM ({C3})",
    "stream_landing": _with(_base()) + "SELECT date, region, total FROM summary",
}
