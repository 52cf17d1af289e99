"""Registered queries (one per operator of the inventory) and their SQL oracles.

Every query reads the driver tables in ``sf_dir`` whole; the oracle is
independent DuckDB SQL over the same tables.  Parameters map the reference's
dates onto the tables' ship-date range.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.functions import dates
from regiocast.functions.dates import sql_date
from regiocast.operators import aggregates as agg
from regiocast.operators.clustering import stable_kmeans
from regiocast.operators.joins import drop_rare_keys, region_join
from regiocast.operators.ordering import positions, with_positions
from regiocast.operators.regression import linear_fit, predict_at
from regiocast.operators.series import flatten_struct, series_chunks, series_collect, with_struct_key
from regiocast.plans.coverage import coverage_clusters, coverage_percent, forecast_at_date
from regiocast.plans.forecast import (
    forecast_next_month,
    top_regions_by_forecast,
    top_regions_by_forecast_rounded,
)
from regiocast.plans.monthly_mean import monthly_mean_per_center
from regiocast.plans.reports import category_trend, region_ranking
from regiocast.session import cut_lineage, remove_scratch, scratch_path
from regiocast.sources import schemas, tables
from regiocast.sources.landing import land, read_after, type_columns
from regiocast.sources.sinks import read_csv, write_csv
from regiocast.streaming.landing import land_available

# Fixed parameters: the reference's dates moved onto the ship-date range
# (1995-01-02 .. 2001-11-04) of the driver tables.
MONTHLY_START_AFTER = "1995-12-31"  # C1, C2
COVERAGE_START_AFTER = "1994-12-26"  # C3
TARGET_DATE = "2002-02-13"  # C3 forecast day
TOP_N = 5
MIN_POINTS = 2
TREND_REGION = "NATION_3"
CLUSTERS_K = 3
SERIES_CHUNK = 5
LANDED_START_AFTER = "1998-06-15"  # C1 on a landed table: leaves out whole months

Query = Callable[[SparkSession, str], DataFrame]


def _summary(spark: SparkSession, d: str, qualified: bool = False) -> DataFrame:
    return tables.summary(spark, d, qualified)


def _summed(spark: SparkSession, d: str, qualified: bool = False) -> DataFrame:
    """Summary rows before the per-day sum, for operators that sum them into
    their own keys: the sum-only analytics and the coverage fit, which folds
    rows into (date, region) points itself (see ``tables.summary_rows``)."""
    return tables.summary_rows(spark, d, qualified)


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return agg.daily_sum(tables.doses(spark, d), MONTHLY_START_AFTER)


def q_date_after_filter(spark: SparkSession, d: str) -> DataFrame:
    return _summary(spark, d).where(f"date > {sql_date(MONTHLY_START_AFTER)}")


def q_sql_view_filter(spark: SparkSession, d: str) -> DataFrame:
    view = f"regiocast_doses_{uuid.uuid4().hex}"  # calls at a time do not share it
    tables.doses(spark, d).createTempView(view)
    try:
        return spark.sql(
            f"SELECT date, age, region, SUM(women) AS women FROM {view} "
            f"WHERE date > {sql_date(MONTHLY_START_AFTER)} GROUP BY date, age, region"
        )
    finally:  # the plan is resolved by now
        spark.catalog.dropTempView(view)


def q_string_cast_sum(spark: SparkSession, d: str) -> DataFrame:
    landed = type_columns(tables.raw_summary(spark, d), schemas.SUMMARY, on_bad="fail")
    return agg.sum_by(landed, ["region"], "total")


def q_month_bucket(spark: SparkSession, d: str) -> DataFrame:
    days = _summary(spark, d).where(f"date > {sql_date(MONTHLY_START_AFTER)}")
    months = days.groupBy(dates.month_start("date").alias("month")).agg(F.count("*").alias("rows"))
    return months.select(
        "month",
        dates.days_in_month("month").cast("long").alias("days_in_month"),
        dates.next_month_start("month").alias("next_month"),
        dates.date_label("month", "yyyy-MM").alias("month_label"),
        dates.date_label(dates.next_month_start("month")).alias("next_label"),
        dates.month_year_label("month").alias("month_year"),
        "rows",
    )


def q_region_normalise(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(
        f"SELECT DISTINCT region AS raw_region, {agg.NORMALISED_REGION} AS region FROM {{s}}",
        s=_summary(spark, d, qualified=True),
    )


def q_struct_flatten(spark: SparkSession, d: str) -> DataFrame:
    monthly = agg.monthly_sum(_summed(spark, d), MONTHLY_START_AFTER)
    packed = with_struct_key(monthly, ["date", "region"])
    return flatten_struct(packed, "key")


def q_monthly_sum(spark: SparkSession, d: str) -> DataFrame:
    return agg.monthly_sum(_summed(spark, d), MONTHLY_START_AFTER)


def q_daily_sum(spark: SparkSession, d: str) -> DataFrame:
    return _daily(spark, d)


def q_region_total(spark: SparkSession, d: str) -> DataFrame:
    return agg.region_total(_summed(spark, d, qualified=True), COVERAGE_START_AFTER)


def q_center_count(spark: SparkSession, d: str) -> DataFrame:
    return agg.center_count(tables.centers(spark, d))


def q_region_join(spark: SparkSession, d: str) -> DataFrame:
    totals = agg.region_total(_summed(spark, d, qualified=True), COVERAGE_START_AFTER)
    pop = tables.population(spark, d).selectExpr(f"{agg.NORMALISED_REGION} AS region", "population")
    return region_join(totals, pop)


def q_min_points_filter(spark: SparkSession, d: str) -> DataFrame:
    return agg.min_points_filter(_daily(spark, d), MIN_POINTS)


def q_rare_key_anti_join(spark: SparkSession, d: str) -> DataFrame:
    daily = _daily(spark, d).selectExpr("*", "trunc(date, 'MM') AS month")
    kept = drop_rare_keys(daily, ["month", "age", "region"], MIN_POINTS)
    return kept.selectExpr("date", "age", "region", "women")


def q_linear_fit(spark: SparkSession, d: str) -> DataFrame:
    daily = _daily(spark, d).selectExpr("*", "trunc(date, 'MM') AS month", "dayofmonth(date) AS day")
    fit = linear_fit(daily, ["month", "age", "region"], "day", "women").where(f"n >= {MIN_POINTS}")
    pred = predict_at(fit, "dayofmonth(last_day(month)) + 1", "trunc")
    return pred.selectExpr(
        "month", "age", "region", "n", "sum_x", "sum_y", "sum_xy", "sum_xx", "predicted"
    )


def q_forecast_next_month(spark: SparkSession, d: str) -> DataFrame:
    return forecast_next_month(tables.doses(spark, d), MONTHLY_START_AFTER, MIN_POINTS, "trunc")


def q_forecast_next_month_rounded(spark: SparkSession, d: str) -> DataFrame:
    return forecast_next_month(tables.doses(spark, d), MONTHLY_START_AFTER, 1, "half_up", value_col="predicted")


def q_forecast_at_date(spark: SparkSession, d: str) -> DataFrame:
    fit = forecast_at_date(_summed(spark, d, qualified=True), COVERAGE_START_AFTER, TARGET_DATE, points="daily")
    return fit.selectExpr("region", "predicted")


def q_series_collect(spark: SparkSession, d: str) -> DataFrame:
    # bounded groups: one month of distinct days, at most 31 elements
    daily = _daily(spark, d).selectExpr("*", "trunc(date, 'MM') AS month")
    s = series_collect(daily, ["month", "age", "region"], "date", "women")
    return s.selectExpr(
        "month", "age", "region",
        "CAST(size(series) AS BIGINT) AS n_points",
        "series[0].date AS first_date",
        "series[0].women AS first_women",
        "element_at(series, -1).date AS last_date",
        "element_at(series, -1).women AS last_women",
    )


def q_series_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The days of a region and age band over all months, five to an array."""
    s = series_chunks(_daily(spark, d), ["age", "region"], "date", "women", SERIES_CHUNK)
    return s.selectExpr(
        "age", "region", "chunk",
        "CAST(size(series) AS BIGINT) AS n_points",
        "series[0].date AS first_date",
        "element_at(series, -1).date AS last_date",
        "element_at(series, -1).women AS last_women",
        "aggregate(series, 0L, (s, p) -> s + p.women) AS women",
    )


def q_monthly_mean_per_center(spark: SparkSession, d: str) -> DataFrame:
    return monthly_mean_per_center(_summed(spark, d), tables.centers(spark, d), MONTHLY_START_AFTER)


def q_top_regions_by_forecast(spark: SparkSession, d: str) -> DataFrame:
    return top_regions_by_forecast(
        tables.doses(spark, d), MONTHLY_START_AFTER, TOP_N, MIN_POINTS, "trunc"
    )


def q_top_regions_by_forecast_rounded(spark: SparkSession, d: str) -> DataFrame:
    return top_regions_by_forecast_rounded(tables.doses(spark, d), MONTHLY_START_AFTER, TOP_N)


def q_coverage_percent(spark: SparkSession, d: str) -> DataFrame:
    return coverage_percent(
        _summed(spark, d, qualified=True),
        tables.population(spark, d),
        COVERAGE_START_AFTER,
        TARGET_DATE,
        points="daily",
    )


def q_region_ranking(spark: SparkSession, d: str) -> DataFrame:
    top = top_regions_by_forecast(
        tables.doses(spark, d), MONTHLY_START_AFTER, TOP_N, MIN_POINTS, "trunc", rank_col="rank"
    )
    return region_ranking(top)


def q_category_trend(spark: SparkSession, d: str) -> DataFrame:
    return category_trend(tables.doses(spark, d), TREND_REGION, MONTHLY_START_AFTER)


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The whole reference job: analytic, globally sorted CSV with a header, read back."""
    path = scratch_path(spark, "csv")
    write_csv(q_monthly_mean_per_center(spark, d), path, sort_by=["date", "region"])
    back = cut_lineage(read_csv(spark, path, schemas.MONTHLY_MEAN))
    remove_scratch(spark, path)
    return back


def q_sorted_report(spark: SparkSession, d: str) -> DataFrame:
    """The report rows with their position in the sorted output: part by part, row by row."""
    path = scratch_path(spark, "report")
    q_top_regions_by_forecast(spark, d).write.parquet(path)
    rows = spark.read.parquet(path).select("*", "_metadata.file_name", "_metadata.row_index")
    back = cut_lineage(positions(rows, "file_name", "row_index"))
    remove_scratch(spark, path)
    return back


def q_single_file_report(spark: SparkSession, d: str) -> DataFrame:
    """The monthly means as one CSV file in order, read back with the place of each row in that file."""
    path = scratch_path(spark, "single")
    write_csv(q_monthly_mean_per_center(spark, d), path, sort_by=["date", "region DESC"], single_file=True)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("_part"), F.monotonically_increasing_id().alias("_id"))
    lines = cut_lineage(lines)
    remove_scratch(spark, path)
    starts = lines.groupBy("_part").agg(F.min("_id").alias("_first"))  # a block's lines are numbered in order
    placed = positions(lines.join(starts, "_part").select("value", "_part", (F.col("_id") - F.col("_first")).alias("_index")))
    fields = F.split("value", ",")
    return placed.where("value != 'date,region,mean_vacc_center' OR position > 1").select(
        F.to_date(fields[0]).alias("date"),
        fields[1].alias("region"),
        fields[2].cast("double").alias("mean_vacc_center"),
        (F.col("position") - 1).alias("position"),
    )


def q_report_positions(spark: SparkSession, d: str) -> DataFrame:
    """The place of every daily sum in the order of its size, largest first, then day, region and age."""
    rows = _daily(spark, d)
    by = [F.desc("women"), F.asc("date"), F.asc("region"), F.asc("age")]
    return with_positions(rows, by).select("date", "age", "region", "women", "position")


def q_doses_landing(spark: SparkSession, d: str) -> DataFrame:
    """The doses feed as text in its six-column layout, landed by the batch job, summed per (date, age, region)."""
    feed, landed = scratch_path(spark, "feed"), scratch_path(spark, "doses")
    tables.raw_doses(spark, d).write.option("header", True).csv(feed)
    rows = cut_lineage(agg.daily_sum(land(spark, feed, landed, schemas.DOSES_RAW, schemas.DOSES)))
    remove_scratch(spark, feed)
    remove_scratch(spark, landed)
    return rows


def q_stream_landing_by_header(spark: SparkSession, d: str) -> DataFrame:
    """Doses in drops of two layouts, landed by the stream: each file is read by its own header."""
    drops, landed = scratch_path(spark, "drops"), scratch_path(spark, "landed")
    feed = tables.raw_doses(spark, d)
    odd = F.dayofyear(F.to_date("date")) % 2 == 1
    feed.where(odd).write.option("header", True).csv(f"{drops}/own")
    feed.where(~odd).select("date", "supplier", "region", "age", "women", "men").write.option("header", True).csv(f"{drops}/permuted")
    rows = land_available(spark, f"{drops}/*", landed, schemas.DOSES_RAW, schemas.DOSES).rows
    summed = cut_lineage(agg.daily_sum(rows))
    remove_scratch(spark, drops)
    remove_scratch(spark, landed)
    return summed


def q_landing_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """A feed with bad dates and counts, landed with quarantine: rows fed, landed and rejected by day and reason."""
    feed, landed = scratch_path(spark, "feed"), scratch_path(spark, "quarantine")
    fed = tables.doses(spark, d).selectExpr(
        "CASE WHEN women % 11 = 3 THEN 'soon' ELSE date_format(date, 'yyyy-MM-dd') END AS date",
        "region",
        "CASE WHEN women % 7 = 2 THEN concat(women, '?') ELSE CAST(women AS STRING) END AS total",
    )
    fed.write.option("header", True).csv(feed)
    good = land(spark, feed, f"{landed}/good", schemas.SUMMARY_RAW, schemas.SUMMARY, on_bad="quarantine", rejects=f"{landed}/bad")
    counted = good.groupBy("region").agg(F.count("*").alias("n_rows"), F.sum("total").alias("total")).selectExpr("region", "'' AS reason", "n_rows", "total")
    bad = spark.read.parquet(f"{landed}/bad").groupBy("region", F.col("_reason").alias("reason")).agg(F.count("*").alias("n_rows"))
    out = cut_lineage(counted.unionByName(bad.withColumn("total", F.lit(None).cast("long"))))
    remove_scratch(spark, feed)
    remove_scratch(spark, landed)
    return out


def q_landed_month_pruning(spark: SparkSession, d: str) -> DataFrame:
    """The monthly means from a summary landed by month: the start date opens only the months from then on."""
    feed, landed = scratch_path(spark, "feed"), scratch_path(spark, "months")
    tables.raw_summary(spark, d).write.option("header", True).csv(feed)
    land(spark, feed, landed, schemas.SUMMARY_RAW, schemas.SUMMARY, month_of="date")
    summary = read_after(spark, landed, schemas.SUMMARY, LANDED_START_AFTER)
    means = cut_lineage(monthly_mean_per_center(summary, tables.centers(spark, d), LANDED_START_AFTER))
    remove_scratch(spark, feed)
    remove_scratch(spark, landed)
    return means


def q_stream_landing(spark: SparkSession, d: str) -> DataFrame:
    """The feed as text drops (derived from the tables), landed by the streaming job."""
    drops, landed = scratch_path(spark, "drops"), scratch_path(spark, "landed")
    tables.raw_summary(spark, d).write.option("header", True).csv(drops)
    rows = cut_lineage(land_available(spark, drops, landed, schemas.SUMMARY_RAW, schemas.SUMMARY).rows)
    remove_scratch(spark, drops)
    remove_scratch(spark, landed)
    return rows


def _clusters(algorithm: str, holds: str, name: str) -> Query:
    """Per region what can be checked of its real label: ``holds`` compares it (centre, low, high of its cluster) to the others."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        labelled = cut_lineage(
            coverage_clusters(
                _summed(spark, d, qualified=True),
                tables.population(spark, d),
                COVERAGE_START_AFTER,
                TARGET_DATE,
                CLUSTERS_K,
                algorithm,
                points="daily",
            )
        )
        return spark.sql(
            f"""
            WITH c AS (SELECT prediction, AVG(percent) AS centre, MIN(percent) AS low, MAX(percent) AS high FROM {{t}} GROUP BY prediction),
                 every AS (SELECT collect_list(struct(*)) AS others, COUNT(1) AS n_clusters FROM c)
            SELECT t.region, t.percent, forall(e.others, o -> o.prediction = t.prediction OR {holds}) AS {name}, e.n_clusters
            FROM {{t}} t JOIN c ON t.prediction = c.prediction JOIN every e ON e.n_clusters > 0""",
            t=labelled,
        )

    return run


def q_region_clusters_stable(spark: SparkSession, d: str) -> DataFrame:
    """The labels themselves: K-means whose result does not depend on the layout, numbered by ascending centre."""
    cov = q_coverage_percent(spark, d)
    return stable_kmeans(cov, ["percent"], CLUSTERS_K, key_cols=["region"]).selectExpr("region", "percent", "CAST(prediction AS BIGINT) AS prediction")


QUERIES: dict[str, Query] = {
    "date_after_filter": q_date_after_filter,
    "sql_view_filter": q_sql_view_filter,
    "string_cast_sum": q_string_cast_sum,
    "month_bucket": q_month_bucket,
    "region_normalise": q_region_normalise,
    "struct_flatten": q_struct_flatten,
    "monthly_sum": q_monthly_sum,
    "daily_sum": q_daily_sum,
    "region_total": q_region_total,
    "center_count": q_center_count,
    "region_join": q_region_join,
    "min_points_filter": q_min_points_filter,
    "rare_key_anti_join": q_rare_key_anti_join,
    "linear_fit": q_linear_fit,
    "forecast_next_month": q_forecast_next_month,
    "forecast_next_month_rounded": q_forecast_next_month_rounded,
    "forecast_at_date": q_forecast_at_date,
    "series_collect": q_series_collect,
    "monthly_mean_per_center": q_monthly_mean_per_center,
    "top_regions_by_forecast": q_top_regions_by_forecast,
    "top_regions_by_forecast_rounded": q_top_regions_by_forecast_rounded,
    "coverage_percent": q_coverage_percent,
    "region_ranking": q_region_ranking,
    "category_trend": q_category_trend,
    "csv_roundtrip": q_csv_roundtrip,
    "stream_landing": q_stream_landing,
    "sorted_report": q_sorted_report,
    "single_file_report": q_single_file_report,
    "report_positions": q_report_positions,
    "series_chunks": q_series_chunks,
    "stream_landing_by_header": q_stream_landing_by_header,
    "landing_quarantine": q_landing_quarantine,
    "landed_month_pruning": q_landed_month_pruning,
    "region_clusters_stable": q_region_clusters_stable,
    "doses_landing": q_doses_landing,
    "region_clusters_kmeans": _clusters("kmeans", "abs(t.percent - c.centre) <= abs(t.percent - o.centre)", "nearest"),
    "region_clusters_bisecting": _clusters("bisecting", "o.high < c.low OR o.low > c.high", "interval"),
}
