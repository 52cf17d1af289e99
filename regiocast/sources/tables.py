"""The four model tables derived from the driver's TPC-H-style Parquet tables.

    doses(date, region, age, women)   lineitem x supplier x nation, one row per
                                      line item: ship date, nation, flag, quantity
    summary(date, region, total)      one row per (ship date, nation)
                                      (``summary_rows``: the same before the per-day sum)
    centers(region)                   one row per supplier, its nation
    population(region, population)    customers per nation

``qualified=True`` names a region ``"<nation> / <region>"`` so that the
region normalisation of the coverage analytic has work to do.

lineitem is the fact table.  Its rows meet the supplier dimension and the
nation names (built once, on the 25 nations) and go straight to the aggregate
of the analytic that reads them.  No join is hinted: below the planner's
broadcast threshold the dimensions are probed in the scan stage; a supplier
table beyond it is joined by one shuffle of the pruned fact rows, with AQE
splitting a hot supplier, and the partial aggregate follows in the same stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the driver tables that the analytics use, declared up front:
# Parquet reads them by name, with no schema-inference job per read.
TABLE_SCHEMAS = {
    "lineitem": "l_suppkey BIGINT, l_quantity DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
}


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.format("parquet")
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.load(_path(sf_dir, name))


def _names(spark: SparkSession, sf_dir: str, qualified: bool) -> tuple[str, dict[str, DataFrame]]:
    """The CTE ``names(nationkey, region)`` and its input tables."""
    if not qualified:
        return "names AS (SELECT n_nationkey AS nationkey, n_name AS region FROM {na})", {"na": read(spark, sf_dir, "nation")}
    return (
        "names AS (SELECT n.n_nationkey AS nationkey, concat_ws(' / ', n.n_name, r.r_name) AS region "
        "FROM {na} n JOIN {rg} r ON n.n_regionkey = r.r_regionkey)",
        {"na": read(spark, sf_dir, "nation"), "rg": read(spark, sf_dir, "region")},
    )


def doses(spark: SparkSession, sf_dir: str, qualified: bool = False) -> DataFrame:
    """(date DATE, region STRING, age STRING, women BIGINT): one row per line item.

    Every consumer sums ``women`` over its own keys, so the rows go straight
    into that aggregate.
    """
    cte, frames = _names(spark, sf_dir, qualified)
    frames.update(li=read(spark, sf_dir, "lineitem"), su=read(spark, sf_dir, "supplier"))
    return spark.sql(
        f"WITH {cte} SELECT CAST(l.l_shipdate AS DATE) AS date, n.region, l.l_returnflag AS age, "
        "CAST(l.l_quantity AS BIGINT) AS women "
        "FROM {li} l JOIN {su} s ON l.l_suppkey = s.s_suppkey JOIN names n ON s.s_nationkey = n.nationkey",
        **frames,
    )


def summary(spark: SparkSession, sf_dir: str, qualified: bool = False) -> DataFrame:
    """(date DATE, region STRING, total BIGINT): one row per (date, region).

    lineitem is summed per (date, nation key) and the names are attached to
    the small aggregate.
    """
    cte, frames = _names(spark, sf_dir, qualified)
    frames.update(li=read(spark, sf_dir, "lineitem"), su=read(spark, sf_dir, "supplier"))
    return spark.sql(
        f"WITH {cte} SELECT f.date, n.region, f.total FROM "
        "(SELECT CAST(l.l_shipdate AS DATE) AS date, s.s_nationkey AS nationkey, SUM(CAST(l.l_quantity AS BIGINT)) AS total "
        "FROM {li} l JOIN {su} s ON l.l_suppkey = s.s_suppkey GROUP BY date, nationkey) f "
        "JOIN names n ON f.nationkey = n.nationkey",
        **frames,
    )


def summary_rows(spark: SparkSession, sf_dir: str, qualified: bool = False) -> DataFrame:
    """(date, region, total) at line-item grain: the summary before its per-day sum.

    Valid input for every operator that sums rows into its own keys: the
    monthly mean C1, monthly sums A1, region totals A3, and the coverage fit,
    which folds rows into (date, region) points itself.  Skipping the daily
    aggregate matters at scale: its partials are (days x regions) rows per scan
    task.  Row-level results (the date filter, the text feed) use ``summary``.
    """
    return doses(spark, sf_dir, qualified).selectExpr("date", "region", "women AS total")


def centers(spark: SparkSession, sf_dir: str, qualified: bool = False) -> DataFrame:
    """(region STRING): one row per supplier (a vaccination centre)."""
    cte, frames = _names(spark, sf_dir, qualified)
    frames.update(su=read(spark, sf_dir, "supplier"))
    return spark.sql(
        f"WITH {cte} SELECT n.region FROM {{su}} s JOIN names n ON s.s_nationkey = n.nationkey",
        **frames,
    )


def population(spark: SparkSession, sf_dir: str, qualified: bool = True) -> DataFrame:
    """(region STRING, population BIGINT): customers per nation.

    Counted on the fact table's foreign key first, so only one row per nation
    and task reaches the shuffle and the join.
    """
    cte, frames = _names(spark, sf_dir, qualified)
    frames.update(cu=read(spark, sf_dir, "customer"))
    return spark.sql(
        f"WITH {cte} SELECT n.region, c.population "
        "FROM (SELECT c_nationkey, COUNT(1) AS population FROM {cu} GROUP BY c_nationkey) c "
        "JOIN names n ON c.c_nationkey = n.nationkey",
        **frames,
    )


def raw_summary(spark: SparkSession, sf_dir: str, qualified: bool = False) -> DataFrame:
    """The summary as a text feed (every column a string), for the landing step."""
    return summary(spark, sf_dir, qualified).selectExpr(
        "date_format(date, 'yyyy-MM-dd') AS date", "region", "CAST(total AS STRING) AS total"
    )


def raw_doses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The doses as a text feed in the layout of ``schemas.DOSES_RAW``: women in the sixth column, another count before it."""
    return doses(spark, sf_dir).selectExpr(
        "date_format(date, 'yyyy-MM-dd') AS date", "'all' AS supplier", "region", "age",
        "CAST(women + 1000 AS STRING) AS men", "CAST(women AS STRING) AS women",
    )
