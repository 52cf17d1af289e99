"""Adapters: both join strategies give the same model tables."""

import pytest
from pyspark.sql import functions as F

from regiocast.sources import tables

from conftest import SF_SMOKE


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _dose_sums(df):
    # consumers only ever sum women; the two plans differ in grain, not in sums
    return _rows(df.groupBy("date", "region", "age").sum("women"))


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def test_shuffle_path_matches_broadcast_path(spark, request):
    summary, doses = _rows(tables.summary(spark, SF_SMOKE)), _dose_sums(tables.doses(spark, SF_SMOKE))
    request.getfixturevalue("no_broadcast")
    assert _rows(tables.summary(spark, SF_SMOKE)) == summary
    assert _dose_sums(tables.doses(spark, SF_SMOKE)) == doses


def _subtree(plan, column):
    """Lines of the plan from the top join down to the scan that reads ``column``."""
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and column in x)
    depth, path = lines[scan].index("FileScan"), [lines[scan]]
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if line.strip() and at < depth:
            path.append(line)
            depth = at
    return path


def test_one_fact_shuffle_past_the_broadcast_limit(spark, no_broadcast):
    df = tables.summary(spark, SF_SMOKE, qualified=True)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    prepared = df._jdf.queryExecution().executedPlan().toString()
    fact = _subtree(prepared, "l_suppkey")
    assert not any("concat_ws" in x for x in fact if "Project" in x)  # no name is built per line item
    joins = [i for i, x in enumerate(fact) if "SortMergeJoin" in x]
    assert sum("Exchange hashpartitioning(l_suppkey" in x for x in fact[: joins[0]]) == 1
    assert sum("Exchange" in x for x in fact[: joins[0]]) == 1
    assert "partial_sum" in plan


def test_hot_supplier(spark, scratch, no_broadcast):
    """A third of all line items of one supplier: same sums, whatever the join."""
    for name in ("supplier", "nation", "region"):
        tables.read(spark, SF_SMOKE, name).write.parquet(f"{scratch}/{name}.parquet")
    items = tables.read(spark, SF_SMOKE, "lineitem").withColumn("l_suppkey", F.expr("IF(hash(l_shipdate, l_quantity) % 3 = 0, 1L, l_suppkey)"))
    items.write.parquet(f"{scratch}/lineitem.parquet")
    got = {r.region: r.v for r in tables.doses(spark, scratch).groupBy("region").agg(F.sum("women").alias("v")).collect()}
    suppliers = {r.s_suppkey: r.s_nationkey for r in tables.read(spark, scratch, "supplier").collect()}
    names = {r.n_nationkey: r.n_name for r in tables.read(spark, scratch, "nation").collect()}
    want = {}
    for r in tables.read(spark, scratch, "lineitem").collect():
        region = names[suppliers[r.l_suppkey]]
        want[region] = want.get(region, 0) + int(r.l_quantity)
    assert got == want


def test_model_table_grain(spark):
    s = tables.summary(spark, SF_SMOKE)
    assert s.columns == ["date", "region", "total"]
    assert s.count() == s.select("date", "region").distinct().count()
    pop = tables.population(spark, SF_SMOKE)
    assert all(" / " in r.region for r in pop.collect())
    assert tables.centers(spark, SF_SMOKE).count() == tables.read(spark, SF_SMOKE, "supplier").count()


def test_summary_rows_sum_to_the_summary(spark):
    rows = tables.summary_rows(spark, SF_SMOKE).groupBy("date", "region").sum("total")
    assert _rows(rows) == _rows(tables.summary(spark, SF_SMOKE))
