"""Positions, chunked series and rare keys: no task holds a whole key or table."""

import random
from itertools import groupby

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from regiocast.operators.joins import drop_rare_keys
from regiocast.operators.ordering import with_positions
from regiocast.operators.series import series_chunks, series_collect


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def skewed():
    """A third of all rows in one key, ties among them, a NULL key and single rows."""
    rng = random.Random(1)
    rows = [("hot", rng.randrange(40), rng.randrange(3)) for _ in range(1000)] + [(None, i % 7, i) for i in range(50)]
    return rows + [(f"k{i // (1 + i % 5)}", i % 11, i) for i in range(1950)]


def test_positions_follow_the_order(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, x int, y int").repartition(6)
    out = with_positions(df, [F.desc("x"), F.asc_nulls_last("k"), F.asc("y")])
    assert "Window" not in _plan(out)
    got = sorted((r.position, r.k, r.x, r.y) for r in out.collect())
    assert [p for p, *_ in got] == list(range(1, len(skewed) + 1))
    assert [r[1:] for r in got] == sorted(skewed, key=lambda r: (-r[1], r[0] is None, r[0] or "", r[2]))
    assert with_positions(df.limit(0), [F.asc("x")]).collect() == []


@pytest.mark.parametrize("size", [1, 7, 5000])
def test_chunks_of_a_hot_key(spark, skewed, size):
    df = spark.createDataFrame(skewed, "k string, x int, y int").repartition(6)
    got = {(r.k, r.chunk): [tuple(p) for p in r.series] for r in series_chunks(df, ["k"], "x", "y", size).collect()}
    want = {}
    for k, rows in groupby(sorted(skewed, key=lambda r: (r[0] or "", r[1], r[2])), key=lambda r: r[0]):
        points = [(x, y) for _, x, y in rows]
        want.update({(k, i // size): points[i : i + size] for i in range(0, len(points), size)})
    assert got == want


def test_a_long_series_is_refused(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, x int, y int")
    with pytest.raises(PySparkException, match="more than 512"):
        series_collect(df, ["k"], "x", "y").collect()
    short = series_collect(df.where("k <> 'hot'"), ["k"], "x", "y").where("k = 'k1'").first()
    assert [tuple(p) for p in short.series] == sorted((x, y) for k, x, y in skewed if k == "k1")
    limited = series_collect(df, ["k"], "x", "y")._jdf.queryExecution().executedPlan().toString()
    assert limited.index("WindowGroupLimit") < limited.rindex("Exchange hashpartitioning") < limited.rindex("WindowGroupLimit")


@pytest.mark.parametrize("materialise", [True, False])
def test_rare_keys_without_a_window(spark, skewed, materialise):
    df = spark.createDataFrame(skewed, "k string, x int, y int").repartition(6)
    out = drop_rare_keys(df, ["k"], 4, materialise)
    assert "Window" not in _plan(out) and "LeftAnti" in _plan(out)
    counts = {}
    for k, *_ in skewed:
        counts[k] = counts.get(k, 0) + 1
    assert sorted(map(repr, (tuple(r) for r in out.collect()))) == sorted(repr(r) for r in skewed if counts[r[0]] >= 4)
    assert None in {r.k for r in out.collect()} and out.columns == df.columns
