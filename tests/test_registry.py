"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from regiocast.oracle import ORACLE_SQL
from regiocast.registry import QUERIES

from conftest import SF_SMOKE

TABLES = ["region", "nation", "customer", "supplier", "lineitem"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.12g}"
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return str(v)
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMOKE, t)}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMOKE)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[key])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "age", "region", "vacc_women"]
    assert df.count() > 0


def test_scratch_folders_are_removed(spark):
    from regiocast.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    before = {f for f in os.listdir(folder) if f.startswith("regiocast-")}
    for key in ("csv_roundtrip", "stream_landing", "doses_landing", "sorted_report"):
        assert entry.queries()[key](spark, SF_SMOKE).count() > 0
    assert {f for f in os.listdir(folder) if f.startswith("regiocast-")} == before
