import datetime as dt

from regiocast.operators.aggregates import center_count, daily_sum, min_points_filter, monthly_sum, region_total
from regiocast.operators.joins import drop_rare_keys
from regiocast.operators.ranking import top_n_per_group
from regiocast.operators.series import flatten_struct, series_collect, with_struct_key

D = dt.date


def test_drop_rare_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    out = drop_rare_keys(df, ["k"], 2)
    assert out.columns == ["k", "v"]
    assert sorted(r.v for r in out.collect()) == [1, 2, 4, 5]


def test_top_n_ties_and_short_groups(spark):
    df = spark.createDataFrame(
        [("g", "r2", 5), ("g", "r1", 5), ("g", "r3", 9), ("h", "r1", 1)], "g string, region string, v int"
    )
    out = top_n_per_group(df, ["g"], ["v DESC", "region"], 2, rank_col="rank")
    assert sorted((r.g, r.region, r.rank) for r in out.collect()) == [
        ("g", "r1", 2),
        ("g", "r3", 1),
        ("h", "r1", 1),
    ]


def test_aggregates(spark):
    doses = spark.createDataFrame(
        [
            (D(2021, 2, 1), "A", "20-29", 3),
            (D(2021, 2, 1), "A", "20-29", 4),
            (D(2021, 2, 2), "A", "20-29", 8),
            (D(2021, 2, 3), "B / X", "20-29", 1),
            (D(2021, 1, 31), "A", "20-29", 100),
        ],
        "date date, region string, age string, women bigint",
    )
    daily = daily_sum(doses, "2021-1-31")
    assert sorted(tuple(r) for r in daily.collect())[0] == (D(2021, 2, 1), "20-29", "A", 7)
    pts = min_points_filter(daily, 2).collect()
    assert [(r.region, r.n_days) for r in pts] == [("A", 2)]
    summary = doses.selectExpr("date", "region", "women AS total")
    assert {tuple(r) for r in monthly_sum(summary, "2021-1-31").collect()} == {
        (D(2021, 2, 1), "A", 15),
        (D(2021, 2, 1), "B / X", 1),
    }
    assert {tuple(r) for r in region_total(summary).collect()} == {("A", 115), ("B", 1)}
    centers = spark.createDataFrame([("A",), ("A",)], "region string")
    assert [tuple(r) for r in center_count(centers).collect()] == [("A", 2)]


def test_series_and_struct_flatten(spark):
    df = spark.createDataFrame(
        [("k", D(2021, 2, 3), 3), ("k", D(2021, 2, 1), 1), ("k", D(2021, 2, 2), 2)], "k string, date date, v int"
    )
    s = series_collect(df, ["k"], "date", "v").first()
    assert [p.v for p in s.series] == [1, 2, 3]
    packed = with_struct_key(df, ["k", "date"])
    assert packed.columns == ["key", "v"]
    assert flatten_struct(packed, "key").columns == ["k", "date", "v"]
