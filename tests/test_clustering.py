"""Fixture D: clustering golden labels, and clustering properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regiocast.operators.clustering import cluster, stable_kmeans

# The 21 (region, percent) pairs of the recorded clustering
# results, in file order, and the recorded labels (seed 1, one partition).
RECORDED = [
    ("Abruzzo", 62.543104253160465),
    ("Basilicata", 60.67033249996804),
    ("Calabria", 57.37002377341127),
    ("Campania", 59.59634907044471),
    ("Emilia-Romagna", 60.11057351971601),
    ("Friuli-Venezia Giulia", 62.43412946620362),
    ("Lazio", 59.91204720461978),
    ("Liguria", 64.18683207434073),
    ("Lombardia", 61.576642180509424),
    ("Marche", 61.2186177489633),
    ("Molise", 65.23822530661243),
    ("Piemonte", 60.01340912335223),
    ("Provincia Autonoma Bolzano", 60.794993582717375),
    ("Provincia Autonoma Trento", 55.40353743494663),
    ("Puglia", 61.14067193948659),
    ("Sardegna", 57.57950226032005),
    ("Sicilia", 54.166890455363855),
    ("Toscana", 59.27447153788928),
    ("Umbria", 61.93999396540861),
    ("Valle d'Aosta", 60.779692481536784),
    ("Veneto", 59.005682280693904),
]
LABELS = {
    ("kmeans", 2): "001000000000010110000",
    ("kmeans", 3): "001000020020010110000",
    ("kmeans", 4): "003300020020010313003",
    ("kmeans", 5): "003300020020010343003",
    ("bisecting", 2): "110001011110101000110",
    ("bisecting", 3): "210002021120101000110",
    ("bisecting", 4): "320113132231202001221",
    ("bisecting", 5): "420114143341202001321",
}


@pytest.fixture(scope="module")
def coverage(spark):
    rows = [(dt.date(2021, 6, 1), region, pct) for region, pct in RECORDED]
    # scrambled over partitions on purpose: cluster() restores key order
    return spark.createDataFrame(rows, "date date, region string, percent double").repartition(4)


@pytest.mark.parametrize("algorithm,k", sorted(LABELS))
def test_recorded_labels(coverage, algorithm, k):
    out = cluster(coverage, ["percent"], k, algorithm, seed=1, order_by=["region"])
    labels = {r.region: r.prediction for r in out.collect()}
    assert "".join(str(labels[region]) for region, _ in RECORDED) == LABELS[(algorithm, k)]


def test_kmeans_rows_are_nearest_their_centre(coverage):
    out = cluster(coverage, ["percent"], 3, "kmeans", order_by=["region"]).collect()
    centres = {}
    for r in out:
        centres.setdefault(r.prediction, []).append(r.percent)
    means = {c: sum(v) / len(v) for c, v in centres.items()}
    assert len(means) == 3
    for r in out:
        assert min(means, key=lambda c: abs(r.percent - means[c])) == r.prediction


def test_rejects_unknown_algorithm(coverage):
    with pytest.raises(ValueError):
        cluster(coverage, ["percent"], 2, "gmm", order_by=["region"])
    with pytest.raises(ValueError):
        cluster(coverage, ["percent"], 2, order_by=[])


@pytest.mark.parametrize("algorithm", ["kmeans", "bisecting"])
def test_labels_do_not_depend_on_input_partitioning(spark, algorithm):
    rows = [(dt.date(2021, 6, 1), region, pct) for region, pct in RECORDED]
    df = spark.createDataFrame(rows, "date date, region string, percent double")
    runs = [
        {r.region: r.prediction for r in cluster(part, ["percent"], 4, algorithm, order_by=["region"], fit_partitions=n).collect()}
        for n in (1, 3)
        for part in (df.coalesce(1), df.repartition(7), df.repartition(21))
    ]
    assert runs[0] == runs[1] == runs[2]
    assert runs[3] == runs[4] == runs[5]
    assert all(set(r.values()) == {0, 1, 2, 3} for r in runs)


@pytest.mark.parametrize("algorithm", ["kmeans", "bisecting"])
def test_relabel_orders_clusters_by_centre(coverage, algorithm):
    rows = cluster(coverage, ["percent"], 3, algorithm, order_by=["region"], relabel=True).collect()
    lo = {}
    for r in rows:
        lo[r.prediction] = min(lo.get(r.prediction, r.percent), r.percent)
    assert sorted(lo) == [0, 1, 2]
    assert lo[0] < lo[1] < lo[2]  # one-dimensional clusters are intervals, numbered low to high


def test_stable_labels_do_not_depend_on_the_layout(spark):
    df = spark.createDataFrame(RECORDED, "region string, percent double")
    runs = [
        {r.region: r.prediction for r in stable_kmeans(part, ["percent"], 4, key_cols=["region"]).collect()}
        for part in (df.coalesce(1), df.repartition(4), df.orderBy(F.desc("percent")).repartition(21))
    ]
    assert runs[0] == runs[1] == runs[2] and set(runs[0].values()) == {0, 1, 2, 3}
    by_label = [sorted(p for region, p in RECORDED if runs[0][region] == label) for label in range(4)]
    assert all(a[-1] < b[0] for a, b in zip(by_label, by_label[1:], strict=False))  # numbered by centre
    means = [sum(c) / len(c) for c in by_label]
    assert all(min(range(4), key=lambda i: abs(p - means[i])) == runs[0][region] for region, p in RECORDED)


def test_stable_labels_of_odd_tables(spark):
    schema = "id int, x double, y double, prediction string"
    rows = [(i, float(i % 3) * 10, 1.0, "old") for i in range(30)] + [(None, 0.0, 1.0, "old"), (77, None, 1.0, "old"), (78, float("nan"), 1.0, "old")]
    got = stable_kmeans(spark.createDataFrame(rows, schema), ["x", "y"], 5, key_cols=["id"]).collect()
    assert {(r.x, r.prediction) for r in got if r.id is not None and r.id < 30} == {(0.0, 0), (10.0, 1), (20.0, 2)}  # three different vectors
    assert [r.prediction for r in got if r.id in (77, 78)] == [None, None] and len(got) == 33
    assert stable_kmeans(spark.createDataFrame([], schema), ["x"], 2, key_cols=["id"]).collect() == []
    with pytest.raises(ValueError):
        stable_kmeans(spark.createDataFrame(rows, schema), ["x"], 2, key_cols=[])
