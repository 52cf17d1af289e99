"""Clustering of per-region features (M1-M4).

``cluster`` uses ``pyspark.ml`` and reproduces its labels for a given layout;
``stable_kmeans`` gives the same labels whatever the layout.

K-means|| initialisation depends on how the rows are split into partitions and
ordered, so the layout of the fit is an argument, the same at every size: the
rows are dealt by ``order_by`` to ``fit_partitions`` partitions and sorted
there.  The default of one partition suits aggregated feature tables (one row
per region); large ones take as many as their size asks for, and get labels
that are as reproducible.  The feature table is checkpointed to the shared
folder first, so the upstream analytic runs once, and lost executors re-read
the checkpoint instead of recomputing the whole lineage during the iterations.
"""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.session import cut_lineage

ALGORITHMS = ("kmeans", "bisecting")


def cluster(
    df: DataFrame,
    feature_cols: list[str],
    k: int,
    algorithm: str = "kmeans",
    seed: int = 1,
    *,
    order_by: list[str],
    fit_partitions: int = 1,
    prediction_col: str = "prediction",
    relabel: bool = False,
) -> DataFrame:
    """``df`` plus ``prediction_col`` (INT cluster label); ``order_by`` is a key of the rows.

    ``relabel=True`` numbers the clusters by ascending centre (first feature,
    then the next ones), so labels do not depend on the algorithm's internal
    numbering.  The k centres are the only thing read on the driver.
    """
    if algorithm not in ALGORITHMS:
        raise ValueError(f"algorithm must be one of {ALGORITHMS}, got {algorithm!r}")
    if k < 2:
        raise ValueError("k must be at least 2")
    if not order_by:
        raise ValueError("order_by must name the key of the rows")
    features = VectorAssembler(inputCols=feature_cols, outputCol="features").transform(df)
    # the layout is part of what is checkpointed: every iteration reads it from the shared folder
    features = cut_lineage(features.repartition(fit_partitions, *order_by).sortWithinPartitions(*order_by))
    if algorithm == "kmeans":
        estimator = KMeans(k=k, seed=seed, featuresCol="features", predictionCol=prediction_col)
    else:
        estimator = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol=prediction_col)
    model = estimator.fit(features)
    out = model.transform(features).drop("features")
    if relabel:
        order = sorted(range(len(model.clusterCenters())), key=lambda i: tuple(model.clusterCenters()[i]))
        cases = " ".join(f"WHEN {old} THEN {new}" for new, old in enumerate(order))
        out = out.withColumn(prediction_col, F.expr(f"CAST(CASE `{prediction_col}` {cases} END AS INT)"))
    return out


def stable_kmeans(
    df: DataFrame,
    feature_cols: list[str],
    k: int,
    *,
    key_cols: list[str],
    seed: int = 1,
    max_iter: int = 100,
    prediction_col: str = "prediction",
) -> DataFrame:
    """``df`` plus ``prediction_col``: K-means labels that do not depend on how the rows are split or ordered.

    The first centres are the ``k`` different feature vectors whose rows have
    the smallest seeded digest of their key; then Lloyd's steps as aggregates
    until no centre moves.  Sums are decimals (12 fractional digits), so the
    order of addition cannot show in a centre; ties go to the lower centre and
    clusters are numbered by ascending centre.  The driver holds k centres.  A
    cluster that loses all rows keeps its centre; with fewer than ``k``
    different vectors there are fewer clusters.  Rows with a NULL or NaN
    feature, which no centre is near to, get a NULL label.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    if not key_cols:
        raise ValueError("key_cols must name the key of the rows")
    rows = cut_lineage(df)
    whole = rows.where(" AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in feature_cols))
    points = whole.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(feature_cols)], *key_cols)
    names = [f"x{i}" for i in range(len(feature_cols))]
    digest = F.md5(F.concat_ws("\u0001", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]))
    first = points.groupBy(*names).agg(F.min(digest).alias("d")).orderBy("d", *names).limit(k).collect()
    centres = sorted(tuple(r[n] for n in names) for r in first)
    for _ in range(max_iter):
        if not centres:
            break
        sums = [F.sum(F.col(n).cast("decimal(28,12)")).cast("double").alias(n) for n in names]
        moved = {r.c: tuple(r[n] / r.n for n in names) for r in points.groupBy(_nearest(names, centres).alias("c")).agg(F.count("*").alias("n"), *sums).collect()}
        new = sorted(moved.get(i, c) for i, c in enumerate(centres))
        if new == centres:
            break
        centres = new
    features = [F.col(c).cast("double") for c in feature_cols]
    usable = F.lit(bool(centres))
    for x in features:
        usable = usable & x.isNotNull() & ~F.isnan(x)
    label = _nearest(features, centres) if centres else F.lit(None).cast("int")
    return rows.withColumn(prediction_col, F.when(usable, label))


def _nearest(features: list, centres: list[tuple[float, ...]]):
    """Number of the nearest centre, the lowest of equally near ones."""
    columns = [F.col(f) if isinstance(f, str) else f for f in features]
    ranked = []
    for i, centre in enumerate(centres):
        distance = sum(((x - F.lit(v)) * (x - F.lit(v)) for x, v in zip(columns, centre, strict=True)), F.lit(0.0))
        ranked.append(F.struct(distance.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*ranked))["i"]
