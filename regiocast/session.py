"""Session helpers: a tuned local/test session and the shared checkpoint folder.

Library code never invents a scratch folder: lineage is cut in the folder the
cluster names in ``spark.checkpoint.dir``.  Only tests and the bench set one,
and only when the session does not already have it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "regiocast",
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench.

    ``checkpoint_dir`` is for test sessions only; on a cluster the shared
    folder comes from the cluster's ``spark.checkpoint.dir``.

    At cluster scale set ``spark.sql.shuffle.partitions`` (or AQE's
    ``coalescePartitions.initialPartitionNum``) to a few thousand and let AQE
    coalesce; locally it is the number of cores.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # local mode runs every task in one JVM on small inputs: small hash-map
        # pages avoid allocating 64 MB per aggregate task
        .config("spark.buffer.pageSize", "2m")
    )
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of this session, if the cluster names one."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: written intermediate tables need a "
            "shared folder (set it on the cluster, or in the test session)"
        )
    return f"{base.rstrip('/')}/regiocast-{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any more."""
    if "/regiocast-" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint when a shared folder exists, else a disk-backed persist.

    Both survive the loss of an executor: the checkpoint is re-read from the
    shared folder, persisted blocks are recomputed from lineage.
    """
    if checkpoint_dir(df.sparkSession) is not None:
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)
