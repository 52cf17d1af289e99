"""Sinks (S4-S6).

``write_csv`` writes with a header; the report of the last run stays until the
new one is complete (see ``files.publish``).  ``single_file=True`` gives one
file in order at any size: the rows are range-sorted and written in parallel
parts, and the file system joins the parts in their order, the header once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocast.sources import files


def sort_keys(keys: list[str]) -> list[Column]:
    """``["date", "v DESC"]`` -> sort columns (T3: mixed directions)."""
    cols = []
    for key in keys:
        name, _, direction = key.strip().partition(" ")
        desc = direction.strip().upper() == "DESC"
        cols.append(F.col(name).desc() if desc else F.col(name).asc())
    return cols


def write_csv(
    df: DataFrame,
    path: str,
    sort_by: list[str] | None = None,
    single_file: bool = False,
) -> None:
    """Replace ``path`` by the rows with a header; ``sort_by`` (``"col"`` or ``"col DESC"``) orders it."""
    spark, out = df.sparkSession, df
    if sort_by:
        out = out.orderBy(*sort_keys(sort_by))
    with files.staged(spark, path) as folder:
        if single_file:
            _write_joined(out, folder)
        else:
            out.write.option("header", True).csv(folder)


def _write_joined(df: DataFrame, folder: str) -> None:
    """One file ``part-00000.csv`` with the header line, then the parts of ``df`` in order."""
    spark = df.sparkSession
    head, body = f"{folder}/.head", f"{folder}/.body"
    names = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
    names.coalesce(1).write.csv(head)
    df.write.csv(body)
    whole = f"{folder}/part-00000.csv"
    files.move(spark, files.parts(spark, head)[0], whole)
    files.join_files(spark, whole, files.parts(spark, body))
    files.remove(spark, head)
    files.remove(spark, body)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def clusters_path(base: str, algorithm: str, k: int) -> str:
    """``<base>/<algorithm>/<k>``: one folder per model, like the reference's layout."""
    return f"{base.rstrip('/')}/{algorithm}/{k}"
