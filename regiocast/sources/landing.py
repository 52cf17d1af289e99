"""Feed landing (S2, S7, P2, P8): text columns -> typed columns, then Parquet.

Columns are taken by name where a file has the names of ``raw_schema``, by
their position in it where it has none of them; a header with some of the
names but not all that are needed stops the landing.  Each file of a feed is
read by its own header, in batch and in the stream alike.
``on_bad='fail'`` keeps the reference's behaviour of failing the job on a bad
number or a missing value; ``on_bad='quarantine'`` lands the good rows and
writes every other row, as it arrived and with the reason, to a side table.
Nothing is dropped in silence, and the feed is read and cast once for both.
"""

from __future__ import annotations

import csv
import datetime as _dt
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocast.functions.dates import as_date, lenient_date_sql, sql_date
from regiocast.sources import files

ON_BAD = ("fail", "quarantine")
REASON, KIND, AS_FED = "_reason", "_kind", "_as_fed"
#: First lines read at a time.
READERS = 8


class Landed(NamedTuple):
    """The landed table and, with ``on_bad='quarantine'``, the rejected rows with their ``_reason``."""

    rows: DataFrame
    rejected: DataFrame | None


def pick_columns(df: DataFrame, schema: T.StructType, raw_schema: T.StructType | None = None) -> DataFrame:
    """The columns of ``schema`` as they arrived: by name if all are there, by position in ``raw_schema`` if none is."""
    names = [f.name for f in schema.fields]
    if set(names) <= set(df.columns):
        return df.select(*[f"`{n}`" for n in names])
    if known := [n for n in names if n in df.columns]:
        raise ValueError(f"unknown header {df.columns}: it has {known} but not {[n for n in names if n not in known]}")
    layout = (raw_schema or schema).names
    if len(df.columns) < len(layout):
        raise ValueError(f"expected at least {len(layout)} columns, got {df.columns}")
    renamed = df.toDF(*layout, *[f"_extra{i}" for i in range(len(df.columns) - len(layout))])
    return renamed.select(*[f"`{n}`" for n in names])


def _cast(field: T.StructField, lenient_dates: bool = False) -> str:
    value = f"`{field.name}`"
    if isinstance(field.dataType, T.StringType):
        return value
    if lenient_dates and isinstance(field.dataType, T.DateType):
        return lenient_date_sql(value)
    return f"TRY_CAST({value} AS {field.dataType.simpleString()})"


def bad_columns(schema: T.StructType, required: list[str] | None = None, lenient_dates: bool = False):
    """Names of the required columns that are NULL or do not cast, joined by commas; empty for a good row."""
    fields = [f for f in schema.fields if required is None or f.name in required]
    return F.concat_ws(",", *[F.when(F.expr(_cast(f, lenient_dates)).isNull(), F.lit(f.name)) for f in fields])


def _checked(on_bad: str) -> None:
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}")


def type_columns(
    df: DataFrame,
    schema: T.StructType,
    on_bad: str = "fail",
    required: list[str] | None = None,
    raw_schema: T.StructType | None = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """The columns of ``schema``, cast to their types.

    ``required`` (default: all) may not be NULL after the cast: the job fails,
    or with ``quarantine`` the row is left out (see ``rejected_rows``).  The
    check is a filter, so it runs whatever columns are used afterwards.  Casts
    to DATE accept one-digit months and days; with ``lenient_dates`` months and
    days beyond their range roll over, like a lenient parser's.
    """
    _checked(on_bad)
    picked = pick_columns(df, schema, raw_schema)
    bad = bad_columns(schema, required, lenient_dates)
    if on_bad == "fail":
        message = F.concat(F.lit("landing: NULL or bad value in "), bad)
        good = F.when(bad == "", F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    else:
        good = bad == ""
    return picked.where(good).selectExpr(*[f"{_cast(f, lenient_dates)} AS `{f.name}`" for f in schema.fields])


def rejected_rows(
    df: DataFrame, schema: T.StructType, required: list[str] | None = None, raw_schema: T.StructType | None = None
) -> DataFrame:
    """The rows that ``quarantine`` leaves out, as text, with ``_reason`` (the bad columns)."""
    picked = pick_columns(df, schema, raw_schema)
    text = [F.col(f"`{f.name}`").cast("string").alias(f.name) for f in schema.fields]
    return picked.withColumn(REASON, bad_columns(schema, required)).where(f"{REASON} != ''").select(*text, REASON)


def sorted_out(df: DataFrame, schema: T.StructType, raw_schema: T.StructType | None = None, lenient_dates: bool = False) -> DataFrame:
    """Every row once: typed columns, ``_as_fed`` (its text and reason; NULL for a good row), ``_kind`` good or rejected."""
    picked = pick_columns(df, schema, raw_schema).withColumn(REASON, bad_columns(schema, lenient_dates=lenient_dates))
    text = [F.col(f"`{f.name}`").cast("string").alias(f.name) for f in schema.fields]
    return picked.select(
        *[F.expr(_cast(f, lenient_dates)).alias(f.name) for f in schema.fields],
        F.when(F.col(REASON) != "", F.struct(*text, F.col(REASON))).alias(AS_FED),
        F.when(F.col(REASON) != "", F.lit("rejected")).otherwise("good").alias(KIND),
    )


def feed_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a feed: itself, or those of the folder; only their names are read."""
    return sorted(r.path for r in spark.read.format("binaryFile").load(path).select("path").collect())


def header_of(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """The column names in the first line of a CSV file; None for an empty file."""
    first = spark.read.text(file).head()
    return tuple(next(csv.reader([first.value.lstrip("﻿")]), ())) if first else None


def read_csv_files(spark: SparkSession, names: list[str], raw_schema: T.StructType, schema: T.StructType | None = None) -> DataFrame:
    """The columns of ``schema`` (default: ``raw_schema``) as text, each file read by its own header.

    Files of one header are one scan, which checks the header of each file
    again.  Only first lines come to the driver.
    """
    wanted = T.StructType([T.StructField(n, T.StringType()) for n in (schema or raw_schema).names])
    with ThreadPool(READERS) as pool:
        headers = pool.map(lambda name: header_of(spark, name), names)
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, header in zip(names, headers, strict=True):
        if header:
            groups.setdefault(header, []).append(name)
    feeds = []
    for header, members in groups.items():
        if len(set(header)) < len(header):
            raise ValueError(f"unknown header {list(header)}: a name occurs twice")
        layout = T.StructType([T.StructField(n, T.StringType()) for n in header])
        scan = spark.read.schema(layout).option("header", True).option("enforceSchema", False).csv(members)
        feeds.append(pick_columns(scan, wanted, raw_schema))
    return reduce(DataFrame.unionByName, feeds) if feeds else spark.createDataFrame([], wanted)


def read_csv_feed(spark: SparkSession, path: str, raw_schema: T.StructType, schema: T.StructType | None = None) -> DataFrame:
    """A text feed (a file or a folder of files, each with a header), every column a string."""
    return read_csv_files(spark, feed_files(spark, path), raw_schema, schema)


def write_landed(
    feed: DataFrame,
    dst: str,
    schema: T.StructType,
    on_bad: str,
    rejects: str,
    partition_by: list[str] | None = None,
    month_of: str | None = None,
    lenient_dates: bool = False,
) -> None:
    """Replace ``dst`` (and ``rejects``) by the rows of ``feed`` in one pass over it.

    With ``quarantine`` one write splits the rows by ``_kind``; the good part
    becomes ``dst`` by a rename, the rejected part, a few rows as a rule, is
    rewritten as it was fed.
    """
    _checked(on_bad)
    spark = feed.sparkSession
    by = [*(["month"] if month_of else []), *(partition_by or [])]
    month = {"month": F.trunc(month_of, "MM")} if month_of else {}
    if on_bad == "fail":
        with files.staged(spark, dst) as folder:
            writer = type_columns(feed, schema, lenient_dates=lenient_dates).withColumns(month).write
            (writer.partitionBy(*by) if by else writer).parquet(folder)
        return
    both, bad = files.beside(dst, "both"), files.beside(rejects, "new")
    try:
        rows = sorted_out(feed, schema, lenient_dates=lenient_dates).withColumns(month)
        rows.write.partitionBy(KIND, *by).parquet(both)
        fed = T.StructType([T.StructField(n, T.StringType()) for n in [*schema.names, REASON]])
        layout = T.StructType([T.StructField(AS_FED, fed)])
        kept = {kind: f"{both}/{KIND}={kind}" for kind in ("good", "rejected")}
        if files.exists(spark, kept["rejected"]):
            spark.read.schema(layout).parquet(kept["rejected"]).select(f"{AS_FED}.*").write.parquet(bad)
        else:
            spark.createDataFrame([], fed).write.parquet(bad)
        if not files.exists(spark, kept["good"]):
            spark.createDataFrame([], schema).write.parquet(kept["good"])
        files.publish(spark, bad, rejects)
        files.publish(spark, kept["good"], dst)
    finally:
        files.remove(spark, both)
        files.remove(spark, bad)


def land(
    spark: SparkSession,
    src: str,
    dst: str,
    raw_schema: T.StructType,
    schema: T.StructType,
    on_bad: str = "fail",
    partition_by: list[str] | None = None,
    rejects: str | None = None,
    month_of: str | None = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """CSV feed -> typed Parquet; returns the landed table read back.

    ``quarantine`` writes the rejected rows to ``rejects`` (``<dst>_rejected``
    by default).  ``month_of`` names a date column by whose month the table is
    partitioned (see ``read_after``).
    """
    feed = read_csv_feed(spark, src, raw_schema, schema)
    write_landed(feed, dst, schema, on_bad, rejects or f"{dst.rstrip('/')}_rejected", partition_by, month_of, lenient_dates)
    return read_landed(spark, dst, schema)


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` of a landed table, whatever it is partitioned by."""
    return spark.read.schema(schema).parquet(path).select(*[f"`{n}`" for n in schema.names])


def read_after(spark: SparkSession, path: str, schema: T.StructType, start_after: str | _dt.date, date_col: str = "date") -> DataFrame:
    """The rows after a day of a table landed by the month of ``date_col``: earlier months are never opened."""
    wide = T.StructType([*schema.fields, T.StructField("month", T.DateType())])
    first = as_date(start_after).replace(day=1)
    rows = spark.read.schema(wide).parquet(path).where(f"month >= {sql_date(first)} AND `{date_col}` > {sql_date(start_after)}")
    return rows.select(*[f"`{n}`" for n in schema.names])
