"""Incremental feed landing with Structured Streaming (S7, streaming form).

The feed arrives as CSV files dropped into a folder (one drop per day or per
publication).  The stream follows the names of new files; each micro-batch
reads its files by their own headers, exactly as the batch landing does, and
writes the good and the rejected rows in one pass to the folder of its number
(``batch=<n>``) of each table.  The checkpoint (in the shared folder) records
which files were taken, and a batch that is run again replaces its folders, so
a restart neither loses nor repeats a drop.  ``available_now=True`` processes
whatever is there and stops, which is how a scheduled ingestion job runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regiocast.sources import files
from regiocast.sources.landing import REASON, Landed, read_csv_files, read_landed, write_landed

#: Files of one micro-batch unless the caller says otherwise; their names and first lines come to the driver.
MAX_FILES = 1000
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def land_stream(
    spark: SparkSession,
    src_dir: str,
    dst_dir: str,
    raw_schema: T.StructType,
    schema: T.StructType,
    checkpoint: str | None = None,
    on_bad: str = "fail",
    partition_by: list[str] | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    rejects: str | None = None,
    month_of: str | None = None,
    lenient_dates: bool = False,
) -> StreamingQuery:
    """Start the landing stream.

    A bad row (``fail``) or an unknown header stops the stream; with
    ``quarantine`` a bad row goes with its reason to ``rejects``
    (``<dst_dir>_rejected`` by default).
    """
    dst = dst_dir.rstrip("/")
    bad = (rejects or f"{dst}_rejected").rstrip("/")
    # the content column is not read: a row of the stream is a file's name
    names = spark.readStream.schema(_FILES).format("binaryFile").option("maxFilesPerTrigger", int(max_files_per_trigger or MAX_FILES)).load(src_dir)

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        feed = read_csv_files(session, sorted(r.path for r in batch.collect()), raw_schema, schema)
        write_landed(feed, f"{dst}/batch={number}", schema, on_bad, f"{bad}/batch={number}", partition_by, month_of, lenient_dates)

    writer = names.select("path").writeStream.foreachBatch(take).option("checkpointLocation", checkpoint or f"{dst}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def land_available(spark: SparkSession, src_dir: str, dst_dir: str, raw_schema, schema, **kwargs) -> Landed:
    """Land every file not yet taken, wait for it, and return the landed table and the rejected rows."""
    dst = dst_dir.rstrip("/")
    query = land_stream(spark, src_dir, dst_dir, raw_schema, schema, available_now=True, **kwargs)
    query.awaitTermination()
    if (failure := query.exception()) is not None:
        raise failure
    rejected = None
    if kwargs.get("on_bad") == "quarantine":
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*schema.names, REASON]])
        rejected = _read(spark, (kwargs.get("rejects") or f"{dst}_rejected").rstrip("/"), text)
    return Landed(_read(spark, dst, schema), rejected)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of batches; empty before the first."""
    return read_landed(spark, path, schema) if files.exists(spark, path) else spark.createDataFrame([], schema)
