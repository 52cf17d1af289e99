"""Files of a table, through the file system that the path names: publishing and joining.

A table is written beside its target and swapped in when it is complete, so a
job that fails leaves the table of the last run as it was.  The swap is two
renames: a reader that comes between them finds no table, never half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Rename; folders above ``dst`` are made."""
    fs, to = _at(spark, dst)
    if to.getParent() is not None:
        fs.mkdirs(to.getParent())
    if not fs.rename(_at(spark, src)[1], to):
        raise OSError(f"could not rename {src} to {dst}")


def beside(path: str, what: str) -> str:
    """A new hidden name in the folder of ``path``: on the same file system, so a rename moves no data."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{what}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the complete ``staged`` in the place of ``path``; what was there goes only after that."""
    path, old = path.rstrip("/"), None
    if exists(spark, path):
        old = beside(path, "old")
        move(spark, path, old)
    try:
        move(spark, staged, path)
    except Exception:
        if old is not None:
            move(spark, old, path)
        raise
    if old is not None:
        remove(spark, old)


@contextmanager
def staged(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to, published as ``path`` unless the body fails."""
    place = beside(path, "new")
    try:
        yield place
        publish(spark, place, path)
    finally:
        remove(spark, place)


def parts(spark: SparkSession, folder: str) -> list[str]:
    """The data files of a written table in the order of their parts."""
    fs, place = _at(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(names) if n.startswith("part-")]


def join_files(spark: SparkSession, target: str, sources: list[str]) -> None:
    """Append ``sources`` in order to the file ``target``.

    A file system that can join files does so without moving data (HDFS);
    elsewhere the bytes are copied through one buffer.
    """
    jvm = spark.sparkContext._jvm
    fs, to = _at(spark, target)
    sources = [s for s in sources if fs.getFileStatus(_at(spark, s)[1]).getLen() > 0]
    if not sources:
        return
    places = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(sources))
    for i, s in enumerate(sources):
        places[i] = _at(spark, s)[1]
    if fs.hasPathCapability(to, "fs.capability.paths.concat"):
        fs.concat(to, places)
        return
    whole = beside(target, "whole")
    out = fs.create(_at(spark, whole)[1])
    try:
        for place in [to, *places]:
            stream = fs.open(place)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
    finally:
        out.close()
    fs.delete(to, False)
    move(spark, whole, target)
