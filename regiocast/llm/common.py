"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.session import checkpoint_dir, cut_lineage, scratch_path

#: A word of the contracts: a run of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Slots of a repeat filter (8 MB): the proven bound of what is broadcast.
FILTER_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written below the shared folder; persisted where the session names none."""
    spark = df.sparkSession
    if checkpoint_dir(spark) is None:
        return cut_lineage(df)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of one batch that goes to Python.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession, rows: int = 1000, size: int = BATCH_BYTES) -> None:
    """Whole texts go to Python in batches of ``rows`` and ``size`` bytes at most, so a worker's memory stays bounded."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        if not 0 < _bytes(spark.conf.get(key)) <= most:
            spark.conf.set(key, str(most))


def _bytes(setting: str) -> int:
    """A whole number, with a unit of size or none."""
    number = re.match(r"-?\d+", setting)[0]
    return int(number) << {"k": 10, "m": 20, "g": 30}.get(setting[len(number) :][:1].lower(), 0)


def split_words(text: Column) -> Column:
    """Words of a text as an array; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), F.lit(""))


def content_key(text: Column) -> Column:
    """32-byte digest that stands for a whole text (NULL counts as empty)."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def texts_of(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one by one, NULL as the empty text."""
    for value in column:
        yield value.as_py() or ""


class RepeatFilter:
    """Fixed-size bitmap of the keys that occur at least twice in a table of keys.

    A key that repeats always passes; a key that does not passes only if it
    shares a slot with one that does.  So the filter may save a shuffle but
    can never lose a row, whatever its size, and its size does not grow with
    the data.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def of(cls, keys: DataFrame, key: str, count: str, bits: int = FILTER_BITS, least: int = 2) -> RepeatFilter:
        """From rows (key long, count long); counts of equal keys are added up first.  ``bits`` is a power of two."""
        slot = F.pmod(F.col("__key"), F.lit(bits))
        rows = (
            keys.groupBy(F.col(key).alias("__key"))
            .agg(F.sum(count).alias("__n"))
            .where(F.col("__n") >= least)
            .groupBy(F.shiftright(slot, 6).alias("word"))
            .agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(__key, {bits}L) & 63 AS int)))").alias("mask"))
            .toArrow()
        )  # at most bits / 64 rows
        words = np.zeros(bits // 64, dtype=np.uint64)
        words[rows["word"].to_numpy().astype(np.int64)] = rows["mask"].to_numpy().astype(np.int64).view(np.uint64)
        return cls(words, bits)

    def __contains__(self, key: int) -> bool:
        slot = key % self.bits
        return bool((int(self.words[slot >> 6]) >> (slot & 63)) & 1)

    def test(self, keys: np.ndarray) -> np.ndarray:
        """Boolean per signed 64-bit key."""
        slot = keys.astype(np.int64).view(np.uint64) & np.uint64(self.bits - 1)
        return ((self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def perhaps_in(keys: DataFrame, bits: int = FILTER_BITS) -> Callable[[Column], Column]:
    """A test for the single long column of ``keys``: true for each of its values, and by chance for few others.

    Keys, not rows, go to Python, and the bitmap has a fixed size.
    """
    key = F.col(keys.columns[0]).alias("key")
    shared = keys.sparkSession.sparkContext.broadcast(RepeatFilter.of(keys.select(key, F.lit(1).alias("n")), "key", "n", bits, least=1))

    @arrow_udf("boolean")
    def perhaps(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.test(batch.to_numpy(zero_copy_only=False)), pa.bool_())

    return perhaps
