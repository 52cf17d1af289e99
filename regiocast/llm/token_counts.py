"""Token counts through a digest cache.

The normalised content of each text and the tokenizer version are digested.
Counts already in the cache are joined; only the different texts it misses
are encoded, each once, and their counts are appended, so the next run over a
grown corpus pays for the new texts alone.  The only normal form that can
never change a count is one that the tokenizer applies itself; the default
(NULL becomes the empty text) suits models with the identity normaliser.

The cache is asked by digest before any text moves.  Two bitmaps of fixed size
then sort the rows: one in no slot of a missed digest is a hit; one in no slot
of a hit or of a digest that repeats is the only row of its text, which is
encoded where it is; texts of the rest meet by digest, and those of the cache
leave by an exact join.  Slots shared by chance cost shuffle, never a row.

Cases: NULL text counts as empty (0 tokens); rows that repeat keep one output
row each and share one encoding; other columns pass through, one named like
an output column is replaced; an empty table gives an empty one; a cache
folder that does not exist is an empty cache.  Counts listed twice, by two
runs at a time, are read as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.llm.common import FILTER_BITS, content_key, cut_lineage, perhaps_in, small_batches, texts_of

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
_LOADED: dict = {}


def version_digest(tokenizer_path: str) -> str:
    """Digest of the tokenizer file, which is its version."""
    with open(tokenizer_path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def counter(tokenizer_path: str) -> Callable[[str], int]:
    """Counts the tokens of one text as the file's library does; one per worker process."""
    if tokenizer_path not in _LOADED:
        if tokenizer_path.endswith(".model"):
            import sentencepiece

            encode = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path).encode
            _LOADED[tokenizer_path] = lambda text: len(encode(text)) if text else 0
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(tokenizer_path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _LOADED[tokenizer_path] = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    return _LOADED[tokenizer_path]


def read_cache(spark, cache_path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    text_col: str = "text",
    out_col: str = "n_tokens",
    normalise: Callable[[Column], Column] | None = None,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` plus ``out_col``; the counts of texts that were not in the cache are appended to it."""
    spark, version = docs.sparkSession, version_digest(tokenizer_path)
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    content = F.coalesce(normalise(text), F.lit("")) if normalise else text

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for batch in batches:
            n = [count(t) for t in texts_of(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], names=["digest", "tokenizer", "n_tokens"])

    def stored() -> DataFrame:
        return read_cache(spark, cache_path).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("__llm_n"))

    digests = docs.select(content_key(content).alias("digest")).groupBy("digest").agg(F.count("*").alias("n"))
    asked = digests.join(stored(), "digest", "left").select(
        F.xxhash64("digest").alias("key"), F.col("__llm_n").isNull().alias("missing"), (F.col("__llm_n").isNotNull() | (F.col("n") > 1)).alias("shared")
    )
    asked = cut_lineage(asked)
    perhaps_missing = perhaps_in(asked.where("missing").select("key"), bits)
    perhaps_shared = perhaps_in(asked.where("shared").select("key"), bits)
    rows = docs.select(content_key(content).alias("digest"), text.alias("t"))
    rows = rows.withColumns({"missing": perhaps_missing(F.xxhash64("digest")), "shared": perhaps_shared(F.xxhash64("digest"))})
    alone = rows.where("missing AND NOT shared").select("digest", "t")
    # one row per different text: copies meet map-side before the shuffle
    together = rows.where("missing AND shared").groupBy("digest").agg(F.first("t").alias("t")).join(stored(), "digest", "left_anti")
    for misses in (alone, together):
        misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = stored().withColumnRenamed("digest", "__llm_digest")
    return (
        docs.drop(out_col)
        .withColumn("__llm_digest", content_key(content))
        .join(counts, "__llm_digest", "left")
        .drop("__llm_digest")
        .withColumnRenamed("__llm_n", out_col)
    )
