"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last 32 bytes hits a pattern, so a
passage that several documents share is cut alike in all of them.  A chunk
that occurs once is encoded in place; a chunk that repeats is encoded once,
its ids travel to the documents that hold it, and every join is repaired:
the text from the last word break of the left chunk to a word break of the
right one is encoded again, and the window grows until its ids agree with the
chunk's own ids beyond the join.  BPE never merges across a break between a
printing character and a blank, so agreement is reached at such a break.

Cases: NULL text counts as empty (no ids, empty decoded text); rows that
repeat keep one output row each; other columns pass through; an existing
column named like the output is replaced; an empty table gives an empty one.
Strings with characters beyond Latin script and common punctuation, chunks or
joins as well, are encoded by the tokenizers library itself.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.llm.common import FILTER_BITS, RepeatFilter, content_key, cut_lineage, small_batches, texts_of

#: Fixed values of the byte-level vocabulary.
END_OF_TEXT = "<|endoftext|>"
#: Cut pattern: one boundary in 512 bytes on average, chunks of 128 bytes at least.
CUT_MASK = (1 << 9) - 1
MIN_CHUNK = 128

#: Characters on which both tokenizer libraries split texts alike beyond doubt.
_UNUSUAL = re.compile("[^\t-\r\x20-\x7e\xa0-ɏ‐-‧‰-⁞₠-₿]")
_BREAK = re.compile(r"(?<=[^\s])[ \n\t\r]")
_GEAR = np.random.RandomState(42).randint(0, 1 << 32, size=256, dtype=np.uint64).astype(np.uint32)
_LOADED: dict = {}


class Codec:
    """Both forms of one vocabulary: the library's JSON file and the same ranks for the fast encoder."""

    def __init__(self, json_path: str):
        import public_tokenizers
        import tiktoken

        self.json_path = json_path
        with open(json_path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {END_OF_TEXT: len(ranks)}
        self.fast = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    @functools.cached_property
    def library(self):
        """Only texts with unusual characters need it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.json_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @staticmethod
    def of(json_path: str) -> Codec:
        """One per worker process."""
        if json_path not in _LOADED:
            _LOADED[json_path] = Codec(json_path)
        return _LOADED[json_path]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if _UNUSUAL.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32)

    @property
    def width(self) -> str:
        """Ids on the way take the fewest bytes that hold the vocabulary."""
        return "<u2" if self.fast.n_vocab <= 1 << 16 else "<u4"

    def pack(self, ids: np.ndarray) -> bytes:
        return ids.astype(self.width).tobytes()

    def unpack(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.width).astype(np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.fast.decode_bytes(ids.tolist()).decode("utf-8", errors="replace")


def cut(text: str) -> list[str]:
    """Content-defined chunks of a text, in order; joined they are the text."""
    raw = text.encode("utf-8")
    if len(raw) <= MIN_CHUNK:
        return [text] if text else []
    data = np.frombuffer(raw, np.uint8)
    rolling = _GEAR[data]
    for shift in (1, 2, 4, 8, 16):  # window of 32 bytes by doubling
        rolling[shift:] = rolling[shift:] + (rolling[:-shift] << np.uint32(shift))
    hits = np.flatnonzero((rolling[:-1] >> np.uint32(23)) == CUT_MASK) + 1
    hits = hits[(data[hits] & 0xC0) != 0x80]  # never inside a character
    chunks, start = [], 0
    for at in hits.tolist():
        if at - start >= MIN_CHUNK:
            chunks.append(raw[start:at].decode("utf-8"))
            start = at
    chunks.append(raw[start:].decode("utf-8"))
    return chunks


def _signed(chunk: str) -> int:
    key = xxhash.xxh3_64_intdigest(chunk.encode("utf-8"))
    return key - (1 << 64) if key >= 1 << 63 else key


def _digest(chunk: str) -> bytes:
    return xxhash.xxh3_128_digest(chunk.encode("utf-8"))


def _shared(text: str, seen: RepeatFilter) -> list[str]:
    """The chunks of a text that may occur elsewhere as well."""
    chunks = cut(text)
    if not chunks:
        return []
    mask = seen.test(np.array([_signed(c) for c in chunks], np.int64))
    return [c for c, hit in zip(chunks, mask.tolist(), strict=True) if hit]


def stitch(text: str, known: dict[bytes, np.ndarray], codec: Codec) -> np.ndarray:
    """Ids of ``text`` from the known ids of some of its chunks, joins repaired."""
    out, pending = [], ""
    for chunk in cut(text):
        ids = known.get(_digest(chunk))
        breaks = [m.start() for m in _BREAK.finditer(chunk)] if ids is not None else []
        done = False
        for first, second in zip(breaks[:-1], breaks[1:], strict=False):
            inner = codec.encode(chunk[first:second])
            window = codec.encode(pending + chunk[:second])
            skip = len(codec.encode(chunk[:first]))
            # agreement beyond the join: window and chunk end in the same ids
            if len(window) >= len(inner) and np.array_equal(window[len(window) - len(inner) :], inner) and np.array_equal(ids[skip : skip + len(inner)], inner):
                tail = len(codec.encode(chunk[breaks[-1] :]))
                out += [window, ids[skip + len(inner) : len(ids) - tail]]
                pending, done = chunk[breaks[-1] :], True
                break
        if not done:
            pending += chunk
    out.append(codec.encode(pending))
    return np.concatenate(out)


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` plus ``ids_col``: the ids as little-endian unsigned 32-bit integers (binary).

    With ``decoded_col`` the ids are decoded as well (see ``decode``), by the
    same worker, so a task never holds two vocabularies.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_signed(c) for t in texts_of(batch.column(0)) for c in cut(t)]
            found, n = np.unique(np.array(keys, np.int64), return_counts=True)
            yield pa.record_batch([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

    # 1. which chunks repeat
    counts = docs.select(text.alias("t")).mapInArrow(count_chunks, "key long, n long")
    seen = spark.sparkContext.broadcast(RepeatFilter.of(counts, "key", "n", filter_bits))

    def sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor()
        for batch in batches:
            packed = [packer.compress(t.encode("utf-8")) if _shared(t, seen.value) else None for t in texts_of(batch.column(1))]
            packed = pa.array(packed, pa.binary())
            yield pa.record_batch([batch.column(0), packed], names=["key", "packed"]).filter(packed.is_valid())

    # 2. the different texts that hold such chunks, cut off from the scan
    shared_texts = cut_lineage(
        docs.select(content_key(F.col(text_col)).alias("key"), text.alias("t"))
        .mapInArrow(sharing, "key binary, packed binary")
        .groupBy("key")
        .agg(F.first("packed").alias("packed"))
    )

    def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            keys, digests, chunks = [], [], []
            for key, packed in zip(batch.column(0), batch.column(1), strict=True):
                t = unpacker.decompress(packed.as_py()).decode("utf-8")
                for digest, chunk in {_digest(c): c for c in _shared(t, seen.value)}.items():
                    keys.append(key.as_py())
                    digests.append(digest)
                    chunks.append(chunk)
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(digests, pa.binary()), pa.array(chunks, pa.string())], names=["key", "digest", "chunk"])

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(tokenizer_path)
        for batch in batches:
            ids = [codec.pack(codec.encode(t)) for t in texts_of(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], names=["digest", "ids"])

    # 3. each repeating chunk is encoded once, and its ids go to the texts that hold it
    rows = shared_texts.mapInArrow(chunk_rows, "key binary, digest binary, chunk string")
    once = rows.groupBy("digest").agg(F.first("chunk").alias("chunk"), F.count("*").alias("n")).where("n > 1")
    dictionary = once.select("digest", "chunk").mapInArrow(encode_chunks, "digest binary, ids binary")
    parts = rows.select("key", "digest").join(dictionary, "digest")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, known, at, unpacker = Codec.of(tokenizer_path), {}, None, zstandard.ZstdDecompressor()
        for batch in batches:
            keys, out = [], []
            for key, digest, ids, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    known, at = {}, key
                if digest is not None:  # the parts come before their text
                    known[digest] = codec.unpack(ids)
                else:
                    keys.append(key)
                    out.append(codec.pack(stitch(unpacker.decompress(packed).decode("utf-8"), known, codec)))
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(out, pa.binary())], names=["key", "ids"])

    together = (
        parts.select("key", "digest", "ids", F.lit(None).cast("binary").alias("packed"))
        .unionByName(shared_texts.select("key", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("binary").alias("ids"), "packed"))
        .repartition("key")
        .sortWithinPartitions("key", F.col("digest").isNull())
    )
    stitched = together.mapInArrow(assemble, "key binary, ids binary").select(F.col("key").alias("__llm_key"), F.col("ids").alias("__llm_packed"))

    def both(codec: Codec, ids: list[np.ndarray | None]) -> pa.Array:
        """The ids as bytes, and their text where it is asked for."""
        wide = pa.array([None if x is None else x.astype("<u4").tobytes() for x in ids], pa.binary())
        texts = pa.array([None if x is None or not decoded_col else codec.decode(x) for x in ids], pa.string())
        return pa.StructArray.from_arrays([wide, texts], ["ids", "text"])

    @arrow_udf("struct<ids: binary, text: string>")
    def widen(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec.of(tokenizer_path)
        for batch in batches:
            yield both(codec, [codec.unpack(v.as_py()) for v in batch])

    @arrow_udf("struct<ids: binary, text: string>")
    def encode_alone(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec.of(tokenizer_path)
        for batch in batches:
            yield both(codec, [None if _shared(t, seen.value) else codec.encode(t) for t in texts_of(batch)])

    # 4. texts without shared chunks are encoded in place; the others get theirs by digest
    kept = docs.drop(ids_col, *([decoded_col] if decoded_col else []))
    alone = kept.withColumn("__llm_ids", encode_alone.asNondeterministic()(text)).where("__llm_ids.ids IS NOT NULL")
    others = kept.withColumn("__llm_key", content_key(F.col(text_col))).join(stitched, "__llm_key").drop("__llm_key")
    others = others.withColumn("__llm_ids", widen("__llm_packed")).drop("__llm_packed")
    out = alone.unionByName(others).withColumn(ids_col, F.col("__llm_ids.ids"))
    if decoded_col:
        out = out.withColumn(decoded_col, F.col("__llm_ids.text"))
    return out.drop("__llm_ids")


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` plus ``out_col``: the text of the ids, special tokens included; NULL ids give an empty text."""

    small_batches(encoded.sparkSession)

    @arrow_udf("string")
    def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec.of(tokenizer_path)
        for batch in batches:
            yield pa.array([codec.decode(np.frombuffer(v.as_py() or b"", "<u4")) for v in batch], pa.string())

    return encoded.withColumn(out_col, decode_ids(F.col(ids_col)))
