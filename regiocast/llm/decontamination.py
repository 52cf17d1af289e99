"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel distance.

Texts are compared as sequences of lower-cased words.  A test item of m words
has an error budget of k = floor(rate * m) word edits and is split into k + 1
pieces; wherever the item occurs with k edits or fewer, one piece is intact.
Windows of a document as long as pieces are hashed and tested against a bitmap
of the pieces' hashes, of a fixed size whatever the benchmark holds; those that
pass are joined to the pieces by hash.  The hits of one text and item give the
stretch that is verified by Myers' bit-parallel algorithm over words (the
distance to the closest passage in it).  Texts are told apart by digest, so
copies share one search, and only texts with a hit travel, once.

An item of so few words that its budget is 0 is found where its words stand
unchanged.  In scripts written without blanks each letter counts as a word.

Cases: a NULL or empty text holds no item, a NULL or empty item (or one without
any letter or digit) matches nothing; a caller may set aside items of fewer than
``min_words`` words; rows that repeat give their own output rows; other columns
are not read; a text is searched whole, however long; empty tables give an
empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.llm.common import FILTER_BITS, RepeatFilter, content_key, cut_lineage, perhaps_in, small_batches, texts_of

#: Letters and signs of scripts written without blanks (Thai, Lao, Myanmar, Khmer, Tai, kana, Han); each counts as a word.
UNSPACED = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u109a-\u109f\u1780-\u17d3\u17d7\u17dc\u17dd\u1950-\u1974\u1980-\u19c9"
    "\u1a20-\u1a7c\u3005-\u3007\u3021-\u3029\u3031-\u3035\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9ef\ua9fa-\ua9fe"
    "\uaa60-\uaa7f\uaa80-\uaadd\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U000323af"
)
_WORDS = re.compile(rf"[^\W{UNSPACED}]+|[{UNSPACED}]")
_GAP = re.compile(rf"[\W{UNSPACED}]")
#: Characters that are hashed together.
BLOCK = 1 << 19
_BASE, _STEP, _MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def pieces_of(words: list[str], budget: int) -> list[tuple[int, list[str]]]:
    """(offset, words) of budget + 1 consecutive pieces of nearly equal length."""
    n = len(words)
    cuts = [n * j // (budget + 1) for j in range(budget + 2)]
    return [(a, words[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


class Pattern:
    """One item as the bit masks of Myers' algorithm; any length, as Python's integers have no word size."""

    def __init__(self, words: list[str]):
        self.m, self.masks = len(words), {}
        for j, w in enumerate(words):
            self.masks[w] = self.masks.get(w, 0) | 1 << j

    def distance(self, text: list[str]) -> int:
        """Smallest number of word edits between the item and any passage of ``text``."""
        full, top = (1 << self.m) - 1, 1 << (self.m - 1)
        plus, minus, score, best = full, 0, self.m, self.m
        for w in text:
            eq = self.masks.get(w, 0)
            vertical = eq | minus
            horizontal = (((eq & plus) + plus) ^ plus) | eq
            up, down = minus | (~(horizontal | plus) & full), plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                best = min(best, score)
            up, down = up << 1 & full, down << 1 & full
            plus, minus = down | (~(vertical | up) & full), up & vertical
        return best


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind of each code point (1: letter of a word, 2: a word itself), and powers of the hash base and their inverses."""
    kinds, single = np.zeros(0x110000, np.uint8), re.compile(rf"[{UNSPACED}]")
    for low in range(0, 0x110000, 0x1000):  # surrogates are no letters
        some = "".join(map(chr, range(low, low + 0x1000)))
        kinds[low : low + 0x1000] = [c.isalnum() or c == "_" for c in some]
        kinds[[low + m.start() for m in single.finditer(some)]] = 2
    powers = [np.concatenate([[np.uint64(1)], np.full(BLOCK - 1, base, np.uint64)]).cumprod(dtype=np.uint64) for base in (_BASE, _UNBASE)]
    return kinds, *powers


def _cut_blocks(texts: list[str]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Lower-cased texts joined to blocks of about ``BLOCK`` characters, and (text, first character) of what is in them.

    A longer text is cut behind a character that is no part of a word.
    """
    parts, places, size = [], [], 0
    for k, text in enumerate(texts):
        text, at = text.lower(), 0
        while at < len(text):
            end = min(len(text), at + BLOCK - 1)
            if end < len(text):
                blank = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
                found = _GAP.search(text, end) if blank < at else None
                end = blank + 1 if blank >= at else found.end() if found else len(text)
            if parts and size + end - at >= BLOCK:
                yield "\n".join(parts), places
                parts, places, size = [], [], 0
            places.append((k, size))
            parts.append(text[at:end])
            size += end - at + 1
            at = end
    if parts:
        yield "\n".join(parts), places


def _block_hashes(block: str) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every word of a lower-cased block, all at once."""
    kinds, powers, inverses = _tables()
    points = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = kinds[points]
    letter, single = kind == 1, kind == 2
    starts = np.flatnonzero(single | (letter & ~np.concatenate([[False], letter[:-1]])))
    ends = np.flatnonzero(single | (letter & ~np.concatenate([letter[1:], [False]]))) + 1
    if len(points) > len(powers):  # one unbroken word, longer than a block
        grown = -(-len(points) // len(powers))
        powers = np.concatenate([powers * _power(_BASE, k * len(powers)) for k in range(grown)])
        inverses = np.concatenate([inverses * _power(_UNBASE, k * len(inverses)) for k in range(grown)])
    sums = np.concatenate([[np.uint64(0)], np.cumsum((points + np.uint64(1)) * powers[: len(points)], dtype=np.uint64)])
    return starts, _mixed((sums[ends] - sums[starts]) * inverses[starts])


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * _MIX
    return keys ^ (keys >> np.uint64(29))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For all words of ``words_of`` of each text in turn: the number of the text, and a hash of the word."""
    owners, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for block, places in _cut_blocks(texts):
        starts, keys = _block_hashes(block)
        firsts = np.array([at for _, at in places])
        owners.append(np.array([k for k, _ in places])[np.searchsorted(firsts, starts, "right") - 1])
        hashes.append(keys)
    return np.concatenate(owners), np.concatenate(hashes)


def window_hashes(hashes: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, signed hash of each window of so many words) for ascending lengths."""
    total, at = hashes, 1
    for length in lengths:
        if length > len(hashes):
            return
        for n in range(at, length):
            total = total[:-1] * _STEP + hashes[n:]
        at = length
        yield length, _mixed(total + np.uint64(length)).view(np.int64)


def _second(keys: np.ndarray) -> np.ndarray:
    """Another slot of the bitmap for the same key."""
    return (keys.view(np.uint64) >> np.uint64(32)).view(np.int64)


def _items(benchmark: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, ``words``, ``n``, ``item``): the words of each item that has enough, and their digest."""

    @arrow_udf("struct<words: string, n: int>")
    def normal(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            words = [words_of(t) for t in texts_of(batch)]
            yield pa.StructArray.from_arrays([pa.array([" ".join(w) for w in words], pa.string()), pa.array([len(w) for w in words], pa.int32())], ["words", "n"])

    rows = benchmark.select(F.col(id_col).alias("id"), normal(F.col(text_col)).alias("w")).where(F.col("w.n") >= max(1, min_words))
    return cut_lineage(rows.select("id", "w.words", "w.n", content_key(F.col("w.words")).alias("item")))


def _pieces(items: DataFrame, rate: float) -> DataFrame:
    """(hash, item, before, behind, length): a piece and the words that its item may reach before and behind its start."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = text.split(" ")
                budget = int(rate * len(words))
                for offset, piece in pieces_of(words, budget):
                    (_, key), = window_hashes(word_hashes([" ".join(piece)])[1], [len(piece)])
                    rows.append((int(key[0]), item, offset + budget, len(words) - offset + budget, len(piece)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["hash", "item", "before", "behind", "length"])

    distinct = items.groupBy("item").agg(F.first("words").alias("words"))
    return cut_lineage(distinct.mapInArrow(split, "hash long, item binary, before int, behind int, length int"))


def _found(docs: DataFrame, items: DataFrame, text_col: str, rate: float, filter_bits: int) -> DataFrame:
    """(``doc``, ``item``, ``distance``): digests of the texts and of the items they hold."""
    spark = docs.sparkSession
    pieces = _pieces(items, rate)
    lengths = [r.length for r in pieces.select("length").distinct().orderBy("length").collect()]  # of pieces: a few
    if not lengths:
        return spark.createDataFrame([], "doc binary, item binary, distance long")
    slots = F.explode(F.array("hash", F.shiftrightunsigned("hash", 32))).alias("key")
    shared = spark.sparkContext.broadcast(RepeatFilter.of(pieces.select(slots, F.lit(1).alias("n")), "key", "n", filter_bits, least=1))
    marks_schema = "doc binary, hash long, at int, packed binary"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, bitmap = zstandard.ZstdCompressor(), shared.value
        for batch in batches:
            texts = list(texts_of(batch.column(1)))
            owner, hashes = word_hashes(texts)
            first = np.searchsorted(owner, np.arange(len(texts)))  # of each text's words
            keys, places, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for length, window in window_hashes(hashes, lengths):
                at = np.flatnonzero(bitmap.test(window))
                at = at[bitmap.test(_second(window[at])) & (owner[at] == owner[at + length - 1])]  # within one text
                keys.append(window[at])
                owners.append(owner[at])
                places.append(at - first[owner[at]])
            key, at, whose = map(np.concatenate, (keys, places, owners))
            hit = np.unique(whose)
            packed = [packer.compress(texts[k].encode("utf-8")) for k in hit.tolist()]
            n = len(key)
            columns = [
                batch.column(0).take(pa.array(np.concatenate([hit, whose]))),
                pa.concat_arrays([pa.nulls(len(hit), pa.int64()), pa.array(key, pa.int64())]),
                pa.array(np.concatenate([np.full(len(hit), -1), at]).astype(np.int32)),
                pa.concat_arrays([pa.array(packed, pa.binary()), pa.nulls(n, pa.binary())]),
            ]
            yield pa.record_batch(columns, names=["doc", "hash", "at", "packed"])

    # 1. what passes the bitmap: the text itself (place -1) and its windows, once for all copies
    seen = docs.select(content_key(F.col(text_col)).alias("doc"), F.col(text_col).alias("t")).where("t IS NOT NULL").mapInArrow(search, marks_schema)
    marks = cut_lineage(seen.groupBy("doc", "hash", "at").agg(F.first("packed").alias("packed")))
    # 2. exact piece hits, and the stretch that those of one item reach
    low, high = F.greatest(F.lit(0), F.col("at") - F.col("before")), F.col("at") + F.col("behind")
    stretches = marks.where("at >= 0").join(pieces, "hash").groupBy("doc", "item").agg(F.min(low).alias("low"), F.max(high).alias("high"))
    nothing = F.lit(None)
    together = (
        marks.where("at < 0").select("doc", "packed", nothing.cast("binary").alias("item"), nothing.cast("int").alias("low"), nothing.cast("int").alias("high"))
        .unionByName(stretches.select("doc", nothing.cast("binary").alias("packed"), "item", "low", "high"))
        .repartition("doc")
        .sortWithinPartitions("doc", F.col("packed").isNull())
    )

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, words = zstandard.ZstdDecompressor(), []
        for batch in batches:
            docs_, items_, parts = [], [], []
            for doc, packed, item, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if packed is not None:  # a text comes before its stretches
                    words = words_of(unpacker.decompress(packed).decode("utf-8"))
                else:
                    docs_.append(doc)
                    items_.append(item)
                    parts.append(" ".join(words[a:b]))
            yield pa.record_batch([pa.array(docs_, pa.binary()), pa.array(items_, pa.binary()), pa.array(parts, pa.string())], names=["doc", "item", "part"])

    # 3. verified word by word
    @arrow_udf("long")
    def distance(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for parts, words in batches:
            known: dict[str, Pattern] = {}
            out = []
            for part, item in zip(texts_of(parts), texts_of(words), strict=True):
                if item not in known:
                    known = {item: Pattern(item.split(" "))}  # one at a time: rows of an item stand together or are few
                out.append(known[item].distance(part.split(" ") if part else []))
            yield pa.array(out, pa.int64())

    distinct = items.groupBy("item").agg(F.first("words").alias("words"), F.first("n").alias("n"))
    checked = together.mapInArrow(cut_out, "doc binary, item binary, part string").join(distinct, "item")
    checked = checked.select("doc", "item", "n", distance("part", "words").alias("distance"))
    return checked.where(F.col("distance") <= F.floor(F.lit(rate) * F.col("n"))).select("doc", "item", "distance")


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = 0.2,
    min_words: int = 1,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The rows of ``docs`` that hold no test item.

    A bitmap of the digests of texts that hold one sets nearly all other rows
    aside; the rest is checked by an exact join, so few texts are shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    found = cut_lineage(_found(docs, _items(benchmark, item_id_col, item_text_col, min_words), text_col, rate, filter_bits).select("doc").distinct())
    perhaps = perhaps_in(found.select(F.xxhash64("doc")), filter_bits)
    keyed = docs.withColumn("__llm_doc", content_key(F.col(text_col)))
    keyed = keyed.withColumn("__llm_hit", perhaps(F.xxhash64("__llm_doc")))
    aside = keyed.where(~F.col("__llm_hit")).select(*docs.columns)
    checked = keyed.where("__llm_hit").join(found.withColumnRenamed("doc", "__llm_doc"), "__llm_doc", "left_anti").select(*docs.columns)
    return aside.unionByName(checked)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = 0.2,
    min_words: int = 1,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(id, item id, ``distance``, ``item_words``) for every document row and each item found in it."""
    small_batches(docs.sparkSession)
    items = _items(benchmark, item_id_col, item_text_col, min_words)
    found = _found(docs, items, text_col, rate, filter_bits)
    named = found.join(items.select("item", F.col("id").alias("__llm_item"), F.col("n").cast("long").alias("item_words")), "item")
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__llm_id"), content_key(F.col(text_col)).alias("doc"))
    return rows.join(named, "doc").select(F.col("__llm_id").alias(id_col), F.col("__llm_item").alias(item_id_col), "distance", "item_words")
