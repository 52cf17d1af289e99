"""Exact substring deduplication by super-k-mers.

A window is ``k`` consecutive words of one document.  Its minimiser is the run
of ``m`` words in it with the smallest hash; consecutive windows that share
their minimiser travel as one packed string of words (a super-k-mer) to the
bucket of the minimiser, so equal windows always meet in one bucket.  Equal
strings are folded on the way, keeping their first place; in the bucket the
windows of the different strings are sorted, which finds the first place of
each window exactly.  A word is removed when a window covers it whose words
also start earlier (smaller document id, or the same id and an earlier start),
judged on the input.

A minimiser that stands in very many different strings (a frequent phrase) is
no bucket: its windows travel one by one, each to the bucket of its own hash,
so they spread over the tasks.  A sketch of the strings of each minimiser says
which ones these are; equal windows have the same minimiser, so they take the
same way, and either way gives the same result.

Only a super-k-mer whose minimiser occurs twice can hold a repeated window; a
fixed-size bitmap of such minimisers (``RepeatFilter``) keeps the others from
travelling and changes no result, and another one of the documents with repeats
keeps the texts of the others where they are.  Folding and sorting are Spark's own and
spill to disk; a string holds at most k - m + 1 windows.

Cases: a NULL or empty text has no words; a NULL id comes before every other;
rows that repeat an id are read as one document at the same places, so none of
them removes its equal twin; other columns pass through, one named like an
output column is replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.llm.common import FILTER_BITS, RepeatFilter, perhaps_in, small_batches, split_words, texts_of, written

WINDOW, MINIMISER = 20, 5
#: A minimiser with some 2,800 different strings or more has half of its sketch's bits set by one string in 64.
HOT_SAMPLE, HOT_BITS = 64, 32
_BLOCK = 1 << 16  # words or windows looked at together
_TOGETHER = 1 << 18  # bytes of documents looked at together
_FOLD = 50_000  # different strings folded at a time in a task
_RANDOM = np.random.RandomState(7)
#: Hash of a word: a random number for each byte times a power for its place; of a run of words: odd factors.
_BYTES = _RANDOM.randint(0, 1 << 62, size=256, dtype=np.uint64) * np.uint64(4) + np.uint64(1)
_BYTES[32] = 0  # the blank between two words
_BASE = 0x9E3779B97F4A7C15
_FACTORS = _RANDOM.randint(0, 1 << 62, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, base, np.uint64))


#: Powers of the base and of its inverse modulo 2^64 for the places of a usual block.
_UP, _DOWN = (_powers(b, 1 << 20) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII blanks, as UTF-8."""
    return text.encode("utf-8").split()


def _word_starts(joined: bytes) -> np.ndarray:
    """Places of the words in bytes that hold one blank between two."""
    return np.append(0, np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1) if joined else np.empty(0, np.int64)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word; equal words have equal hashes."""
    joined = b" ".join(raw.split())
    return _hashes(joined, _word_starts(joined))


def _hashes(joined: bytes, starts: np.ndarray) -> np.ndarray:
    data = np.frombuffer(joined, np.uint8)
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _BLOCK):
        own = starts[at : at + _BLOCK]
        low, high = own[0], starts[at + _BLOCK] if at + _BLOCK < len(starts) else len(data)
        up, down = (_UP, _DOWN) if high - low <= len(_UP) else (_powers(b, high - low) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        out[at : at + _BLOCK] = np.add.reduceat(_BYTES[data[low:high]] * up[: high - low], own - low) * down[own - low]
    return out ^ (out >> np.uint64(29))


def _first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value of each window, by windows of twice the width from two of the last."""
    place, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        later = values[step:] < values[:-step]
        values, place = np.where(later, values[step:], values[:-step]), np.where(later, place[step:], place[:-step])
        span += step
    return place


@dataclass
class SuperKmers:
    """The runs of windows of some documents that share their minimiser's place."""

    joined: bytes  # the words of all documents, a blank between two
    places: np.ndarray  # of the words in it, and of one behind the last
    doc: np.ndarray  # of each run: its document,
    key: np.ndarray  # the minimiser,
    first: np.ndarray  # the first and the last window, counted over all words,
    last: np.ndarray
    string: np.ndarray  # a hash of its words
    before: np.ndarray  # words before each document

    @classmethod
    def of(cls, texts: list[str], k: int, m: int) -> SuperKmers:
        lines = [b" ".join(words_of(t)) for t in texts]
        joined = b" ".join(filter(None, lines))
        starts = _word_starts(joined)
        counts = np.array([line.count(b" ") + 1 if line else 0 for line in lines], np.int64)
        before, places = np.cumsum(counts) - counts, np.append(starts, len(joined) + 1)
        n, grams = len(starts) - k + 1, len(starts) - m + 1
        if n <= 0:
            return cls(joined, places, *(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64)), before)
        each = _hashes(joined, starts)
        mixed = np.zeros(grams, np.uint64)
        for j in range(m):
            mixed += each[j : j + grams] * _FACTORS[j % 64]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _FACTORS[-1]
        place = np.empty(n, np.int64)
        for at in range(0, n, _BLOCK):
            place[at : at + _BLOCK] = at + _first_minima(mixed[at : at + _BLOCK + k - m], k - m + 1)
        owner = np.repeat(np.arange(len(lines)), counts)
        window = np.flatnonzero(owner[:n] == owner[k - 1 :])  # of one document
        place = place[window]
        new = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(window) else window
        first, last = window[new], window[np.append(new[1:], len(window)) - 1] if len(window) else window
        sums = np.append(np.uint64(0), np.cumsum(each, dtype=np.uint64))
        string = (sums[last + k] - sums[first]) * _FACTORS[0]
        return cls(joined, places, owner[first], mixed[place[new]].view(np.int64), first, last, string ^ (string >> np.uint64(32)), before)

    def words(self, first: np.ndarray, n: int | np.ndarray) -> Iterator[bytes]:
        """The packed strings of ``n`` words from each first one."""
        for a, b in zip(self.places[first].tolist(), (self.places[first + n] - 1).tolist(), strict=True):
            yield self.joined[a:b]


def super_kmers(raw: bytes, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, last window, hash of the words) of each super-k-mer of one text."""
    own = SuperKmers.of([raw.decode("utf-8")], k, m)
    return own.key, own.first, own.last, own.string


def _together(texts: Iterator[str]) -> Iterator[list[str]]:
    """Neighbouring texts of about ``_TOGETHER`` bytes; a longer one may end its group."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= _TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def _filters(counts: DataFrame, bits: int, hot_bits: int) -> tuple[RepeatFilter, RepeatFilter]:
    """Bitmaps of the minimisers that occur twice or more, and of those with very many strings; from one aggregate."""
    slot = f"pmod(key, {bits}L)"
    one = f"shiftleft(1L, cast({slot} & 63 AS int))"
    rows = (
        counts.groupBy("key")
        .agg(F.sum("n").alias("n"), F.bit_or("strings").alias("strings"))
        .where("n > 1")
        .groupBy(F.expr(f"shiftright({slot}, 6)").alias("word"))
        .agg(F.expr(f"bit_or({one})").alias("seen"), F.expr(f"bit_or(CASE WHEN bit_count(strings) >= {hot_bits} THEN {one} ELSE 0L END)").alias("hot"))
        .toArrow()
    )  # at most bits / 64 rows
    out = []
    for name in ("seen", "hot"):
        words = np.zeros(bits // 64, dtype=np.uint64)
        words[rows["word"].to_numpy().astype(np.int64)] = rows[name].to_numpy().astype(np.int64).view(np.uint64)
        out.append(RepeatFilter(words, bits))
    return out[0], out[1]


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = WINDOW,
    m: int = MINIMISER,
    filter_bits: int = FILTER_BITS,
    hot_sample: int = HOT_SAMPLE,
    hot_bits: int = HOT_BITS,
) -> DataFrame:
    """``docs`` plus ``kept_text`` (kept words joined by a space), ``n_words`` and ``n_removed``.

    A minimiser's windows travel alone if ``hot_bits`` of the 64 bits of its
    sketch are set, to which one string in ``hot_sample`` adds.
    """
    if not 1 <= m <= k:
        raise ValueError("a minimiser is shorter than its window")
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = dict(docs.dtypes)[id_col]
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("t"))

    def count_minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [SuperKmers.of(texts, k, m) for texts in _together(texts_of(batch.column(0)))]
            keys = np.concatenate([np.empty(0, np.int64), *[p.key for p in parts]])
            strings = np.concatenate([np.empty(0, np.uint64), *[p.string for p in parts]])
            del parts
            sketch = np.where(strings % np.uint64(hot_sample) == 0, np.uint64(1) << (strings // np.uint64(hot_sample) % np.uint64(64)), np.uint64(0))
            order = np.argsort(keys, kind="stable")
            found, first, n = np.unique(keys[order], return_index=True, return_counts=True)
            masks = np.bitwise_or.reduceat(sketch[order], first) if len(found) else sketch
            yield pa.record_batch([pa.array(found, pa.int64()), pa.array(n, pa.int64()), pa.array(masks.view(np.int64), pa.int64())], names=["key", "n", "strings"])

    # 1. which minimisers repeat
    counts = docs.select(text.alias("t")).mapInArrow(count_minimisers, "key long, n long, strings long")
    shared = spark.sparkContext.broadcast(_filters(counts, filter_bits, hot_bits))

    def repeating(texts: Iterator[str]) -> Iterator[tuple[int, int, int, bytes]]:
        """(number of the text, bucket, first window, packed words) of the super-k-mers that may repeat."""
        seen, hot = shared.value
        base = 0
        for group in _together(texts):
            found = SuperKmers.of(group, k, m)
            hits = np.flatnonzero(seen.test(found.key))
            alone = hot.test(found.key[hits])
            own = hits[~alone]
            first = found.first[own]
            numbers, starts = base + found.doc[own], first - found.before[found.doc[own]]
            yield from zip(numbers.tolist(), found.key[own].tolist(), starts.tolist(), found.words(first, found.last[own] + k - first), strict=True)
            for r in hits[alone].tolist():
                windows, doc = np.arange(found.first[r], found.last[r] + 1), int(found.doc[r])
                for start, window in zip((windows - found.before[doc]).tolist(), found.words(windows, k), strict=True):
                    yield base + doc, int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True), start, window
            base += len(group)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Different strings of a stretch of documents with their first places and counts."""
        names, folded = ["bucket", "string", "id", "start", "n"], {}

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            rows = [(key[0], key[1].decode("utf-8"), place[1], place[2], n) for key, (place, n) in folded.items()]
            folded.clear()
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.string(), kind, pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        in_order = lambda p: p if p[0] else (False, p[2])  # noqa: E731  a NULL id comes first
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            ids = batch.column(0).to_pylist()
            for r, bucket, start, string in repeating(texts_of(batch.column(1))):
                place = (ids[r] is not None, ids[r], start)
                old = folded.get((bucket, string))
                if old is None:
                    folded[bucket, string] = (place, 1)
                else:
                    folded[bucket, string] = (min(old[0], place, key=in_order), old[1] + 1)
            if len(folded) >= _FOLD:
                yield flush(kind)
        if folded:
            yield flush(kind)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every place of the strings, each by its digest."""
        for batch in batches:
            rows, starts, digests = [], [], []
            for r, _, start, string in repeating(texts_of(batch.column(2))):
                rows.append(r)
                starts.append(start)
                digests.append(hashlib.md5(string).digest())
            index = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(index), batch.column(1).take(index), pa.array(starts, pa.int64()), pa.array(digests, pa.binary())]
            yield pa.record_batch(columns, names=["id", "text_key", "start", "string"])

    # 2. to the buckets as packed strings, equal ones folded before and after the shuffle
    place = F.struct(F.col("id").isNotNull().alias("named"), F.col("id").alias("id"), F.col("start").alias("start"))
    packed = keyed.select("id", "t").mapInArrow(fold, f"bucket long, string string, id {kind}, start long, n long")
    folded = packed.repartition("bucket").groupBy("bucket", "string").agg(F.min(place).alias("own"), F.sum("n").alias("n"))
    # 3. in each bucket the windows are sorted, and each gets its first place
    one = F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda o: F.array_join(F.slice("w", o + 1, k), " "))
    cut = folded.select("bucket", F.unhex(F.md5("string")).alias("string"), "n", "own", F.split("string", " ").alias("w"))
    windows = cut.select("bucket", "string", "n", "own", F.posexplode(one).alias("offset", "window")).select(
        "bucket",
        "string",
        "n",
        "offset",
        "window",
        F.struct(F.col("own.named").alias("named"), F.col("own.id").alias("id"), (F.col("own.start") + F.col("offset")).alias("start")).alias("at"),
    )
    placed = windows.selectExpr("*", "min(at) OVER (PARTITION BY bucket, window) AS first").drop("window")
    firsts = (
        placed.groupBy("bucket", "string")
        .agg(
            F.max((F.col("n") > 1) | (F.col("first") != F.col("at"))).alias("repeats"),
            F.collect_list(F.struct("offset", "first")).alias("windows"),  # at most k - m + 1
        )
        .where("repeats")
        .select("string", "windows")
    )
    # 4. each occurrence compares its places with the first ones
    own = F.struct(F.col("id").isNotNull().alias("named"), F.col("id").alias("id"))
    later = F.filter("windows", lambda w: (w["first"]["start"] != F.col("start") + w["offset"]) | (F.struct(w["first"]["named"].alias("named"), w["first"]["id"].alias("id")) != own))
    found = (
        keyed.mapInArrow(occurrences, f"id {kind}, text_key long, start long, string binary")
        .join(firsts, "string")
        .select("id", "text_key", F.transform(later, lambda w: F.col("start") + w["offset"]).alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy(F.col("id").alias("__llm_id"), F.col("text_key").alias("__llm_key"))
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))  # of one document
    )

    @arrow_udf("array<long>")
    def stretches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """First word and the one after the last of each stretch that the windows cover, in order."""
        for batch in batches:
            out = []
            for starts in batch:
                at = np.unique(starts.values.to_numpy())
                apart = np.flatnonzero(at[1:] > at[:-1] + k)
                ends = np.append(at[apart], at[-1]) + k
                out.append(np.column_stack([at[np.append(0, apart + 1)], ends]).ravel())
            yield pa.array(out, pa.list_(pa.int64()))

    removed = written(found.select("__llm_id", "__llm_key", stretches("starts").alias("__llm_covered")), "repeats")
    is_hit = perhaps_in(removed.select(F.xxhash64("__llm_id", "__llm_key")), filter_bits)

    @arrow_udf("struct<kept:string,n_words:long,n_removed:long>")
    def keep(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, covered in batches:
            kept, n_words, n_removed = [], [], []
            for t, edges in zip(texts_of(batch), covered, strict=True):
                words = words_of(t)
                left, at = [], 0
                if edges.is_valid:
                    for start, end in zip(*[iter(edges.as_py())] * 2, strict=True):
                        left += words[at:start]
                        at = end
                left += words[at:]
                kept.append(b" ".join(left).decode("utf-8"))
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
            yield pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=["kept", "n_words", "n_removed"])

    # 5. the words that are left; a text without repeats stays where it is
    rest = docs.drop("kept_text", "n_words", "n_removed").withColumn("__llm_text_key", F.xxhash64(text))
    rest = rest.withColumn("__llm_hit", is_hit(F.xxhash64(id_col, "__llm_text_key")))
    same = F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.col("__llm_text_key") == F.col("__llm_key"))
    touched = rest.where("__llm_hit").join(removed, same, "left").withColumn("__llm_kept", keep(text, "__llm_covered"))
    words = split_words(F.col(text_col))
    whole = F.struct(F.array_join(words, " ").alias("kept"), F.size(words).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"))
    untouched = rest.where("NOT __llm_hit").withColumn("__llm_kept", whole)
    return (
        touched.drop("__llm_id", "__llm_key", "__llm_covered")
        .unionByName(untouched)
        .withColumns({"kept_text": F.col("__llm_kept.kept"), "n_words": F.col("__llm_kept.n_words"), "n_removed": F.col("__llm_kept.n_removed")})
        .drop("__llm_kept", "__llm_hit", "__llm_text_key")
    )
