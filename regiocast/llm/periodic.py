"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words with a smallest period q (words q apart are the
same) of at least ``MIN_LENGTH`` words and ``MIN_REPEATS`` periods that no
neighbouring word extends.  For each power of two L the factors of L words are
named from the names of their halves.  Where a factor, its next occurrence and
the one after that are p <= 2 L apart each, they form an arithmetic progression
that proposes the period p; the stretch is extended both ways as long as words
p apart agree.  A run of period q has such a progression for the first L >= q,
with p = q: a nearer occurrence would give a smaller period.  A factor that
occurs once in its text has no longer one that repeats, so only places whose
factor occurs again are named at the next length; texts of a batch are named
together, as words of different texts never share a name.

Cases: a NULL or empty text has no words and no runs; a NULL id is an id like
any other; rows that repeat get one output row each; a text is searched whole,
however long; other columns pass through, those named like an output column
are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.llm.common import WORD, small_batches, texts_of

MIN_LENGTH, MIN_REPEATS = 6, 4
#: Words named together; a longer text makes a block of its own.
BLOCK_WORDS = 1 << 18
RUNS = "array<struct<start: long, length: long, period: long>>"
_WORD = re.compile(WORD)


def _next_same(pos: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each of the ascending places, the next place of the same name, or -1."""
    order = np.argsort(names, kind="stable")
    follows = np.full(len(pos), -1, np.int64)
    same = names[order][1:] == names[order][:-1]
    follows[order[:-1][same]] = pos[order[1:][same]]
    return follows


def _proposals(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first places, periods) of the progressions of each length; ``longest`` bounds the periods sought."""
    n, length = len(words), 1
    name = words.astype(np.int64)  # by place; -1: occurs once
    pos = np.arange(n)
    while len(pos):
        _, compact, counts = np.unique(name[pos], return_inverse=True, return_counts=True)
        often = counts[compact] > 1
        dead = pos[~often]
        pos, compact = pos[often], compact[often]
        name[pos], name[dead] = compact, -1
        if not len(pos):
            return
        follows = np.full(n, -1, np.int64)
        follows[pos] = _next_same(pos, compact)
        gap = np.where(follows[pos] >= 0, follows[pos] - pos, 0)
        at, p = pos[(gap > 0) & (gap <= 2 * length)], gap[(gap > 0) & (gap <= 2 * length)]
        again = follows[at + p] == at + 2 * p
        at, p = at[again], p[again]
        fresh = np.ones(len(at), bool)  # the first of neighbouring places with one period
        fresh[1:] = (at[1:] != at[:-1] + 1) | (p[1:] != p[:-1])
        yield at[fresh], p[fresh]
        if length >= longest:
            return
        pairs = pos[pos + length < n]
        pairs = pairs[name[pairs + length] >= 0]
        joined = name[pairs] * (len(counts) + 1) + name[pairs + length]
        name = np.full(n, -1, np.int64)
        name[pairs] = joined
        pos, length = pairs, 2 * length


def _extent(words: np.ndarray, at: int, p: int) -> tuple[int, int]:
    """Start and end of the longest stretch of period p around at, at + p."""
    end, step = at, 32
    while True:
        a, b = words[end : end + step], words[end + p : end + p + step]
        differ = np.flatnonzero(a[: len(b)] != b)
        if len(differ):
            end += int(differ[0])
            break
        end += len(b)
        if len(b) < step:
            break
        step *= 2
    start, step = at, 32
    while start:
        low = max(0, start - step)
        differ = np.flatnonzero(words[low:start] != words[low + p : start + p])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, step * 2
    return start, end + p


def runs_of(words: np.ndarray, longest: int, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    found, seen = set(), set()
    for starts, periods in _proposals(words, longest):
        for at, p in zip(starts.tolist(), periods.tolist(), strict=True):
            if (at, p) in seen:
                continue
            seen.add((at, p))
            start, end = _extent(words, at, p)
            if end - start >= max(min_length, min_repeats * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _blocks(texts: Iterator[str]) -> Iterator[list[list[str]]]:
    """The words of neighbouring texts, up to ``BLOCK_WORDS`` together."""
    block, size = [], 0
    for text in texts:
        words = _WORD.findall(text)
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append(words)
        size += len(words)
    if block:
        yield block


def _block_runs(texts: list[list[str]], min_length: int, min_repeats: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; a name that occurs once keeps texts apart."""
    firsts, coded, at, used = [], [], 0, 0
    for words in texts:
        codes = {w: used + i for i, w in enumerate(dict.fromkeys(words))}
        used += len(codes) + 1
        own = np.full(len(words) + 1, used - 1, np.int64)
        own[:-1] = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
        firsts.append(at)
        coded.append(own)
        at += len(own)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    bounds = np.array(firsts)
    for start, length, p in runs_of(np.concatenate(coded), max(map(len, texts)) // min_repeats, min_length, min_repeats):
        k = int(np.searchsorted(bounds, start, "right")) - 1
        out[k].append((start - firsts[k], length, p))
    return out


def _collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words outside every run's repeats: of each run its first period stays, unless another run drops it."""
    if not runs:
        return " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, p in runs:
        edge[start + p] += 1
        edge[start + length] -= 1
    return " ".join(w for w, dropped in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not dropped)


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``docs`` plus ``runs`` (start, length, period in words; by start, then period) and ``collapsed``, the words that stay."""
    small_batches(docs.sparkSession)

    @arrow_udf(f"struct<runs: {RUNS}, collapsed: string>")
    def periodic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            runs, texts = [], []
            for block in _blocks(texts_of(batch)):
                for words, own in zip(block, _block_runs(block, min_length, min_repeats), strict=True):
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                    texts.append(_collapsed(words, own))
            yield pa.StructArray.from_arrays([pa.array(runs, pa.list_(kind)), pa.array(texts, pa.string())], ["runs", "collapsed"])

    found = docs.drop("runs", "collapsed", "__llm_runs").withColumn("__llm_runs", periodic(F.col(text_col)))
    return found.withColumns({"runs": F.col("__llm_runs.runs"), "collapsed": F.col("__llm_runs.collapsed")}).drop("__llm_runs")


def greatest_run(runs: Column) -> Column:
    """The run of most periods, compared exactly; ties: the smallest start, then period.  NULL without runs."""
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda best, r: F.when(more(best, r), r).otherwise(best))
