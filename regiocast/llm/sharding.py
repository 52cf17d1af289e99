"""Shards of nearly equal bytes: minimax contiguous partition of atomic groups.

Documents with equal texts form a group that is never split.  Groups stand in
the order of their text digest, and the shards are contiguous runs of groups
whose largest has the smallest possible size: the capacity is found by binary
search, each candidate is checked greedily (fill a shard up to the capacity,
go on with the next), and the groups are cut where the greedy check cuts.

The driver never sees the groups.  It holds cells (digest prefixes with their
bytes and numbers of groups), at first one per two-byte prefix, on which the
search brackets the capacity and each cut; only the cells that a bracket
touches are split by their next byte, until capacity and cuts are exact.

Rows get gapless slots within their shard by counting blocks of rows first and
numbering within a block, so no task holds a whole shard; a row that repeats is
numbered once, with its count.

Cases: a NULL text is an empty one (and of its group); repeated rows get a
slot each; a NULL id is an id like any other; other columns are not read; an
empty table gives an empty one, and with fewer groups than shards the last
shards stay empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiocast.llm.common import content_key, cut_lineage

#: Bytes of a row beside its text.
ROW_BYTES = 8
#: Blocks of rows numbered on their own in each shard.
BLOCKS = 256
#: Slots of one repeated row that are listed at a time.
RUN = 1 << 16


class Cells:
    """Ordered cells of groups: prefix, bytes, groups; the borders between them are known places to cut."""

    def __init__(self, rows: list[tuple[bytes, int, int]]):
        self.rows = sorted(rows)
        self.prefixes = [r[0] for r in self.rows]
        self.atomic = np.array([r[2] == 1 for r in self.rows], bool)
        self.borders = np.concatenate([[0], np.cumsum([r[1] for r in self.rows], dtype=np.int64)])

    @property
    def total(self) -> int:
        return int(self.borders[-1])

    def cuts(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of the place of each greedy cut; equal where the cells decide it."""
        low = high = 0
        out = []
        for _ in range(shards):
            low = int(self.borders[np.searchsorted(self.borders, low + capacity, "right") - 1])
            at = int(np.searchsorted(self.borders, high + capacity, "right")) - 1
            # beyond the last border the next group may still fit, unless it is alone in its cell
            high = int(self.borders[at]) if at == len(self.rows) or self.atomic[at] else high + capacity
            out.append((low, min(high, self.total)))
        return out

    def bracket(self, shards: int) -> tuple[int, int]:
        """(largest capacity known to be too small, smallest known to do)."""

        def smallest(end: int) -> int:
            """Smallest capacity whose last cut, by its lower (0) or upper (1) bound, reaches the end."""
            low, high = 0, self.total
            while low < high:
                middle = (low + high) // 2
                if self.cuts(middle, shards)[-1][end] >= self.total:
                    high = middle
                else:
                    low = middle + 1
            return low

        return smallest(1) - 1, smallest(0)

    def undecided(self, shards: int) -> list[int]:
        """Cells to look into before the capacity and all its cuts are exact."""
        low, high = self.bracket(shards)
        if low + 1 == high:
            spans = [c for c in self.cuts(high, shards) if c[0] != c[1]]
        else:
            spans = [(a[0], b[1]) for a, b in zip(self.cuts(low + 1, shards), self.cuts(high, shards), strict=True)]
        found: set[int] = set()
        for a, b in spans:
            first, last = np.searchsorted(self.borders, [a, b], "right") - 1
            found.update(range(int(first), min(int(last), len(self.rows) - 1) + 1))
        return [j for j in sorted(found) if not self.atomic[j]]


def _cells(groups: DataFrame, width: int) -> list[tuple[bytes, int, int]]:
    prefix = F.expr(f"substring(digest, 1, {width})")
    rows = groups.groupBy(prefix.alias("prefix")).agg(F.sum("bytes"), F.count("*")).toArrow()
    return [(p, b, n) for p, b, n in zip(*(c.to_pylist() for c in rows.columns), strict=True)]


def minimax_cuts(groups: DataFrame, shards: int) -> list[bytes]:
    """First digest prefix of each shard after the first, for ``groups`` (digest binary, bytes long)."""
    rows = _cells(groups, 2)  # at most 65,536
    while True:
        cells = Cells(rows)
        split = cells.undecided(shards)
        if not split:
            break
        open_prefixes = [cells.prefixes[j] for j in split]
        rows = [r for j, r in enumerate(cells.rows) if j not in set(split)]
        for width in sorted({len(p) for p in open_prefixes}):
            wanted = [F.lit(p) for p in open_prefixes if len(p) == width]
            within = groups.where(F.expr(f"substring(digest, 1, {width})").isin(*wanted))
            rows += _cells(within, width + 1)
    _, capacity = cells.bracket(shards)
    out = []
    for place, _ in cells.cuts(capacity, shards)[:-1]:
        at = int(np.searchsorted(cells.borders, place, "right")) - 1
        out.append(cells.prefixes[at] if at < len(cells.rows) else b"\xff" * 33)  # above every digest
    return out


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``shard``, ``slot``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # rows that repeat are one row with a count from here on: no task sorts or numbers them one by one
    base = cut_lineage(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            content_key(text).alias("digest"),
        )
        .groupBy("id", "size", "text_crc32", "digest")
        .agg(F.count("*").alias("n"))
    )
    groups = cut_lineage(base.groupBy("digest").agg(F.sum(F.col("size") * F.col("n")).alias("bytes")))
    shard = F.lit(0)
    for first in minimax_cuts(groups, shards):
        shard = shard + (F.col("digest") >= F.lit(first)).cast("int")
    placed = base.withColumn("shard", shard).withColumn("block", F.pmod(F.xxhash64("id", "digest"), F.lit(blocks)).cast("int"))
    counts = placed.groupBy("shard", "block").agg(F.sum("n").alias("rows"))  # shards x blocks rows at most
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("shard", "block").orderBy(F.col("id").asc_nulls_first(), "digest").rowsBetween(Window.unboundedPreceding, -1)
    first_slots = placed.withColumn("before", F.coalesce(F.sum("n").over(own), F.lit(0))).join(F.broadcast(offsets), ["shard", "block"])
    # the slots of repeated rows are counted out in runs of bounded length
    start = F.col("offset") + F.col("before")
    runs = first_slots.select("id", "size", "text_crc32", "shard", (start + F.col("n")).alias("end"), F.explode(F.sequence(start, start + F.col("n") - 1, F.lit(RUN))).alias("at"))
    slots = F.sequence("at", F.least(F.col("at") + (RUN - 1), F.col("end") - 1))
    return runs.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", F.explode(slots).alias("slot"))
