"""SimHash near-duplicates by a grid join over segment bit counts.

A fingerprint of 64 bits is mapped to the bit counts of 16 segments of four
bits.  The Manhattan distance of two such vectors never exceeds the Hamming
distance of the fingerprints, so links are found by a range join on the grid
of vectors: each fingerprint goes to the grid cells within half the distance
of its own vector, two that link meet in a cell between them, and the pair is
then verified exactly on the bits.  Only different fingerprints take part;
copies are folded into one before.  Links become components by alternating
star contractions, each round written to the shared checkpoint folder.

Cases: a NULL or empty text has no words and fingerprint zero, linked like any
other; a NULL id never names a component unless all its ids are NULL; rows
that repeat get one output row each, and of a component the rows of one
(id, text) pair are marked ``keep``; other columns of the input are not read;
an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.llm.common import cut_lineage, perhaps_in, small_batches, texts_of

SEGMENTS, SEGMENT_BITS = 16, 4  # 16 counts of 0..4, three bits each in a packed cell
EDGES_A_TASK = 200_000
_BLOCK = 1 << 16  # shingles counted at a time


def fingerprint(text: str, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text, A-Z lower-cased."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z only, ASCII blanks only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*(words[k:] for k in range(shingle)), strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(grams), _BLOCK):
        h = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams[at : at + _BLOCK]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(grams), bitorder="little").view("<u8")[0])


def fingerprint_col(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long."""

    @arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64).view(np.int64))

    return simhash(text)


def grid_cells(fp: Column, radius: int) -> Column:
    """Cells of the grid of segment bit counts within ``radius`` (Manhattan) of the fingerprint's own."""
    own = F.lit(0).cast("long")
    for s in range(SEGMENTS):
        ones = F.bit_count(F.shiftrightunsigned(fp, SEGMENT_BITS * s).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)))
        own = own + F.shiftleft(ones.cast("long"), 3 * s)
    cells = F.array(own)

    def around(cell: Column) -> Column:
        steps = [cell]
        for s in range(SEGMENTS):
            count, one = F.shiftright(cell, 3 * s).bitwiseAND(F.lit(7)), F.lit(1 << 3 * s)
            steps += [F.when(count < SEGMENT_BITS, cell + one), F.when(count > 0, cell - one)]
        return F.array_compact(F.array(*steps))

    for _ in range(radius):
        cells = F.array_distinct(F.flatten(F.transform(cells, around)))
    return cells


def links(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """(src, dst), src < dst, of different fingerprints at ``max_bits`` or fewer differing bits."""
    placed = fingerprints.select("fp", F.explode(grid_cells(F.col("fp"), (max_bits + 1) // 2)).alias("cell"))
    a, b = placed.select("cell", F.col("fp").alias("src")), placed.select("cell", F.col("fp").alias("dst"))
    near = (F.col("src") < F.col("dst")) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits)
    return a.join(b, "cell").where(near).select("src", "dst").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (src, dst): its component's smallest node.

    Large-star and small-star steps in turn; they hang every node below a
    smaller neighbour until each component is one star.  Minima are partial
    aggregates, and the joins can be split by key, so a hub is no hot task.
    """
    edges = cut_lineage(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")))
    state = None
    while True:
        stat = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first()
        if tuple(stat) == state or stat[0] == 0:
            break
        state = tuple(stat)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = cut_lineage(small.coalesce(-(-stat[0] // EDGES_A_TASK)))  # a round is as many tasks as its edges ask for
    children = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return children.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def row_key(id_: Column, text: Column) -> Column:
    """16-byte digest of id and text; only rows that repeat share one."""
    return F.unhex(F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("none")), F.lit(":"), F.coalesce(text, F.lit("")))))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id, repeated rows once."""
    judged = cut_lineage(near_duplicates(docs, id_col, text_col, shingle, max_bits).groupBy("row_key").agg(F.first("keep").alias("keep"), F.count("*").alias("n")))
    # a bitmap of the rows that go or repeat sets nearly all others aside, so few texts are shuffled
    perhaps = perhaps_in(judged.where("NOT keep OR n > 1").select(F.xxhash64("row_key")))
    keyed = docs.withColumn("__llm_key", row_key(F.col(id_col), F.col(text_col)))
    keyed = keyed.withColumn("__llm_hit", perhaps(F.xxhash64("__llm_key")))
    kept = judged.where("keep").select(F.col("row_key").alias("__llm_key"))
    checked = keyed.where("__llm_hit").join(kept, "__llm_key", "left_semi").dropDuplicates(["__llm_key"])
    return keyed.where(~F.col("__llm_hit")).select(*docs.columns).unionByName(checked.select(*docs.columns))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, ``row_key`` (see there), ``fingerprint`` (16 hex digits), ``component_id``, ``keep``."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = cut_lineage(docs.select(F.col(id_col).alias("id"), row_key(F.col(id_col), text).alias("row_key"), fingerprint_col(text, shingle).alias("fp")))
    best = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row_key").alias("row_key"))
    nodes = cut_lineage(base.groupBy("fp").agg(F.min(best).alias("best")))
    roots = components(links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    winners = rooted.groupBy("root").agg(F.min("best").alias("win"))
    of_fp = rooted.select("fp", "root").join(winners, "root").select("fp", "win")
    return base.join(of_fp, "fp").select(
        F.col("id").alias(id_col),
        "row_key",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("win.id").alias("component_id"),
        (F.col("row_key") == F.col("win.row_key")).alias("keep"),
    )
