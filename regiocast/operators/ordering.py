"""Positions in a global order without a global window.

Rows are range-sorted into parts and each part is numbered from zero as it is
written; the counts per part are summed up on the driver (one number per
part), and a row's position is the sum before its part plus its index there.
No task holds more than its own part, whatever the keys.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocast.session import cut_lineage

PART, INDEX = "_part", "_index"
_ROW_BITS = 33  # monotonically_increasing_id: the part above, the row's index below


def in_parts(df: DataFrame, by: list[Column]) -> DataFrame:
    """``df`` in global order, written once, plus ``_part`` and the row's ``_index`` in it.

    Rows equal in ``by`` may fall into several parts, so one value's rows are
    no hot part; which of them comes first is open.
    """
    spread = "_spread"
    sorted_ = df.withColumn(spread, F.monotonically_increasing_id()).repartitionByRange(*by, F.col(spread)).sortWithinPartitions(*by, F.col(spread))
    row = F.monotonically_increasing_id()
    return cut_lineage(
        sorted_.withColumns({PART: F.shiftright(row, _ROW_BITS), INDEX: row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}).drop(spread)
    )


def offsets(df: DataFrame, part: str = PART) -> DataFrame:
    """(part, ``_before``): the rows in all parts before it, in the order of ``part``."""
    counts = df.groupBy(part).agg(F.count("*").alias("n")).orderBy(part).collect()  # a row per part
    before = [0, *accumulate(r.n for r in counts)]
    rows = [(r[0], n) for r, n in zip(counts, before, strict=False)]
    kind = df.schema[part].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"`{part}` {kind}, _before long")


def positions(df: DataFrame, part: str = PART, index: str = INDEX, position: str = "position") -> DataFrame:
    """``df`` with its 1-based position instead of ``part`` and ``index``."""
    numbered = df.join(offsets(df, part), part).withColumn(position, F.col("_before") + F.col(index) + 1)
    return numbered.drop(part, index, "_before")


def with_positions(df: DataFrame, by: list[Column], position: str = "position") -> DataFrame:
    """``df`` plus its 1-based position in the order ``by``."""
    return positions(in_parts(df, by), position=position)
