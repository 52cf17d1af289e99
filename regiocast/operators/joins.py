"""Joins (J1-J3).

No hints: the planner broadcasts a side whose size is known to lie below
``spark.sql.autoBroadcastJoinThreshold``, AQE converts a shuffle join when a
side turns out that small, and splits skewed keys otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from regiocast.session import cut_lineage


def region_join(left: DataFrame, right: DataFrame, on: str | list[str] = "region") -> DataFrame:
    """Inner equi-join; keys missing on either side vanish (reference semantics)."""
    return left.join(right, on=on, how="inner")


def drop_rare_keys(df: DataFrame, keys: list[str], min_count: int, materialise: bool = True) -> DataFrame:
    """Keep rows whose key (NULL is a key like any other) occurs at least ``min_count`` times.

    Counts per key are partial aggregates; the rare keys are joined against
    the rows, and no task holds a key's rows: a hot key is a count of one row
    per task in the aggregate, and a side that can be split in the join.
    ``materialise`` writes ``df`` once where both uses would compute it again;
    a plain scan is better read twice (the counts read the keys only).
    """
    rows = cut_lineage(df) if materialise else df
    cols, by = ", ".join(f"r.`{c}`" for c in df.columns), ", ".join(f"`{k}`" for k in keys)
    same = " AND ".join(f"r.`{k}` <=> rare.`{k}`" for k in keys)
    return df.sparkSession.sql(
        f"SELECT {cols} FROM {{rows}} r LEFT ANTI JOIN "
        f"(SELECT {by} FROM {{rows}} GROUP BY {by} HAVING COUNT(1) < {int(min_count)}) rare ON {same}",
        rows=rows,
    )
