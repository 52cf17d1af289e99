"""Top-n per group (T1) and composite ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame


def top_n_per_group(
    df: DataFrame,
    group_cols: list[str],
    order_by: list[str],
    n: int,
    rank_col: str | None = None,
) -> DataFrame:
    """First ``n`` rows of each group by ``order_by`` (SQL sort keys, e.g. ``"v DESC"``).

    Groups shorter than n are kept whole.  ``row_number() <= n`` lets Catalyst
    insert a partial WindowGroupLimit before the exchange, so at most n rows
    per group and task are shuffled.
    """
    cols = ", ".join(f"`{c}`" for c in df.columns)
    rank = f", _rank AS `{rank_col}`" if rank_col else ""
    return df.sparkSession.sql(
        f"SELECT {cols}{rank} FROM (SELECT *, row_number() OVER (PARTITION BY "
        f"{', '.join(f'`{g}`' for g in group_cols)} ORDER BY {', '.join(order_by)}) AS _rank FROM {{t}}) "
        f"WHERE _rank <= {int(n)}",
        t=df,
    )
