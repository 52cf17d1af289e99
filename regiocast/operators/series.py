"""Per-key series as arrays (A6, P16) and struct keys flattened to columns.

The analytics never build arrays (the fit is a partial aggregate).  A series
of bounded length is one array per key (``series_collect``, which refuses a
longer one); one of any length is cut into arrays of a fixed size
(``series_chunks``), so no task collects a whole hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocast.operators.ordering import INDEX, PART, in_parts

#: Points of one series; below Spark's threshold up to which a rank filter is applied before the shuffle.
MAX_POINTS = 512


def series_collect(
    df: DataFrame, keys: list[str], order_col: str, value_col: str, alias: str = "series", max_points: int = MAX_POINTS
) -> DataFrame:
    """keys + ``alias``: array<struct<order_col, value_col>> sorted by ``order_col``.

    A key of more than ``max_points`` rows fails the query: only that many and
    one more are kept of it, before the shuffle, so it is never collected.
    """
    cols = ", ".join(f"`{k}`" for k in keys)
    point = f"struct(`{order_col}`, `{value_col}`)"
    limited = (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {cols} ORDER BY `{order_col}`, `{value_col}`) AS _at FROM {{t}}) "
        f"WHERE _at <= {int(max_points) + 1}"
    )
    return df.sparkSession.sql(
        f"SELECT {cols}, CASE WHEN count(1) <= {int(max_points)} THEN sort_array(collect_list({point})) "
        f"ELSE raise_error('series_collect: a key has more than {int(max_points)} rows, see series_chunks') END AS `{alias}` "
        f"FROM ({limited}) GROUP BY {cols}",
        t=df,
    )


def series_chunks(df: DataFrame, keys: list[str], order_col: str, value_col: str, size: int, alias: str = "series") -> DataFrame:
    """keys, ``chunk`` (from 0) and ``alias``: the next ``size`` points at most, sorted by ``order_col``, then value.

    The rows are range-sorted by key and order into parts, so a hot key is
    many parts; a row's place in its key is its index in the part plus the
    key's rows in earlier parts, which are counts of (part, key).
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    rows = in_parts(df.select(*keys, order_col, value_col), [F.col(c) for c in [*keys, order_col, value_col]])
    cols = ", ".join(f"`{k}`" for k in keys)
    same = " AND ".join(f"r.`{k}` <=> s.`{k}`" for k in keys)
    return df.sparkSession.sql(
        f"""
        WITH runs AS (SELECT {cols}, {PART}, min({INDEX}) AS _first, count(1) AS _n FROM {{rows}} GROUP BY {cols}, {PART}),
             starts AS (  -- a key has as many rows here as it has parts
               SELECT *, coalesce(sum(_n) OVER (PARTITION BY {cols} ORDER BY {PART} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before
               FROM runs),
             placed AS (
               SELECT {', '.join(f'r.`{k}`' for k in keys)}, r.`{order_col}`, r.`{value_col}`,
                      (s._before + r.{INDEX} - s._first) div {int(size)} AS chunk
               FROM {{rows}} r JOIN starts s ON r.{PART} = s.{PART} AND {same})
        SELECT {cols}, chunk, sort_array(collect_list(struct(`{order_col}`, `{value_col}`))) AS `{alias}`
        FROM placed GROUP BY {cols}, chunk""",
        rows=rows,
    )


def with_struct_key(df: DataFrame, key_cols: list[str], key: str = "key") -> DataFrame:
    """Pack ``key_cols`` into one struct column ``key`` (the remaining columns follow)."""
    rest = [f"`{c}`" for c in df.columns if c not in key_cols]
    return df.selectExpr(f"struct({', '.join(f'`{c}`' for c in key_cols)}) AS `{key}`", *rest)


def flatten_struct(df: DataFrame, struct_col: str, fields: dict[str, str] | None = None) -> DataFrame:
    """Struct fields as top-level columns; ``fields`` maps output name -> field name."""
    names = fields or {f.name: f.name for f in df.schema[struct_col].dataType.fields}
    rest = [f"`{c}`" for c in df.columns if c != struct_col]
    return df.selectExpr(*[f"`{struct_col}`.`{src}` AS `{dst}`" for dst, src in names.items()], *rest)
