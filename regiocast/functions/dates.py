"""Date helpers.

All arithmetic is on ``DATE`` values, so results do not depend on the session
time zone, and a filter on ``CAST(ts AS DATE)`` is unwrapped by Catalyst into a
range on the raw timestamp that reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | _dt.date | _dt.datetime) -> _dt.date:
    """Parse ``yyyy-M-d`` leniently (one-digit month and day accepted)."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    year, month, day = (int(part) for part in str(value).strip().split("-"))
    return _dt.date(year, month, day)


def sql_date(value: str | _dt.date | _dt.datetime) -> str:
    """A SQL DATE literal: foldable, so a comparison with it is pushed down."""
    return f"DATE'{as_date(value).isoformat()}'"


def sql_after(start_after: str | _dt.date | None, col: str = "date") -> str:
    """``WHERE`` clause for the strictly-after filter (empty when no bound)."""
    return f"WHERE {col} > {sql_date(start_after)}" if start_after is not None else ""


def lenient_date_sql(col: str) -> str:
    """``y-M-d`` text as a date; a month or day beyond its range rolls over (``2021-13-1`` is 2022-01-01, ``2021-2-30`` 2021-03-02)."""
    part = lambda i: f"TRY_CAST(regexp_extract({col}, '^([0-9]{{1,4}})-([0-9]{{1,4}})-([0-9]{{1,5}})$', {i}) AS INT)"
    first = f"add_months(TRY_CAST(concat(lpad(regexp_extract({col}, '^([0-9]{{1,4}})-', 1), 4, '0'), '-01-01') AS DATE), {part(2)} - 1)"
    return f"date_add({first}, {part(3)} - 1)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(col: str | Column) -> Column:
    return F.trunc(_c(col), "MM")


def days_in_month(col: str | Column) -> Column:
    return F.dayofmonth(F.last_day(_c(col)))


def next_month_start(col: str | Column) -> Column:
    return F.add_months(month_start(col), 1)


def month_year_label(col: str | Column) -> Column:
    """``M-yyyy`` (no zero padding), the key the SQL variant built by concat."""
    c = _c(col)
    return F.concat(F.month(c).cast("string"), F.lit("-"), F.year(c).cast("string"))


def date_label(col: str | Column, pattern: str = "dd-MM-yyyy") -> Column:
    """A date as text, ``dd-MM-yyyy`` like the SQL variant's reports."""
    return F.date_format(_c(col), pattern)
