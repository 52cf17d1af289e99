"""Region-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_region_sql(col: str = "region") -> str:
    """SQL: text before the first ``/``, trimmed: ``"A / X"`` -> ``"A"``.

    ``substring_index`` is a plain scan, no regex, and keeps the whole string
    when there is no ``/``.
    """
    return f"trim(substring_index({col}, '/', 1))"


def normalise_region(col: str | Column) -> Column:
    """Column form of :func:`normalise_region_sql`."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.substring_index(c, "/", 1))
