"""Exact integer arithmetic for forecasts.

Spark's ``div`` truncates toward zero like a Java ``(long)`` cast.  Floor
division is built from it for a positive divisor.
"""

from __future__ import annotations


def trunc_div_sql(num: str, den: str) -> str:
    """SQL: ``num / den`` truncated toward zero."""
    return f"{num} div {den}"


def floor_div_pos_sql(num: str, den: str) -> str:
    """SQL: ``floor(num / den)`` for ``den > 0``."""
    return f"CASE WHEN {num} >= 0 THEN {num} div {den} ELSE -(({den} - 1 - {num}) div {den}) END"
