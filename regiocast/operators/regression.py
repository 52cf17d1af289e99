"""Simple linear regression per group (A7) and its value at a point.

x and y are integers (a day offset and a count), so the fit is kept as five
exact sums, each a partial aggregate with constant state per group; no group
is ever collected.  With D = n*Sxx - Sx^2, the least-squares line at x0 is

    num / den,   num = Sy*D + (n*Sxy - Sx*Sy)*(n*x0 - Sx),   den = n*D

evaluated in integers - checked 64-bit first, DECIMAL(38,0) for a group that
overflows - so truncation and half-up rounding are exact (floating point
disagrees across engines after truncation).  D = 0 (one
point, or one distinct x) has no line: the prediction is 0, as a Java cast or
``Math.round`` of NaN gives.

The SQL builders are shared by the DataFrame operators below and by the SQL
plans, so the formula exists once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from regiocast.functions.arithmetic import floor_div_pos_sql, trunc_div_sql

EXACT = "DECIMAL(38,0)"
ROUNDINGS = ("trunc", "half_up")


def _x(expr: str) -> str:
    return f"CAST({expr} AS {EXACT})"


def checked_sum(term: str, of: str) -> str:
    """64-bit SUM of ``term``; the query fails if a term or the sum leaves 64 bits.

    ``term`` is NULL only where ``of`` is, or where it overflowed, so comparing
    the two counts tells an overflow from a missing value, in any ANSI mode.
    """
    error = "CAST(raise_error('a sum of the fit leaves 64 bits') AS BIGINT)"
    return f"CASE WHEN COUNT({term}) < COUNT({of}) THEN {error} WHEN COUNT({of}) = 0 THEN NULL ELSE coalesce(try_sum({term}), {error}) END"


def fit_aggregates(x: str, y: str) -> list[str]:
    """Aggregates n, sum_x, sum_y, sum_xy, sum_xx of integer SQL expressions x, y.

    The sums are 64-bit (codegen'd primitive adds; a DECIMAL(38,0) sum would
    box every row).  A group too large for them fails the query; it is never
    answered from a part of its rows.
    """
    xb, yb = f"CAST({x} AS BIGINT)", f"CAST({y} AS BIGINT)"
    return [
        "COUNT(1) AS n",
        f"{checked_sum(xb, xb)} AS sum_x",
        f"{checked_sum(yb, yb)} AS sum_y",
        f"{checked_sum(f'try_multiply({xb}, {yb})', f'{xb} + 0 * {yb}')} AS sum_xy",
        f"{checked_sum(f'try_multiply({xb}, {xb})', xb)} AS sum_xx",
    ]


def _prediction_decimal_sql(x0: str, rounding: str) -> str:
    """The line at x0 in DECIMAL(38,0): exact as long as every product fits 38 digits, else an error or NULL."""
    n, sx, sy, sxy, sxx = (_x(c) for c in ("n", "sum_x", "sum_y", "sum_xy", "sum_xx"))
    d = f"({n} * {sxx} - {sx} * {sx})"
    num = f"({sy} * {d} + ({n} * {sxy} - {sx} * {sy}) * ({n} * {_x(x0)} - {sx}))"
    den = f"({n} * {d})"
    if rounding == "trunc":
        value = trunc_div_sql(num, den)
    else:
        # floor(num / den + 1/2) = floor((2 num + den) / (2 den)): Math.round's half-up, exact
        value = floor_div_pos_sql(f"(2 * {num} + {den})", f"(2 * {den})")
    return f"CASE WHEN {d} = 0 THEN CAST(0 AS BIGINT) ELSE {value} END"


def _prediction_long_sql(x0: str, rounding: str) -> str:
    """The same in checked 64-bit arithmetic: NULL as soon as any step overflows."""

    def mul(a: str, b: str) -> str:
        return f"try_multiply({a}, {b})"

    def sub(a: str, b: str) -> str:
        return f"try_subtract({a}, {b})"

    x0b = f"CAST({x0} AS BIGINT)"
    d = sub(mul("n", "sum_xx"), mul("sum_x", "sum_x"))
    num = f"try_add({mul('sum_y', d)}, {mul(sub(mul('n', 'sum_xy'), mul('sum_x', 'sum_y')), sub(mul('n', x0b), 'sum_x'))})"
    den = mul("n", d)
    if rounding == "trunc":
        value = trunc_div_sql(num, den)
    else:
        a, b = f"try_add({mul('2', num)}, {den})", mul("2", den)
        value = f"CASE WHEN {a} >= 0 THEN {a} div {b} ELSE -({sub(sub(b, '1'), a)} div {b}) END"
    return f"CASE WHEN {d} = 0 THEN CAST(0 AS BIGINT) ELSE {value} END"


def prediction_sql(x0: str, rounding: str = "trunc") -> str:
    """BIGINT expression over columns n, sum_x, sum_y, sum_xy, sum_xx: the line at x0.

    Evaluated in checked 64-bit arithmetic first; only a group whose
    intermediate products leave 64 bits is evaluated again in DECIMAL(38,0)
    (``coalesce`` evaluates its second argument only when the first is NULL).
    Both are exact, so the result does not depend on which one answers.  A
    group whose products leave 38 digits too fails the query.  Sums that are
    NULL for want of values give NULL.
    """
    if rounding not in ROUNDINGS:
        raise ValueError(f"rounding must be one of {ROUNDINGS}")
    exact = f"coalesce({_prediction_long_sql(x0, rounding)}, {_prediction_decimal_sql(x0, rounding)}, "
    exact += "CAST(raise_error('the forecast leaves 38 digits') AS BIGINT))"
    return f"CASE WHEN sum_y IS NULL OR sum_xy IS NULL THEN NULL ELSE {exact} END"


def _position_mask(bits: int, *index_bits: int) -> int:
    """Signed 64-bit mask of the positions b < ``bits`` whose index has all ``index_bits`` set."""
    m = sum(1 << b for b in range(bits) if all((b >> k) & 1 for k in index_bits))
    return m - (1 << 64) if m >= 1 << 63 else m


def bit_power_sum_sql(mask: str, bits: int, power: int, offset: int = 0) -> str:
    """SQL: sum of (b + offset) ** power over the set bits b < ``bits`` of ``mask``.

    Used where the distinct x values of a group are kept as bit masks: their
    count, sum and sum of squares follow exactly from the masks.  Writing a
    position as b = sum_k 2^k [bit k of b], the sum over set bits is
    sum_k 2^k * bit_count(mask & M_k), with M_k the positions whose index has
    bit k set; squares need the pairs M_j & M_k.  So 64 bits take 6 and 21
    ``bit_count`` terms instead of 64 - a small, codegen'd expression.
    """
    if power not in (1, 2):
        raise ValueError("power must be 1 or 2")
    width = max(1, (bits - 1).bit_length())
    cnt = f"bit_count({mask})"

    def count(*ks: int) -> str:
        return f"bit_count({mask} & CAST({_position_mask(bits, *ks)} AS BIGINT))"

    s1 = " + ".join(f"{1 << k} * {count(k)}" for k in range(width))
    s2 = " + ".join(
        f"{(1 << (j + k)) * (1 if j == k else 2)} * {count(j, k)}" for j in range(width) for k in range(j, width)
    )
    if power == 1:
        return f"({s1} + {offset} * {cnt})" if offset else f"({s1})"
    # sum (b + o)^2 = sum b^2 + 2 o sum b + o^2 cnt
    return f"({s2} + {2 * offset} * ({s1}) + {offset * offset} * {cnt})" if offset else f"({s2})"


def linear_fit(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """keys + n and Sx, Sy, Sxy, Sxx (BIGINT; an overflow fails) of columns x, y."""
    cols = ", ".join(f"`{k}`" for k in keys)
    aggs = ", ".join(fit_aggregates(f"`{x}`", f"`{y}`"))
    return df.sparkSession.sql(f"SELECT {cols}, {aggs} FROM {{t}} GROUP BY {cols}", t=df)


def predict_at(fit: DataFrame, x0: int | str, rounding: str = "trunc", alias: str = "predicted") -> DataFrame:
    """Add ``alias`` (BIGINT): the fitted line at ``x0`` (an int or a SQL expression)."""
    return fit.selectExpr("*", f"{prediction_sql(str(x0), rounding)} AS `{alias}`")


def fit_line(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """General (double-valued) fit: slope, intercept and point count per group."""
    cols = ", ".join(f"`{k}`" for k in keys)
    return df.sparkSession.sql(
        f"SELECT {cols}, regr_slope(`{y}`, `{x}`) AS slope, regr_intercept(`{y}`, `{x}`) AS intercept, "
        f"regr_count(`{y}`, `{x}`) AS n FROM {{t}} GROUP BY {cols}",
        t=df,
    )
