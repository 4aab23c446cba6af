"""Exact rounding of sums, averages and shares.

Sums run over integers (fixed-point values are scaled to integers first), so a result does not
depend on the order in which partitions are merged, nor on task retries. A ratio is divided as
decimals and rounded half away from zero, once per result row.
"""


def rounded(x: str, digits: int = 4) -> str:
    """``round(x, digits)`` of a DOUBLE with the same result at less cost per row.

    ``round`` builds a BigDecimal per row. It is needed only next to a tie, where the decimal form
    of the double decides; elsewhere the nearest multiple is found in plain arithmetic.
    """
    y = f"(({x}) * {10**digits}D)"
    plain = f"abs({y}) < 1e9D AND abs(abs({y} - rint({y})) - 0.5D) > 1e-6D"
    return f"CASE WHEN {plain} THEN rint({y}) / {10**digits}D ELSE round({x}, {digits}) END"


def units(x: str, digits: int = 4) -> str:
    """A value already rounded to ``digits`` places, as a BIGINT multiple of ``10**-digits``."""
    return f"CAST(rint(({x}) * {10**digits}D) AS BIGINT)"


def ratio(num: str, den: str, digits: int, scale: int = 0) -> str:
    """``round(num / 10**scale / den, digits)`` as DOUBLE; null where ``den`` is 0 or null.

    ``num`` and ``den`` are BIGINT. The decimal quotient has at least 14 places, so it is never
    rounded into a tie that the true quotient is not.
    """
    bottom = f"NULLIF(CAST({den} AS DECIMAL(20,0)), 0)"
    if scale:
        bottom = f"({bottom} * {10**scale})"
    return f"CAST(round(CAST({num} AS DECIMAL(20,0)) / {bottom}, {digits}) AS DOUBLE)"


def wide_ratio(num: str, den: str, digits: int, scale: int = 0) -> str:
    """The same for DECIMAL(38,0) integers, whose decimal quotient would keep too few places."""
    wide = "DECIMAL(38,0)"
    top, bottom = f"CAST({num} AS {wide})", f"NULLIF(CAST({den} AS {wide}), 0)"
    if digits >= scale:
        top = f"CAST({top} * {10 ** (digits - scale)} AS {wide})"
    else:
        bottom = f"CAST({bottom} * {10 ** (scale - digits)} AS {wide})"
    dividend, divisor = f"CAST({top} * 2 + {bottom} AS {wide})", f"CAST({bottom} * 2 AS {wide})"
    whole = f"CAST({dividend} - {dividend} % {divisor} AS DOUBLE)"
    return f"{whole} / CAST({divisor} AS DOUBLE) / {10**digits}D"


def total(x: str) -> str:
    return f"sum(CAST({x} AS BIGINT))"


def avg_of(x: str, digits: int) -> str:
    """Average of an integer column, nulls ignored."""
    return ratio(total(x), f"count({x})", digits)


def avg_fixed(x: str, digits: int, scale: int = 4) -> str:
    """Average of a fixed-point DOUBLE column, nulls ignored."""
    return ratio(f"sum({units(x, scale)})", f"count({x})", digits, scale)


def sum_fixed(x: str, digits: int, scale: int = 4) -> str:
    return ratio(f"sum({units(x, scale)})", "1", digits, scale)


def hits(condition: str) -> str:
    """``SUM(CASE WHEN condition THEN 1 ELSE 0 END)``; 0 when nothing matches."""
    return f"count_if({condition})"


def percent(part: str, whole: str, digits: int = 1) -> str:
    return ratio(f"({part}) * 100", whole, digits)
