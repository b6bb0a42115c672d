"""Fixed-point arithmetic for sums and averages, as SQL text.

Sums of doubles depend on the order of addition, so two correct plans can round to
different cents. Sums are therefore carried as whole numbers of 10^-6 (bigint): they are
exact in any order and stay in eight bytes. A reading beyond ±10^6 is an error whatever the
ANSI setting, so that no window of fewer than four million readings can overflow. NaN counts
as missing. Maxima stay doubles and are rounded once, at the end.

The helpers give text instead of columns: one call parses a whole select list, where
building dozens of columns piece by piece takes longer than a small query.
"""

from __future__ import annotations

DECIMALS = 6
OUTPUT_DECIMALS = 2
LARGEST = 10**6


def to_units(value: str, decimals: int = DECIMALS) -> str:
    """Nearest whole number of 10^-decimals, as bigint; NULL for NaN."""
    number = present(value)
    units = f"CAST(rint({number} * {10**decimals}D) AS BIGINT)"
    error = f"raise_error(concat('reading beyond the exact range: ', {number}))"
    return f"IF(abs({number}) > {LARGEST}D, CAST({error} AS BIGINT), {units})"


def present(value: str) -> str:
    """The value as double, NULL in place of NaN."""
    return f"nullif(CAST({value} AS DOUBLE), double('NaN'))"


def rounded_ratio(units: str, count: str = "1L", decimals: int = DECIMALS) -> str:
    """``round(units * 10^-decimals / count, 2)`` as double, ties away from zero.

    NULL where ``units`` is NULL or ``count`` is not positive.
    """
    step = f"({count}) * {10 ** (decimals - OUTPUT_DECIMALS)}L"
    half_up = f"(2L * abs({units}) + {step}) DIV (2L * {step})"
    cents = f"IF({units} < 0, -1L, 1L) * ({half_up})"
    return f"IF({count} > 0, CAST({cents} AS DOUBLE) / {10**OUTPUT_DECIMALS}D, NULL)"
