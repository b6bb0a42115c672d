"""Forward-looking window columns: ``[t, t + interval]``, closed at both ends.

These are plain RANGE frames for ad-hoc use on any interval up to weeks. A frame costs
time in proportion to its rows and keeps a series in one task, so whole tables go through
``operators.rolling`` (averages, sums, maxima) or ``operators.mode`` instead, which take
months too. Month frames are refused: adding a month clamps at short months, the frame's
upper bound then moves backwards, and a sliding frame cannot follow it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from wxengine.functions.exact import OUTPUT_DECIMALS, present


def _over(aggregate: str, at: str, interval: str, partition_by: Sequence[str]) -> Column:
    amount, unit = interval.split()
    unit = unit.rstrip("s").upper()
    if unit in ("MONTH", "YEAR"):
        raise ValueError("month frames are not monotonic; use operators.rolling")
    keys = ", ".join(f"`{name}`" for name in partition_by)
    return F.expr(
        f"{aggregate} OVER (PARTITION BY {keys} ORDER BY `{at}` "
        f"RANGE BETWEEN CURRENT ROW AND INTERVAL '{amount}' {unit} FOLLOWING)"
    )


def averaged_by_datetime(
    column: str, at: str, interval: str, partition_by: Sequence[str] = ("station_id",)
) -> Column:
    """Rolling average, rounded to two decimals."""
    exact = f"avg(CAST(`{column}` AS DECIMAL(24,6)))"
    return F.round(_over(exact, at, interval, partition_by), 2).cast("double")


def sum_over_datetime(
    column: str, at: str, interval: str, partition_by: Sequence[str] = ("station_id",)
) -> Column:
    """Rolling sum, rounded to two decimals."""
    exact = f"sum(CAST(`{column}` AS DECIMAL(24,6)))"
    return F.round(_over(exact, at, interval, partition_by), 2).cast("double")


def find_max_in_interval(
    column: str, at: str, interval: str, partition_by: Sequence[str] = ("station_id",)
) -> Column:
    """Rolling maximum of the values as they are, rounded once to two decimals."""
    largest = f"max({present(f'`{column}`')})"
    return F.round(_over(largest, at, interval, partition_by), OUTPUT_DECIMALS)


def find_mode_in_interval(
    column: str, at: str, interval: str, partition_by: Sequence[str] = ("station_id",)
) -> Column:
    """Rolling mode of the values as they are, the smallest on a tie, rounded once to two decimals."""
    mode = f"mode({present(f'`{column}`')}, true)"
    return F.round(_over(mode, at, interval, partition_by), OUTPUT_DECIMALS)
