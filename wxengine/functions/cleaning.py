"""Missing-value conventions and the station class."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The station classes, the id prefixes that decide them, and the text
# that marks a missing value.
MANNED = "有人站"
AUTOMATIC = "自動站"
AGRICULTURAL = "農業雨量站"
CLASS_BY_PREFIX = {"46": MANNED, "C0": AUTOMATIC, "C1": AUTOMATIC}
MISSING_TAG = "-99"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def negative_to_null(value: Column | str) -> Column:
    """Negative numbers mark a missing measurement."""
    value = _column(value)
    return F.when(~(value < 0), value)


def na_tag_to_null(value: Column | str) -> Column:
    """The text ``-99`` marks a missing description."""
    return F.nullif(_column(value), F.lit(MISSING_TAG))


def empty_to_null(value: Column | str) -> Column:
    """The empty string marks a missing text or date."""
    return F.nullif(_column(value), F.lit(""))


def station_class(station_id: Column | str) -> Column:
    """Class of a station from its id prefix; anything else, NULL too, is agricultural."""
    station_id = _column(station_id)
    cases = F
    for prefix, name in CLASS_BY_PREFIX.items():
        cases = cases.when(station_id.startswith(prefix), F.lit(name))
    return cases.otherwise(F.lit(AGRICULTURAL))
