"""Calendar grains on zone-less wall-clock timestamps.

``date_trunc`` turns TIMESTAMP_NTZ into a zoned timestamp; the helpers here go through
DATE and day-time intervals instead, so no result depends on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Grain:
    """One calendar grain: ``suffix`` names its columns, ``count`` units are its length."""

    suffix: str
    unit: str
    count: int = 1

    @property
    def interval(self) -> str:
        return f"{self.count} {self.unit}"


HOURLY = Grain("hourly", "hour")
DAILY = Grain("daily", "day")
WEEKLY = Grain("weekly", "week")
MONTHLY = Grain("monthly", "month")
GRAINS = (HOURLY, DAILY, WEEKLY, MONTHLY)


# Lengths of the units that have one, in seconds.
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}


@dataclass(frozen=True)
class Interval:
    """A length of time: some months, clamped to a month's last day, or some seconds."""

    months: int = 0
    seconds: int = 0

    @classmethod
    def parse(cls, text: str) -> Interval:
        """From text such as ``90 minutes`` or ``3 months``."""
        amount, unit = text.split()
        unit = unit.lower().rstrip("s")
        if int(amount) <= 0 or unit not in _SECONDS | _MONTHS:
            raise ValueError(f"not a length of time: {text!r}")
        if unit in _MONTHS:
            return cls(months=int(amount) * _MONTHS[unit])
        return cls(seconds=int(amount) * _SECONDS[unit])

    @property
    def sql(self) -> str:
        if self.months:
            return f"INTERVAL '{self.months}' MONTH"
        return f"INTERVAL '{self.seconds}' SECOND"

    @property
    def longest_days(self) -> int:
        """Days that it never exceeds."""
        return 31 * self.months if self.months else -(-self.seconds // 86400)


def interval(text: str) -> Column:
    """Interval literal from text such as ``1 hour``."""
    amount, unit = text.split()
    return F.expr(f"INTERVAL '{amount}' {unit.rstrip('s').upper()}")


def midnight(day: Column) -> Column:
    return day.cast("date").cast("timestamp_ntz")


def time_of_day(at: Column) -> Column:
    """Day-time interval since midnight."""
    return at - midnight(at)


def trunc_to(at: Column, grain: Grain) -> Column:
    """Start of the calendar unit holding ``at``; weeks start on Monday."""
    if grain.unit == "hour":
        return midnight(at) + F.make_dt_interval(hours=F.hour(at))
    if grain.unit == "day":
        return midnight(at)
    return midnight(F.trunc(at.cast("date"), grain.unit))


def is_anchor(at: Column, grain: Grain) -> Column:
    """True for a reading exactly on the start of a calendar unit."""
    return at == trunc_to(at, grain)


def wall_to_instant(at: Column) -> Column:
    """TIMESTAMP whose UTC clock shows the wall-clock value, whatever the session zone.

    Neither a cast nor interval arithmetic on TIMESTAMP would do: both follow the session
    zone's daylight saving.
    """
    seconds = F.date_part(F.lit("SECOND"), at)
    day = (F.year(at), F.month(at), F.dayofmonth(at))
    return F.make_timestamp(*day, F.hour(at), F.minute(at), seconds, F.lit("UTC"))


def instant_to_wall(instant: Column) -> Column:
    """Inverse of :func:`wall_to_instant`."""
    since = F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(instant)
    return F.lit("1970-01-01T00:00:00").cast("timestamp_ntz") + since
