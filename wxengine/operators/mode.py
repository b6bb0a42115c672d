"""Most frequent value, the smallest one on a tie.

The mode of a window does not follow from the modes of its parts, so long windows are swept: a
count per value goes up when a reading comes into the window and down when it leaves it,
and every reading costs the same few steps however long the window is.

A series is cut into chunks of days, about as long as the window, and every chunk is swept
on its own. It begins with a table of values and counts, what is in the window as the chunk
starts, and takes events in the order of time: readings come in where the first window that
reaches them begins, a reading asks for the mode, and leaves. Events, tables and chunks are
made by the DataFrame API; rows come to a task sorted by chunk and time and stream through
it, so that a task holds the counts of one window's distinct values and no rows. A station
with a third of all readings is as many chunks as any other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wxengine.functions.ahead import find_mode_in_interval
from wxengine.functions.calendar import (
    Grain,
    Interval,
    instant_to_wall,
    interval,
    trunc_to,
    wall_to_instant,
)
from wxengine.functions.exact import OUTPUT_DECIMALS, present
from wxengine.operators.dedup import first_per_key

# Order of events at one time: the window's end is set back, or moves on by whole days, then
# readings come in, readings ask, and readings leave, as windows are closed at both ends.
_START, _MOVED, _ENTER, _ASK, _LEAVE = range(5)


def _chunk(at: str, days: int) -> str:
    return f"CAST(floor(datediff(CAST({at} AS DATE), DATE'1970-01-01') / {days}) AS INT)"


def _event(at: str, order: int, change: int) -> str:
    return f"struct({at} AS _at, {order} AS _order, {change} AS _change)"


def _month_events(months: int, days: int) -> tuple[list[str], str]:
    """When a reading comes into windows of months, and the first day that it is in before.

    The windows from day d end on day d + months. Up to four days end on the last of a short
    month, so its readings come in, out and in again; days that no window ends on (the 30th
    of March) come in whole with the next.
    """
    midnight = "CAST({} AS TIMESTAMP_NTZ)"
    early = [f"date_add(add_months(_day, -{months}), {i})" for i in range(4)]
    ends = [f"add_months({d}, {months}) = _day" for d in early]
    # The first day whose windows end later than the reading's day.
    later = ", ".join([*early, f"date_add({early[0]}, 4)"])
    first = f"array_min(filter(array({later}), d -> add_months(d, {months}) > _day))"
    events = [f"IF({ends[0]}, {_event(f'{midnight.format(early[0])} + _tod', _ENTER, 1)}, NULL)"]
    # A chunk that starts on that day has the reading in its table.
    whole = f"NOT {ends[0]} AND {_chunk(first, days)} = {_chunk(f'date_sub({first}, 1)', days)}"
    events.append(f"IF({whole}, {_event(midnight.format(first), _MOVED, 1)}, NULL)")
    for d, end in list(zip(early, ends, strict=True))[1:]:
        # A chunk that starts on this day does not have the reading in its table.
        again = f"{end} AND {_chunk(d, days)} = {_chunk(f'date_sub({d}, 1)', days)}"
        events.append(f"IF({again}, {_event(midnight.format(d), _MOVED, -1)}, NULL)")
        events.append(f"IF({end}, {_event(f'{midnight.format(d)} + _tod', _ENTER, 1)}, NULL)")
    # In the table of chunks that start after this day: the windows of their first day go on.
    return events, f"date_sub({first}, 1)"


def _swept(counts: DataFrame, series: list[str], length: Interval) -> DataFrame:
    """(series, at, ``_mode``) for each time in ``counts`` (series, at, ``_value``, ``_n``).

    Rows without a value ask only. Times are not NULL.
    """
    days = max(1, length.longest_days)
    rows = counts.selectExpr(
        *series,
        "_at",
        "_value",
        "_n",
        "CAST(_at AS DATE) AS _day",
        "_at - CAST(CAST(_at AS DATE) AS TIMESTAMP_NTZ) AS _tod",
    )
    if length.months:
        enters, last_day = _month_events(length.months, days)
        first_chunk = f"{_chunk(last_day, days)} + 1"
    else:
        enters = [_event(f"_at - {length.sql}", _ENTER, 1)]
        first_chunk = f"{_chunk(f'_at - {length.sql}', days)} + 1"
    leave = _event("_at", _LEAVE, -1)
    changes = rows.filter("_value IS NOT NULL")
    events = changes.withColumn("_events", F.expr(f"array({', '.join([*enters, leave])})")).select(
        *series, F.explode("_events").alias("_event"), "_value", "_n"
    )
    events = events.filter("_event IS NOT NULL").select(*series, "_event.*", "_value", "_n").selectExpr(
        *series, f"{_chunk('_at', days)} AS _chunk", "_at", "_order", "_value", "_change * _n AS _n"
    )
    # What is in the window as a chunk starts, one row per value.
    own = _chunk("_day", days)
    tables = changes.selectExpr(
        *series, f"explode(IF({first_chunk} <= {own}, sequence({first_chunk}, {own}), array())) AS _chunk", "_value", "_n"
    )
    tables = tables.groupBy(*series, "_chunk", "_value").agg(F.sum("_n").alias("_n"))
    start = f"CAST(date_add(DATE'1970-01-01', _chunk * {days}) AS TIMESTAMP_NTZ)"
    tables = tables.selectExpr(*series, "_chunk", f"{start} AS _at", f"{_START} AS _order", "_value", "_n")
    asks = rows.select(*series, "_at").distinct().selectExpr(
        *series, f"{own.replace('_day', '_at')} AS _chunk", "_at", f"{_ASK} AS _order", "NULL AS _value", "0L AS _n"
    )
    ordered = (
        tables.unionByName(events)
        .unionByName(asks.withColumn("_value", F.col("_value").cast("double")))
        .withColumn("_at", F.unix_micros(wall_to_instant(F.col("_at"))))
        .select("_chunk", "_at", "_order", "_value", "_n", *series)
    )
    # A series may be NULL, in its key too; the chunk leads, being cheaper to compare.
    dealt = ordered.repartition("_chunk", *series).sortWithinPartitions("_chunk", *series, "_at", "_order")
    kinds = ", ".join(f"`{c}` {ordered.schema[c].dataType.simpleString()}" for c in series)
    found = dealt.mapInArrow(_sweep(series), f"{kinds + ', ' if kinds else ''}_at bigint, _mode double")
    return found.withColumn("_at", instant_to_wall(F.timestamp_micros("_at")))


class _Counts:
    """Counts per value, with the most frequent one at hand."""

    def __init__(self) -> None:
        self._count: dict[float, int] = {}
        # Every count that a value has had; those out of date are dropped when they come up.
        self._heap: list[tuple[int, float]] = []

    def change(self, value: float, n: int) -> None:
        count = self._count.get(value, 0) + n
        if count:
            self._count[value] = count
            heapq.heappush(self._heap, (-count, value))
        else:
            del self._count[value]
        if len(self._heap) > 4 * len(self._count) + 64:
            self._heap = [(-c, v) for v, c in self._count.items()]
            heapq.heapify(self._heap)

    def mode(self) -> float | None:
        heap = self._heap
        while heap and self._count.get(heap[0][1], 0) != -heap[0][0]:
            heapq.heappop(heap)
        return heap[0][1] if heap else None


def _sweep(series: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, _Counts()
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ["_chunk", *series]), strict=True)
            columns = (batch.column(c).to_pylist() for c in ("_order", "_value", "_n"))
            asked, modes = [], []
            for i, (key, order, value, n) in enumerate(zip(keys, *columns, strict=True)):
                if key != now:
                    now, counts = key, _Counts()
                if order == _ASK:
                    asked.append(i)
                    modes.append(counts.mode())
                else:
                    counts.change(value, n)
            picked = batch.select([*series, "_at"]).take(pa.array(asked, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(modes, pa.float64())], names=[*series, "_at", "_mode"]
            )

    return run


def rolling_mode(
    readings: DataFrame,
    column: str,
    length: str = "1 hour",
    station: str = "station_id",
    at: str = "measure_at",
    result: str | None = None,
) -> DataFrame:
    """Mode of ``column`` over ``[t, t + length]`` per station, for windows of few readings.

    Each row keeps a frame, without Python. The series is split by day, and readings that an
    earlier day's frames reach are repeated in it; their own results are dropped.
    """
    day = F.col(at).cast("date")
    first = (F.col(at) - interval(length)).cast("date")
    spread = readings.withColumn("_day", F.explode(F.sequence(first, day)))
    mode = find_mode_in_interval(column, at, length, partition_by=(station, "_day"))
    return (
        spread.withColumn(result or f"{column}_mode", mode)
        .filter(F.col("_day") == day)
        .drop("_day")
    )


def swept_mode(
    readings: DataFrame,
    column: str,
    length: str,
    station: str | None = "station_id",
    at: str = "measure_at",
    result: str | None = None,
) -> DataFrame:
    """Mode of ``column`` over ``[t, t + length]`` for every reading, rounded to two decimals.

    Windows may be of any length, months too. ``station=None`` counts the readings of all
    stations together: they are first counted per time and value, and only the distinct times
    are swept. Values are counted as they are, and the mode is rounded once. NaN counts as
    missing. A reading without a time is in no window but its own.
    """
    value = F.expr(present(f"`{column}`"))
    series = [] if station is None else ["_series"]
    named = readings if station is None else readings.withColumn("_series", F.col(station))
    timed = named.filter(F.col(at).isNotNull())
    # 0.0 and -0.0 are one value.
    counts = timed.select(*series, F.col(at).alias("_at"), (value + F.lit(0.0)).alias("_value"))
    counts = counts.groupBy(*series, "_at", "_value").agg(F.count("*").alias("_n"))
    modes = _swept(counts, series, Interval.parse(length)).withColumnsRenamed(
        {"_at": "_asked", "_series": "_of"}
    )
    same = F.col(at) == F.col("_asked")
    if series:
        same = same & F.col("_series").eqNullSafe(F.col("_of"))
    mode = F.when(F.col(at).isNull(), value).otherwise(F.col("_mode"))
    name = result or f"{column}_mode"
    kept = [F.col(f"`{c}`") for c in readings.columns if c != name]
    return named.join(modes, same, "left").select(*kept, F.round(mode, OUTPUT_DECIMALS).alias(name))


def mode_per_unit(
    readings: DataFrame,
    column: str,
    grain: Grain,
    at: str = "measure_at",
    result: str | None = None,
) -> DataFrame:
    """Mode of ``column`` across all stations per calendar unit (half-open).

    Counting per unit and value first shrinks the rows before any unit comes together.
    """
    counts = (
        readings.filter(F.col(column).isNotNull())
        .groupBy(trunc_to(F.col(at), grain).alias(at), F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("value_count"))
    )
    top = first_per_key(counts, (at,), [F.col("value_count").desc(), F.col("_value").asc()])
    return top.select(at, F.col("_value").alias(result or f"{column}_mode"), "value_count")
