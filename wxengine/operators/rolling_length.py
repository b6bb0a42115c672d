"""Rolling aggregates over ``[t, t + length]`` for windows of any length.

Months go through ``operators.rolling``. Any other length is a block: windows that start in
one block end in the next, at the same offset, so an interval is

    the rest of t's block from t on  +  the start of the next block up to t's offset

Both come from running aggregates within a block, and each reading's start is placed into
the block before, where own readings take the last one at or before their offset. The plan is
linear in the readings, splits a station by blocks, and sorts each block twice; window
buffers spill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wxengine.functions.calendar import Grain, Interval, wall_to_instant
from wxengine.operators.measures import WEATHER, Measures
from wxengine.operators.rolling import rolling

_OWN, _START = 0, 1
_RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def rolling_length(
    readings: DataFrame,
    length: str,
    suffix: str,
    measures: Measures = WEATHER,
    station: str = "station_id",
    at: str = "measure_at",
) -> DataFrame:
    """Add ``<measurement>_<suffix>_{average,sum,max}`` over a length such as ``90 minutes``.

    The readings must be unique by station and time. A reading without a time counts for its
    own window only.
    """
    span = Interval.parse(length)
    if span.months:
        return rolling(readings, [Grain(suffix, "month", span.months)], measures, station, at)
    micros = span.seconds * 1_000_000
    own = [f"`{c}`" for c in readings.columns]
    rows = readings.withColumn("_micros", F.unix_micros(wall_to_instant(F.col(at)))).selectExpr(
        *own,
        # Without a time there is no block and nothing else in it.
        f"CAST(floor(_micros / {micros}) AS BIGINT) AS _block",
        f"pmod(_micros, {micros}L) AS _offset",
        *measures.reading_state(),
    )
    up = f"OVER (PARTITION BY _block, `{station}` ORDER BY _offset {_RUNNING})"
    down = f"OVER (PARTITION BY _block, `{station}` ORDER BY _offset DESC {_RUNNING})"
    rows = rows.selectExpr("*", *measures.merged_state("start_", over=up))
    rows = rows.selectExpr("*", *measures.merged_state("rest_", over=down))
    start = f"{measures.packed('start_')} AS _start"
    rows = rows.selectExpr(*own, "_block", "_offset", f"{measures.packed('rest_')} AS _rest", start)

    place = "struct({} AS _block, {} AS _role)"
    places = f"array({place.format('_block', _OWN)}, {place.format('_block - 1', _START)})"
    placed = rows.withColumn("_place", F.explode(F.expr(f"IF(_block IS NULL, slice({places}, 1, 1), {places})")))
    is_own = f"_place._role = {_OWN}"
    kept = [c for c in readings.columns if c != station]
    placed = placed.selectExpr(
        f"`{station}`",
        *[f"IF({is_own}, `{c}`, NULL) AS `{c}`" for c in [*kept, "_rest"]],
        f"IF({is_own}, NULL, _start) AS _start",
        "_offset",
        "_place.*",
    )
    # Starts sort before own readings of the same offset, as intervals are closed.
    window = f"OVER (PARTITION BY _block, `{station}` ORDER BY _offset, _role DESC {_RUNNING})"
    found = placed.selectExpr("*", f"last(_start, true) {window} AS _reached").filter(f"_role = {_OWN}")
    total = [f"{value} AS `_{n}`" for n, value in measures.joined(["_rest", "_reached"]).items()]
    return found.selectExpr(*own, *total).selectExpr(*own, *measures.values(suffix, "_"))
