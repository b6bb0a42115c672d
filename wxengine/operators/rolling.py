"""Rolling aggregates over ``[t, t + interval]`` for every reading.

A RANGE frame re-aggregates every row's frame (a month holds thousands of readings), keeps
a whole series in one task, and is wrong for months. This plan is linear, splits each
series by day, and is exact for all four grains:

    [t, t + interval] =  rest of t's own block
                      +  whole days in between          (weeks and months only)
                      +  start of the block of t + interval

A block is a day, or an hour for the hourly grain. It takes two shuffles on
(station, day), so a busy station spreads over its days, and no task needs more of a series
at once than one station's readings of one day, 144 at a ten-minute cadence:

1. Running aggregates upward and downward give, at each reading, the start of its block up
   to it and the rest of its block from it on.
2. Each reading's start is placed, at its time of day, into every earlier block whose
   intervals end in its block. There each own reading takes the last start at or before its
   time of day, and the whole days, which come as one row per station and day.

The block scheme follows van Herk (1992) and Gil and Werman (1993).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wxengine.functions.calendar import DAILY, GRAINS, HOURLY, MONTHLY, WEEKLY, Grain
from wxengine.operators.measures import WEATHER, Measures

# Roles of a placed row: a reading itself, or a start that completes a grain's intervals.
_OWN = 0
_ROLE = {"hour": 1, "day": 2, "week": 3, "month": 4}
_RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def rolling(
    readings: DataFrame,
    grains: Sequence[Grain] = GRAINS,
    measures: Measures = WEATHER,
    station: str = "station_id",
    at: str = "measure_at",
    days: DataFrame | None = None,
) -> DataFrame:
    """Add the rolling columns of ``measures`` for each grain.

    The readings must be unique by station and time. Grains are of one hour, day or week, and
    at most one of any number of months.

    ``days`` are the readings' station days (``day_totals``) where they are stored already;
    the readings then need only be those of days on which wanted windows start or end.
    """
    if not grains:
        return readings
    hourly = HOURLY in grains
    by_day = any(grain != HOURLY for grain in grains)
    long_grains = [grain for grain in grains if grain.unit in ("week", "month")]

    blocks = _with_blocks(readings, measures, station, at, hourly, by_day)
    rows = _placed(blocks, readings.columns, grains, station)
    if long_grains:
        days = day_totals(readings, measures, station, at) if days is None else days
        between = _days_between(days, long_grains, measures, station)
        rows = rows.unionByName(between, allowMissingColumns=True)

    # The day leads every sort, as it is cheaper to compare than the station.
    # Starts sort before own readings of the same time, as intervals are closed; the row of
    # whole days has no time and sorts first. The hour leads, so both windows share a sort.
    hour = "_hour, " if hourly else ""
    order = f"_tod, _role DESC {_RUNNING}"
    day_window = f"OVER (PARTITION BY _day, `{station}` ORDER BY {hour}{order})"
    hour_window = f"OVER (PARTITION BY _day, `{station}`, _hour ORDER BY {order})"
    found = [
        f"last(IF(_role = {_ROLE[g.unit]}, _start, NULL), true) {day_window} AS _start_{g.suffix}"
        for g in grains
        if g != HOURLY
    ] + [f"first(_{g.suffix}, true) {day_window} AS _between_{g.suffix}" for g in long_grains]
    if hourly:
        rows = rows.selectExpr("*", "extract(HOUR FROM _tod) AS _hour")
    if found:
        rows = rows.selectExpr("*", *found)
    if hourly:
        start = f"last(IF(_role = {_ROLE['hour']}, _start, NULL), true) {hour_window}"
        rows = rows.selectExpr("*", f"{start} AS _start_hourly")

    totals, values = [], []
    for grain in grains:
        parts = ["_rest_hour" if grain == HOURLY else "_rest_day", f"_start_{grain.suffix}"]
        parts += [f"_between_{grain.suffix}"] if grain in long_grains else []
        prefix = f"{grain.suffix}_"
        totals += [f"{value} AS `{prefix}{n}`" for n, value in measures.joined(parts).items()]
        values += measures.values(grain.suffix, prefix)
    own = rows.filter(f"_role = {_OWN}").selectExpr(*_quoted(readings.columns), *totals)
    return own.selectExpr(*_quoted(readings.columns), *values)


def _quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def _months(grains: Sequence[Grain]) -> int:
    """Length of the one grain of months, 0 without one."""
    (months,) = [g.count for g in grains if g.unit == "month"] or [0]
    return months


def _with_blocks(readings, measures, station, at, hourly, by_day) -> DataFrame:
    """Readings with the start and the rest of their day, and of their hour if needed."""
    # The readings are shuffled as they are: their states follow from them and are wider.
    rows = readings.selectExpr("*", f"CAST(`{at}` AS DATE) AS _day").repartition("_day", station)
    rows = rows.selectExpr(
        "*",
        f"`{at}` - CAST(CAST(`{at}` AS DATE) AS TIMESTAMP_NTZ) AS _tod",
        f"hour(`{at}`) AS _hour",
        f"-hour(`{at}`) AS _hour_down",
        *measures.reading_state(),
    )
    # Days first: their shuffle also serves the hours. Both windows of a direction sort
    # alike, as the hour orders a day the way the time of day does. Going down by a number
    # that the upward windows give keeps the optimizer from mixing the directions, which
    # would sort again for every window.
    blocks = (["day"] if by_day else []) + (["hour"] if hourly else [])

    def window(block: str, hour: str, order: str) -> str:
        keys = f"_day, `{station}`" + (f", {hour}" if block == "hour" else "")
        lead = f"{hour}, " if hourly and block == "day" else ""
        return f"OVER (PARTITION BY {keys} ORDER BY {lead}{order} {_RUNNING})"

    for block in blocks:
        up = window(block, "_hour", "_tod")
        rows = rows.selectExpr("*", *measures.merged_state(f"start_{block}_", over=up))
    rows = rows.selectExpr("*", f"count(1) {up} AS _nth")
    for block in blocks:
        down = window(block, "_hour_down", "_nth DESC")
        rows = rows.selectExpr("*", *measures.merged_state(f"rest_{block}_", over=down))
    packed = [
        f"{measures.packed(f'{prefix}_{block}_')} AS _{prefix}_{block}"
        for prefix in ("start", "rest")
        for block in blocks
    ]
    return rows.selectExpr(*_quoted(readings.columns), f"`{at}` AS _at", "_day", "_tod", *packed)


def _placed(blocks: DataFrame, columns, grains, station) -> DataFrame:
    """Each reading as its own row, and its start in the blocks whose intervals end in its."""

    def place(day: str, tod: str, role: int) -> str:
        return f"struct({day} AS _day, {tod} AS _tod, {role} AS _role)"

    places = [place("_day", "_tod", _OWN)]
    if HOURLY in grains:
        earlier = "_at - INTERVAL '1' HOUR"
        midnight = f"CAST(CAST({earlier} AS DATE) AS TIMESTAMP_NTZ)"
        places.append(place(f"CAST({earlier} AS DATE)", f"{earlier} - {midnight}", _ROLE['hour']))
    if DAILY in grains:
        places.append(place("date_sub(_day, 1)", "_tod", _ROLE['day']))
    if WEEKLY in grains:
        places.append(place("date_sub(_day, 7)", "_tod", _ROLE['week']))
    all_places = f"array({', '.join(places)})"
    if months := _months(grains):
        # The last of a month is reached from up to four days (Feb 28 from Jan 28 to 31),
        # other days from one, and some from none (Mar 30 of a common year): NULL places.
        before = [f"date_add(add_months(_day, -{months}), {later})" for later in range(4)]
        ending = [
            f"IF(add_months({day}, {months}) = _day, {place(day, '_tod', _ROLE['month'])}, NULL)"
            for day in before
        ]
        usual, at_end = ", ".join([*places, ending[0]]), ", ".join([*places, *ending])
        all_places = f"IF(_day = last_day(_day), array({at_end}), array({usual}))"

    # A reading without a time ends no interval but its own.
    all_places = f"IF(_day IS NULL, array({places[0]}), {all_places})"

    structs = [c for c in blocks.columns if c.startswith("_rest_")]
    by_hour, by_day = "_start_hour" in blocks.columns, "_start_day" in blocks.columns
    start = "_start_day" if by_day else "_start_hour"
    if by_hour and by_day:
        start = f"IF(_place._role = {_ROLE['hour']}, _start_hour, _start_day)"
    own = f"_place._role = {_OWN}"
    kept = [c for c in columns if c != station]
    # As a column of its own the array is generated code also where explode is not.
    placed = blocks.withColumn("_places", F.expr(all_places)).withColumn(
        "_place", F.explode("_places")
    )
    placed = placed.filter("_place IS NOT NULL")
    return placed.selectExpr(
        f"`{station}`",
        *[f"IF({own}, `{c}`, NULL) AS `{c}`" for c in [*kept, *structs]],
        f"IF({own}, NULL, {start}) AS _start",
        "_place.*",
    )


def day_totals(
    readings: DataFrame,
    measures: Measures = WEATHER,
    station: str = "station_id",
    at: str = "measure_at",
) -> DataFrame:
    """State of each station day, with its date as ``_of``."""
    states = readings.selectExpr(
        f"`{station}`", f"CAST(`{at}` AS DATE) AS _of", *measures.reading_state()
    )
    return states.groupBy(station, "_of").agg(*[F.expr(e) for e in measures.merged_state()])


def _days_between(days, grains, measures, station) -> DataFrame:
    """For each station and day, the state of the whole days inside its intervals."""
    # A month from day d spans a later day whole if it ends after it; a week if within six.
    months = _months(grains)
    earliest = 31 * months if months else 6
    # Days meet in chunks of a station's days, where each is added up in all places that it
    # counts in; a day goes to one chunk or two. Shuffled place by place, it would go to 31.
    length = 2 * earliest
    chunks = (
        f"sequence(floor((unix_date(_of) - {earliest}) / {length}), floor((unix_date(_of) - 1) / {length}))"
    )
    days = days.withColumn("_of_chunk", F.explode(F.expr(chunks))).repartition("_of_chunk", station)
    first = f"date_from_unix_date(CAST(_of_chunk * {length} AS INT))"
    last = f"least(date_sub(_of, 1), date_add({first}, {length - 1}))"
    start = F.explode(F.expr(f"sequence(greatest(date_sub(_of, {earliest}), {first}), {last})"))
    spanned = {"week": "_day >= date_sub(_of, 6)", "month": f"add_months(_day, {months}) > _of"}
    merged = [
        F.expr(e)
        for grain in grains
        for e in measures.merged_state(f"{grain.suffix}_", where=spanned[grain.unit])
    ]
    between = days.withColumn("_day", start).groupBy(station, "_of_chunk", "_day").agg(*merged)
    return between.selectExpr(
        f"`{station}`",
        "_day",
        *[f"{measures.packed(f'{grain.suffix}_')} AS _{grain.suffix}" for grain in grains],
    )
