"""For each registered query, SQL that gives the same rows over the same tables."""

from __future__ import annotations

from wxengine.catalog.inputs import CUTS, LATE, LATE_WITHIN, STEPS
from wxengine.catalog.queries import CUT_OFF, SHORT_DELAY
from wxengine.operators.measures import WEATHER, Measures
from wxengine.operators.select_suffix import grain_columns, published_name
from wxengine.functions.calendar import DAILY, GRAINS, HOURLY, MONTHLY, WEEKLY, Grain
from wxengine.plans.staging import MAY_BE_TAGGED, NEVER_NEGATIVE, READING_COLUMNS


def _station_id(number: str) -> str:
    return (
        f"CASE ({number}) % 4 WHEN 0 THEN '46' WHEN 1 THEN 'C0' WHEN 2 THEN 'C1' ELSE '72' END"
        f" || lpad(CAST({number} AS VARCHAR), 8, '0')"
    )


def _class(station_id: str) -> str:
    return (
        f"CASE WHEN starts_with({station_id}, '46') THEN '有人站'"
        f" WHEN starts_with({station_id}, 'C0') OR starts_with({station_id}, 'C1') THEN '自動站'"
        " ELSE '農業雨量站' END"
    )


RAW = f"""
events_k AS (
  SELECT event_id, user_id // 32 AS no, event_type, value, ts,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS k
  FROM events
),
unclassed AS (
  SELECT event_id, {_station_id("no")} AS station_id,
         CASE WHEN event_type = 'error' THEN -99.0::DOUBLE ELSE value END AS air_temperature,
         k + 900 AS air_pressure,
         CAST(event_id % 101 AS DOUBLE) AS relative_humidity,
         CAST(event_id % 173 AS DOUBLE) / 10::DOUBLE AS wind_speed,
         (k * 10) % 360 AS wind_direction,
         CAST((event_id * 7) % 360 AS DOUBLE) AS wind_direction_gust,
         (CAST(event_id % 173 AS DOUBLE) + k) / 10::DOUBLE AS peak_gust_speed,
         CASE event_type WHEN 'purchase' THEN k / 2::DOUBLE WHEN 'signup' THEN -99.0::DOUBLE
              ELSE 0.0::DOUBLE END AS precipitation,
         CASE WHEN event_type <> 'view' THEN CAST(event_id % 11 AS DOUBLE) / 10::DOUBLE END
           AS sunshine_duration_10min,
         CAST(event_id % 12 AS DOUBLE) AS uv_index,
         'Station ' || CAST(no AS VARCHAR) || ' ' || event_type AS station_name,
         CASE WHEN event_type = 'error' THEN '-99' ELSE event_type END AS visibility,
         CASE WHEN event_type = 'click' THEN '-99' ELSE event_type END AS weather_status,
         time_bucket(INTERVAL '10 minutes',
           TIMESTAMP '2023-11-28 00:00:00' + (ts - TIMESTAMP '2024-01-01 00:00:00') * 4)
           AS measure_at
  FROM events_k
),
raw AS (SELECT *, {_class("station_id")} AS station_type FROM unclassed)
"""

_CLEAN = ", ".join(
    [f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}" for c in NEVER_NEGATIVE]
    + [f"nullif({c}, '-99') AS {c}" for c in MAY_BE_TAGGED]
)


def _unique(name: str, where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT {", ".join(READING_COLUMNS)} FROM (
    SELECT event_id, station_id, station_name, station_type, measure_at, {_CLEAN}
    FROM raw WHERE {where}
  ) QUALIFY row_number() OVER (PARTITION BY station_id, measure_at ORDER BY event_id) = 1
)
"""


READINGS = RAW + "," + _unique("readings")

_UNIT = {HOURLY: "1 HOUR", DAILY: "1 DAY", WEEKLY: "7 DAY", MONTHLY: "1 MONTH"}


def _round(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def _window_columns(grain: Grain, measures: Measures) -> list[str]:
    w = grain.suffix
    exact = lambda c: f"CAST({c} AS DECIMAL(24,6))"
    return (
        [
            _round(
                f"CAST(sum({exact(c)}) OVER {w} AS DOUBLE) / nullif(count({c}) OVER {w}, 0)"
            )
            + f" AS {c}_{w}_average"
            for c in measures.averaged
        ]
        + [_round(f"sum({exact(c)}) OVER {w}") + f" AS {c}_{w}_sum" for c in measures.summed]
        + [_round(f"max({c}) OVER {w}") + f" AS {c}_{w}_max" for c in measures.maxed]
    )


def _windows(grains) -> str:
    return "WINDOW " + ", ".join(
        f"{g.suffix} AS (PARTITION BY station_id ORDER BY measure_at RANGE BETWEEN CURRENT ROW"
        f" AND INTERVAL {_UNIT[g]} FOLLOWING)"
        for g in grains
    )


def _rolled(source: str, grains, measures: Measures, kept: str) -> str:
    columns = [c for g in grains for c in _window_columns(g, measures)]
    return f"SELECT {kept}, {', '.join(columns)} FROM {source} {_windows(grains)}"


def _rolling(grains, measures: Measures = WEATHER, kept: str = "station_id, measure_at") -> str:
    return f"WITH {READINGS} {_rolled('readings', grains, measures, kept)}"


def _artifact(grain: Grain, measures: Measures = WEATHER, readings: str = READINGS) -> str:
    names = [c.rsplit(" AS ", 1)[1] for c in _window_columns(grain, measures)]
    renamed = ", ".join(f"{c} AS {published_name(c, grain)}" for c in grain_columns(names, grain))
    rolled = _rolled(
        "readings", [grain], measures, "station_id, station_name, station_type, measure_at"
    )
    return (
        f"WITH {readings}, rolled AS ({rolled})"
        f" SELECT station_id, station_name, station_type, measure_at, {renamed} FROM rolled"
        f" WHERE measure_at = date_trunc('{grain.unit}', measure_at)"
    )


_LANDED = f"""
WITH {RAW}
SELECT station_id, {", ".join(NEVER_NEGATIVE)}, station_name, visibility, weather_status,
       station_type, measure_at{{extra}}
FROM raw
"""

_WEATHER_REGISTER = f"""
SELECT {_station_id("s_suppkey")} AS station_id,
       CASE WHEN s_suppkey % 5 = 0 THEN {_station_id("s_suppkey + 1")} END AS original_station_id,
       CASE WHEN s_acctbal < 0 THEN {_station_id("s_suppkey + 2")} END AS new_station_id,
       CASE WHEN s_acctbal < 0 THEN '已撤銷' ELSE '現存測站' END AS station_status,
       s_name AS station_name, upper(s_name) AS station_name_en,
       'C' || CAST(s_nationkey AS VARCHAR) AS country_name,
       'L' || CAST(s_nationkey AS VARCHAR) AS location,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'note' END AS notes,
       s_acctbal AS station_altitude,
       CAST(s_suppkey % 180 AS DOUBLE) AS station_longitude,
       CAST(s_suppkey % 90 AS DOUBLE) AS station_latitude,
       CAST(DATE '1990-01-01' + CAST(s_suppkey % 9000 AS INTEGER) AS DATE) AS start_at,
       CASE WHEN s_acctbal < 0 THEN DATE '2020-06-30' END AS end_at
FROM supplier
"""

_DIGITS = "lpad(CAST((c_custkey * 7919) % 1000000 AS VARCHAR), 6, '0')"
_RAIN_REGISTER = f"""
SELECT {_station_id("c_custkey + 5")} AS station_id,
       CAST(c_nationkey AS VARCHAR) AS city_code,
       substring(c_mktsegment, 1, 3) AS town_code,
       c_name AS station_name,
       CAST(CAST(c_custkey % 90 AS VARCHAR) || '.' || {_DIGITS} AS DECIMAL(10,5)) AS station_latitude,
       CAST(CAST(c_custkey % 180 AS VARCHAR) || '.' || {_DIGITS} AS DECIMAL(10,5)) AS station_longitude,
       'City ' || CAST(c_nationkey AS VARCHAR) AS city_name,
       c_mktsegment AS town_name
FROM customer
"""

_GEO = f"""
SELECT {_station_id("o_custkey")} AS station_id,
       CAST(o_custkey % 90 AS DOUBLE) + 0.5::DOUBLE AS station_latitude,
       CAST(o_custkey % 180 AS DOUBLE) + 0.5::DOUBLE AS station_longitude,
       CAST(o_custkey % 4000 AS DOUBLE) AS station_altitude,
       'County ' || CAST(o_custkey % 23 AS VARCHAR) AS country_name,
       CAST(o_custkey % 23 AS VARCHAR) AS country_code,
       'Town ' || o_orderstatus AS town_name,
       o_orderstatus AS town_code,
       'TWD67' AS coordinate_format,
       o_orderdate, o_orderkey
FROM orders
"""
_GEO_COLUMNS = (
    "station_id, station_latitude, station_longitude, station_altitude, country_name,"
    " country_code, town_name, town_code, coordinate_format"
)

_GEO_OF_STATIONS = f"SELECT DISTINCT {_GEO_COLUMNS} FROM ({_GEO})"

_FULL_OUTER = """
SELECT coalesce(rain.station_id, weather.station_id) AS station_id,
       original_station_id, new_station_id, city_code, town_code, station_status,
       coalesce(rain.station_name, weather.station_name) AS station_name, station_name_en,
       coalesce(city_name, country_name) AS city_name, town_name, location, notes,
       station_altitude,
       coalesce(weather.station_longitude, CAST(rain.station_longitude AS DOUBLE)) AS station_longitude,
       coalesce(weather.station_latitude, CAST(rain.station_latitude AS DOUBLE)) AS station_latitude,
       start_at, end_at
FROM rain FULL OUTER JOIN weather ON rain.station_id = weather.station_id
"""


def _stations(rain: str, weather: str, geo: str, where: str = "") -> str:
    return f"""
WITH rain AS ({rain}), weather AS ({weather}), geo AS ({geo}), both_ AS ({_FULL_OUTER}),
dimension AS (
  SELECT coalesce(both_.station_id, geo.station_id) AS station_id,
         original_station_id, new_station_id,
         coalesce(city_code, geo.country_code) AS country_code,
         coalesce(both_.town_code, geo.town_code) AS town_code,
         station_status, station_name, station_name_en,
         coalesce(city_name, geo.country_name) AS country_name,
         coalesce(both_.town_name, geo.town_name) AS town_name,
         location, notes, coordinate_format AS tw97_coordinate_format,
         {_class("both_.station_id")} AS station_type,
         both_.station_altitude AS station_altitude,
         both_.station_longitude AS station_longitude_wgs87,
         both_.station_latitude AS station_latitude_wgs87,
         geo.station_longitude AS station_longitude_tw97,
         geo.station_latitude AS station_latitude_tw97,
         start_at, end_at
  FROM both_ FULL OUTER JOIN geo ON both_.station_id = geo.station_id
)
SELECT * FROM dimension {where}
"""


def _twice(query: str) -> str:
    return f"SELECT * FROM ({query}) UNION ALL SELECT * FROM ({query})"


_RUN = GRAINS
_RUN_COLUMNS = ", ".join(READING_COLUMNS)


def _two_runs(first_where: str) -> str:
    first = _unique("first_run", first_where)
    return f"""
WITH {READINGS}, {first},
stored AS ({_rolled("first_run", _RUN, WEATHER, _RUN_COLUMNS)}),
again AS ({_rolled("readings", _RUN, WEATHER, _RUN_COLUMNS)})
SELECT * FROM stored
UNION ALL
SELECT * FROM again WHERE measure_at > (SELECT max(measure_at) FROM stored)
"""


def _artifact_runs(grain: Grain) -> str:
    """Two runs of the rolling table, and after each an append to the published one.

    The second takes nothing where the first has published nothing to compare with.
    """
    names = [c.rsplit(" AS ", 1)[1] for c in _window_columns(grain, WEATHER)]
    renamed = ", ".join(f"{c} AS {published_name(c, grain)}" for c in grain_columns(names, grain))
    anchors = f"WHERE measure_at = date_trunc('{grain.unit}', measure_at)"
    first = _unique("first_run", f"measure_at <= TIMESTAMP '{CUT_OFF}'")
    return f"""
WITH {READINGS}, {first},
stored AS ({_rolled("first_run", _RUN, WEATHER, _RUN_COLUMNS)}),
again AS ({_rolled("readings", _RUN, WEATHER, _RUN_COLUMNS)}),
published AS (SELECT * FROM stored {anchors})
SELECT station_id, station_name, station_type, measure_at, {renamed} FROM (
  SELECT * FROM published
  UNION ALL
  SELECT * FROM again {anchors} AND measure_at > (SELECT max(measure_at) FROM published)
    AND measure_at > (SELECT max(measure_at) FROM stored))
"""


def _fine_digits() -> str:
    fine = READINGS + """, fine AS (
  SELECT * REPLACE (round(air_temperature / 7, 6) AS air_temperature) FROM readings)"""
    measures = Measures(*[("air_temperature",)] * 3)
    return f"WITH {fine} {_rolled('fine', GRAINS, measures, 'station_id, measure_at')}"


def _arrivals(late_within: str | None = None) -> str:
    """One reading per station and time, with the step of its first delivery."""
    cuts = [f"TIMESTAMP '{cut}'" for cut in CUTS]
    step = " + ".join(f"CAST(measure_at >= {cut} AS INTEGER)" for cut in cuts)
    near = " OR ".join(
        f"measure_at < {c} AND measure_at >= {c} - INTERVAL {LATE_WITHIN}" for c in cuts
    )
    late = f"{LATE} AND {step} < {len(cuts)}" + (f" AND ({near})" if late_within else "")
    return f"""
arrivals AS (
  SELECT {", ".join(READING_COLUMNS)}, {step} + CAST({late} AS INTEGER) AS step FROM (
    SELECT event_id, station_id, station_name, station_type, measure_at, {_CLEAN} FROM raw
    QUALIFY row_number() OVER (PARTITION BY station_id, measure_at ORDER BY event_id) = 1)
)
"""


def _streamed_hours_closed() -> str:
    """Hours that end before the delay, over what is not later than the delay when it comes."""
    taken = f"""{RAW}, {_arrivals()}, readings AS (
  SELECT * EXCLUDE (step) FROM arrivals a
  WHERE step = 0 OR measure_at >
    (SELECT max(measure_at) FROM arrivals b WHERE b.step < a.step) - INTERVAL {SHORT_DELAY})"""
    closed = f"(SELECT max(measure_at) FROM arrivals) - INTERVAL {SHORT_DELAY}"
    return f"{_artifact(HOURLY, readings=taken)} AND measure_at + INTERVAL 1 HOUR <= {closed}"


# What each run of a job takes: readings later than all that came before it.
_TAKEN = f"{RAW}, {_arrivals()}, " + ", ".join(
    f"""
run{k} AS (
  SELECT * EXCLUDE (step) FROM arrivals
  WHERE step = {k} AND ({k} = 0 OR measure_at > (SELECT max(measure_at) FROM arrivals WHERE step < {k})))
"""
    for k in range(STEPS)
)


def _job_rolled(run: str = "") -> str:
    """The rolling table after a run for each step, with windows as they were then."""
    rolled = [
        f"({_rolled(f'run{k}', _RUN, WEATHER, _RUN_COLUMNS + run.format(k))})" for k in range(STEPS)
    ]
    return f"WITH {_TAKEN} " + " UNION ALL ".join(rolled)


def _job_artifacts() -> str:
    """Published rows of all runs, of grains of which the first run has published some."""
    selects = []
    for grain in GRAINS:
        names = [c.rsplit(" AS ", 1)[1] for c in _window_columns(grain, WEATHER)]
        renamed = ", ".join(f"{c} AS {published_name(c, grain)}" for c in grain_columns(names, grain))
        selects.append(
            f"SELECT station_id, station_name, station_type, measure_at, {renamed},"
            f" '{grain.suffix}' AS grain FROM rolled WHERE measure_at = date_trunc('{grain.unit}', measure_at)"
            f" AND EXISTS (SELECT 1 FROM rolled WHERE run = 0 AND measure_at = date_trunc('{grain.unit}', measure_at))"
        )
    return f"WITH rolled AS ({_job_rolled(', {} AS run')}) " + " UNION ALL ".join(selects)


def _job_closed() -> str:
    runs = " UNION ALL ".join(f"SELECT * FROM run{k}" for k in range(STEPS))
    return f"""
WITH {_TAKEN}, readings AS ({runs}), rolled AS ({_rolled("readings", _RUN, WEATHER, _RUN_COLUMNS)})
SELECT * FROM rolled WHERE measure_at + INTERVAL 1 MONTH <= (SELECT max(measure_at) FROM readings)
"""


def _landed_twice(register: str, again: str) -> str:
    return f"SELECT * FROM ({register}) UNION ALL SELECT * FROM ({register}) WHERE {again}"


# The newest landed row of a station is a copy of the first, so the registers are as they are.
_SEEN_LAST = (
    f"SELECT {_GEO_COLUMNS} FROM ({_GEO}) QUALIFY row_number() OVER"
    " (PARTITION BY station_id ORDER BY o_orderdate DESC, o_orderkey % 1000000 DESC) = 1"
)


def _station_lists() -> str:
    dimension = _stations(_RAIN_REGISTER, _WEATHER_REGISTER, _SEEN_LAST)
    return f"""
WITH listed AS (
  SELECT *, CASE station_status WHEN '現存測站' THEN 'existing' ELSE 'revoked' END AS list
  FROM ({dimension}) WHERE station_status IN ('現存測站', '已撤銷'))
SELECT * FROM listed UNION ALL SELECT * FROM listed
"""


def _swept_mode(length: str, together: bool = False) -> str:
    """Mode by counting the readings of each window; times count once where stations do not."""
    if together:
        return f"""
WITH {READINGS},
asked AS (SELECT DISTINCT measure_at FROM readings),
bag AS (SELECT measure_at, wind_direction AS v, count(*) AS n FROM readings
        WHERE wind_direction IS NOT NULL GROUP BY ALL),
counts AS (SELECT a.measure_at, b.v, sum(b.n) AS n FROM asked a JOIN bag b
           ON b.measure_at BETWEEN a.measure_at AND a.measure_at + INTERVAL {length} GROUP BY ALL),
best AS (SELECT measure_at, v FROM counts
         QUALIFY row_number() OVER (PARTITION BY measure_at ORDER BY n DESC, v) = 1)
SELECT station_id, measure_at, wind_direction, round(v, 2) AS wind_direction_mode
FROM readings LEFT JOIN best USING (measure_at)
"""
    return f"""
WITH {READINGS},
counts AS (SELECT a.station_id, a.measure_at, b.wind_direction AS v, count(*) AS n
           FROM readings a JOIN readings b ON a.station_id = b.station_id
            AND b.measure_at BETWEEN a.measure_at AND a.measure_at + INTERVAL {length}
           WHERE b.wind_direction IS NOT NULL GROUP BY ALL),
best AS (SELECT station_id, measure_at, v FROM counts
         QUALIFY row_number() OVER (PARTITION BY station_id, measure_at ORDER BY n DESC, v) = 1)
SELECT station_id, measure_at, wind_direction, round(v, 2) AS wind_direction_mode
FROM readings LEFT JOIN best USING (station_id, measure_at)
"""


def _rolling_length(length: str, suffix: str) -> str:
    columns = _window_columns(Grain(suffix, "any"), WEATHER)
    return f"""
WITH {READINGS} SELECT station_id, measure_at, {", ".join(columns)} FROM readings
WINDOW {suffix} AS (PARTITION BY station_id ORDER BY measure_at RANGE BETWEEN CURRENT ROW
                    AND INTERVAL {length} FOLLOWING)
"""


_CUSTOMER_RECORDS = (
    "FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0"
)

ORACLES = {
    "scan_json_landing": _LANDED.format(extra=""),
    "landing_compaction": f"""
WITH {RAW}
SELECT 'weather_record' AS feed, CAST(date_trunc('week', measure_at) AS DATE) AS ingest_date,
       station_id, measure_at
FROM raw
""",
    "flatten_object": f"""
SELECT c_custkey, 'name' AS object_key, c_name AS object_value {_CUSTOMER_RECORDS}
UNION ALL
SELECT c_custkey, 'segment' AS object_key, c_mktsegment AS object_value {_CUSTOMER_RECORDS}
""",
    "flatten_nested_array": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "flatten_deep_path": _WEATHER_REGISTER,
    "flatten_top_array": _RAIN_REGISTER,
    "json_extract": _LANDED.format(extra=""),
    "json_array_index": f"SELECT {_GEO_COLUMNS} FROM ({_GEO})",
    "json_casts": """
SELECT o_orderkey, o_totalprice AS price,
       CAST(CAST(o_orderkey % 180 AS VARCHAR) || '.' ||
            lpad(CAST((o_orderkey * 7919) % 1000000 AS VARCHAR), 6, '0') AS DECIMAL(10,5)) AS longitude,
       CAST(o_orderdate AS DATE) AS order_day, o_orderdate AS ordered_at,
       CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey AS DOUBLE) END AS lenient
FROM orders
""",
    "negative_to_null": f"""
WITH {RAW}
SELECT event_id, {", ".join(f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}" for c in NEVER_NEGATIVE)}
FROM raw
""",
    "sentinel_to_null": f"""
WITH {RAW}
SELECT event_id, {", ".join(f"CASE WHEN {c} = '-99' THEN NULL ELSE {c} END AS {c}" for c in MAY_BE_TAGGED)}
FROM raw
""",
    "empty_to_null": """
SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_type END AS type_or_null,
       CASE WHEN p_size % 4 <> 0
            THEN CAST('2024-03-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS DATE) END
         AS day_or_null
FROM part
""",
    "station_type": f"""
WITH keyed AS (
  SELECT o_orderkey,
         CASE WHEN o_custkey % 9 <> 0 THEN {_station_id("o_custkey")} END AS station_id
  FROM orders)
SELECT o_orderkey, station_id, {_class("station_id")} AS station_type FROM keyed
""",
    "dedup_readings": f"WITH {READINGS} SELECT * FROM readings",
    "rolling_avg": _rolling([DAILY], Measures(averaged=WEATHER.averaged)),
    "rolling_sum": _rolling([DAILY], Measures(summed=WEATHER.summed)),
    "rolling_max": _rolling([DAILY], Measures(maxed=WEATHER.maxed)),
    "rolling_mode_station": f"""
WITH {READINGS},
counts AS (
  SELECT a.station_id, a.measure_at, b.wind_direction AS v, count(b.wind_direction) AS n
  FROM readings a JOIN readings b ON a.station_id = b.station_id
   AND b.measure_at BETWEEN a.measure_at AND a.measure_at + INTERVAL 1 HOUR
  GROUP BY ALL),
best AS (
  SELECT station_id, measure_at, v FROM counts
  QUALIFY row_number() OVER (PARTITION BY station_id, measure_at ORDER BY n DESC, v) = 1)
SELECT r.station_id, r.measure_at, r.wind_direction, round(v, 2) AS wind_direction_mode
FROM readings r JOIN best USING (station_id, measure_at)
""",
    "mode_bucket_global": f"""
WITH {READINGS},
counts AS (
  SELECT date_trunc('hour', measure_at) AS measure_at, wind_direction AS v, count(*) AS value_count
  FROM readings WHERE wind_direction IS NOT NULL GROUP BY 1, 2)
SELECT measure_at, v AS wind_direction_mode, value_count FROM counts
QUALIFY row_number() OVER (PARTITION BY measure_at ORDER BY value_count DESC, v) = 1
""",
    "rolling_hour": _rolling([HOURLY]),
    "rolling_day": _rolling([DAILY]),
    "rolling_week": _rolling([WEEKLY]),
    "rolling_month": _rolling([MONTHLY]),
    "rolling_all": _rolling(GRAINS, WEATHER, _RUN_COLUMNS),
    "rolling_fine_digits": _fine_digits(),
    "dynamic_select_hourly": _artifact(HOURLY),
    "dynamic_select_daily": _artifact(DAILY),
    "dynamic_select_weekly": _artifact(WEEKLY),
    "dynamic_select_monthly": _artifact(MONTHLY),
    "window_functions_hour": f"""
WITH {READINGS}
SELECT station_id, measure_at, {_round("CAST(sum(CAST(air_temperature AS DECIMAL(24,6))) OVER w AS DOUBLE) / nullif(count(air_temperature) OVER w, 0)")} AS average,
       {_round("sum(CAST(precipitation AS DECIMAL(24,6))) OVER w")} AS total,
       {_round("max(wind_speed) OVER w")} AS largest
FROM readings
WINDOW w AS (PARTITION BY station_id ORDER BY measure_at RANGE BETWEEN CURRENT ROW
             AND INTERVAL 1 HOUR FOLLOWING)
""",
    "agg_hourly": _artifact(HOURLY),
    "agg_daily": _artifact(DAILY),
    "agg_weekly": _artifact(WEEKLY),
    "agg_monthly": _artifact(MONTHLY),
    "agg_daily_from_days": _artifact(DAILY),
    "agg_weekly_from_days": _artifact(WEEKLY),
    "agg_monthly_from_days": _artifact(MONTHLY),
    "readings_by_class": f"""
WITH {READINGS}
SELECT CASE station_type WHEN '有人站' THEN 'manned' WHEN '自動站' THEN 'automatic'
            ELSE 'agricultural' END AS view_name,
       station_id, measure_at, station_type
FROM readings
""",
    "station_full_outer": f"WITH rain AS ({_RAIN_REGISTER}), weather AS ({_WEATHER_REGISTER}) {_FULL_OUTER}",
    "station_join_3way": _stations(_RAIN_REGISTER, _WEATHER_REGISTER, _GEO_OF_STATIONS),
    "station_fanout": _stations(
        _twice(_RAIN_REGISTER), _twice(_WEATHER_REGISTER), f"SELECT {_GEO_COLUMNS} FROM ({_GEO})"
    ),
    "station_latest": _stations(
        _RAIN_REGISTER,
        _WEATHER_REGISTER,
        f"SELECT {_GEO_COLUMNS} FROM ({_GEO}) QUALIFY row_number() OVER"
        " (PARTITION BY station_id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    ),
    "existing_stations": _stations(
        _RAIN_REGISTER, _WEATHER_REGISTER, _GEO_OF_STATIONS, "WHERE station_status = '現存測站'"
    ),
    "revoked_stations": _stations(
        _RAIN_REGISTER, _WEATHER_REGISTER, _GEO_OF_STATIONS, "WHERE station_status = '已撤銷'"
    ),
    "geo_distinct": f"""
SELECT DISTINCT {_GEO_COLUMNS}, {_class("station_id")} AS station_type FROM ({_GEO})
""",
    "incremental_append": _two_runs(f"measure_at <= TIMESTAMP '{CUT_OFF}'"),
    "artifact_append": _artifact_runs(HOURLY),
    "artifact_append_daily": _artifact_runs(DAILY),
    "artifact_append_weekly": _artifact_runs(WEEKLY),
    "artifact_append_monthly": _artifact_runs(MONTHLY),
    "late_data_drop": _two_runs(f"measure_at <= TIMESTAMP '{CUT_OFF}' AND event_id % 10 <> 3"),
    "full_refresh": _rolling(_RUN, WEATHER, _RUN_COLUMNS),
    "closed_windows_only": f"""
WITH {READINGS}, rolled AS ({_rolled("readings", _RUN, WEATHER, _RUN_COLUMNS)})
SELECT * FROM rolled
WHERE measure_at + INTERVAL 1 MONTH <= (SELECT max(measure_at) FROM readings)
""",
    "stream_file_ingest": _LANDED.format(
        extra=", CAST(date_trunc('week', measure_at) AS DATE) AS ingest_date"
    ),
    "stream_dedup": f"WITH {READINGS} SELECT * FROM readings",
    "stream_agg_hourly": _artifact(HOURLY),
    "stream_agg_daily": _artifact(DAILY),
    "stream_closed_hours": _streamed_hours_closed(),
    "stream_agg_weekly": _artifact(WEEKLY),
    "stream_days_to_months": _artifact(MONTHLY),
    "job_measurements": _job_rolled(),
    "job_artifacts": _job_artifacts(),
    "job_closed_windows": _job_closed(),
    "job_repair": _rolling(_RUN, WEATHER, _RUN_COLUMNS),
    "job_stations": _stations(
        _landed_twice(_RAIN_REGISTER, "city_code <> '3'"),
        _landed_twice(_WEATHER_REGISTER, "location <> 'L3'"),
        _GEO_OF_STATIONS,
    ),
    "job_stations_latest": _stations(_RAIN_REGISTER, _WEATHER_REGISTER, _SEEN_LAST),
    "job_station_lists": _station_lists(),
    "rolling_mode_day": _swept_mode("1 DAY"),
    "rolling_mode_week": _swept_mode("7 DAY"),
    "rolling_mode_month": _swept_mode("1 MONTH"),
    "rolling_mode_all_stations": _swept_mode("1 HOUR", together=True),
    "rolling_mode_all_stations_week": _swept_mode("7 DAY", together=True),
    "rolling_90_minutes": _rolling_length("90 MINUTE", "long"),
    "rolling_36_hours": _rolling_length("36 HOUR", "long"),
    "rolling_3_months": _rolling_length("3 MONTH", "quarterly"),
    "window_functions_digits": f"""
WITH {READINGS},
fine AS (SELECT station_id, measure_at, (uv_index + 1) / 200::DOUBLE - 0.00004::DOUBLE AS v FROM readings),
counts AS (
  SELECT a.station_id, a.measure_at, b.v, count(b.v) AS n
  FROM fine a JOIN fine b ON a.station_id = b.station_id
   AND b.measure_at BETWEEN a.measure_at AND a.measure_at + INTERVAL 1 HOUR
  GROUP BY ALL),
largest AS (SELECT station_id, measure_at, max(v) AS v FROM counts GROUP BY ALL),
modes AS (SELECT station_id, measure_at, v FROM counts
          QUALIFY row_number() OVER (PARTITION BY station_id, measure_at ORDER BY n DESC, v) = 1)
SELECT station_id, measure_at, {_round("largest.v")} AS largest, {_round("modes.v")} AS mode
FROM largest JOIN modes USING (station_id, measure_at)
""",
}
