"""Small responses of the three feeds, in the shape the staging models read."""

from __future__ import annotations

import json
from pathlib import Path


def station(
    station_id="466920",
    at="2024-08-01T10:00:00+08:00",
    name="A",
    temperature="31.2",
    precipitation="0.5",
    weather="-99",
    coordinates=(("f1", "25.01", "121.50"), ("f2", "25.00", "121.49")),
    **changes,
):
    weather_element = {
        "Weather": weather,
        "VisibilityDescription": "16-20",
        "AirTemperature": temperature,
        "AirPressure": "1003.1",
        "RelativeHumidity": "70",
        "WindSpeed": "2.1",
        "WindDirection": "120",
        "SunshineDuration": "0.1",
        "UVIndex": "-99",
        "Now": {"Precipitation": precipitation},
        "GustInfo": {"PeakGustSpeed": "-99", "Occurred_at": {"WindDirection": "-99"}},
    }
    weather_element.update(changes)
    return {
        "StationId": station_id,
        "StationName": name,
        "ObsTime": {"DateTime": at},
        "GeoInfo": {
            "Coordinates": [
                {"CoordinateFormat": f, "StationLatitude": lat, "StationLongitude": lon}
                for f, lat, lon in coordinates
            ],
            "StationAltitude": "5.3",
            "CountyName": "c",
            "TownName": "t",
            "CountyCode": "63",
            "TownCode": "6300100",
        },
        "WeatherElement": weather_element,
    }


def measurements(*stations):
    return {"records": {"Station": list(stations)}}


def weather_station(station_id="466920", status="現存測站", **changes):
    fields = {
        "StationID": station_id,
        "status": status,
        "StationName": "W",
        "StationNameEN": "W EN",
        "CountyName": "wc",
        "Location": "l",
        "Notes": "",
        "OriginalStationID": "",
        "NewStationID": "",
        "StationAltitude": 5.3,
        "StationLongitude": 121.5,
        "StationLatitude": 25.0,
        "StationStartDate": "1896-01-01",
        "StationEndDate": "",
    }
    fields.update(changes)
    return fields


def weather_register(*stations):
    return {"records": {"data": {"stationStatus": {"station": list(stations)}}}}


def rain_station(station_id="C0A520", **changes):
    fields = {
        "Station_ID": station_id,
        "Station_name": "R",
        "Station_Latitude": "24.977123456",
        "Station_Longitude": "121.400000",
        "CITY_SN": "65",
        "CITY": "rc",
        "TOWN_SN": "6500100",
        "TOWN": "rt",
    }
    fields.update(changes)
    return fields


def rain_register(*stations):
    return {"Data": list(stations)}


def land(folder: Path, arrival: str, *responses) -> None:
    """Write one landed file; ``arrival`` is for example 2024-08-01_10_03."""
    folder.mkdir(parents=True, exist_ok=True)
    lines = "\n".join(json.dumps(response, ensure_ascii=False) for response in responses)
    (folder / f"weather_report_10min-{arrival}.json").write_text(lines, encoding="utf-8")
