"""Hand-made API records landed the way the extraction step lands them:
``pd.json_normalize`` of the ``results`` list (dotted column names, lists
kept), plus the parent id and ``extraction_timestamp``, one Parquet file
per page under ``<root>/<entity>/new/<batch>/``."""

from __future__ import annotations

import datetime as dt
import os

import pandas as pd

PM25 = {"id": 2, "name": "pm25", "units": "ug/m3", "display_name": "PM2.5"}
NO2 = {"id": 5, "name": "no2", "units": "ppm", "display_name": None}


def t(day: int, hour: int = 0, minute: int = 0) -> str:
    return dt.datetime(2025, 12, day, hour, minute).strftime("%Y-%m-%dT%H:%M:%SZ")


def span(a: str, b: str) -> dict:
    return {"utc": a, "local": a.replace("Z", "+00:00")}


def write_page(root: str, entity: str, records: list[dict], batch: str, extracted: dt.datetime,
               parent: tuple[str, int] | None = None) -> str:
    df = pd.json_normalize(records)
    if parent is not None:
        df[parent[0]] = parent[1]
    df["extraction_timestamp"] = pd.Timestamp(extracted).tz_localize("UTC")
    folder = f"{root}/{entity}/new/{batch}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part-{len(os.listdir(folder)):05d}.parquet"
    df.to_parquet(path, index=False)
    return path


def country(i, code, name):
    return {"id": i, "code": code, "name": name, "datetime_first": "2016-01-01T00:00:00Z",
            "datetime_last": "2025-12-30T00:00:00Z", "parameters": [PM25]}


def parameter(p, description):
    return {**p, "description": description}


def location(i, name, locality, country_id, code, lat, lon, last_day=30):
    return {"id": i, "name": name, "locality": locality, "timezone": "Europe/Belgrade", "is_mobile": False,
            "is_monitor": True, "instruments": [{"id": 1, "name": "Government Monitor"}],
            "sensors": [{"id": i * 10, "name": "pm25 ug/m3", "parameter": PM25}],
            "bounds": [lon, lat, lon, lat], "distance": None,
            "country": {"id": country_id, "code": code, "name": "x"},
            "owner": {"id": 4, "name": "Owner"}, "provider": {"id": 7, "name": "Provider"},
            "coordinates": {"latitude": lat, "longitude": lon},
            "datetime_first": span(t(1), t(1)), "datetime_last": span(t(last_day), t(last_day))}


def sensor(i, param, summary_min, with_latest=True):
    rec = {"id": i, "name": f"{param['name']} {param['units']}", "parameter": param,
           "datetime_first": span(t(1), t(1)), "datetime_last": span(t(30), t(30)),
           "coverage": {"expected_count": 24, "expected_interval": "24:00:00", "observed_count": 20,
                        "observed_interval": "20:00:00", "percent_complete": 83.3, "percent_coverage": 83.3,
                        "datetime_from": span(t(1), t(1)), "datetime_to": span(t(30), t(30))},
           "summary": {"min": summary_min, "q02": 1.5, "q25": 4.0, "median": 8.0, "q75": 12.0, "q98": 30.0,
                       "max": 40.0, "avg": 9.5, "sd": 3.25}}
    rec["latest"] = ({"datetime": span(t(30), t(30)), "value": 12.5,
                      "coordinates": {"latitude": 44.8, "longitude": 20.4}} if with_latest else None)
    return rec


def measurement(value, param, start: str, end: str):
    return {"value": value,
            "period": {"label": "raw", "interval": "01:00:00", "datetime_from": span(start, start),
                       "datetime_to": span(end, end)},
            "parameter": param,
            "coverage": {"expected_count": 1, "expected_interval": "01:00:00", "observed_count": 1,
                         "observed_interval": "01:00:00", "percent_complete": 100.0, "percent_coverage": 100.0,
                         "datetime_from": span(start, start), "datetime_to": span(end, end)}}


def land_first_batch(root: str) -> None:
    e1 = dt.datetime(2025, 12, 30, 6, 0)
    write_page(root, "country", [country(80, "RS", "Serbia"), country(110, "BA", "Bosnia"),
                                 country(1, "XX", "Elsewhere")], "country_b1", e1)
    write_page(root, "parameter", [parameter(PM25, "Fine particles"), parameter(NO2, None),
                                   parameter({"id": 9, "name": "co", "units": "ppm", "display_name": "CO"}, None)],
               "parameter_b1", e1)
    write_page(root, "location", [location(100, "Belgrade-1", "Belgrade", 80, "RS", 44.8, 20.4),
                                  location(101, "Belgrade-2", " Belgrade ", 80, "RS", 44.9, 20.5),
                                  location(102, " Novi Sad ", None, 80, "RS", 45.2, 19.8),
                                  location(103, "Sarajevo-1", "Sarajevo", 110, "BA", 43.8, 18.4)],
               "location_b1", e1)
    # schema drift across sensor pages: summary.min int64 on one page,
    # double on the next, and no latest.* columns on the third
    write_page(root, "sensor", [sensor(1000, PM25, 1)], "sensor_b1", e1, ("location_id", 100))
    write_page(root, "sensor", [sensor(1001, NO2, 2.5)], "sensor_b1", e1, ("location_id", 101))
    write_page(root, "sensor", [sensor(1002, PM25, 3.5, with_latest=False)], "sensor_b1", e1, ("location_id", 103))
    write_page(root, "measurement", [measurement(10.0, PM25, t(28, 10), t(28, 11)),
                                     measurement(20.0, PM25, t(28, 11), t(28, 12)),
                                     measurement(30.0, PM25, t(29, 10), t(29, 11))],
               "measurement_b1", e1, ("sensor_id", 1000))
    write_page(root, "measurement", [measurement(1.0, NO2, t(29, 10), t(29, 11))],
               "measurement_b1", e1, ("sensor_id", 1001))
    # the same reading extracted twice in one batch, with another coverage:
    # both versions tie in bronze and are one row in silver
    twice = measurement(7.0, PM25, t(29, 23), t(30, 0))
    write_page(root, "measurement", [twice], "measurement_b1", e1, ("sensor_id", 1002))
    write_page(root, "measurement", [{**twice, "coverage": {**twice["coverage"], "observed_count": 2}}],
               "measurement_b1", e1, ("sensor_id", 1002))


def land_second_batch(root: str) -> None:
    e2 = dt.datetime(2025, 12, 31, 6, 0)
    write_page(root, "location", [location(104, "Sarajevo-2", "Sarajevo", 110, "BA", 43.9, 18.5)],
               "location_b2", e2)
    write_page(root, "sensor", [sensor(1003, PM25, 4.0)], "sensor_b2", e2, ("location_id", 104))
    # a revised value for an existing reading, and a new reading on a day
    # that already has an aggregate row (the group straddles two batches)
    write_page(root, "measurement", [measurement(99.0, PM25, t(29, 10), t(29, 11)),
                                     measurement(50.0, PM25, t(29, 12), t(29, 13))],
               "measurement_b2", e2, ("sensor_id", 1000))
    write_page(root, "measurement", [measurement(5.0, PM25, t(30, 1), t(30, 2))],
               "measurement_b2", e2, ("sensor_id", 1003))
