"""Files, text layouts and parsers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarmac.operators import joins
from tarmac.sources import dims, flights, sinks, weather


def test_visibility_units(spark):
    rows = [("2024-01-01 10:53", "10.00"), ("2024-01-01 11:53", "0.25"), ("2024-01-01 12:53", "M"), ("2024-01-01 13:53", "T"), ("2024-01-01 14:53", "30.00"), ("bad", "1")]
    got = weather.parse_visibility(spark.createDataFrame(rows, "valid string, vsby string")).collect()
    assert [r.visibility_m for r in got] == [16093.44, 402.336, None, None, 25000.0]


def test_compound_visibility(spark):
    rows = [("2024-01-01T10:00:00", "016000,1,N,5,N"), ("2024-01-01T11:00:00", "999999,9,N,9,N"), ("2024-01-09T00:00:00", "000400,1,N,5,N")]
    df = spark.createDataFrame(rows, "DATE string, VIS string")
    got = weather.parse_compound_visibility(df, "2024-01-01", "2024-01-02").collect()
    assert [r.visibility_m for r in got] == [16000.0]


def test_reports_join_on_the_hour(spark):
    flights_ = spark.createDataFrame([(1, "DEN", "2024-01-01 15:30"), (2, "DEN", "2024-01-01 14:55"), (3, "BOS", "2024-01-01 15:30")], "id int, Origin string, t string")
    flights_ = flights_.withColumn("dep_utc", F.col("t").cast("timestamp"))
    reports = spark.createDataFrame([("DEN", "2024-01-01 15:53", 3.0), ("DEN", "2024-01-01 15:20", 0.5), ("BOS", "2024-01-01 15:10", None)], "airport string, t string, visibility_m double")
    reports = reports.withColumn("valid_utc", F.col("t").cast("timestamp")).drop("t")
    got = {r.id: r.origin_dep_visibility_isd_m for r in joins.report_visibility(flights_, reports).collect()}
    assert got == {1: 0.5, 2: None, 3: None}


@pytest.mark.parametrize("text", ['"DEN","LAS","mdw"\n', "DEN\nLAS\n MDW \n\n", "DEN, 'LAS'\nMDW"])
def test_allow_list_layouts(spark, tmp_path, text):
    path = tmp_path / "codes.csv"
    path.write_text(text)
    got = {r.IATA for r in dims.load_allow_list(spark, str(path)).collect()}
    assert got == {"DEN", "LAS", "MDW"}


def test_allow_list_column(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text("Rank,IATA\n1,DEN\n2,las\n")
    assert {r.IATA for r in dims.load_allow_list(spark, str(path), "iata").collect()} == {"DEN", "LAS"}


def test_airports_and_gaps(spark, tmp_path):
    path = tmp_path / "airports.csv"
    path.write_text("IATA,Latitude,Longitude,Timezone\nden,39.8,-104.6,America/Denver\nLAS,x,-115,America/Los_Angeles\nMDW,41,-87,nan\nBNA,36,-86,Mars/Base\n")
    airports = dims.load_airports(spark, str(path))
    needed = spark.createDataFrame([("DEN",), ("LAS",), ("MDW",), ("BNA",), ("ATL",)], "IATA string")
    gaps = {r.IATA: r.reason for r in dims.airport_gaps(airports, needed).collect()}
    assert gaps == {"LAS": "BAD_LATLON", "MDW": "MISSING_TZ", "BNA": "UNRECOGNIZED_TZ", "ATL": "MISSING_ROW"}
    with pytest.raises(ValueError, match="LAS:BAD_LATLON"):
        dims.require_airports(airports, needed)
    with pytest.raises(ValueError, match="Timezone"):
        dims.airports_from(airports.drop("Timezone"))


def test_registry_file(spark, tmp_path):
    path = tmp_path / "master.txt"
    path.write_bytes("﻿N-NUMBER , MFR MDL CODE,OTHER,\n 12A , C1 ,x,\n7,C2\n9,C3,y,z,extra\n".encode())
    got = dims.load_registry(spark, str(path), ["N-NUMBER", "MFR MDL CODE"]).collect()
    assert [tuple(r) for r in got] == [("12A", "C1"), ("7", "C2"), ("9", "C3")]


def test_action_calendar(spark, tmp_path):
    path = tmp_path / "actions.csv"
    head = ",".join(dims.ACTION_COLUMNS)
    path.write_text(f"{head}\nE1, wn ,Pilot,AIRLINE_WIDE,all,2024-01-01,,2024-02-01,2024-01-30,10,Strike,9,s,n\nE2,ALL,atc,system_wide,ALL,,,2024-03-01,,x,sickout,2,s,n\n")
    actions = dims.load_actions(spark, str(path))
    assert {(r.event_id, r.problem) for r in dims.action_problems(actions).collect()} == {("E1", "severity_range"), ("E1", "date_order")}
    assert actions.filter("event_id = 'E1'").first().airline_iata == "WN"


def test_scan_and_land(spark, tmp_path):
    rows = [(dt.date(2024, 1, 31), "WN", "DEN", 1), (dt.date(2024, 2, 1), "AA", "DEN", 2), (dt.date(2024, 2, 2), "WN", "LAS", 3)]
    df = spark.createDataFrame(rows, "FlightDate date, Reporting_Airline string, Origin string, extra int").withColumn("Dest", F.lit("BOS"))
    path = str(tmp_path / "raw")
    flights.land_months(df, path)
    got = flights.scan(spark, [f"{path}/Year=2024/Month=*", f"{path}/Year=2024/Month=2", f"{path}/Year=1999/*"], base=path, start="2024-02-01", end="2024-12-31", airlines=["wn"])
    assert [(r.Origin, r.FlightDate) for r in got.collect()] == [("LAS", dt.date(2024, 2, 2))]
    assert "extra" not in got.columns
    # Landing one month again leaves the other months alone.
    flights.land_months(df.filter("extra = 2"), path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(FileNotFoundError):
        flights.read_parquet(spark, [f"{path}/nothing*"])


def test_pushdown_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "WN", "DEN", "BOS", 5.0, 1)], "FlightDate date, Reporting_Airline string, Origin string, Dest string, DepDelayMinutes double, unused int")
    path = str(tmp_path / "f")
    df.write.parquet(path)
    plan = flights.scan(spark, [path], start="2024-01-01", end="2024-02-01").select("Origin")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(FlightDate" in text and "unused" not in text and "DepDelayMinutes" not in text


def test_csv_conversion_skips_done_files(spark, tmp_path):
    source, target = tmp_path / "csv", tmp_path / "parquet"
    source.mkdir()
    (source / "a.csv").write_text("time,v\n2024-01-01T05:00,1\nbad,2\n")
    weather.convert_csv(spark, str(source), str(target))
    (source / "a.csv").write_text("time,v\n2024-01-01T05:00,9\n")
    (source / "b.csv").write_text("time,v\n2024-01-02T05:00,3\n")
    weather.convert_csv(spark, str(source), str(target))
    got = sorted((r.source_file, r.v) for r in spark.read.parquet(str(target)).collect())
    assert got == [("a.csv", "1"), ("a.csv", "2"), ("b.csv", "3")]


def test_payload_without_block(spark):
    df = spark.createDataFrame([('{"daily": {"time": ["2024-01-01", "2024-01-02"], "weather_code": [3, null]}}',), ('{"hourly": {}}',)], "p string")
    got = weather.payload_rows(df, "p", "daily", ["weathercode", "precipitation_sum"]).collect()
    assert [tuple(r) for r in got] == [("2024-01-01", 3.0, None), ("2024-01-02", None, None)]


def test_utc_hours_at_clock_changes(spark):
    rows = [("2024-03-10 01:00",), ("2024-03-10 02:00",), ("2024-03-10 03:00",), ("2024-11-03 00:00",), ("2024-11-03 01:00",), ("2024-11-03 02:00",)]
    df = spark.createDataFrame(rows, "time string").select(F.lit("MDW").alias("airport"), "time", F.lit("America/Chicago").alias("tz"))
    df = df.withColumn("v", F.hour(F.col("time").cast("timestamp")).cast("double"))
    got = {r.hour_utc.strftime("%m-%d %H"): r.v for r in joins.utc_hours(df, ["v"]).collect()}
    # 02:00 does not exist and takes 03:00's place; 01:00 in November occurs twice and is dropped.
    assert got == {"03-10 07": 1.0, "03-10 08": 2.0, "11-03 05": 0.0, "11-03 08": 2.0}


def test_local_times(spark):
    airports = spark.createDataFrame([("MDW", 41.8, -87.7, "America/Chicago"), ("LAX", 33.9, -118.4, "America/Los_Angeles")], "IATA string, Latitude double, Longitude double, Timezone string")
    rows = [(1, "2024-07-01", "MDW", "LAX", 2350, 40), (2, "2024-03-10", "MDW", "LAX", 230, 500), (3, "2024-07-01", "ZZZ", "LAX", 900, 1000)]
    df = spark.createDataFrame(rows, "id int, d string, Origin string, Dest string, CRSDepTime int, CRSArrTime int").withColumn("FlightDate", F.col("d").cast("date"))
    got = {r.id: r for r in joins.local_times(df, airports).withColumns({"dep": F.date_format("dep_utc", "dd HH:mm"), "arr": F.date_format("arr_dt_local", "dd HH:mm")}).collect()}
    assert (got[1].sched_dep_hour, got[1].dep_dow, got[1].dep, got[1].arr) == (23, 0, "02 04:50", "02 00:40")
    assert got[2].dep == "10 08:30" and got[3].dep is None


def test_report_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", float("nan"), 1.23456789), ("b", float("inf"), 2.0)], "f string, x double, y double")
    path = sinks.write_stage(df, str(tmp_path / "{target}_ge{thr}"), "dep", 15)
    assert path.endswith("dep_ge15")
    sinks.write_report(sinks.json_safe(spark.read.parquet(path)), str(tmp_path / "r"))
    got = spark.read.schema("f string, x double, y double").json(str(tmp_path / "r")).orderBy("f").collect()
    assert [(r.x, r.y) for r in got] == [(None, 1.234568), (None, 2.0)]
