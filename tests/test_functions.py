"""Column functions on hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tarmac.functions import calendar, lookups, parse, scoring


def values(df, col="x"):
    return [r[col] for r in df.select(col).collect()]


def test_numbers_and_nan(spark):
    df = spark.createDataFrame([("1.5",), ("M",), ("NaN",), (None,), (" 2 ",)], "t string")
    assert values(df.withColumn("x", parse.num("t"))) == [1.5, None, None, None, 2.0]


def test_hhmm(spark):
    rows = [(1530,), (5,), (2400,), (2460,), (1261,), (None,), (2359,)]
    df = spark.createDataFrame(rows, "t int").withColumn("d", F.lit("2024-03-10").cast("date"))
    day = dt.datetime(2024, 3, 10)
    assert values(df.withColumn("x", parse.hhmm_ts("d", "t"))) == [
        day.replace(hour=15, minute=30),
        day.replace(minute=5),
        None,
        None,
        None,
        None,
        day.replace(hour=23, minute=59),
    ]
    assert values(df.withColumn("x", parse.hhmm_minutes("t"))) == [930, 5, 1440, None, None, None, 1439]


def test_wrap_and_blocks(spark):
    df = spark.createDataFrame([(10, 1430), (1430, 10), (720, 0), (0, 720), (1, None)], "a int, b int")
    assert values(df.withColumn("x", parse.wrap_diff(F.col("a"), F.col("b")))) == [20, -20, 720, -720, None]
    blocks = spark.createDataFrame([(5,), (2330,), (2600,), (None,)], "t int")
    assert values(blocks.withColumn("x", parse.time_block("t"))) == ["0000-0059", "2300-2359", "2300-2359", "0000-0059"]


def test_tails(spark):
    df = spark.createDataFrame([(" n012 ",), ("unknown",), ("",), (None,), ("N000",)], "t string")
    assert values(df.withColumn("x", parse.clean_tail("t"))) == ["N012", None, None, None, "N000"]
    assert values(df.withColumn("x", parse.registry_number("t"))) == ["12", "UNKNOWN", "", None, ""]


def test_thanksgiving_2024(spark):
    df = spark.range(1).select(calendar.nth_weekday(F.lit(2024), 11, "Thu", 4).alias("x"))
    assert values(df) == [dt.date(2024, 11, 28)]
    labor = spark.range(1).select(calendar.nth_weekday(F.lit(2025), 9, "Mon", 1).alias("x"))
    assert values(labor) == [dt.date(2025, 9, 1)]
    memorial = spark.range(1).select(calendar.last_weekday(F.lit(2024), 5, "Mon").alias("x"))
    assert values(memorial) == [dt.date(2024, 5, 27)]


def test_holidays_stay_in_their_year(spark):
    days = ["2024-01-01", "2024-12-31", "2024-12-28", "2024-12-29", "2024-11-26", "2024-11-25", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast("date"))
    assert values(df.withColumn("x", calendar.is_holiday(F.col("d")))) == [1, 0, 1, 0, 1, 0, 0]


def test_peak_hour_keeps_unknown(spark):
    df = spark.createDataFrame([(15,), (16,), (20,), (21,), (None,)], "h int")
    assert values(df.withColumn("x", calendar.is_peak_hour(F.col("h")))) == [0, 1, 1, 0, None]


def test_bins_and_scores(spark):
    df = spark.createDataFrame([(0.2, 0.5, 0.1, 0.3), (0.0, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    ps = [F.col(c) for c in "abcd"]
    dist = df.select(scoring.bin_distribution(ps).alias("x"))
    first, second = values(dist)
    assert [round(v, 9) for v in first] == [0.8, 0.0, 0.1, 0.0, 0.1]
    assert second == [1.0, 0.0, 0.0, 0.0, 0.0]
    text = values(df.select(scoring.probability_text(ps).alias("x")))[0]
    assert text == "P>=15=0.200, P>=30=0.500, P>=60=0.100, P>=120=0.300"


def test_reasons(spark):
    df = spark.createDataFrame(
        [(1, 20.0, 40), (0, 2.0, 3), (None, None, None)],
        "flightnum_od_low_support int, flightnum_od_depdelay_mean_lastN double, origin_congestion_3h_total int",
    )
    found = values(df.withColumn("x", scoring.reason(df.columns)))
    assert found[0] == "limited flight-number history; this flight/route often departs late; busy origin (recent congestion)"
    assert found[1] == found[2] == "no strong delay signals detected"


def test_lookups(spark):
    df = spark.createDataFrame([("MSY", 95), ("XXX", 12), (None, None)], "a string, c int")
    assert values(df.withColumn("x", lookups.us_region(F.col("a")))) == ["Southwest", "Other", "Other"]
    assert values(df.withColumn("x", lookups.wmo_class(F.col("c")))) == ["Thunderstorm", "Unknown", "Unknown"]
    names = spark.createDataFrame([("origin_dep_hour_weathercode",), ("carrier_delay_rate_anomaly_7d",), ("od_pair",)], "n string")
    assert values(names.withColumn("x", lookups.feature_family(F.col("n")))) == ["weather", "calendar", "schedule"]
