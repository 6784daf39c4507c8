"""Reading, parsing and landing, over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import sets
from tarmac.session import shared_dir
from tarmac.sources import dims, flights, sinks, weather

from . import bindings as b
from .joined import local_sql
from .registry import plain, query

DAY = "CAST(FlightDate AS VARCHAR) AS FlightDate"
TS = "'%Y-%m-%d %H:%M:%S'"


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "flight_scan",
    "S01 P38",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, Dest, {DAY}, DepDelayMinutes FROM flights WHERE FlightDate BETWEEN DATE '2024-02-01' AND DATE '2024-06-30' AND Reporting_Airline IN ('AF', 'RO')",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = flights.select_flights(b.flights(spark, sf), "2024-02-01", "2024-06-30", ["af", "ro"])
    return plain(made.select("Reporting_Airline", "Origin", "Dest", "FlightDate", "DepDelayMinutes"))


@query(
    "allowed_airport_scan",
    "S01 S07 J08",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, Dest, {DAY} FROM flights WHERE Origin IN (SELECT * FROM a) AND Dest IN (SELECT * FROM a) AND Reporting_Airline = 'NF'",
        a=f"SELECT {b._airport_sql('n_nationkey')} FROM nation WHERE n_regionkey < 3",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    codes = b.table(spark, sf, "nation").filter("n_regionkey < 3").select(b._airport("n_nationkey").alias("IATA"))
    made = flights.select_flights(b.flights(spark, sf), single_airline="NF", airports=codes)
    return plain(made.select("Reporting_Airline", "Origin", "Dest", "FlightDate"))


@query(
    "parquet_paths",
    "S01 U01",
    "SELECT 'orders' AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # The second pattern matches the first file again and the third matches nothing.
    orders = flights.read_parquet(spark, [f"{sf}/orders.parquet", f"{sf}/order?.parquet", f"{sf}/no_such_*.parquet"])
    customers = flights.read_parquet(spark, [f"{sf}/customer.parquet"], recursive=True)
    parts = [
        orders.agg(F.lit("orders").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")),
        customers.agg(F.lit("customer").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("key_sum")),
    ]
    return sets.concat(parts)


@query("projected_read", "S02", "SELECT c_custkey, c_acctbal FROM customer")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return flights.read_projected(b.table(spark, sf, "customer"), ["c_custkey", "no_such_column", "c_acctbal"])


@query(
    "canonical_columns",
    "S04",
    "SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS Reporting_Airline, CAST(o_custkey AS BIGINT) AS Flight_Number_Reporting_Airline, o_orderpriority AS Origin, count(*) AS n FROM orders GROUP BY ALL",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.table(spark, sf, "orders").select(
        F.expr("CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END").alias(" Operating_Airline "),
        F.lit("XX").alias("IATA_Code_Marketing_Airline"),
        F.col("o_custkey").alias("Flight_Number_Marketing_Airline"),
        F.col("o_orderpriority").alias("Origin "),
    )
    made = flights.canonicalize(raw)
    return made.groupBy("Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin").agg(F.count(F.lit(1)).alias("n"))


@query("airport_table", "S05", b.sql("airports", "SELECT * FROM airports"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return b.airport_dim(spark, sf)


@query(
    "airport_gaps",
    "S06 U02",
    b.sql(
        "flights",
        f"SELECT IATA, CASE WHEN k % 5 = 0 THEN 'MISSING_ROW' WHEN k % 5 = 1 THEN 'BAD_LATLON' WHEN k % 5 = 2 THEN 'MISSING_TZ' ELSE 'UNRECOGNIZED_TZ' END AS reason FROM "
        f"(SELECT {b._airport_sql('n_nationkey')} AS IATA, n_nationkey AS k FROM nation) WHERE k % 5 < 4 AND IATA IN (SELECT Origin FROM flights UNION SELECT Dest FROM flights)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey") % 5
    table = b.table(spark, sf, "nation").filter(k != 0).select(
        b._airport("n_nationkey").alias("IATA"),
        F.when(k != 1, F.lit("40.0")).alias("Latitude"),
        F.lit("-80").alias("Longitude"),
        F.when(k == 2, F.lit("NaN")).when(k == 3, F.lit("Mars/Base")).otherwise(F.lit("America/Denver")).alias("Timezone"),
    )
    return dims.airport_gaps(dims.airports_from(table), sets.endpoints(b.flights(spark, sf)))


@query(
    "allow_list",
    "S07",
    f"SELECT DISTINCT {b._airport_sql('c_custkey % 20')} AS IATA FROM customer",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    code = b._airport("c_custkey % 20")
    lines = b.table(spark, sf, "customer").select(F.concat(F.lit(' "'), F.lower(code), F.lit("\" , '"), code, F.lit("',")).alias("value"))
    return dims.codes_from_lines(lines)


@query(
    "landed_months",
    "S08 S01",
    b.sql("ord", "SELECT CAST(year(FlightDate) AS INT) AS \"Year\", CAST(month(FlightDate) AS INT) AS \"Month\", count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM ord GROUP BY ALL"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = _place(spark, "months")
    flights.land_months(b.orders(spark, sf), path, ["row_id", "FlightDate", "price"])
    landed = flights.read_parquet(spark, [f"{path}/Year=*/Month=*"], base=path)
    return landed.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"))


@query(
    "converted_csv_columns",
    "S09",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE strftime(o_orderdate, {TS}) END AS time FROM orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr("CASE WHEN o_orderkey % 6 = 0 THEN 'n/a' ELSE date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm\") END")
    return plain(weather.csv_columns(b.table(spark, sf, "orders").select("o_orderkey", text.alias("time"))))


@query(
    "action_problems",
    "S10",
    "SELECT 'E' || c_custkey AS event_id, unnest(list_filter([CASE WHEN c_custkey % 4 = 0 THEN 'worker_type' END, CASE WHEN c_custkey % 3 = 0 THEN 'action_type' END, CASE WHEN c_custkey % 5 = 0 THEN 'scope' END, "
    "CASE WHEN c_custkey % 8 > 5 OR c_custkey % 8 = 0 THEN 'severity_range' END, CASE WHEN c_custkey % 7 = 6 THEN 'date_order' END], lambda x: x IS NOT NULL)) AS problem FROM customer",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    k = "c_custkey"
    raw = b.table(spark, sf, "customer").select(
        F.expr(f"'E' || {k}").alias("event_id"),
        F.lit(" wn").alias("airline_iata"),
        F.expr(f"CASE WHEN {k} % 4 = 0 THEN 'barista' ELSE ' Pilot ' END").alias("worker_type"),
        F.expr(f"CASE WHEN {k} % 5 = 0 THEN NULL ELSE 'AIRLINE_WIDE' END").alias("scope"),
        F.lit("all").alias("affected_airports"),
        F.lit("2024-01-01").alias("announced_date"),
        F.lit("soon").alias("cooling_off_start"),
        F.lit("2024-03-05").alias("action_start_date"),
        F.expr(f"CASE {k} % 7 WHEN 6 THEN '2024-03-01' WHEN 5 THEN 'open' ELSE '2024-03-09' END").alias("action_end_date"),
        F.lit("1200").alias("workers_involved"),
        F.expr(f"CASE WHEN {k} % 3 = 0 THEN 'parade' ELSE 'Strike' END").alias("action_type"),
        F.expr(f"CAST({k} % 8 AS STRING)").alias("severity"),
        F.lit("").alias("source"),
        F.lit("").alias(" notes "),
    )
    return dims.action_problems(dims.actions_from(raw))


@query(
    "visibility_reports",
    "S11",
    b.sql(
        "reports",
        f"SELECT event_id, strftime(valid_utc, {TS}) AS valid_utc, visibility_sm, round(CASE WHEN visibility_sm IS NOT NULL THEN least(25000, visibility_sm * 1609.344) END, 6) + 0.0 AS visibility_m FROM reports WHERE valid_utc IS NOT NULL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(weather.parse_visibility(b.reports(spark, sf), ["event_id"]))


@query(
    "compound_visibility",
    "S12",
    b.sql(
        "reports",
        f"SELECT event_id, strftime(valid_utc, {TS}) AS valid_utc, round(metres / 1609.344, 6) + 0.0 AS visibility_sm, least(25000, metres) AS visibility_m FROM reports "
        "WHERE valid_utc IS NOT NULL AND metres IS NOT NULL AND valid_utc >= TIMESTAMP '2024-01-05' AND valid_utc <= TIMESTAMP '2024-01-21'",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(weather.parse_compound_visibility(b.reports(spark, sf), "2024-01-05", "2024-01-20", ["event_id"]))


_ICAO = "CASE WHEN c_custkey % 6 = 0 THEN 'EGLL' ELSE 'K' || chr(CAST(65 + c_custkey % 26 AS INT)) || chr(CAST(65 + c_custkey % 7 AS INT)) || 'A' END"


@query(
    "station_table",
    "S13 L12",
    b.sql(
        "",
        "SELECT substring(icao, 2, 3) AS IATA, lpad(CAST(arg_max(k, ending) AS VARCHAR), 6, '0') AS usaf, lpad(CAST(arg_max(k % 1000, ending) AS VARCHAR), 5, '0') AS wban FROM s WHERE k % 4 <> 0 AND regexp_matches(icao, '^K[A-Z]{3}$') GROUP BY 1",
        s=f"SELECT c_custkey AS k, {_ICAO} AS icao, 20000101 + c_custkey AS ending FROM customer",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.table(spark, sf, "customer").select(
        F.expr("CAST(c_custkey AS STRING)").alias("USAF"),
        F.expr("CAST(c_custkey % 1000 AS STRING)").alias("WBAN"),
        F.expr("CASE WHEN c_custkey % 4 = 0 THEN 'CA' ELSE 'US' END").alias("CTRY"),
        F.expr(_ICAO).alias("ICAO"),
        F.expr("CAST(20000101 + c_custkey AS STRING)").alias("END"),
    )
    return dims.stations(raw)


@query(
    "payload_rows",
    "S14 S15",
    b.sql("daily_wx", f"SELECT airport, CAST(FlightDate AS VARCHAR) AS time, temperature_2m_max, weathercode, CAST(NULL AS DOUBLE) AS precipitation_sum FROM daily_wx"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # One payload per airport and month, with the newer spelling of one variable.
    wx = b.daily_weather(spark, sf).withColumn("time", F.col("FlightDate").cast("string"))
    rows = wx.groupBy("airport", F.month("FlightDate").alias("m")).agg(F.collect_list(F.struct("time", "temperature_2m_max", "weathercode")).alias("r"))
    arrays = F.struct(
        F.transform("r", lambda x: x["time"]).alias("time"),
        F.transform("r", lambda x: x["temperature_2m_max"]).alias("temperature_2m_max"),
        F.transform("r", lambda x: x["weathercode"]).alias("weather_code"),
    )
    payloads = rows.select("airport", F.to_json(F.struct(arrays.alias("daily"))).alias("payload"))
    return weather.payload_rows(payloads, "payload", "daily", ["temperature_2m_max", "weathercode", "precipitation_sum"], ["airport"])


@query("event_properties", "S14", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(
    "weather_aliases",
    "S15",
    "SELECT l_orderkey, l_linenumber, l_tax AS windspeed_10m, l_discount AS weathercode, l_quantity AS weather_code FROM lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_tax").alias("wind_speed_10m"),
        F.col("l_discount").alias("weathercode"),
        F.col("l_quantity").alias("weather_code"),
    )
    return weather.normalize_columns(raw)


@query(
    "chunk_coverage",
    "S16 L12",
    b.sql(
        "daily_wx",
        f"SELECT airport, {DAY}, temperature_2m_max FROM daily_wx WHERE FlightDate BETWEEN DATE '2024-03-10' AND DATE '2024-05-20' "
        "AND date_trunc('month', FlightDate) + INTERVAL 20 DAY >= DATE '2024-03-10'",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    wx = b.daily_weather(spark, sf)
    month = F.trunc("FlightDate", "month")
    name = F.concat_ws("_", "airport", month.cast("string"), F.date_add(month, 20).cast("string"), F.lit("UTC_daily"))
    # Every row occurs in two chunk files, as overlapping chunks do.
    twice = sets.concat([wx.withColumn("file", name), wx.withColumn("file", name)])
    made = weather.chunks_in_range(twice, F.col("file"), "2024-03-10", "2024-05-20", "FlightDate")
    return plain(made.select("airport", "FlightDate", "temperature_2m_max"))


@query(
    "weather_chunk_files",
    "S16",
    b.sql(
        "daily_wx",
        f"SELECT airport, {DAY}, temperature_2m_max FROM daily_wx WHERE FlightDate BETWEEN DATE '2024-03-10' AND DATE '2024-05-20' "
        "AND date_trunc('month', FlightDate) + INTERVAL 20 DAY >= DATE '2024-03-10'",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Daily weather written as one folder of files per airport and month, and read back by their names."""
    wx = b.daily_weather(spark, sf)
    month = F.trunc("FlightDate", "month")
    name = F.concat_ws("_", "airport", month.cast("string"), F.date_add(month, 20).cast("string"), F.lit("UTC_daily"))
    place = _place(spark, "chunks")
    wx.withColumn("chunk", name).repartition("chunk").write.partitionBy("chunk").parquet(place)
    made = weather.load_chunks(spark, f"{place}/chunk=*/*.parquet", "2024-03-10", "2024-05-20", "FlightDate")
    return plain(made.select("airport", "FlightDate", "temperature_2m_max"))


@query(
    "folder_scan",
    "S03",
    b.sql("flights", f"SELECT Reporting_Airline, Origin, Dest, {DAY}, DepDelayMinutes, Cancelled FROM flights WHERE FlightDate >= DATE '2024-03-01' AND Reporting_Airline IN ('AF', 'NO')"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Flights landed by year and month, and every file below the folder read again."""
    place = _place(spark, "landed")
    flights.land_months(b.flights(spark, sf), place)
    columns = ["FlightDate", "Reporting_Airline", "Origin", "Dest", "DepDelayMinutes", "Cancelled"]
    made = flights.scan_dir(spark, place, columns, start="2024-03-01", airlines=["AF", "NO"])
    return plain(made.select("Reporting_Airline", "Origin", "Dest", "FlightDate", "DepDelayMinutes", "Cancelled"))


@query(
    "raw_month_files",
    "S23",
    b.sql("flights", f"SELECT Reporting_Airline, Origin, Dest, {DAY}, CAST(Flight_Number_Reporting_Airline AS BIGINT) AS Flight_Number_Reporting_Airline FROM flights WHERE Reporting_Airline = 'RO' AND month(FlightDate) IN (2, 3)"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Raw months under the names that they are published with, read for one carrier."""
    raw = b.flights(spark, sf).withColumnsRenamed({"Reporting_Airline": " Operating_Airline", "Flight_Number_Reporting_Airline": "Flight_Number_Operating_Airline"})
    place = _place(spark, "raw")
    # Gathered by month, and a big month cut into pieces of even size, so that no task holds a month.
    raw.withColumn("month", F.month("FlightDate")).hint("rebalance", "month").write.partitionBy("month").parquet(place)
    made = flights.load_raw(spark, [f"{place}/month={m}/*.parquet" for m in (2, 3)], "ro")
    return plain(made.select("Reporting_Airline", "Origin", "Dest", "FlightDate", "Flight_Number_Reporting_Airline"))


@query(
    "csv_files_converted",
    "S09",
    b.sql("daily_wx", f"SELECT airport, strftime(FlightDate, {TS}) AS FlightDate, round(temperature_2m_max, 6) + 0.0 AS temperature_2m_max, CASE WHEN weathercode % 7 = 0 THEN NULL ELSE weathercode END AS weathercode FROM daily_wx"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Daily weather written as CSV, converted once, and again when nothing is left to convert."""
    source, target = _place(spark, "csv"), _place(spark, "converted")
    code = F.when(F.col("weathercode") % 7 == 0, F.lit("n/a")).otherwise(F.col("weathercode").cast("string"))
    wx = b.daily_weather(spark, sf).select("airport", "FlightDate", "temperature_2m_max", code.alias("weathercode"))
    wx.write.csv(source, header=True)
    for _again in range(2):
        weather.convert_csv(spark, source, target, numbers=["temperature_2m_max", "weathercode"])
    return plain(spark.read.parquet(target).drop("source_file"))


@query(
    "registry_table",
    "S18",
    "SELECT coalesce(trim(CAST(p_size AS VARCHAR)), '') AS \"N-NUMBER\", coalesce(CASE WHEN p_partkey % 3 > 0 THEN trim(p_type) END, '') AS \"MFR MDL CODE\", count(*) AS n FROM part GROUP BY ALL",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.table(spark, sf, "part").select(
        F.expr("'  ' || p_size || ' '").alias("N-NUMBER"), F.expr("CASE WHEN p_partkey % 3 > 0 THEN ' ' || p_type END").alias("MFR MDL CODE")
    )
    made = dims.registry_columns(raw, ["N-NUMBER", "MFR MDL CODE"])
    return made.groupBy("N-NUMBER", "MFR MDL CODE").agg(F.count(F.lit(1)).alias("n"))


@query(
    "history_pool",
    "S19 P06",
    b.sql(
        "flights airports",
        f"SELECT Reporting_Airline, Origin, Dest, {DAY}, DepDelayMinutes, CAST(coalesce(DepDelayMinutes >= 15, false) AS INT) AS \"DepDel15\", strftime(dep, {TS}) AS dep_dt_local, strftime(arr0, {TS}) AS arr_dt_local "
        "FROM t WHERE FlightDate BETWEEN DATE '2024-03-01' - 60 AND DATE '2024-07-31'",
        t=local_sql(False),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = flights.history_pool(b.flights(spark, sf), b.airport_dim(spark, sf), "2024-03-01", "2024-07-31")
    return plain(made.select("Reporting_Airline", "Origin", "Dest", "FlightDate", "DepDelayMinutes", "DepDel15", "dep_dt_local", "arr_dt_local"))


@query(
    "chunk_work_list",
    "S20",
    b.sql(
        "airports daily_wx",
        "SELECT airport, CAST(s AS VARCHAR) AS chunk_start, CAST(least(CAST(s + 29 AS DATE), DATE '2024-12-25') AS VARCHAR) AS chunk_end FROM (SELECT IATA AS airport, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-12-25', INTERVAL 30 DAY)) AS DATE) AS s FROM airports) "
        "WHERE (airport, s) NOT IN (SELECT airport, s FROM done)",
        done="SELECT airport, CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '2024-01-01', FlightDate) // 30 * 30 AS INT) AS DATE) AS s FROM daily_wx GROUP BY ALL HAVING max(temperature_2m_max) > 49",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    wx = b.daily_weather(spark, sf)
    start = F.expr("date_add(DATE'2024-01-01', CAST(datediff(FlightDate, DATE'2024-01-01') DIV 30 * 30 AS INT))")
    done = (
        wx.groupBy("airport", start.alias("chunk_start"))
        .agg(F.max("temperature_2m_max").alias("top"))
        .filter("top > 49")
        .select("airport", "chunk_start", F.expr("least(date_add(chunk_start, 29), DATE'2024-12-25')").alias("chunk_end"))
    )
    return plain(weather.plan_chunks(b.airport_dim(spark, sf), "2024-01-01", "2024-12-25", 30, done))


@query(
    "stage_per_threshold",
    "S21 P24",
    b.sql("flights", " UNION ALL ".join(f"SELECT CAST({t} AS INT) AS thr, count(*) AS n, CAST(sum(CAST(coalesce(DepDelayMinutes, 0) >= {t} AS INT)) AS BIGINT) AS late FROM flights" for t in (15, 30, 60, 120))),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf).select("Origin", F.coalesce("DepDelayMinutes", F.lit(0.0)).alias("v"), F.explode(F.array(*map(F.lit, (15, 30, 60, 120)))).alias("thr"))
    path = _place(spark, "thresholds")
    sinks.write_per_threshold(f.withColumn("y", (F.col("v") >= F.col("thr")).cast("int")), path)
    return spark.read.parquet(path).groupBy("thr").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("late"))


@query(
    "statistics_report",
    "S22 A10",
    b.sql(
        "flights",
        " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS count, round(avg({c}), 6) + 0.0 AS mean, round(quantile_cont({c}, 0.95), 6) + 0.0 AS p95 FROM flights" for c in ("TaxiOut", "AirTime")),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from tarmac.operators.stats import numeric_stats

    path = _place(spark, "report")
    sinks.write_report(sinks.json_safe(numeric_stats(b.flights(spark, sf), ["TaxiOut", "AirTime"])), path)
    report = spark.read.schema("feature string, count bigint, mean double, p95 double").json(path)
    return plain(report)
