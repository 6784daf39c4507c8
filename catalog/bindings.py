"""The given tables read as flights, legs, weather and labor actions.

Each binding exists twice: as a DataFrame and as the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AIRPORTS = (
    "ATL BOS DEN DFW ORD EWR PHX BWI MDW BNA LAX SFO SEA LAS MCO MIA CLT MSP DTW SLC SAN AUS HNL JFK ZZZ"
).split()
ZONES = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"]
CARRIERS = ["AF", "AO", "NF", "NO", "RF", "RO"]
HUBS = ["ATL", "ORD", "LAX"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _airport(index: str) -> Column:
    return F.expr(f"element_at(array({_list(AIRPORTS)}), cast({index} as int) + 1)")


def _airport_sql(index: str) -> str:
    return f"([{_list(AIRPORTS)}])[CAST({index} AS INT) + 1]"


# Columns of a flight that read the same in both engines.
_FLIGHT = {
    "Reporting_Airline": "l_returnflag || l_linestatus",
    "Flight_Number_Reporting_Airline": "l_partkey % 2 + 1",
    "Tail_Number": "'N' || l_suppkey",
    "CRSDepTime": "CASE WHEN l_orderkey % 97 = 0 THEN 2400 WHEN l_orderkey % 89 = 0 THEN NULL "
    "ELSE CAST((l_orderkey % 24) * 100 + l_linenumber * 7 % 60 AS INT) END",
    "CRSArrTime": "CAST((l_orderkey % 24 + 1 + l_partkey % 4) % 24 * 100 + l_linenumber * 11 % 60 AS INT)",
    "WheelsOff": "CAST((l_orderkey % 24) * 100 + (l_linenumber * 7 + 13) % 60 AS INT)",
    "DepDelayMinutes": "CASE WHEN l_discount > 0.095 THEN NULL ELSE (l_quantity - 1) * 3 END",
    "ArrDelayMinutes": "CASE WHEN l_tax > 0.075 THEN NULL ELSE (l_quantity - 1) * 3 + l_linenumber * 4 - 14 END",
    "CarrierDelay": "CASE WHEN l_linenumber % 3 = 0 THEN l_quantity ELSE CAST(0 AS DOUBLE) END",
    "WeatherDelay": "CASE WHEN l_linenumber % 5 = 0 THEN l_quantity ELSE CAST(0 AS DOUBLE) END",
    "NASDelay": "CASE WHEN l_linenumber % 4 = 0 THEN l_quantity END",
    "LateAircraftDelay": "CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END",
    "Cancelled": "CASE WHEN l_partkey % 17 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "Diverted": "CASE WHEN l_partkey % 29 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "CRSElapsedTime": "CASE WHEN l_partkey % 10 = 9 THEN CAST(0 AS DOUBLE) ELSE CAST(60 + l_partkey % 10 * 15 AS DOUBLE) END",
    "ActualElapsedTime": "CAST(60 + l_partkey % 10 * 15 AS DOUBLE) + l_quantity - 20",
    "AirTime": "CASE WHEN l_discount < 0.005 THEN NULL ELSE CAST(35 + l_partkey % 10 * 15 AS DOUBLE) + l_quantity - 20 END",
    "TaxiOut": "CAST(l_linenumber * 3 + l_partkey % 7 AS DOUBLE)",
    "TaxiIn": "CAST(l_linenumber + l_partkey % 3 AS DOUBLE)",
    "Distance": "CAST(100 + l_partkey % 50 * 40 AS DOUBLE)",
}

_LEG_ID = {"leg_id": "(l_orderkey * 10 + l_linenumber) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT)"}


def flights(spark: SparkSession, sf: str, numbered: bool = False) -> DataFrame:
    """Line items as flights of one year; the pair of keys is not unique, as in the table.

    ``numbered`` adds ``leg_id``, which is.
    """
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left"
    )
    offset = F.pmod(F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")), F.lit(360))
    return rows.select(
        F.date_add(F.lit("2024-01-01").cast("date"), offset.cast("int")).alias("FlightDate"),
        _airport("s_nationkey").alias("Origin"),
        _airport("l_partkey % 5 * 5").alias("Dest"),
        *[F.expr(e).alias(n) for n, e in (_FLIGHT | (_LEG_ID if numbered else {})).items()],
    )


_FLIGHTS = (
    "SELECT CAST(DATE '2024-01-01' + CAST((date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 360 + 360) % 360 AS INT) AS DATE)"
    f" AS FlightDate, {_airport_sql('s_nationkey')} AS Origin, {_airport_sql('l_partkey % 5 * 5')} AS Dest, "
    + ", ".join(f"{e} AS {n}" for n, e in _FLIGHT.items())
)
_FROM_LINES = " FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey"
FLIGHTS = _FLIGHTS + _FROM_LINES
NUMBERED = _FLIGHTS + f", {_LEG_ID['leg_id']} AS leg_id" + _FROM_LINES

_TYPES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]


def _zone_hours(airport: str) -> str:
    """Hours from an airport's clock to UTC; the airports of the legs lie in four zones."""
    arms = " ".join(f"WHEN '{v}' THEN {5 + i % 4}" for i, v in enumerate(_TYPES))
    return f"CASE {airport} {arms} ELSE 5 END"


def legs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as aircraft legs with a unique id, in whole minutes."""
    dest = f"element_at(array({_list(_TYPES)}), cast((event_id * 7 + user_id) % 5 as int) + 1)"
    e = table(spark, sf, "events")
    dep = F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz")
    return e.select(
        F.col("event_id").alias("leg_id"),
        dep.cast("date").alias("FlightDate"),
        F.expr("'T' || user_id").alias("Tail_Number"),
        F.expr("'C' || user_id % 4").alias("Reporting_Airline"),
        F.expr("user_id % 25").alias("Flight_Number_Reporting_Airline"),
        F.upper("event_type").alias("Origin"),
        F.expr(dest).alias("Dest"),
        dep.alias("dep_dt_local"),
        (dep + F.expr("make_dt_interval(0, 0, cast(30 + event_id % 90 as int), 0)")).alias("arr_dt_local"),
        (dep + F.expr(f"make_dt_interval(0, {_zone_hours('upper(event_type)')}, 0, 0)")).alias("dep_utc"),
        (dep + F.expr(f"make_dt_interval(0, {_zone_hours(dest)}, cast(30 + event_id % 90 as int), 0)")).alias("arr_utc"),
        F.expr("CASE WHEN event_id % 41 = 0 THEN NULL ELSE floor(value) END").cast("double").alias("DepDelayMinutes"),
        (F.hour(dep) * 100 + F.minute(dep)).alias("CRSDepTime"),
        F.expr("CAST(100 + event_id % 60 * 30 AS DOUBLE)").alias("Distance"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 40 AS DOUBLE) END").alias("arrdelay_mean_14d_car_od"),
    )


_DEST_SQL = f"([{_list(_TYPES)}])[CAST((event_id * 7 + user_id) % 5 AS INT) + 1]"
LEGS = (
    "SELECT event_id AS leg_id, CAST(ts AS DATE) AS FlightDate, 'T' || user_id AS Tail_Number, "
    "'C' || user_id % 4 AS Reporting_Airline, user_id % 25 AS Flight_Number_Reporting_Airline, "
    f"upper(event_type) AS Origin, ([{_list(_TYPES)}])[CAST((event_id * 7 + user_id) % 5 AS INT) + 1] AS Dest, "
    "date_trunc('minute', ts) AS dep_dt_local, "
    "date_trunc('minute', ts) + to_minutes(CAST(30 + event_id % 90 AS INT)) AS arr_dt_local, "
    f"date_trunc('minute', ts) + to_hours({_zone_hours('upper(event_type)')}) AS dep_utc, "
    f"date_trunc('minute', ts) + to_minutes(CAST(30 + event_id % 90 AS INT)) + to_hours({_zone_hours(_DEST_SQL)}) AS arr_utc, "
    "CASE WHEN event_id % 41 = 0 THEN NULL ELSE floor(value) END AS DepDelayMinutes, "
    "CAST(extract('hour' FROM ts) * 100 + extract('minute' FROM ts) AS INT) AS CRSDepTime, "
    "CAST(100 + event_id % 60 * 30 AS DOUBLE) AS Distance, "
    "CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 40 AS DOUBLE) END AS arrdelay_mean_14d_car_od "
    "FROM events"
)


def airport_text(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as an airport table in text, as a CSV would give it."""
    return table(spark, sf, "nation").select(
        F.concat(F.lit(" "), F.lower(_airport("n_nationkey"))).alias("IATA"),
        F.expr("CAST(25.0D + n_nationkey * 37 % 24 AS STRING)").alias("Latitude"),
        F.expr("CAST(-71.0D - n_nationkey * 53 % 50 AS STRING)").alias("Longitude"),
        F.expr(f"element_at(array({_list(ZONES)}), n_nationkey % 4 + 1)").alias("Timezone"),
    )


AIRPORT_DIM = (
    f"SELECT {_airport_sql('n_nationkey')} AS IATA, CAST(25 + n_nationkey * 37 % 24 AS DOUBLE) AS Latitude, "
    "CAST(-71 - n_nationkey * 53 % 50 AS DOUBLE) AS Longitude, "
    f"([{_list(ZONES)}])[CAST(n_nationkey % 4 AS INT) + 1] AS Timezone FROM nation"
)


def airport_dim(spark: SparkSession, sf: str) -> DataFrame:
    from tarmac.sources.dims import airports_from

    return airports_from(airport_text(spark, sf))


def daily_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Orders reduced to one row of weather per airport and day; some days are missing."""
    offset = F.pmod(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")), F.lit(360))
    return (
        table(spark, sf, "orders")
        .groupBy(
            _airport("o_custkey % 25").alias("airport"),
            F.date_add(F.lit("2024-01-01").cast("date"), offset.cast("int")).alias("FlightDate"),
        )
        .agg(
            F.round(F.max("o_totalprice") / 10000, 3).alias("temperature_2m_max"),
            F.round(F.min("o_totalprice") / 20000, 3).alias("precipitation_sum"),
            F.max(F.expr("CAST(o_orderkey % 100 AS DOUBLE)")).alias("weathercode"),
        )
    )


DAILY_WX = (
    f"SELECT {_airport_sql('o_custkey % 25')} AS airport, "
    "CAST(DATE '2024-01-01' + CAST((date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) % 360 + 360) % 360 AS INT) AS DATE) AS FlightDate, "
    "round(max(o_totalprice) / 10000, 3) AS temperature_2m_max, round(min(o_totalprice) / 20000, 3) AS precipitation_sum, "
    "max(CAST(o_orderkey % 100 AS DOUBLE)) AS weathercode FROM orders GROUP BY 1, 2"
)


def hourly_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Orders reduced to one row per airport and UTC hour."""
    offset = F.pmod(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")), F.lit(360))
    day = F.date_add(F.lit("2024-01-01").cast("date"), offset.cast("int")).cast("timestamp")
    return (
        table(spark, sf, "orders")
        .groupBy(
            _airport("o_custkey % 25").alias("airport"),
            (day + F.expr("make_dt_interval(0, cast(o_orderkey % 24 as int), 0, 0)")).alias("hour_utc"),
        )
        .agg(F.round(F.max("o_totalprice") / 10000, 3).alias("temperature_2m"), F.max(F.expr("CAST(o_orderkey % 80 AS DOUBLE)")).alias("cape"))
    )


HOURLY_WX = (
    f"SELECT {_airport_sql('o_custkey % 25')} AS airport, "
    "CAST(DATE '2024-01-01' + CAST((date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) % 360 + 360) % 360 AS INT) AS TIMESTAMP) "
    "+ to_hours(CAST(o_orderkey % 24 AS INT)) AS hour_utc, round(max(o_totalprice) / 10000, 3) AS temperature_2m, "
    "max(CAST(o_orderkey % 80 AS DOUBLE)) AS cape FROM orders GROUP BY 1, 2"
)


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """Events as airport reports in text."""
    return table(spark, sf, "events").select(
        _airport("user_id % 25").alias("airport"),
        F.expr("CASE WHEN event_id % 53 = 0 THEN 'no time' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END").alias("valid"),
        F.expr("CASE WHEN event_id % 13 = 0 THEN 'M' WHEN event_id % 11 = 0 THEN 'T' ELSE CAST(floor(value) / 4 AS STRING) END").alias("vsby"),
        F.expr("CASE WHEN event_id % 13 = 0 THEN '999999,9,N,9,N' ELSE lpad(CAST(CAST(floor(value) AS INT) * 100 AS STRING), 6, '0') || ',1,N,5,N' END").alias("VIS"),
        F.expr("CASE WHEN event_id % 53 = 0 THEN 'no time' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END").alias("DATE"),
        "event_id",
    )


REPORTS = (
    f"SELECT {_airport_sql('user_id % 25')} AS airport, "
    "CASE WHEN event_id % 53 = 0 THEN NULL ELSE date_trunc('second', ts) END AS valid_utc, "
    "CASE WHEN event_id % 13 = 0 OR event_id % 11 = 0 THEN NULL ELSE floor(value) / 4 END AS visibility_sm, "
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(CAST(floor(value) AS INT) * 100 AS DOUBLE) END AS metres, event_id FROM events"
)

_ACTION = {
    "event_id": "'E' || n_nationkey",
    "airline_iata": f"CASE WHEN n_nationkey % 6 = 0 THEN 'ALL' ELSE substring('{''.join(CARRIERS)}', n_nationkey % 6 * 2 + 1, 2) END",
    "worker_type": "CASE n_nationkey % 4 WHEN 0 THEN 'pilot' WHEN 1 THEN 'atc' WHEN 2 THEN 'ground_crew' ELSE 'mechanic' END",
    "scope": "CASE n_nationkey % 3 WHEN 0 THEN 'airline_wide' WHEN 1 THEN 'airport_specific' ELSE 'system_wide' END",
    "severity": "n_nationkey % 5 + 1",
}


def actions(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as labor actions; every seventh has no end."""
    start = F.expr("date_add(DATE'2024-01-01', n_nationkey * 14 + 2)")
    return table(spark, sf, "nation").select(
        *[F.expr(e).alias(n) for n, e in _ACTION.items()],
        F.when(
            F.expr("n_nationkey % 3 = 1"), F.concat(_airport("n_nationkey"), F.lit(","), _airport("(n_nationkey + 5) % 25"))
        )
        .otherwise("ALL")
        .alias("affected_airports"),
        start.alias("action_start_date"),
        F.expr("CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE date_add(DATE'2024-01-01', n_nationkey * 14 + 2 + n_nationkey % 20) END").alias("action_end_date"),
        F.expr("CASE WHEN n_nationkey % 2 = 0 THEN date_add(DATE'2024-01-01', n_nationkey * 14 - 20) END").alias("cooling_off_start"),
    )


ACTIONS = (
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _ACTION.items()) + ", "
    f"CASE WHEN n_nationkey % 3 = 1 THEN {_airport_sql('n_nationkey')} || ',' || {_airport_sql('(n_nationkey + 5) % 25')} ELSE 'ALL' END AS affected_airports, "
    "CAST(DATE '2024-01-01' + (n_nationkey * 14 + 2) AS DATE) AS a_start, "
    "CASE WHEN n_nationkey % 7 = 0 THEN CAST(DATE '2024-01-01' + (n_nationkey * 14 + 2) AS DATE) "
    "ELSE CAST(DATE '2024-01-01' + (n_nationkey * 14 + 2 + n_nationkey % 20) AS DATE) END AS a_end, "
    "CASE WHEN n_nationkey % 2 = 0 THEN CAST(DATE '2024-01-01' + (n_nationkey * 14 - 20) AS DATE) END AS cool FROM nation"
)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a score in (0, 1) that repeats across documents."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return (
        table(spark, sf, "labels")
        .join(docs, "doc_id")
        .select(
            "doc_id",
            "lang",
            "source",
            F.col("quality").alias("y"),
            F.col("toxic").alias("toxic"),
            "n_chars",
            F.expr("floor(n_chars / 50) * 50 / (floor(n_chars / 50) * 50 + 1500)").alias("p"),
        )
    )


SCORED = (
    "SELECT doc_id, lang, source, quality AS y, toxic, n_chars, "
    "floor(n_chars / 50) * 50 / (floor(n_chars / 50) * 50 + 1500) AS p FROM labels JOIN documents USING (doc_id)"
)


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as rows with a unique id, a date and a 0/1 label."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderdate").cast("date").alias("FlightDate"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").alias("cust"),
        F.col("o_totalprice").alias("price"),
        F.expr("CASE WHEN o_totalprice > 350000 THEN 1 ELSE 0 END").alias("y"),
    )


ORDERS = (
    "SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS FlightDate, o_orderpriority AS priority, o_custkey AS cust, "
    "o_totalprice AS price, CASE WHEN o_totalprice > 350000 THEN 1 ELSE 0 END AS y FROM orders"
)

VIEWS = {
    "flights": FLIGHTS,
    "numbered": NUMBERED,
    "legs": LEGS,
    "airports": AIRPORT_DIM,
    "daily_wx": DAILY_WX,
    "hourly_wx": HOURLY_WX,
    "reports": REPORTS,
    "actions": ACTIONS,
    "scored": SCORED,
    "ord": ORDERS,
}


def sql(views: str, body: str, **ctes: str) -> str:
    """A statement over the named views; further named queries come before the body."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in views.split()] + [f"{n} AS ({q})" for n, q in ctes.items()]
    text = (f"WITH {', '.join(parts)} " if parts else "") + body
    # The same small shift as on the Spark side keeps exact ties off the rounding edge.
    return text.replace(", 6) + 0.0", " + 1e-9, 6) + 0.0")


def r(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {name}"
