"""Joins: dimensions, hours, as-of, labor actions, registry and feature merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import actions as act
from tarmac.operators import joins, lags
from tarmac.sources import weather

from . import bindings as b
from .registry import plain, query

CARRIER, ORIGIN, DEST, DATE = "Reporting_Airline", "Origin", "Dest", "FlightDate"
DAY = "CAST(FlightDate AS VARCHAR) AS FlightDate"
TS = "'%Y-%m-%d %H:%M:%S'"

_HAV = (
    "round(2 * 3958.8 * asin(sqrt(pow(sin(radians(d.Latitude - o.Latitude) / 2), 2) + cos(radians(o.Latitude)) * cos(radians(d.Latitude)) "
    "* pow(sin(radians(d.Longitude - o.Longitude) / 2), 2))), 6) + 0.0"
)


@query(
    "airport_lookup",
    "J02",
    b.sql(
        "flights airports",
        "SELECT Origin, count(*) AS n, any_value(Latitude) AS \"Origin_lat\", any_value(Longitude) AS \"Origin_lon\", any_value(Timezone) AS \"Origin_TZ\" FROM flights LEFT JOIN airports ON Origin = IATA GROUP BY Origin",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = joins.airport_columns(b.flights(spark, sf).select(ORIGIN), b.airport_dim(spark, sf), ORIGIN, ORIGIN)
    return made.groupBy(ORIGIN, "Origin_lat", "Origin_lon", "Origin_TZ").agg(F.count(F.lit(1)).alias("n"))


@query(
    "haversine_distance",
    "P09 J02",
    b.sql(
        "flights airports",
        f"SELECT Origin, Dest, {DAY}, {_HAV} AS Distance FROM flights LEFT JOIN airports o ON Origin = o.IATA LEFT JOIN airports d ON Dest = d.IATA",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = b.flights(spark, sf).select(ORIGIN, DEST, DATE, "Distance")
    return plain(joins.haversine_distance(fact, b.airport_dim(spark, sf)))


def instant_sql(zone: str, clock: str) -> str:
    """UTC wall clock of a local one; a repeated hour means its first pass."""
    seen = f"timezone({zone}, {clock})"
    first = f"CASE WHEN timezone({zone}, {seen} - INTERVAL 1 HOUR) = {clock} THEN {seen} - INTERVAL 1 HOUR ELSE {seen} END"
    return f"(({first}) AT TIME ZONE 'UTC')"


def local_sql(overnight: bool = True) -> str:
    def clock(c: str) -> str:
        return f"CASE WHEN {c} <= 2359 AND {c} % 100 < 60 THEN CAST(FlightDate AS TIMESTAMP) + to_minutes(CAST({c} // 100 * 60 + {c} % 100 AS INT)) END"

    roll = "CASE WHEN dep IS NOT NULL AND CRSArrTime < CRSDepTime THEN arr0 + INTERVAL 1 DAY ELSE arr0 END" if overnight else "arr0"
    return (
        f"SELECT *, {roll} AS arr FROM (SELECT f.*, o.Timezone AS otz, d.Timezone AS dtz, {clock('CRSDepTime')} AS dep, {clock('CRSArrTime')} AS arr0 "
        "FROM flights f LEFT JOIN airports o ON Origin = o.IATA LEFT JOIN airports d ON Dest = d.IATA)"
    )


@query(
    "local_times",
    "P05 P06 P10",
    b.sql(
        "flights airports",
        f"SELECT Origin, Dest, {DAY}, strftime(dep, {TS}) AS dep_dt_local, strftime(arr, {TS}) AS arr_dt_local, strftime({instant_sql('otz', 'dep')}, {TS}) AS dep_utc, "
        f"strftime({instant_sql('dtz', 'arr')}, {TS}) AS arr_utc, CAST(hour(dep) AS INT) AS sched_dep_hour, CAST(minute(dep) AS INT) AS sched_dep_minute, "
        f"CAST(isodow(dep) - 1 AS INT) AS dep_dow, CAST(hour(arr) AS INT) AS sched_arr_hour FROM t",
        t=local_sql(),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = joins.local_times(b.flights(spark, sf), b.airport_dim(spark, sf))
    cols = ["dep_dt_local", "arr_dt_local", "dep_utc", "arr_utc", "sched_dep_hour", "sched_dep_minute", "dep_dow", "sched_arr_hour"]
    return plain(made.select(ORIGIN, DEST, DATE, *cols))


@query(
    "daily_weather",
    "J03",
    b.sql(
        "flights daily_wx",
        f"SELECT Origin, Dest, f.FlightDate::VARCHAR AS FlightDate, o.temperature_2m_max AS origin_temperature_2m_max, o.precipitation_sum AS origin_precipitation_sum, o.weathercode AS origin_weathercode, "
        "d.temperature_2m_max AS dest_temperature_2m_max, d.precipitation_sum AS dest_precipitation_sum, d.weathercode AS dest_weathercode FROM flights f "
        "LEFT JOIN daily_wx o ON o.airport = Origin AND o.FlightDate = f.FlightDate LEFT JOIN daily_wx d ON d.airport = Dest AND d.FlightDate = f.FlightDate",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact, wx = b.flights(spark, sf).select(ORIGIN, DEST, DATE), b.daily_weather(spark, sf)
    return plain(joins.daily_weather(joins.daily_weather(fact, wx, ORIGIN, "origin_"), wx, DEST, "dest_"))


@query(
    "hourly_weather",
    "J04 P06",
    b.sql(
        "flights airports hourly_wx",
        f"SELECT Origin, Dest, {DAY}, CRSDepTime, o.temperature_2m AS origin_dep_temperature_2m, o.cape AS origin_dep_cape, d.temperature_2m AS dest_arr_temperature_2m, d.cape AS dest_arr_cape FROM t "
        f"LEFT JOIN hourly_wx o ON o.airport = Origin AND o.hour_utc = date_trunc('hour', {instant_sql('otz', 'dep')}) "
        f"LEFT JOIN hourly_wx d ON d.airport = Dest AND d.hour_utc = date_trunc('hour', {instant_sql('dtz', 'arr')})",
        t=local_sql(),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact, wx = joins.local_times(b.flights(spark, sf), b.airport_dim(spark, sf)), b.hourly_weather(spark, sf)
    made = joins.hourly_weather(joins.hourly_weather(fact, wx, ORIGIN, "dep_utc", "origin_dep_"), wx, DEST, "arr_utc", "dest_arr_")
    return plain(
        made.select(ORIGIN, DEST, DATE, "CRSDepTime", "origin_dep_temperature_2m", "origin_dep_cape", "dest_arr_temperature_2m", "dest_arr_cape")
    )


_LOCAL_WX = (
    "SELECT airport, hour_utc AS time, any_value(Timezone) AS tz, any_value(temperature_2m) AS temperature_2m FROM hourly_wx JOIN airports ON airport = IATA GROUP BY airport, hour_utc"
)


@query(
    "local_hours_to_utc",
    "J05",
    b.sql(
        "airports hourly_wx",
        f"SELECT airport, strftime(hour_utc, {TS}) AS hour_utc, arg_min(temperature_2m, time) AS temperature_2m FROM k GROUP BY ALL",
        x=_LOCAL_WX,
        y="SELECT *, timezone(tz, time) AS moment FROM x",
        # A wall clock that two instants show is ambiguous: it is dropped.
        k="SELECT airport, time, temperature_2m, date_trunc('hour', moment AT TIME ZONE 'UTC') AS hour_utc FROM y WHERE NOT (timezone(tz, moment + INTERVAL 1 HOUR) = time OR timezone(tz, moment - INTERVAL 1 HOUR) = time)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    zones = b.airport_dim(spark, sf).select(F.col("IATA").alias("airport"), F.col("Timezone").alias("tz"))
    local = b.hourly_weather(spark, sf).withColumn("time", F.date_format("hour_utc", "yyyy-MM-dd HH:mm:ss")).join(zones, ["airport"])
    return plain(joins.utc_hours(local, ["temperature_2m"]))


@query(
    "report_visibility",
    "J06 S11 L12",
    b.sql(
        "flights airports reports",
        f"SELECT Origin, {DAY}, CRSDepTime, round(v, 6) + 0.0 AS origin_dep_visibility_isd_m FROM t LEFT JOIN e ON e.airport = Origin AND e.h = date_trunc('hour', {instant_sql('otz', 'dep')})",
        t=local_sql(),
        m="SELECT *, CASE WHEN visibility_sm IS NOT NULL THEN least(25000, visibility_sm * 1609.344) END AS v FROM reports WHERE valid_utc IS NOT NULL",
        e="SELECT airport, date_trunc('hour', valid_utc) AS h, v FROM m QUALIFY row_number() OVER (PARTITION BY airport, date_trunc('hour', valid_utc) ORDER BY valid_utc, event_id) = 1",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = joins.local_times(b.flights(spark, sf), b.airport_dim(spark, sf))
    seen = weather.parse_visibility(b.reports(spark, sf), ["airport"])
    return plain(joins.report_visibility(fact, seen).select(ORIGIN, DATE, "CRSDepTime", "origin_dep_visibility_isd_m"))


@query(
    "asof_statistic",
    "J07",
    b.sql(
        "flights daily_wx",
        "SELECT Origin, f.FlightDate::VARCHAR AS FlightDate, w.temperature_2m_max AS temp FROM flights f ASOF LEFT JOIN w ON w.airport = f.Origin AND f.FlightDate >= w.FlightDate",
        w="SELECT * FROM daily_wx WHERE day(FlightDate) < 12",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    wx = b.daily_weather(spark, sf).filter(F.dayofmonth(DATE) < 12)
    right = wx.select(F.col("airport").alias(ORIGIN), DATE, F.col("temperature_2m_max").alias("temp"))
    return plain(joins.attach_asof(b.flights(spark, sf).select(ORIGIN, DATE), right, [ORIGIN]))


@query(
    "known_keys",
    "J08",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, Dest, {DAY} FROM flights WHERE (Reporting_Airline, Origin) IN (SELECT Reporting_Airline, Origin FROM flights WHERE FlightDate < DATE '2024-01-08')",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    early = f.filter(F.col(DATE) < F.lit("2024-01-08").cast("date"))
    return plain(joins.known_keys(f, early, [CARRIER, ORIGIN]).select(CARRIER, ORIGIN, DEST, DATE))


# --- labor actions ------------------------------------------------------------------------------

_ALL_C = "(airline_iata = 'ALL' OR scope = 'system_wide')"
_ALL_A = "(affected_airports = 'ALL' OR scope IN ('airline_wide', 'system_wide'))"
_HIT_C = f"({_ALL_C} OR a.airline_iata = k.Reporting_Airline)"
_HIT_A = f"({_ALL_A} OR list_contains(string_split(affected_airports, ','), k.Origin))"
_IN = "k.FlightDate BETWEEN a.a_start AND a.a_end"
_KEYS = "SELECT DISTINCT Reporting_Airline, Origin, FlightDate FROM flights"


def _severity(match: str) -> str:
    return b.sql(
        "flights actions",
        f"SELECT Reporting_Airline, Origin, {DAY}, strike_severity FROM flights JOIN s USING (Reporting_Airline, Origin, FlightDate)",
        k=_KEYS,
        s=f"SELECT k.Reporting_Airline, k.Origin, k.FlightDate, CAST(coalesce(max(a.severity), 0) AS INT) AS strike_severity FROM k LEFT JOIN actions a ON {_IN} AND ({match}) GROUP BY ALL",
    )


@query("action_severity", "J09", _severity(f"{_HIT_C} AND {_HIT_A}"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = b.flights(spark, sf).select(CARRIER, ORIGIN, DATE)
    return plain(act.action_severity(fact, b.actions(spark, sf)))


@query("action_severity_either", "J09", _severity(f"{_HIT_C} OR {_HIT_A}"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = b.flights(spark, sf).select(CARRIER, ORIGIN, DATE)
    return plain(act.action_severity(fact, b.actions(spark, sf), "as_written"))


_TO_START = "date_diff('day', k.FlightDate, a.a_start)"
_SINCE_END = "date_diff('day', a.a_end, k.FlightDate)"


@query(
    "days_to_action",
    "J10",
    b.sql(
        "flights actions",
        f"SELECT Reporting_Airline, {DAY}, days_to_strike FROM flights JOIN s USING (Reporting_Airline, FlightDate)",
        k="SELECT DISTINCT Reporting_Airline, FlightDate FROM flights",
        s=f"SELECT k.Reporting_Airline, k.FlightDate, CAST(min({_TO_START}) AS INT) AS days_to_strike FROM k LEFT JOIN actions a ON {_HIT_C} AND {_TO_START} BETWEEN 0 AND 90 GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(act.days_to_action(b.flights(spark, sf).select(CARRIER, DATE), b.actions(spark, sf)))


_RANK = "CASE worker_type WHEN 'atc' THEN 6 WHEN 'pilot' THEN 5 WHEN 'mechanic' THEN 4 WHEN 'flight_attendant' THEN 3 WHEN 'ground_crew' THEN 2 WHEN 'dispatcher' THEN 1 END"
_COOL_LEFT = "date_diff('day', k.FlightDate, a.cool + 30)"


@query(
    "action_features",
    "J11",
    b.sql(
        "flights actions",
        f"SELECT Reporting_Airline, Origin, {DAY}, * EXCLUDE (Reporting_Airline, Origin, FlightDate) FROM (SELECT Reporting_Airline, Origin, FlightDate FROM flights) JOIN s USING (Reporting_Airline, Origin, FlightDate)",
        k=_KEYS,
        s=f"SELECT k.Reporting_Airline, k.Origin, k.FlightDate, CAST(count(*) FILTER ({_IN} AND {_HIT_C}) > 0 AS INT) AS strike_active_carrier, "
        f"CAST(count(*) FILTER ({_IN} AND {_HIT_A}) > 0 AS INT) AS strike_active_origin, CAST(coalesce(max(severity) FILTER ({_IN} AND ({_HIT_C} OR {_HIT_A})), 0) AS INT) AS strike_severity, "
        f"coalesce(arg_max(worker_type, {_RANK}) FILTER ({_IN} AND ({_HIT_C} OR {_HIT_A})), 'none') AS strike_worker_type, "
        f"CAST(count(*) FILTER ({_COOL_LEFT} BETWEEN 0 AND 30 AND (airline_iata = 'ALL' OR airline_iata = k.Reporting_Airline)) > 0 AS INT) AS in_cooling_off, "
        f"CAST(min({_COOL_LEFT}) FILTER ({_COOL_LEFT} BETWEEN 0 AND 30 AND (airline_iata = 'ALL' OR airline_iata = k.Reporting_Airline)) AS INT) AS cooling_off_days_remaining, "
        f"CAST(min({_TO_START}) FILTER ({_HIT_C} AND {_TO_START} BETWEEN 0 AND 90) AS INT) AS days_to_strike, "
        f"CAST(min({_SINCE_END}) FILTER ({_HIT_C} AND {_SINCE_END} BETWEEN 0 AND 90) AS INT) AS days_since_strike_end, "
        f"CAST(count(*) FILTER ({_IN} AND {_HIT_A} AND airline_iata <> 'ALL' AND airline_iata <> k.Reporting_Airline) > 0 AS INT) AS strike_spillover_origin "
        "FROM k, actions a GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = b.flights(spark, sf).select(CARRIER, ORIGIN, DATE)
    return plain(act.action_features(fact, b.actions(spark, sf)))


@query(
    "event_study",
    "A27",
    b.sql(
        "flights actions",
        f"SELECT event_id, {DAY}, count(DepDelayMinutes) AS flights, round(avg(DepDelayMinutes), 6) + 0.0 AS mean_delay, round(100 * avg(CAST(coalesce(DepDelayMinutes >= 15, false) AS DOUBLE)), 6) + 0.0 AS delay_rate_15, "
        "FlightDate BETWEEN a_start AND a_end AS in_action FROM flights JOIN actions ON (airline_iata = 'ALL' OR airline_iata = Reporting_Airline) AND FlightDate BETWEEN a_start - 7 AND a_end + 7 GROUP BY event_id, FlightDate, a_start, a_end",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(act.event_study(b.flights(spark, sf), b.actions(spark, sf), "DepDelayMinutes"))


# --- registry and merges ------------------------------------------------------------------------


def _registry(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    s = b.table(spark, sf, "supplier")
    master = s.filter("s_suppkey % 7 != 0").select(F.col("s_suppkey").cast("string").alias("n_number"), F.expr("'C' || s_nationkey").alias("mfr_mdl_code"))
    models = b.table(spark, sf, "nation").select(
        F.expr("'C' || n_nationkey").alias("code"), F.expr("' ' || n_name").alias("mfr"), F.expr("CASE WHEN n_nationkey % 2 = 0 THEN 'M' || n_nationkey END").alias("model")
    )
    return master, models


@query(
    "aircraft_type",
    "J12 P20",
    b.sql(
        "flights",
        "SELECT Tail_Number, coalesce(nullif(trim(coalesce(trim(mfr), '') || ' ' || coalesce(model, '')), ''), 'Unknown') AS aircraft_type, count(*) AS n FROM flights LEFT JOIN m ON regexp_replace(regexp_replace(Tail_Number, '^N', ''), '^0+', '') = n_number "
        "LEFT JOIN d USING (code) GROUP BY ALL",
        m="SELECT CAST(s_suppkey AS VARCHAR) AS n_number, 'C' || s_nationkey AS code FROM supplier WHERE s_suppkey % 7 <> 0",
        d="SELECT 'C' || n_nationkey AS code, ' ' || n_name AS mfr, CASE WHEN n_nationkey % 2 = 0 THEN 'M' || n_nationkey END AS model FROM nation",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = joins.aircraft_type(b.flights(spark, sf).select("Tail_Number"), *_registry(spark, sf))
    return made.groupBy("Tail_Number", "aircraft_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "aircraft_age",
    "P19",
    b.sql(
        "flights",
        "SELECT Tail_Number, a AS \"Aircraft_Age_Years\", CASE WHEN a IS NULL THEN 'Unknown' WHEN a <= 5 THEN '0-5' WHEN a <= 10 THEN '6-10' WHEN a <= 15 THEN '11-15' ELSE '16+' END AS \"Aircraft_Age_Bucket\", count(*) AS n "
        "FROM (SELECT Tail_Number, CAST(year(FlightDate) - y AS DOUBLE) AS a FROM flights LEFT JOIN r USING (Tail_Number)) GROUP BY ALL",
        r="SELECT 'N' || s_suppkey AS Tail_Number, 1995 + s_suppkey % 30 AS y FROM supplier WHERE s_suppkey % 9 <> 0",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    reg = b.table(spark, sf, "supplier").filter("s_suppkey % 9 != 0").select(
        F.expr("'N' || s_suppkey").alias("Tail_Number"), F.expr("CAST(1995 + s_suppkey % 30 AS DOUBLE)").alias("Year_Mfr")
    )
    made = joins.aircraft_age(b.flights(spark, sf).select("Tail_Number", DATE), reg)
    return made.groupBy("Tail_Number", "Aircraft_Age_Years", "Aircraft_Age_Bucket").agg(F.count(F.lit(1)).alias("n"))


@query(
    "merged_features",
    "J13 U05",
    b.sql(
        "legs",
        "SELECT leg_id, d.n_dep, d.worst FROM legs LEFT JOIN d USING (FlightDate, Reporting_Airline, Flight_Number_Reporting_Airline, Origin, Dest, CRSDepTime)",
        d="SELECT FlightDate, Reporting_Airline, Flight_Number_Reporting_Airline, Origin, Dest, CRSDepTime, count(*) AS n_dep, max(DepDelayMinutes) AS worst FROM legs GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from tarmac.plans.arrival import MERGE_KEYS

    legs = b.legs(spark, sf)
    keys = [k for k in MERGE_KEYS if k in legs.columns]
    dep = legs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_dep"), F.max("DepDelayMinutes").alias("worst"))
    return joins.merge_features(legs, dep, MERGE_KEYS).select("leg_id", "n_dep", "worst")


@query(
    "duplicate_keys",
    "J13",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return joins.duplicate_keys(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "merged_hourly_feeds",
    "S17",
    b.sql(
        "hourly_wx",
        f"SELECT airport, strftime(hour_utc, {TS}) AS hour_utc, temperature_2m, c.cape, CAST(NULL AS DOUBLE) AS visibility FROM hourly_wx LEFT JOIN (SELECT airport, hour_utc, cape * 2 AS cape FROM hourly_wx WHERE hour(hour_utc) % 2 = 0) c USING (airport, hour_utc)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    h = b.hourly_weather(spark, sf)
    forecast = h.filter(F.hour("hour_utc") % 2 == 0).select("airport", "hour_utc", (F.col("cape") * 2).alias("cape"))
    return plain(joins.merge_hourly(h, forecast, ["visibility", "cape"], ["temperature_2m", "visibility", "cape"]))


@query(
    "populated_rate",
    "J06 Q08",
    b.sql("flights", "SELECT round(avg(CAST(DepDelayMinutes IS NOT NULL AS DOUBLE)), 6) + 0.0 AS populated_rate FROM flights"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(joins.populated_rate(b.flights(spark, sf), "DepDelayMinutes"))


@query(
    "next_day_statistic",
    "J14 A03",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, CAST(FlightDate + 1 AS VARCHAR) AS FlightDate, round(avg(CAST(coalesce(CarrierDelay, 0) > 0 AS DOUBLE)), 6) + 0.0 AS r FROM flights GROUP BY Reporting_Airline, FlightDate",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(lags.next_day(lags.daily_rate(b.flights(spark, sf), [CARRIER], F.col("CarrierDelay") > 0, "r")))
