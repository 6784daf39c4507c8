"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import calendar, geo, lookups, parse, scoring, weather
from tarmac.operators import stats

from . import bindings as b
from .registry import plain, query

DAY = "CAST(FlightDate AS VARCHAR) AS FlightDate"

_MESSY = "CASE l_partkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN ' 12.5 ' WHEN 2 THEN 'nan' WHEN 3 THEN '' WHEN 4 THEN CAST(l_suppkey AS VARCHAR(20)) ELSE NULL END"
_MESSY_SPARK = _MESSY.replace("VARCHAR(20)", "STRING")


@query(
    "numbers_from_text",
    "P01",
    "SELECT l_orderkey, CASE l_partkey % 6 WHEN 1 THEN 12.5 WHEN 4 THEN CAST(l_suppkey AS DOUBLE) END AS v FROM lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "lineitem")
    return plain(t.select("l_orderkey", parse.num(F.expr(_MESSY_SPARK)).alias("v")))


@query(
    "days_from_text",
    "P02",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS loose, "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS strict FROM orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    loose = F.when(F.col("o_orderkey") % 5 == 0, F.lit("not a day")).otherwise(text)
    t = b.table(spark, sf, "orders")
    return plain(t.select("o_orderkey", parse.day(loose).alias("loose"), parse.day_strict(text).alias("strict")))


@query(
    "normalised_keys",
    "P03",
    "SELECT o_orderkey, upper(trim(o_orderpriority)) AS priority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(o_custkey AS BIGINT) AS cust FROM orders",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")).alias("priority"),
        F.col("o_orderdate").alias("day"),
        F.col("o_custkey").cast("string").alias("cust"),
    )
    return plain(parse.norm_keys(t, ["priority", "absent"], ["day"], ["cust"]))


_TAILS = "CASE l_suppkey % 8 WHEN 0 THEN 'unknown' WHEN 1 THEN ' NaN ' WHEN 2 THEN '' WHEN 3 THEN 'n00' || l_suppkey ELSE 'N' || l_suppkey END"


@query(
    "clean_tails",
    "P04 P20",
    f"SELECT l_suppkey, count(*) AS n, CASE WHEN l_suppkey % 8 > 2 THEN upper(trim({_TAILS})) END AS tail, "
    f"regexp_replace(regexp_replace(upper(trim({_TAILS})), '^N', ''), '^0+', '') AS registry FROM lineitem GROUP BY ALL",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr(_TAILS)
    t = b.table(spark, sf, "lineitem").select("l_suppkey", parse.clean_tail(raw).alias("tail"), parse.registry_number(raw).alias("registry"))
    return plain(t.groupBy("l_suppkey", "tail", "registry").agg(F.count(F.lit(1)).alias("n")))


_HHMM = "CAST(l_orderkey % 2600 AS INT)"


@query(
    "hhmm_times",
    "P05 P07 P10 P23",
    f"SELECT l_orderkey, CASE WHEN {_HHMM} <= 2359 AND {_HHMM} % 100 < 60 THEN strftime(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) "
    f"+ to_minutes(CAST({_HHMM} // 100 * 60 + {_HHMM} % 100 AS INT)), '%Y-%m-%d %H:%M:%S') END AS ts, "
    f"CASE WHEN {_HHMM} % 100 <= 59 THEN CAST({_HHMM} // 100 * 60 + {_HHMM} % 100 AS DOUBLE) END AS minutes, "
    f"CAST({_HHMM} // 100 AS INT) AS hour, CAST(isodow(l_shipdate) - 1 AS INT) AS dow, "
    f"printf('%02d00-%02d59', least(23, {_HHMM} // 100), least(23, {_HHMM} // 100)) AS block FROM lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "lineitem").withColumn("hhmm", F.expr(_HHMM))
    d = F.col("l_shipdate").cast("date")
    return plain(
        t.select(
            "l_orderkey",
            parse.hhmm_ts(d, "hhmm").alias("ts"),
            parse.hhmm_minutes("hhmm").alias("minutes"),
            parse.hhmm_hour("hhmm").alias("hour"),
            calendar.weekday(d).alias("dow"),
            parse.time_block("hhmm").alias("block"),
        )
    )


@query(
    "wrapped_minutes",
    "P08",
    "SELECT o_orderkey, CAST(CASE WHEN d < -720 THEN d + 1440 WHEN d > 720 THEN d - 1440 ELSE d END AS DOUBLE) AS diff "
    "FROM (SELECT o_orderkey, o_orderkey % 1440 - o_custkey * 7 % 1440 AS d FROM orders)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, c = F.col("o_orderkey") % 1440, F.col("o_custkey") * 7 % 1440
    return plain(b.table(spark, sf, "orders").select("o_orderkey", parse.wrap_diff(a, c).alias("diff")))


@query(
    "great_circle_miles",
    "P09",
    "SELECT c_custkey, round(2 * 3958.8 * asin(sqrt(pow(sin(radians(la2 - la1) / 2), 2) + cos(radians(la1)) * cos(radians(la2)) "
    "* pow(sin(radians(lo2 - lo1) / 2), 2))), 6) + 0.0 AS miles FROM (SELECT c_custkey, c_custkey % 90 * 1.0 AS la1, c_custkey % 170 * 1.0 AS lo1, "
    "c_nationkey * 3.0 AS la2, c_nationkey * -5.0 AS lo2 FROM customer)".replace(", 6) + 0.0", " + 1e-9, 6) + 0.0"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return plain(
        b.table(spark, sf, "customer").select(
            "c_custkey", geo.haversine_miles(k % 90 * 1.0, k % 170 * 1.0, n * 3.0, n * -5.0).alias("miles")
        )
    )


@query(
    "route_keys",
    "P11",
    b.sql("flights", "SELECT Origin || '_' || Dest AS od_pair, count(*) AS n FROM flights GROUP BY ALL"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return b.flights(spark, sf).groupBy(parse.od_pair().alias("od_pair")).agg(F.count(F.lit(1)).alias("n"))


def _nth(month: int, dow: int, n: int) -> str:
    """SQL of the n-th ISO weekday of a month of the row's year."""
    first = f"make_date(year(d), {month}, 1)"
    return f"({first} + CAST(({dow} - isodow({first}) + 7) % 7 + {7 * (n - 1)} AS INT))"


_LAST_MON = "(last_day(make_date(year(d), 5, 1)) - CAST(isodow(last_day(make_date(year(d), 5, 1))) - 1 AS INT))"
_HOLIDAYS = [
    ("make_date(year(d), 1, 1)", 1),
    (_nth(1, 1, 3), 1),
    (_nth(2, 1, 3), 1),
    (_LAST_MON, 2),
    ("make_date(year(d), 7, 4)", 2),
    (_nth(9, 1, 1), 2),
    (_nth(11, 4, 4), 2),
    ("make_date(year(d), 12, 25)", 3),
]


HOLIDAY_SQL = " OR ".join(f"abs(date_diff('day', CAST({h} AS DATE), d)) <= {w}" for h, w in _HOLIDAYS)


@query(
    "holiday_flags",
    "P12 P13",
    f"SELECT CAST(d AS VARCHAR) AS day, count(*) AS n, CAST({HOLIDAY_SQL}"
    " AS INT) AS is_holiday, CAST(strftime(d, '%m%d') BETWEEN '0315' AND '0415' AS INT) AS is_spring_break "
    "FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY d",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    days = b.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    d = F.col("day")
    return plain(days.withColumns({"is_holiday": calendar.is_holiday(d), "is_spring_break": calendar.is_spring_break(d)}))


@query(
    "seasons_and_hours",
    "P14 P16",
    "SELECT event_id, CAST(month(ts) AS INT) AS month, CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring' "
    "WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS north, CASE WHEN month(ts) IN (12, 1, 2) THEN 'Summer' WHEN month(ts) IN (3, 4, 5) THEN 'Fall' "
    "WHEN month(ts) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS south, CAST(hour(ts) >= 22 AS INT) AS late_evening, "
    "CAST(hour(ts) BETWEEN 16 AND 20 AS INT) AS peak FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    m, h = F.month("ts"), F.hour("ts")
    return b.table(spark, sf, "events").select(
        "event_id",
        m.alias("month"),
        calendar.season(m).alias("north"),
        calendar.season(m, calendar.SOUTHERN).alias("south"),
        calendar.is_late_evening(h).alias("late_evening"),
        calendar.is_peak_hour(h).alias("peak"),
    )


def _raw_weather(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        (F.col("l_quantity") - 25).alias("origin_temperature_2m_max"),
        (F.col("l_quantity") - 30).alias("origin_dep_temperature_2m"),
        F.expr("CASE WHEN l_tax > 0.07 THEN NULL ELSE l_extendedprice END").alias("origin_dep_visibility"),
        F.expr("l_extendedprice / 100 - 400").alias("origin_dep_cape"),
        F.expr("CAST(l_linenumber AS DOUBLE) * 8").alias("origin_dep_windspeed_10m"),
        F.expr("CAST(l_suppkey % 40 AS DOUBLE)").alias("origin_dep_windgusts_10m"),
        F.expr("CAST(l_partkey % 5 AS DOUBLE)").alias("origin_dep_precipitation"),
    )


_WEATHER = (
    "SELECT l_orderkey, l_quantity - 25 + 273.15 AS tmax, l_quantity - 30 + 273.15 AS tdep, CASE WHEN l_tax > 0.07 THEN NULL ELSE least(l_extendedprice, 25000) END AS vis, "
    "greatest(l_extendedprice / 100 - 400, 0) AS cape, CAST(l_linenumber AS DOUBLE) * 8 AS wind, CAST(l_suppkey % 40 AS DOUBLE) AS gust, CAST(l_partkey % 5 AS DOUBLE) AS rain FROM lineitem"
)


@query(
    "weather_units",
    "P15 P17",
    b.sql(
        "",
        "SELECT l_orderkey, round(tmax, 6) + 0.0 AS origin_temp_max_K, round(vis, 6) + 0.0 AS origin_dep_visibility_m, round(cape, 6) + 0.0 AS origin_dep_cape_jkg, "
        "round(ln(1 + cape), 6) + 0.0 AS origin_dep_log1p_cape, round(wind * rain, 6) + 0.0 AS wind_x_precip FROM w",
        w=_WEATHER,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = weather.weather_units(_raw_weather(spark, sf))
    t = t.withColumn("wind_x_precip", weather.wind_x_precip(t))
    return plain(
        t.select("l_orderkey", "origin_temp_max_K", "origin_dep_visibility_m", "origin_dep_cape_jkg", "origin_dep_log1p_cape", "wind_x_precip")
    )


@query(
    "row_maximum",
    "P18",
    "SELECT l_orderkey, greatest(CASE WHEN l_linenumber > 2 THEN l_discount END, CASE WHEN l_linenumber < 5 THEN l_tax END, CASE WHEN l_linenumber = 4 THEN l_quantity END) AS hub_max FROM lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.expr("CASE WHEN l_linenumber > 2 THEN l_discount END").alias("hub_0_lateaircraft_rate_last1"),
        F.expr("CASE WHEN l_linenumber < 5 THEN l_tax END").alias("hub_1_lateaircraft_rate_last1"),
        F.expr("CASE WHEN l_linenumber = 4 THEN l_quantity END").alias("hub_2_lateaircraft_rate_last1"),
        F.lit(1e9).alias("hub_2_depdelay_mean_last1"),
    )
    return t.select("l_orderkey", weather.row_max(t, r"hub_.*_lateaircraft_rate_last1").alias("hub_max"))


@query(
    "candidate_columns",
    "P36",
    b.sql(
        "",
        "SELECT l_orderkey, CAST(cape > 500 AS INT) AS is_convective, CAST(coalesce(vis < 5000, false) AS INT) AS is_ifr, CAST(tdep < 273.15 AS INT) AS below_freezing, "
        "round(gust / nullif(wind, 0), 6) + 0.0 AS gust_factor FROM w",
        w=_WEATHER,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = weather.candidate_columns(weather.weather_units(_raw_weather(spark, sf)))
    return plain(t.select("l_orderkey", "is_convective", "is_ifr", "below_freezing", "gust_factor"))


def _case(c: str, table: dict, default: str) -> str:
    pairs = " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in table.items())
    return f"CASE {c} {pairs} ELSE '{default}' END"


_CLASS = lookups.WMO_CLASS


@query(
    "weather_codes",
    "P21",
    f"SELECT l_orderkey % 110 AS code, count(*) AS n, {_case('CAST(l_orderkey % 110 AS INT)', lookups.WMO_LABEL, 'Unknown')} AS label, "
    f"{_case('CAST(l_orderkey % 110 AS INT)', _CLASS, 'Unknown')} AS severity FROM lineitem GROUP BY l_orderkey % 110",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % 110).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return t.withColumns({"label": lookups.wmo_label(F.col("code")), "severity": lookups.wmo_class(F.col("code"))})


_REGION = lookups.REGION


@query(
    "airport_regions",
    "P22",
    b.sql("flights", f"SELECT Origin, count(*) AS n, {_case('Origin', _REGION, 'Other')} AS region FROM flights GROUP BY Origin"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.flights(spark, sf).groupBy("Origin").agg(F.count(F.lit(1)).alias("n"))
    return t.withColumn("region", lookups.us_region(F.col("Origin")))


@query(
    "threshold_labels",
    "P24 P28",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, {DAY}, "
        + ", ".join(f"CAST(coalesce(DepDelayMinutes, 0) >= {t} AS INT) AS y_dep_ge{t}" for t in scoring.THRESHOLDS)
        + ", "
        + ", ".join(f"CAST(coalesce(ArrDelayMinutes >= {t}, false) AS INT) AS y_arr_ge{t}" for t in scoring.THRESHOLDS)
        + ", CAST(CASE WHEN DepDelayMinutes >= 120 THEN 4 WHEN DepDelayMinutes >= 60 THEN 3 WHEN DepDelayMinutes >= 30 THEN 2 WHEN DepDelayMinutes >= 15 THEN 1 ELSE 0 END AS INT) AS bin, "
        "CASE WHEN DepDelayMinutes >= 120 THEN '>= 120 min' WHEN DepDelayMinutes >= 60 THEN '60-120 min' WHEN DepDelayMinutes >= 30 THEN '30-60 min' "
        "WHEN DepDelayMinutes >= 15 THEN '15-30 min' ELSE '< 15 min' END AS bin_label FROM flights",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.flights(spark, sf)
    made = scoring.departure_labels(F.col("DepDelayMinutes")) | scoring.arrival_labels(F.col("ArrDelayMinutes"))
    made["bin"] = scoring.true_bin(F.col("DepDelayMinutes"))
    t = t.withColumns(made).withColumn("bin_label", scoring.bin_label(F.col("bin")))
    return plain(t.select("Reporting_Airline", "Origin", "FlightDate", *made, "bin_label"))


@query(
    "folded_categories",
    "P25",
    "SELECT l_orderkey, CASE l_partkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN ' 12.5 ' WHEN 4 THEN CAST(l_suppkey AS VARCHAR) ELSE 'Unknown' END AS category FROM lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "lineitem").select("l_orderkey", parse.as_category(F.expr(_MESSY_SPARK)).alias("category"))


@query(
    "fixed_bins",
    "P27",
    "SELECT l_orderkey, CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'low' WHEN l_quantity > 10 AND l_quantity <= 30 THEN 'mid' WHEN l_quantity > 30 AND l_quantity <= 45 THEN 'high' END AS on_right, "
    "CASE WHEN l_quantity >= 0 AND l_quantity < 10 THEN 'low' WHEN l_quantity >= 10 AND l_quantity < 30 THEN 'mid' WHEN l_quantity >= 30 AND l_quantity < 45 THEN 'high' END AS on_left FROM lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    q, edges, names = F.col("l_quantity"), [0, 10, 30, 45], ["low", "mid", "high"]
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", scoring.cut(q, edges, names).alias("on_right"), scoring.cut(q, edges, names, right=False).alias("on_left")
    )


_RULES = [
    ("l_suppkey % 3 = 1", "limited flight-number history"),
    ("l_quantity >= 10", "this flight/route often departs late"),
    ("coalesce(CASE WHEN l_tax > 0.02 THEN l_tax * 200 END >= 10, false)", "carrier delays elevated recently"),
    ("l_linenumber * 10 >= 30", "busy origin (recent congestion)"),
    ("l_partkey % 4 = 0", "weather that day"),
]


@query(
    "score_reasons",
    "P29",
    "SELECT l_orderkey, CASE WHEN len(a) = 0 THEN 'no strong delay signals detected' ELSE array_to_string(a[1:3], '; ') END AS reason FROM (SELECT l_orderkey, list_filter(["
    + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in _RULES)
    + "], lambda x: x IS NOT NULL) AS a FROM lineitem)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.expr("l_suppkey % 3").alias("flightnum_od_low_support"),
        F.col("l_quantity").alias("flightnum_od_depdelay_mean_lastN"),
        F.expr("CASE WHEN l_tax > 0.02 THEN l_tax * 200 END").alias("carrier_depdelay_mean_lastNdays"),
        F.expr("l_linenumber * 10").alias("origin_congestion_3h_total"),
        F.expr("CASE WHEN l_partkey % 4 = 0 THEN 61 END").alias("origin_daily_weathercode"),
    )
    return t.select("l_orderkey", scoring.reason(t.columns).alias("reason"))


_P = {
    15: "(l_partkey % 64) / 64.0D",
    30: "(l_suppkey % 64) / 64.0D",
    60: "(l_orderkey % 64) / 64.0D",
    120: "(l_linenumber * 3 % 64) / 64.0D",
}


def _probabilities(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "lineitem")
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.expr(e).alias(f"p_ge{t_}") for t_, e in _P.items()])


_PSQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(f"{e.replace('64.0D', '64.0')} AS p_ge{t}" for t, e in _P.items()) + " FROM lineitem"
_MONO = (
    "SELECT *, p_ge15 AS m1, least(p_ge15, p_ge30) AS m2, least(p_ge15, p_ge30, p_ge60) AS m3, least(p_ge15, p_ge30, p_ge60, p_ge120) AS m4 FROM p"
)
_BINS = "SELECT *, 1 - m1 AS b0, m1 - m2 AS b1, m2 - m3 AS b2, m3 - m4 AS b3, m4 AS b4 FROM m"


@query(
    "monotone_probabilities",
    "P31 P30",
    b.sql(
        "",
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, m1, m2, m3, m4, printf('P>=15=%.3f, P>=30=%.3f, P>=60=%.3f, P>=120=%.3f', "
        "p_ge15 + 1e-9, p_ge30 + 1e-9, p_ge60 + 1e-9, p_ge120 + 1e-9) AS text FROM m",
        p=_PSQL,
        m=_MONO,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = _probabilities(spark, sf)
    ps = [F.col(f"p_ge{x}") for x in _P]
    mono = scoring.monotone(ps)
    text = scoring.probability_text([p + 1e-9 for p in ps])
    return t.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[m.alias(f"m{i + 1}") for i, m in enumerate(mono)], text.alias("text")
    )


@query(
    "bin_distribution",
    "P32 P33",
    b.sql(
        "",
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        + ", ".join(f"round(b{i}, 6) + 0.0 AS b{i}" for i in range(5))
        + ", round(b0 * 7.5 + b1 * 22.5 + b2 * 45 + b3 * 90 + b4 * 150, 6) + 0.0 AS minutes, round(b1 + 2 * b2 + 3 * b3 + 4 * b4, 6) + 0.0 AS severity, "
        "CAST(CASE greatest(b0, b1, b2, b3, b4) WHEN b0 THEN 0 WHEN b1 THEN 1 WHEN b2 THEN 2 WHEN b3 THEN 3 ELSE 4 END AS INT) AS likeliest FROM d",
        p=_PSQL,
        m=_MONO,
        d=_BINS,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = _probabilities(spark, sf).withColumn("d", scoring.bin_distribution([F.col(f"p_ge{x}") for x in _P]))
    d = F.col("d")
    return plain(
        t.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            *[d[i].alias(f"b{i}") for i in range(5)],
            scoring.weighted_sum(d, scoring.BIN_MINUTES).alias("minutes"),
            scoring.weighted_sum(d, scoring.BIN_SEVERITY).alias("severity"),
            scoring.likeliest_bin(d).alias("likeliest"),
        )
    )


_NAMES = [
    "flightnum_od_depdelay_mean_last7",
    "is_holiday",
    "origin_dep_temp_K",
    "origin_depdelay_mean_last7",
    "origin_daily_precip_sum_mm",
    "wind_x_precip",
    "hub_0_depdelay_mean_last1",
    "carrier_depdelay_std_last14",
    "Origin",
    "tail_leg_num_day",
]
_FAMILIES = ["flightnum_od", "calendar", "weather", "rolling", "weather", "weather", "rolling", "rolling", "schedule", "other"]


@query(
    "feature_families",
    "P34",
    f"SELECT ([{b._list(_NAMES)}])[CAST(p_partkey % 10 AS INT) + 1] AS feature, ([{b._list(_FAMILIES)}])[CAST(p_partkey % 10 AS INT) + 1] AS family, count(*) AS n FROM part GROUP BY ALL",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    name = F.expr(f"element_at(array({b._list(_NAMES)}), cast(p_partkey % 10 as int) + 1)")
    t = b.table(spark, sf, "part").select(name.alias("feature"))
    return t.groupBy("feature", lookups.feature_family(F.col("feature")).alias("family")).agg(F.count(F.lit(1)).alias("n"))


_TEXTS = list(lookups.CAUSE_DOMAIN)
_DOMAIN = lookups.CAUSE_DOMAIN


def causes(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a justification text, some without."""
    text = F.expr(f"CASE WHEN event_id % 31 < 29 THEN element_at(array({b._list(_TEXTS)}), cast(event_id % 31 as int) + 1) END")
    t = b.table(spark, sf, "events").withColumn("delay_domain", lookups.cause_domain(text))
    return t.withColumns({**lookups.domain_flags(F.col("delay_domain")), "hour": F.hour("ts")}).withColumn(
        "is_lcc", lookups.is_low_cost(F.expr("CASE user_id % 4 WHEN 0 THEN 'gol' WHEN 1 THEN 'azul' ELSE 'TAM' END"))
    )


CAUSES = (
    f"SELECT *, {_case('txt', _DOMAIN, 'Unknown')} AS delay_domain FROM (SELECT *, CAST(hour(ts) AS INT) AS hour, "
    f"CASE WHEN event_id % 31 < 29 THEN ([{b._list(_TEXTS)}])[CAST(event_id % 31 AS INT) + 1] END AS txt, "
    "CAST(user_id % 4 < 2 AS INT) AS is_lcc FROM events)"
)


@query(
    "delay_domains",
    "P35 P37",
    b.sql(
        "",
        "SELECT event_id, delay_domain, is_lcc, CAST(hour >= 22 AS INT) AS is_late_evening, "
        + ", ".join(f"CAST(delay_domain = '{d}' AS INT) AS \"is_delayed_{d}\"" for d in lookups.DOMAINS)
        + " FROM c",
        c=CAUSES,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = causes(spark, sf)
    late = calendar.is_late_evening(F.col("hour")).alias("is_late_evening")
    return t.select("event_id", "delay_domain", "is_lcc", late, *[f"is_delayed_{d}" for d in lookups.DOMAINS])


@query(
    "block_minutes",
    "P37",
    b.sql("legs", "SELECT leg_id, date_diff('minute', dep_dt_local, arr_dt_local) AS sched_block_minutes FROM legs"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return b.legs(spark, sf).select(
        "leg_id", scoring.block_minutes(F.col("dep_dt_local"), F.col("arr_dt_local")).alias("sched_block_minutes")
    )


@query(
    "day_window",
    "P38",
    b.sql("ord", f"SELECT row_id, {DAY} FROM ord WHERE FlightDate BETWEEN DATE '1995-01-01' AND DATE '1996-06-30'"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.orders(spark, sf).filter(parse.between_days("FlightDate", "1995-01-01", "1996-06-30"))
    return plain(t.select("row_id", "FlightDate"))


@query(
    "flown_history",
    "P39",
    b.sql(
        "flights",
        "SELECT Reporting_Airline, count(*) AS n_all, count(*) FILTER (coalesce(Cancelled, 0) = 0) AS n_flown, "
        "round(avg(DepDelayMinutes) FILTER (coalesce(Cancelled, 0) = 0), 6) + 0.0 AS mean_flown FROM flights GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    held = parse.flown()
    return plain(
        b.flights(spark, sf)
        .groupBy("Reporting_Airline")
        .agg(F.count(F.lit(1)).alias("n_all"), F.count(F.when(held, 1)).alias("n_flown"), F.avg(F.when(held, F.col("DepDelayMinutes"))).alias("mean_flown"))
    )


@query(
    "severe_weather",
    "P40",
    "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_quantity > 45 OR l_suppkey % 60 > 50",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rough = (F.col("l_quantity") > 45) | (F.col("l_suppkey") % 60 > 50)
    return b.table(spark, sf, "lineitem").filter(rough).select("l_orderkey", "l_linenumber", "l_suppkey")


_EARLY = "FROM flights WHERE FlightDate < DATE '2024-07-01'"


@query(
    "median_imputed",
    "P26",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, {DAY}, coalesce(DepDelayMinutes, (SELECT quantile_cont(DepDelayMinutes, 0.5) {_EARLY})) AS DepDelayMinutes, "
        f"coalesce(AirTime, (SELECT quantile_cont(AirTime, 0.5) {_EARLY})) AS AirTime FROM flights",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.flights(spark, sf).select("Reporting_Airline", "Origin", "FlightDate", "DepDelayMinutes", "AirTime")
    early = t.filter(F.col("FlightDate") < F.lit("2024-07-01").cast("date"))
    return plain(stats.impute_median(t, ["DepDelayMinutes", "AirTime"], early))
