"""Daily statistics and the lag windows over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import scoring
from tarmac.operators import daily, joins, lags, ordered

from . import bindings as b
from .registry import plain, query

CARRIER, ORIGIN, DEST, DATE = "Reporting_Airline", "Origin", "Dest", "FlightDate"
FLIGHT_NUM, TAIL = "Flight_Number_Reporting_Airline", "Tail_Number"
DAY = "CAST(FlightDate AS VARCHAR) AS FlightDate"
DAYNUM = "date_diff('day', DATE '1970-01-01', FlightDate)"
LATE = "CAST(coalesce(LateAircraftDelay, 0) >= 15 AS DOUBLE)"


def frame(keys: Sequence[str], w: int) -> str:
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY FlightDate ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"


def means(keys: Sequence[str], named: dict[str, str], windows=(1, 7, 14), suffix: str = "") -> str:
    return ", ".join(f"avg({v}) {frame(keys, w)} AS {p}_last{w}{suffix}" for p, v in named.items() for w in windows)


def stds(keys: Sequence[str], named: dict[str, str], windows=(7, 14)) -> str:
    return ", ".join(f"stddev_samp({v}) {frame(keys, w)} AS {p}_last{w}" for p, v in named.items() for w in windows)


def daily_sql(keys: Sequence[str], measures: str, where: str = "true", source: str = "flights") -> str:
    return f"SELECT {', '.join(keys)}, FlightDate, {measures} FROM {source} WHERE {where} GROUP BY ALL"


def rr(names: Sequence[str]) -> str:
    return ", ".join(b.r(n, n) for n in names)


def names(prefixes: Sequence[str], windows=(1, 7, 14), suffix: str = "") -> list[str]:
    return [f"{p}_last{w}{suffix}" for p in prefixes for w in windows]


KNOWN = "DepDelayMinutes IS NOT NULL"

# --- daily aggregates ---------------------------------------------------------------------------


@query(
    "daily_mean_delay",
    "A01",
    b.sql("flights", f"SELECT Reporting_Airline, Origin, {DAY}, round(avg(DepDelayMinutes), 6) + 0.0 AS mean_delay FROM flights WHERE {KNOWN} GROUP BY ALL"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(daily.daily_mean(b.flights(spark, sf), [CARRIER, ORIGIN], "DepDelayMinutes", "mean_delay"))


@query(
    "daily_median_delay",
    "A02",
    b.sql("flights", f"SELECT Reporting_Airline, Origin, {DAY}, quantile_cont(DepDelayMinutes, 0.5) AS median_delay FROM flights WHERE {KNOWN} GROUP BY ALL"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(daily.daily_median(b.flights(spark, sf), [CARRIER, ORIGIN], "DepDelayMinutes", "median_delay"))


@query(
    "daily_cancel_rate",
    "A03",
    b.sql("flights", f"SELECT Origin, {DAY}, round(avg(CAST(Cancelled > 0 AS DOUBLE)), 6) + 0.0 AS cancel_rate FROM flights GROUP BY ALL"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(daily.daily_rate(b.flights(spark, sf), [ORIGIN], F.col("Cancelled") > 0, "cancel_rate"))


@query(
    "daily_measures",
    "A04",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, {DAY}, count(*) AS n, round(avg(DepDelayMinutes), 6) + 0.0 AS mean_delay, max(DepDelayMinutes) AS max_delay, "
        f"round(avg({LATE}), 6) + 0.0 AS late_rate FROM flights GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    measures = {
        "n": F.count(F.lit(1)),
        "mean_delay": F.avg("DepDelayMinutes"),
        "max_delay": F.max("DepDelayMinutes"),
        "late_rate": F.avg(daily.late_aircraft().cast("double")),
    }
    return plain(daily.daily_agg(b.flights(spark, sf), [CARRIER], measures))


# --- rows of observed days ----------------------------------------------------------------------

_CARRIER_STATS = f"SELECT Reporting_Airline, FlightDate, {means([CARRIER], {'carrier_depdelay_mean': 'v'})}, {stds([CARRIER], {'carrier_depdelay_std': 'v'})} FROM cd"
_CARRIER_NAMES = names(["carrier_depdelay_mean"]) + names(["carrier_depdelay_std"], (7, 14))
_CO_NAMES = names(["carrier_origin_depdelay_mean"]) + names(["carrier_origin_depdelay_std"], (7, 14))
_LABELS = [f"y_dep_ge{t}" for t in scoring.THRESHOLDS]


@query(
    "carrier_month_baselines",
    "S01 P03 A01 W01 J01 P24",
    b.sql(
        "flights",
        "SELECT Reporting_Airline, CAST(month(FlightDate) AS INT) AS month, count(*) AS n, "
        + ", ".join(f"round(avg({n}), 6) + 0.0 AS {n}" for n in _CARRIER_NAMES)
        + ", "
        + ", ".join(f"round(avg(CAST(coalesce(DepDelayMinutes, 0) >= {t} AS DOUBLE)), 6) + 0.0 AS y_dep_ge{t}" for t in scoring.THRESHOLDS)
        + " FROM flights LEFT JOIN cs USING (Reporting_Airline, FlightDate) GROUP BY ALL",
        cd=daily_sql([CARRIER], "avg(DepDelayMinutes) AS v", KNOWN),
        cs=_CARRIER_STATS,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = b.flights(spark, sf).select(CARRIER, DATE, "DepDelayMinutes")
    out = joins.attach(fact, lags.carrier_stats(fact), [CARRIER, DATE])
    out = out.withColumns(scoring.departure_labels(F.col("DepDelayMinutes")))
    return plain(
        out.groupBy(CARRIER, F.month(DATE).alias("month")).agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in [*_CARRIER_NAMES, *_LABELS]]
        )
    )


@query(
    "carrier_baselines",
    "W01 J01",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, {DAY}, {rr(_CARRIER_NAMES + _CO_NAMES)} FROM flights "
        "LEFT JOIN cs USING (Reporting_Airline, FlightDate) LEFT JOIN os USING (Reporting_Airline, Origin, FlightDate)",
        cd=daily_sql([CARRIER], "avg(DepDelayMinutes) AS v", KNOWN),
        cs=_CARRIER_STATS,
        od=daily_sql([CARRIER, ORIGIN], "avg(DepDelayMinutes) AS v", KNOWN),
        os=f"SELECT Reporting_Airline, Origin, FlightDate, {means([CARRIER, ORIGIN], {'carrier_origin_depdelay_mean': 'v'})}, "
        f"{stds([CARRIER, ORIGIN], {'carrier_origin_depdelay_std': 'v'})} FROM od",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.carrier_baselines(f.select(CARRIER, ORIGIN, DATE), f))


@query(
    "origin_baselines",
    "W02",
    b.sql(
        "flights",
        f"SELECT Origin, {DAY}, {rr(names(['origin_depdelay_mean']) + names(['origin_depdelay_std'], (7, 14)))} FROM flights LEFT JOIN s USING (Origin, FlightDate)",
        d=daily_sql([ORIGIN], "avg(DepDelayMinutes) AS v", KNOWN),
        s=f"SELECT Origin, FlightDate, {means([ORIGIN], {'origin_depdelay_mean': 'v'})}, {stds([ORIGIN], {'origin_depdelay_std': 'v'})} FROM d",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.origin_baselines(f.select(ORIGIN, DATE), f))


_TAIL_NAMES = {"tail_depdelay_mean": "v", "tail_lateaircraft_rate": "late"}
_DEST_NAMES = {"dest_depdelay_mean": "v", "dest_lateaircraft_rate": "late"}


@query(
    "tail_history",
    "W03",
    b.sql(
        "flights",
        f"SELECT Tail_Number, {DAY}, {rr(names(list(_TAIL_NAMES)))} FROM flights LEFT JOIN s USING (Tail_Number, FlightDate)",
        d=daily_sql([TAIL], f"avg(DepDelayMinutes) AS v, avg({LATE}) AS late", KNOWN),
        s=f"SELECT Tail_Number, FlightDate, {means([TAIL], _TAIL_NAMES)} FROM d",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.tail_history(f.select(TAIL, DATE), f))


@query(
    "dest_rolling",
    "W04",
    b.sql(
        "flights",
        f"SELECT Dest, {DAY}, {rr(names(list(_DEST_NAMES)))} FROM flights LEFT JOIN s USING (Dest, FlightDate)",
        d=daily_sql([ORIGIN], f"avg(DepDelayMinutes) AS v, avg({LATE}) AS late", KNOWN),
        s=f"SELECT Origin AS Dest, FlightDate, {means([ORIGIN], _DEST_NAMES)} FROM d",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.dest_rolling(f.select(DEST, DATE), f))


_HUB_NAMES = [n for i in range(3) for w in (1, 7, 14) for n in (f"hub_{i}_depdelay_mean_last{w}", f"hub_{i}_lateaircraft_rate_last{w}")]


def _hub_frame(w: int) -> str:
    return f"OVER (ORDER BY FlightDate ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"


@query(
    "hub_spillover",
    "W05 J19",
    b.sql(
        "flights",
        f"SELECT {DAY}, {rr(_HUB_NAMES)} FROM flights LEFT JOIN s USING (FlightDate)",
        d=daily_sql([ORIGIN], f"avg(DepDelayMinutes) AS v, avg({LATE}) AS late", f"Origin IN ({b._list(b.HUBS)})"),
        p="SELECT FlightDate, "
        + ", ".join(f"max(CASE WHEN Origin = '{h}' THEN v END) AS v{i}, max(CASE WHEN Origin = '{h}' THEN late END) AS l{i}" for i, h in enumerate(b.HUBS))
        + " FROM d GROUP BY FlightDate",
        s="SELECT FlightDate, "
        + ", ".join(
            f"avg(v{i}) {_hub_frame(w)} AS hub_{i}_depdelay_mean_last{w}, avg(l{i}) {_hub_frame(w)} AS hub_{i}_lateaircraft_rate_last{w}"
            for i in range(3)
            for w in (1, 7, 14)
        )
        + " FROM p",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.hub_spillover(f.select(DATE), f, b.HUBS))


@query(
    "hub_wide",
    "J19",
    b.sql(
        "flights",
        f"SELECT {DAY}, "
        + ", ".join(f"round(max(CASE WHEN Origin = '{h}' THEN v END), 6) + 0.0 AS v_{i}" for i, h in enumerate(b.HUBS))
        + " FROM d GROUP BY FlightDate",
        d=daily_sql([ORIGIN], "avg(DepDelayMinutes) AS v", KNOWN),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    d = daily.daily_mean(b.flights(spark, sf), [ORIGIN], "DepDelayMinutes", "v")
    return plain(lags.hub_wide(d, b.HUBS, ["v"]))


_RATES = {"origin_nas_rate": "nas", "origin_lateaircraft_rate": "late", "origin_weather_rate": "wx"}


@query(
    "cause_rates",
    "W07 A03",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, {DAY}, {rr(names(list(_RATES)) + names(['carrier_lateaircraft_rate']))} FROM flights "
        "LEFT JOIN s USING (Origin, FlightDate) LEFT JOIN cs USING (Reporting_Airline, FlightDate)",
        d=daily_sql(
            [ORIGIN],
            f"avg(CAST(coalesce(NASDelay, 0) > 0 AS DOUBLE)) AS nas, avg({LATE}) AS late, avg(CAST(coalesce(WeatherDelay, 0) > 0 AS DOUBLE)) AS wx",
        ),
        s=f"SELECT Origin, FlightDate, {means([ORIGIN], _RATES)} FROM d",
        cd=daily_sql([CARRIER], f"avg({LATE}) AS late"),
        cs=f"SELECT Reporting_Airline, FlightDate, {means([CARRIER], {'carrier_lateaircraft_rate': 'late'})} FROM cd",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.cause_rates(f.select(CARRIER, ORIGIN, DATE), f))


# --- yesterday ----------------------------------------------------------------------------------


def _medians(keys: str, name: str, rename: str = "") -> str:
    return (
        f"SELECT {keys}{rename}, CAST(FlightDate + 1 AS DATE) AS FlightDate, quantile_cont(DepDelayMinutes, 0.5) AS {name} "
        f"FROM flights WHERE {KNOWN} GROUP BY ALL"
    )


_MEDIANS = [
    "carrier_depdelay_median_last1",
    "carrier_origin_depdelay_median_last1",
    "dest_depdelay_median_last1",
    *[f"hub_{i}_depdelay_median_last1" for i in range(3)],
]


@query(
    "median_yesterday",
    "W06 A02 J14",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, Dest, {DAY}, {rr(_MEDIANS)} FROM flights LEFT JOIN a USING (Reporting_Airline, FlightDate) "
        "LEFT JOIN o USING (Reporting_Airline, Origin, FlightDate) LEFT JOIN d USING (Dest, FlightDate) LEFT JOIN h USING (FlightDate)",
        a=_medians("Reporting_Airline", "carrier_depdelay_median_last1"),
        o=_medians("Reporting_Airline, Origin", "carrier_origin_depdelay_median_last1"),
        d=_medians("Origin", "dest_depdelay_median_last1", " AS Dest"),
        h0=_medians("Origin", "m"),
        h="SELECT FlightDate, "
        + ", ".join(f"max(CASE WHEN Origin = '{h}' THEN m END) AS hub_{i}_depdelay_median_last1" for i, h in enumerate(b.HUBS))
        + f" FROM h0 WHERE Origin IN ({b._list(b.HUBS)}) GROUP BY FlightDate",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.median_last1(f.select(CARRIER, ORIGIN, DEST, DATE), f, b.HUBS))


@query(
    "rates_yesterday",
    "W08",
    b.sql(
        "flights",
        f"SELECT Origin, {DAY}, {rr(['origin_nasdelay_rate_last1d', 'cancel_rate_origin_last1d'])} FROM flights LEFT JOIN s USING (Origin, FlightDate)",
        s="SELECT Origin, CAST(FlightDate + 1 AS DATE) AS FlightDate, avg(CAST(coalesce(NASDelay, 0) > 0 AS DOUBLE)) AS origin_nasdelay_rate_last1d, "
        "avg(CAST(Cancelled <> 0 AS DOUBLE)) AS cancel_rate_origin_last1d FROM flights GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.prior_day_rates(f.select(ORIGIN, DATE), f))


@query(
    "previous_day_join",
    "J14",
    b.sql(
        "flights",
        f"SELECT Origin, {DAY}, round(m, 6) + 0.0 AS mean_delay FROM flights LEFT JOIN s USING (Origin, FlightDate)",
        s=f"SELECT Origin, CAST(FlightDate + 1 AS DATE) AS FlightDate, avg(DepDelayMinutes) AS m FROM flights WHERE {KNOWN} GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(joins.attach_prev_day(f.select(ORIGIN, DATE), daily.daily_mean(f, [ORIGIN], "DepDelayMinutes", "mean_delay"), [ORIGIN]))


@query(
    "divert_rate",
    "W09",
    b.sql(
        "flights",
        f"SELECT Origin, {DAY}, {rr(['divert_rate_origin_last14d'])} FROM flights LEFT JOIN s USING (Origin, FlightDate)",
        d=daily_sql([ORIGIN], "avg(CAST(coalesce(Diverted, 0) > 0 AS DOUBLE)) AS v"),
        s=f"SELECT Origin, FlightDate, {means([ORIGIN], {'divert_rate_origin': 'v'}, (14,), 'd')} FROM d",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.divert_rate(f.select(ORIGIN, DATE), f))


# --- z-scores -----------------------------------------------------------------------------------


def _atleast(fn: str, key: str, w: int, least: int) -> str:
    f = frame([key], w)
    return f"CASE WHEN count(v) {f} >= {least} THEN {fn}(v) {f} END"


_CANCEL_Z = (
    f"SELECT Reporting_Airline, FlightDate, ({_atleast('avg', CARRIER, 7, 1)} - {_atleast('avg', CARRIER, 60, 7)}) "
    f"/ nullif({_atleast('stddev_samp', CARRIER, 60, 7)}, 0) AS airline_cancel_rate_anomaly_7d FROM d"
)


@query(
    "cancel_anomaly",
    "W12",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, {DAY}, {rr(['airline_cancel_rate_anomaly_7d'])} FROM flights LEFT JOIN s USING (Reporting_Airline, FlightDate)",
        d=daily_sql([CARRIER], "avg(coalesce(Cancelled, 0)) AS v"),
        s=_CANCEL_Z,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.cancel_anomaly(f.select(CARRIER, DATE), f))


@query(
    "carrier_anomaly",
    "W13",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, {DAY}, {rr(['carrier_delay_rate_anomaly_7d'])} FROM flights LEFT JOIN s USING (Reporting_Airline, FlightDate)",
        d=daily_sql([CARRIER], "avg(CAST(coalesce(CarrierDelay, 0) > 0 AS DOUBLE)) AS v"),
        s=f"SELECT Reporting_Airline, FlightDate, ({_atleast('avg', CARRIER, 7, 3)} - {_atleast('avg', CARRIER, 60, 14)}) "
        f"/ CASE WHEN {_atleast('stddev_samp', CARRIER, 60, 14)} < 0.01 THEN 0.01 ELSE {_atleast('stddev_samp', CARRIER, 60, 14)} END "
        "AS carrier_delay_rate_anomaly_7d FROM d",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.carrier_anomaly(f.select(CARRIER, DATE), f))


# --- calendar ranges ----------------------------------------------------------------------------

FN_OD = [CARRIER, FLIGHT_NUM, ORIGIN, DEST]
CAR_OD = [CARRIER, ORIGIN, DEST]


def _between(keys: Sequence[str], w: int) -> str:
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {DAYNUM} RANGE BETWEEN {w} PRECEDING AND 1 PRECEDING)"


@query(
    "on_time_rate",
    "W11",
    b.sql(
        "flights",
        f"SELECT {', '.join(FN_OD)}, {DAY}, {rr(['flightnum_od_otp_rate_last14d'])} FROM flights LEFT JOIN s USING ({', '.join(FN_OD)}, FlightDate)",
        k=f"SELECT *, CAST(DepDelayMinutes <= 15 AS DOUBLE) AS ok FROM flights WHERE {KNOWN} AND coalesce(Cancelled, 0) = 0",
        a=f"SELECT {', '.join(FN_OD)}, FlightDate, avg(ok) {_between(FN_OD, 14)} AS v FROM k",
        s=f"SELECT {', '.join(FN_OD)}, FlightDate, avg(v) AS flightnum_od_otp_rate_last14d FROM a GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.otp_rate(f.select(*FN_OD, DATE), f))


def range_sql(keys: Sequence[str], value: str, windows: dict[int, tuple[str, str]], medians: dict[int, str], where: str = "true") -> str:
    out = [f"avg(x) {_between(keys, w)} AS {m}, count(x) {_between(keys, w)} AS {n}" for w, (m, n) in windows.items()]
    out += [f"quantile_cont(x, 0.5) {_between(keys, w)} AS {m}" for w, m in medians.items()]
    inner = f"(SELECT {', '.join(keys)}, FlightDate, {value} AS x FROM flights WHERE {value} IS NOT NULL AND {where})"
    return f"SELECT DISTINCT {', '.join(keys)}, FlightDate, {', '.join(out)} FROM {inner}"


@query(
    "range_statistics",
    "W21",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, Dest, {DAY}, {rr(['m7', 'med7', 'm14'])}, n7, n14 FROM s",
        s=range_sql(CAR_OD, "ArrDelayMinutes", {7: ("m7", "n7"), 14: ("m14", "n14")}, {7: "med7"}),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.range_stats(f, CAR_OD, "ArrDelayMinutes", {7: ("m7", "n7"), 14: ("m14", "n14")}, {7: "med7"}))


def asof(keys: Sequence[str], stats: str) -> str:
    """The fact is anything with these keys; DuckDB has the join built in."""
    on = " AND ".join(f"{{left}}.{k} = {stats}.{k}" for k in keys)
    return f"ASOF LEFT JOIN {stats} ON {on} AND {{left}}.FlightDate >= {stats}.FlightDate"


def asof_sql(parts: list[tuple[list[str], str]], shown: str, fact_cols: str) -> str:
    """Attach each part to the distinct keys first, then to the rows."""
    body = f"SELECT {shown} FROM flights f "
    for keys, stats in parts:
        on = " AND ".join(f"f.{k} = {stats}.{k}" for k in keys)
        body += f"ASOF LEFT JOIN {stats} ON {on} AND f.FlightDate >= {stats}.FlightDate "
    return body


def _shown(cols: Sequence[str]) -> str:
    return ", ".join("CAST(f.FlightDate AS VARCHAR) AS FlightDate" if c == DATE else f"f.{c}" for c in cols)


def _stat_cols(doubles: Sequence[str], ints: Sequence[str] = ()) -> str:
    return ", ".join([b.r(n, n) for n in doubles] + list(ints))


_ROUTE_D = [f"arrdelay_mean_{w}d_{t}" for t in ("fn_od", "car_od") for w in (7, 14)] + [f"arrdelay_median_7d_{t}" for t in ("fn_od", "car_od")]
_ROUTE_N = [f"arrdelay_n_{w}d_{t}" for t in ("fn_od", "car_od") for w in (7, 14)]


@query(
    "route_arrival_stats",
    "W22 J07",
    b.sql(
        "flights",
        asof_sql([(FN_OD, "a"), (CAR_OD, "c")], f"{_shown([*FN_OD, DATE])}, {_stat_cols(_ROUTE_D, _ROUTE_N)}", ""),
        a=range_sql(FN_OD, "ArrDelayMinutes", {w: (f"arrdelay_mean_{w}d_fn_od", f"arrdelay_n_{w}d_fn_od") for w in (7, 14)}, {7: "arrdelay_median_7d_fn_od"}),
        c=range_sql(CAR_OD, "ArrDelayMinutes", {w: (f"arrdelay_mean_{w}d_car_od", f"arrdelay_n_{w}d_car_od") for w in (7, 14)}, {7: "arrdelay_median_7d_car_od"}),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.route_arrival_stats(f.select(*FN_OD, DATE), f))


@query(
    "elapsed_ratio",
    "W23",
    b.sql(
        "flights",
        asof_sql([(FN_OD, "a")], f"{_shown([*FN_OD, DATE])}, {_stat_cols(['elapsed_time_ratio_last14d'], ['elapsed_time_ratio_n_last14d'])}", ""),
        a=range_sql(
            FN_OD, "(ActualElapsedTime / nullif(CRSElapsedTime, 0))", {14: ("elapsed_time_ratio_last14d", "elapsed_time_ratio_n_last14d")}, {}
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.elapsed_ratio_stats(f.select(*FN_OD, DATE), f))


_AIR_D = [f"airtime_mean_{w}d_{t}" for t in ("fn_od", "car_od") for w in (7, 14)]
_AIR_N = [f"airtime_n_{w}d_{t}" for t in ("fn_od", "car_od") for w in (7, 14)]


@query(
    "airtime_stats",
    "W24",
    b.sql(
        "flights",
        asof_sql([(FN_OD, "a"), (CAR_OD, "c")], f"{_shown([*FN_OD, DATE])}, {_stat_cols(_AIR_D, _AIR_N)}", ""),
        a=range_sql(FN_OD, "AirTime", {w: (f"airtime_mean_{w}d_fn_od", f"airtime_n_{w}d_fn_od") for w in (7, 14)}, {}),
        c=range_sql(CAR_OD, "AirTime", {w: (f"airtime_mean_{w}d_car_od", f"airtime_n_{w}d_car_od") for w in (7, 14)}, {}),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.airtime_stats(f.select(*FN_OD, DATE), f))


def _minutes(c: str) -> str:
    return f"CASE WHEN {c} >= 0 AND {c} // 100 <= 47 AND {c} % 100 <= 59 THEN {c} // 100 * 60 + {c} % 100 END"


_D = f"(({_minutes('WheelsOff')}) - ({_minutes('CRSDepTime')}))"
_SLIP = f"CAST(CASE WHEN {_D} < -720 THEN {_D} + 1440 WHEN {_D} > 720 THEN {_D} - 1440 ELSE {_D} END AS DOUBLE)"
_BLOCK = "lpad(CAST(least(23, coalesce(CRSDepTime // 100, 0)) AS VARCHAR), 2, '0')"
_BLOCK = f"({_BLOCK} || '00-' || {_BLOCK} || '59')"
_SLIP_D = [f"wo_slip_mean_{w}d_{t}" for t in ("fn_od", "origin_blk") for w in (7, 14)]
_SLIP_N = [f"wo_slip_n_{w}d_{t}" for t in ("fn_od", "origin_blk") for w in (7, 14)]


@query(
    "wheels_off_slip",
    "W25 P07 P08 P23",
    b.sql(
        "",
        asof_sql([(FN_OD, "a"), ([ORIGIN, "DepTimeBlk"], "c")], f"{_shown([*FN_OD, DATE, 'DepTimeBlk'])}, {_stat_cols(_SLIP_D, _SLIP_N)}", ""),
        raw=b.FLIGHTS,
        flights=f"SELECT *, {_SLIP} AS slip, {_BLOCK} AS DepTimeBlk FROM raw",
        a=range_sql(FN_OD, "slip", {w: (f"wo_slip_mean_{w}d_fn_od", f"wo_slip_n_{w}d_fn_od") for w in (7, 14)}, {}),
        c=range_sql([ORIGIN, "DepTimeBlk"], "slip", {w: (f"wo_slip_mean_{w}d_origin_blk", f"wo_slip_n_{w}d_origin_blk") for w in (7, 14)}, {}),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.wheels_off_slip_stats(f.select(*FN_OD, DATE, "CRSDepTime"), f).drop("CRSDepTime"))


# --- hub weather --------------------------------------------------------------------------------


@query(
    "hub_weather",
    "W26",
    b.sql(
        "flights daily_wx",
        f"SELECT {DAY}, "
        + rr([f"hub_{h}_{v}_{w}" for h in b.HUBS for v in ("temperature_2m_max", "precipitation_sum") for w in ("today", "yesterday")])
        + " FROM flights LEFT JOIN p USING (FlightDate)",
        span=f"SELECT airport, min(FlightDate) AS lo, max(FlightDate) AS hi FROM daily_wx WHERE airport IN ({b._list(b.HUBS)}) GROUP BY airport",
        spine="SELECT airport, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS FlightDate FROM span",
        t="SELECT airport, FlightDate, temperature_2m_max, precipitation_sum, lag(temperature_2m_max) OVER w AS t1, lag(precipitation_sum) OVER w AS p1 "
        "FROM spine LEFT JOIN daily_wx USING (airport, FlightDate) WINDOW w AS (PARTITION BY airport ORDER BY FlightDate)",
        p="SELECT FlightDate, "
        + ", ".join(
            f"max(CASE WHEN airport = '{h}' THEN {c} END) AS hub_{h}_{n}"
            for h in b.HUBS
            for c, n in (
                ("temperature_2m_max", "temperature_2m_max_today"),
                ("t1", "temperature_2m_max_yesterday"),
                ("precipitation_sum", "precipitation_sum_today"),
                ("p1", "precipitation_sum_yesterday"),
            )
        )
        + " FROM t GROUP BY FlightDate",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = b.flights(spark, sf).select(DATE)
    return plain(lags.hub_weather(fact, b.daily_weather(spark, sf), b.HUBS, ["temperature_2m_max", "precipitation_sum"]))


# --- trial features -----------------------------------------------------------------------------

_TRIAL = [
    (ORIGIN, "TaxiOut", "taxi_out_mean_origin", (1, 7, 14)),
    (DEST, "TaxiIn", "taxi_in_mean_dest", (1, 7, 14)),
    (ORIGIN, "Cancelled", "cancel_rate_origin", (1, 7, 14)),
    (CARRIER, "Cancelled", "cancel_rate_carrier", (1, 7)),
    (ORIGIN, "Diverted", "divert_rate_origin", (7, 14)),
    ("Origin, Dest", "ActualElapsedTime / nullif(CRSElapsedTime, 0)", "elapsed_time_ratio", (14,)),
    (CARRIER, "CAST(coalesce(WeatherDelay, 0) > 0 AS DOUBLE)", "carrier_wxdelay_rate", (1, 7)),
    (ORIGIN, "CAST(coalesce(NASDelay, 0) > 0 AS DOUBLE)", "origin_nasdelay_rate", (1, 7)),
    (ORIGIN, "coalesce(CASE WHEN TaxiIn > 2 THEN TaxiIn END, 0)", "gate_hold_mean_origin", (1, 7)),
]


@query(
    "trial_features",
    "W27",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, Dest, {DAY}, {rr([f'{p}_last{w}d' for _, _, p, ws in _TRIAL for w in ws])} FROM flights "
        + " ".join(f"LEFT JOIN t{i} USING ({k}, FlightDate)" for i, (k, _, _, _) in enumerate(_TRIAL)),
        **{f"d{i}": f"SELECT {k}, FlightDate, avg({v}) AS v FROM flights GROUP BY {k}, FlightDate" for i, (k, v, _, _) in enumerate(_TRIAL)},
        **{f"t{i}": f"SELECT {k}, FlightDate, {means([k], {p: 'v'}, ws, 'd')} FROM d{i}" for i, (k, _, p, ws) in enumerate(_TRIAL)},
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf).withColumn("TotalAddGTime", F.expr("CASE WHEN TaxiIn > 2 THEN TaxiIn END"))
    made = lags.trial_features(f)
    return plain(made.select(CARRIER, ORIGIN, DEST, DATE, *[f"{p}_last{w}d" for _, _, p, ws in _TRIAL for w in ws]))


@query(
    "signal_variants",
    "W29",
    b.sql(
        "flights",
        f"SELECT Reporting_Airline, Origin, Dest, Flight_Number_Reporting_Airline, {DAY}, "
        f"{rr(['origin_la_rate', 'carrier_la_rate', 'otp_rate_unweighted_last14', 'airline_cancel_rate_anomaly_7d'])} FROM flights "
        "LEFT JOIN o USING (Origin, FlightDate) LEFT JOIN c USING (Reporting_Airline, FlightDate) "
        f"LEFT JOIN p USING ({', '.join(FN_OD)}, FlightDate) LEFT JOIN z USING (Reporting_Airline, FlightDate)",
        o=f"SELECT Origin, CAST(FlightDate + 1 AS DATE) AS FlightDate, avg({LATE}) AS origin_la_rate FROM flights GROUP BY ALL",
        c=f"SELECT Reporting_Airline, CAST(FlightDate + 1 AS DATE) AS FlightDate, avg({LATE}) AS carrier_la_rate FROM flights GROUP BY ALL",
        p0=daily_sql(FN_OD, "avg(CAST(DepDelayMinutes <= 15 AS DOUBLE)) AS v", f"{KNOWN} AND coalesce(Cancelled, 0) = 0"),
        p=f"SELECT {', '.join(FN_OD)}, FlightDate, {means(FN_OD, {'otp_rate_unweighted': 'v'}, (14,))} FROM p0",
        d=daily_sql([CARRIER], "avg(coalesce(Cancelled, 0)) AS v"),
        z0=_CANCEL_Z,
        z="SELECT Reporting_Airline, CAST(FlightDate + 1 AS DATE) AS FlightDate, airline_cancel_rate_anomaly_7d FROM z0",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return plain(lags.signal_variants(f.select(*FN_OD, DATE), f))


@query(
    "prior_leg",
    "W20",
    b.sql(
        "legs",
        f"SELECT leg_id, {rr(['prior_leg_depdelay_mean_last7', 'prior_leg_depdelay_mean_last14'])}, CAST(leg = 1 AS INT) AS is_first_leg_of_day FROM n "
        "LEFT JOIN s USING (Reporting_Airline, Flight_Number_Reporting_Airline, Origin, FlightDate)",
        n="SELECT *, row_number() OVER (PARTITION BY Tail_Number, CAST(dep_dt_local AS DATE) ORDER BY dep_utc, leg_id) AS leg FROM legs",
        q="SELECT *, lag(DepDelayMinutes) OVER w AS pd, lag(Dest) OVER w AS pdest FROM legs WINDOW w AS (PARTITION BY Tail_Number, FlightDate ORDER BY dep_utc, leg_id)",
        d="SELECT Reporting_Airline, Flight_Number_Reporting_Airline, Origin, FlightDate, avg(pd) AS v FROM q WHERE pdest = Origin AND pd IS NOT NULL GROUP BY ALL",
        s=f"SELECT Reporting_Airline, Flight_Number_Reporting_Airline, Origin, FlightDate, {means([CARRIER, FLIGHT_NUM, ORIGIN], {'prior_leg_depdelay_mean': 'v'}, (7, 14))} FROM d",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    legs = b.legs(spark, sf)
    fact = ordered.tail_leg_number(legs, ["leg_id"])
    out = ordered.prior_leg_features(fact, legs, ["leg_id"])
    return plain(out.select("leg_id", "prior_leg_depdelay_mean_last7", "prior_leg_depdelay_mean_last14", "is_first_leg_of_day"))
