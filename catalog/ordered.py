"""Operators that follow the order of legs, and counts of flights around a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import congestion, history, ordered, stats

from . import bindings as b
from .registry import plain, query

TIES = ["leg_id"]


def _legs(spark: SparkSession, sf: str) -> DataFrame:
    return b.legs(spark, sf)


_DAYNUM = "date_diff('day', DATE '1970-01-01', FlightDate)"
_KEYS = "Reporting_Airline, Flight_Number_Reporting_Airline, Origin, Dest"


def _earlier(fn: str, w: int) -> str:
    return (
        f"(SELECT {fn} FROM legs h WHERE h.Reporting_Airline = f.Reporting_Airline AND h.Flight_Number_Reporting_Airline = f.Flight_Number_Reporting_Airline "
        f"AND h.Origin = f.Origin AND h.Dest = f.Dest AND h.FlightDate >= f.FlightDate - {w} AND (h.FlightDate < f.FlightDate OR "
        "(h.FlightDate = f.FlightDate AND h.dep_dt_local < f.dep_dt_local)))"
    )


def _history_sql() -> str:
    parts = []
    for w in (1, 7, 14):
        parts.append(f"avg(v) FILTER (age <= {w}) AS mean{w}, quantile_cont(v, 0.5) FILTER (age <= {w}) AS med{w}, count(v) FILTER (age <= {w}) AS n{w}, stddev_pop(v) FILTER (age <= {w}) AS std{w}")
    pairs = (
        "SELECT f.leg_id, h.DepDelayMinutes AS v, date_diff('day', h.FlightDate, f.FlightDate) AS age FROM legs f JOIN legs h ON "
        "h.Reporting_Airline = f.Reporting_Airline AND h.Flight_Number_Reporting_Airline = f.Flight_Number_Reporting_Airline AND h.Origin = f.Origin AND h.Dest = f.Dest "
        "AND h.DepDelayMinutes IS NOT NULL AND h.FlightDate >= f.FlightDate - 14 AND (h.FlightDate < f.FlightDate OR (h.FlightDate = f.FlightDate AND h.dep_dt_local < f.dep_dt_local))"
    )
    shown = ", ".join(
        [f"round(mean{w}, 6) + 0.0 AS flightnum_od_depdelay_mean_last{w}, med{w} AS flightnum_od_depdelay_median_last{w}" for w in (1, 7, 14)]
        + [f"round(CASE WHEN n{w} > 1 THEN std{w} END, 6) + 0.0 AS flightnum_od_depdelay_std_last{w}" for w in (7, 14)]
    )
    return b.sql(
        "legs",
        f"SELECT leg_id, {shown}, CAST(coalesce(n14, 0) AS INT) AS flightnum_od_support_count_last14d, CAST(coalesce(n14, 0) <= 2 AS INT) AS flightnum_od_low_support_last14d FROM legs LEFT JOIN s USING (leg_id)",
        pairs=pairs,
        s=f"SELECT leg_id, {', '.join(parts)} FROM pairs GROUP BY leg_id",
    )


@query("flight_history", "W10", _history_sql())
def _(spark: SparkSession, sf: str) -> DataFrame:
    legs = _legs(spark, sf)
    made = history.flight_history(legs, legs)
    return plain(made.select("leg_id", *[c for c in made.columns if c.startswith("flightnum_od_")]))


def _near(left: str, right: str, keys: str, pool: str, asked: str, minutes: int) -> str:
    on = " AND ".join(f"h.{k} = f.{k}" for k in keys.split())
    return (
        f"SELECT f.leg_id, count(h.leg_id) AS n FROM legs f LEFT JOIN legs h ON {on} AND CAST(h.{pool} AS DATE) = CAST(f.{pool} AS DATE) "
        f"AND h.{pool} >= {asked} - INTERVAL {minutes} MINUTE AND h.{pool} <= {asked} + INTERVAL {minutes} MINUTE GROUP BY f.leg_id"
    )


@query(
    "departure_congestion",
    "W14",
    b.sql(
        "legs",
        "SELECT leg_id, CAST(greatest(a.n - 1, 0) AS INT) AS origin_congestion_3h_total, CAST(greatest(c.n - 1, 0) AS INT) AS origin_airline_congestion_3h_total FROM a JOIN c USING (leg_id)",
        a=_near("", "", "Origin", "dep_dt_local", "f.dep_dt_local", 180),
        c=_near("", "", "Origin Reporting_Airline", "dep_dt_local", "f.dep_dt_local", 180),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    legs = _legs(spark, sf)
    made = congestion.departure_congestion(legs, legs)
    return made.select("leg_id", "origin_congestion_3h_total", "origin_airline_congestion_3h_total")


_ETA = "(f.arr_dt_local + to_milliseconds(CAST(round(coalesce(f.arrdelay_mean_14d_car_od, 0) * 60000) AS BIGINT)))"


@query(
    "arrival_congestion",
    "W15",
    b.sql(
        "",
        "SELECT leg_id, CAST(a.n - 1 AS INT) AS dest_arrivals_pm60_sched, CAST(c.n - 1 AS INT) AS dest_airline_arrivals_pm60_sched, "
        "CAST(greatest(e.n - 1, 0) AS INT) AS dest_arrivals_pm60_eta, CAST(greatest(g.n - 1, 0) AS INT) AS dest_airline_arrivals_pm60_eta "
        "FROM a JOIN c USING (leg_id) JOIN e USING (leg_id) JOIN g USING (leg_id)",
        legs0=b.LEGS,
        legs="SELECT * REPLACE (arrdelay_mean_14d_car_od + (leg_id % 2) * 0.4 AS arrdelay_mean_14d_car_od) FROM legs0",
        a=_near("", "", "Dest", "arr_dt_local", "f.arr_dt_local", 60),
        c=_near("", "", "Dest Reporting_Airline", "arr_dt_local", "f.arr_dt_local", 60),
        e=_near("", "", "Dest", "arr_dt_local", _ETA, 60),
        g=_near("", "", "Dest Reporting_Airline", "arr_dt_local", _ETA, 60),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    legs = _legs(spark, sf).withColumn("arrdelay_mean_14d_car_od", F.expr("arrdelay_mean_14d_car_od + (leg_id % 2) * 0.4D"))
    made = congestion.arrival_congestion(legs)
    return made.select("leg_id", *[c for c in made.columns if "_pm60_" in c])


@query(
    "tail_leg_number",
    "W16",
    b.sql(
        "legs",
        "SELECT leg_id, CAST(row_number() OVER (PARTITION BY Tail_Number, CAST(dep_dt_local AS DATE) ORDER BY dep_utc, leg_id) AS INT) AS tail_leg_num_day FROM legs",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.tail_leg_number(_legs(spark, sf), TIES).select("leg_id", "tail_leg_num_day")


@query(
    "hours_since_first",
    "W17",
    b.sql(
        "legs",
        "SELECT leg_id, round(date_diff('minute', min(dep_utc) OVER (PARTITION BY Reporting_Airline, Flight_Number_Reporting_Airline, CAST(dep_dt_local AS DATE)), dep_utc) / 60, 6) + 0.0 "
        "AS flightnum_hours_since_first_departure_today FROM legs",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(ordered.hours_since_first(_legs(spark, sf)).select("leg_id", "flightnum_hours_since_first_departure_today"))


def _lagged(keys: str) -> str:
    return (
        f"SELECT *, lag(arr_utc) OVER w AS p_arr, lag(Dest) OVER w AS p_dest FROM legs WINDOW w AS (PARTITION BY {keys} ORDER BY dep_utc, leg_id)"
    )


@query(
    "recent_arrival",
    "W18",
    b.sql(
        "legs",
        "SELECT leg_id, CAST(coalesce(p_dest = Origin AND date_diff('minute', p_arr, dep_utc) BETWEEN 0 AND 300, false) AS INT) AS has_recent_arrival_turn_5h FROM q",
        q=_lagged("Tail_Number"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.recent_arrival(_legs(spark, sf), TIES).select("leg_id", "has_recent_arrival_turn_5h")


_TURN = "CASE WHEN p_dest = Origin THEN greatest(0, least(48, date_diff('minute', p_arr, dep_utc) / 60)) END"


@query(
    "turn_time",
    "W19",
    b.sql(
        "legs",
        f"SELECT leg_id, round({_TURN}, 6) + 0.0 AS turn_time_hours FROM q",
        q=_lagged("Reporting_Airline, Flight_Number_Reporting_Airline"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(ordered.turn_time(_legs(spark, sf), TIES).select("leg_id", "turn_time_hours"))


@query(
    "tail_cascade",
    "A05",
    b.sql(
        "legs",
        "SELECT leg_id, tail_n_legs_scheduled, round(tail_min_turn_time, 6) + 0.0 AS tail_min_turn_time, CAST(coalesce(tail_min_turn_time < 0.75, false) AS INT) AS tail_has_tight_turn FROM t JOIN s USING (Tail_Number, FlightDate)",
        q=_lagged("Reporting_Airline, Flight_Number_Reporting_Airline"),
        t=f"SELECT *, {_TURN} AS turn FROM q",
        s="SELECT Tail_Number, FlightDate, count(*) AS tail_n_legs_scheduled, min(turn) AS tail_min_turn_time FROM t GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = ordered.tail_cascade(ordered.turn_time(_legs(spark, sf), TIES))
    return plain(made.select("leg_id", "tail_n_legs_scheduled", "tail_min_turn_time", "tail_has_tight_turn"))


def _delayed(spark: SparkSession, sf: str) -> DataFrame:
    return _legs(spark, sf).withColumn("delayed", (F.coalesce("DepDelayMinutes", F.lit(0.0)) >= 15).cast("double"))


_DEL = "SELECT *, CAST(coalesce(DepDelayMinutes, 0) >= 15 AS DOUBLE) AS delayed FROM legs"


@query(
    "cascade_daily",
    "A06",
    b.sql(
        "legs",
        "SELECT Tail_Number, CAST(FlightDate AS VARCHAR) AS FlightDate, count(delayed) AS n_legs, min_by(delayed, dep_dt_local) AS first_delayed, sum(delayed) AS total_delayed, "
        "max(DepDelayMinutes) AS max_delay_min, round(avg(DepDelayMinutes), 6) + 0.0 AS mean_delay_min, CAST(sum(delayed) > 0 AS INT) AS any_delayed, CAST(sum(delayed) > 1 AS INT) AS cascade, "
        "CASE WHEN min_by(delayed, dep_dt_local) = 1 THEN CAST(sum(delayed) > 1 AS INT) END AS cascade_given_first FROM d GROUP BY Tail_Number, FlightDate",
        d=_DEL,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(ordered.cascade_daily(_delayed(spark, sf), "dep_dt_local", TIES, "delayed", "DepDelayMinutes"))


@query(
    "tail_schedule",
    "A07",
    b.sql(
        "legs",
        "SELECT Tail_Number, CAST(FlightDate AS VARCHAR) AS FlightDate, round(avg(turn), 6) + 0.0 AS mean_turn, min(CRSDepTime) AS min_sched_dep, max(CRSDepTime) AS max_sched_dep, "
        "count(DISTINCT Origin) AS n_airports, round(avg(Distance), 6) + 0.0 AS mean_distance FROM t GROUP BY Tail_Number, FlightDate",
        q=_lagged("Reporting_Airline, Flight_Number_Reporting_Airline"),
        t=f"SELECT *, {_TURN} AS turn FROM q",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(ordered.tail_schedule(ordered.turn_time(_legs(spark, sf), TIES)))


_PREV = "SELECT *, lag(delayed) OVER w AS prev_delayed, lag(DepDelayMinutes) OVER w AS prev_delay_min FROM d WINDOW w AS (PARTITION BY Tail_Number, FlightDate ORDER BY CRSDepTime, leg_id)"


@query("previous_leg", "W30", b.sql("legs", "SELECT leg_id, prev_delayed, prev_delay_min FROM p", d=_DEL, p=_PREV))
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = ordered.previous_leg(_delayed(spark, sf), "dep_dt_local", TIES, "delayed", "DepDelayMinutes")
    return made.select("leg_id", "prev_delayed", "prev_delay_min")


@query(
    "delay_propagation",
    "A34",
    b.sql(
        "legs",
        "SELECT round(a, 6) + 0.0 AS p_after_delayed, round(b, 6) + 0.0 AS p_after_ok, round(a / greatest(b, 0.001), 6) + 0.0 AS lift FROM "
        "(SELECT avg(delayed) FILTER (prev_delayed = 1) AS a, avg(delayed) FILTER (prev_delayed = 0) AS b FROM p)",
        d=_DEL,
        p=_PREV,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.propagation(ordered.previous_leg(_delayed(spark, sf), "dep_dt_local", TIES, "delayed", "DepDelayMinutes")))


def _cut(c: str, edges: list, labels: list[str]) -> str:
    arms = " ".join(f"WHEN {c} > {lo} AND {c} <= {hi} THEN '{name}'" for lo, hi, name in zip(edges[:-1], edges[1:], labels))
    return f"CASE {arms} END"


@query(
    "delay_absorption",
    "A35 P27 A08",
    b.sql(
        "",
        "SELECT 'turn_time' AS \"by\", t AS bin, round(avg(delayed), 6) + 0.0 AS cascade_rate, count(delayed) AS n FROM x WHERE t IS NOT NULL GROUP BY t HAVING count(*) > 30 "
        "UNION ALL SELECT 'prev_delay', s, round(avg(delayed), 6) + 0.0, count(delayed) FROM x WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 30",
        legs0=b.LEGS,
        legs=f"SELECT *, {_TURN} AS turn_time_hours FROM ({_lagged('Reporting_Airline, Flight_Number_Reporting_Airline').replace('FROM legs', 'FROM legs0')})",
        d=_DEL,
        p=_PREV,
        x="SELECT delayed, "
        + _cut("turn_time_hours", [0, 0.5, 0.75, 1.0, 1.5, 2.0, 4.0, 24.0], ["<30m", "30-45m", "45-60m", "1-1.5h", "1.5-2h", "2-4h", "4h+"])
        + " AS t, "
        + _cut("prev_delay_min", [0, 15, 30, 45, 60, 120, 500], ["0-15", "15-30", "30-45", "45-60", "60-120", "120+"])
        + " AS s FROM p WHERE prev_delayed = 1",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    turned = ordered.turn_time(_delayed(spark, sf), TIES)
    return plain(stats.absorption(ordered.previous_leg(turned, "dep_dt_local", TIES, "delayed", "DepDelayMinutes")))


@query(
    "rolling_rows",
    "W28",
    b.sql(
        "legs",
        "SELECT leg_id, round(avg(CAST(coalesce(DepDelayMinutes, 0) > 0 AS DOUBLE)) OVER (PARTITION BY Origin ORDER BY dep_dt_local, leg_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) + 0.0 "
        "AS delay_rate_origin_last1d FROM legs",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    late = (F.coalesce("DepDelayMinutes", F.lit(0.0)) > 0).cast("double")
    made = ordered.row_rolling(
        _legs(spark, sf), ["Origin"], "dep_dt_local", TIES, late, "delay_rate_origin_last1d"
    )
    return plain(made.select("leg_id", "delay_rate_origin_last1d"))
