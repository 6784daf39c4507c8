"""Checks of a feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import calendar, scoring
from tarmac.operators import lags, quality

from . import bindings as b
from .joined import local_sql
from .lagged import _between, FN_OD, KNOWN
from .registry import plain, query

T = scoring.THRESHOLDS


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """A feature table with good and bad columns."""
    f = b.flights(spark, sf)
    return f.select(
        "FlightDate",
        "Origin",
        "Dest",
        "Reporting_Airline",
        "DepDelayMinutes",
        "Distance",
        F.col("CRSDepTime"),
        (F.col("TaxiOut") / 100).alias("origin_nas_rate_last7"),
        (F.col("TaxiOut") / 10).alias("origin_weather_rate_last7"),
        F.expr("CASE WHEN TaxiIn > 5 THEN TaxiIn * 20 END").alias("carrier_depdelay_mean_last7"),
        F.expr("DepDelayMinutes * 0.3D").alias("arrdelay_median_7d_fn_od"),
        F.expr("CAST(CRSElapsedTime AS STRING)").alias("CRSElapsedTime"),
        F.expr("CASE WHEN Origin = 'ATL' THEN 'Atlanta' ELSE Origin END").alias("od_pair"),
        *[e.alias(n) for n, e in scoring.departure_labels(F.col("DepDelayMinutes")).items()],
    )


FEATURES = (
    "SELECT FlightDate, Origin, Dest, Reporting_Airline, DepDelayMinutes, Distance, CRSDepTime, TaxiOut / 100 AS origin_nas_rate_last7, TaxiOut / 10 AS origin_weather_rate_last7, "
    "CASE WHEN TaxiIn > 5 THEN TaxiIn * 20 END AS carrier_depdelay_mean_last7, DepDelayMinutes * 0.3 AS arrdelay_median_7d_fn_od, CAST(CRSElapsedTime AS VARCHAR) AS CRSElapsedTime, Origin AS od_pair, "
    + ", ".join(f"CAST(coalesce(DepDelayMinutes, 0) >= {t} AS INT) AS y_dep_ge{t}" for t in T)
    + " FROM flights"
)
_COLS = (
    "FlightDate Origin Dest Reporting_Airline DepDelayMinutes Distance CRSDepTime origin_nas_rate_last7 origin_weather_rate_last7 carrier_depdelay_mean_last7 arrdelay_median_7d_fn_od CRSElapsedTime od_pair "
    "y_dep_ge15 y_dep_ge30 y_dep_ge60 y_dep_ge120"
).split()


def _arm(check: str, subject: str, status: str, detail: str) -> str:
    source = " FROM x" if "(" in status + detail else ""
    return f"SELECT '{check}' AS \"check\", '{subject}' AS subject, {status} AS status, {detail} AS detail{source}"


def _range(c: str, lo: float, hi: float) -> str:
    return _arm("range", c, f"CASE WHEN min({c}) < {lo} OR max({c}) > {hi} THEN 'FAIL' ELSE 'PASS' END", f"printf('[%.2f, %.2f]', CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE))")


_FINDINGS = [
    _arm("row_count", "table", "'PASS'", "CAST(count(*) AS VARCHAR)"),
    _arm("expected_columns", "table", "'FAIL'", "'no_such_feature'"),
    *[
        _arm("null_fraction", c, f"CASE WHEN 1 - count({c}) / count(*) > 0.5 THEN 'WARN' ELSE 'PASS' END", f"printf('%.4f', 1 - count({c}) / count(*) + 1e-9)")
        for c in _COLS
    ],
    _range("DepDelayMinutes", 0, 5000),
    _range("Distance", 0, 6000),
    _range("CRSDepTime", 0, 2400),
    _range("origin_nas_rate_last7", 0, 1),
    _range("origin_weather_rate_last7", 0, 1),
    _range("carrier_depdelay_mean_last7", -30, 5000),
    _range("arrdelay_median_7d_fn_od", -30, 5000),
    _arm("type", "CRSElapsedTime", "'FAIL'", "'string'"),
    _arm("codes", "Origin", "'PASS'", "'0'"),
    _arm("codes", "Dest", "'PASS'", "'0'"),
    _arm("codes", "Reporting_Airline", "'PASS'", "'0'"),
    _arm("category", "FlightDate", "'PASS'", "CAST(count(*) AS VARCHAR)"),
    _arm("category", "od_pair", "'PASS'", "CAST(count(*) AS VARCHAR)"),
    _arm("feature_coverage", "table", "'PASS'", "'13 registered features'"),
]


@query("feature_findings", "Q01 U04", b.sql("flights", " UNION ALL ".join(_FINDINGS), x=FEATURES))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_features(_features(spark, sf), ["Origin", "no_such_feature"])


@query(
    "verdict",
    "Q04 Q01",
    b.sql(
        "flights",
        "SELECT count(*) FILTER (status = 'PASS') AS n_pass, count(*) FILTER (status = 'WARN') AS n_warn, count(*) FILTER (status = 'FAIL') AS n_fail, 'FAIL' AS status FROM f",
        x=FEATURES,
        f=" UNION ALL ".join(_FINDINGS),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.roll_up(quality.validate_features(_features(spark, sf), ["Origin", "no_such_feature"]))


def _percentiles(name: str, p: float, limits: dict[str, float]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", '{c}' AS subject, CASE WHEN quantile_cont({c}, {p}) > {limit} THEN 'WARN' ELSE 'PASS' END AS status, printf('%.2f', quantile_cont({c}, {p}) + 1e-9) AS detail FROM x"
        for c, limit in limits.items()
    )


@query(
    "magnitude_check",
    "Q02",
    b.sql("flights", _percentiles("multiday_magnitude", 0.95, {"carrier_depdelay_mean_last7": 120, "arrdelay_median_7d_fn_od": 60}), x=FEATURES),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.magnitude_check(_features(spark, sf))


@query(
    "p99_check",
    "Q03",
    b.sql("flights", _percentiles("p99_spot_check", 0.99, {"carrier_depdelay_mean_last7": 200, "arrdelay_median_7d_fn_od": 150}), x=FEATURES),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.p99_check(_features(spark, sf))


_LABELS = [f"y_dep_ge{t}" for t in T]


@query(
    "label_invariants",
    "Q05",
    b.sql(
        "flights",
        " UNION ALL ".join(
            [
                f"SELECT 'base_rate_order' AS \"check\", '{a}>={c}' AS subject, CASE WHEN avg({a}) >= avg({c}) THEN 'PASS' ELSE 'FAIL' END AS status, printf('%.4f', avg({a}) - avg({c}) + 1e-9) AS detail FROM x"
                for a, c in zip(_LABELS[:-1], _LABELS[1:])
            ]
            + [
                f"SELECT 'label_nesting', '{c}->{a}', CASE WHEN count(*) FILTER ({c} = 1 AND {a} = 0) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) FILTER ({c} = 1 AND {a} = 0) AS VARCHAR) FROM x"
                for a, c in zip(_LABELS[:-1], _LABELS[1:])
            ]
            + ["SELECT 'base_rate_band', 'y_dep_ge15', CASE WHEN avg(y_dep_ge15) BETWEEN 0.1 AND 0.5 THEN 'PASS' ELSE 'WARN' END, printf('%.4f', avg(y_dep_ge15) + 1e-9) FROM x"]
        ),
        x=FEATURES,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.label_invariants(_features(spark, sf), _LABELS, {"y_dep_ge15": (0.1, 0.5)})


@query(
    "range_checks",
    "Q06 U04",
    b.sql(
        "flights",
        " UNION ALL ".join(
            [
                f"SELECT 'rate_bounds' AS \"check\", '{c}' AS subject, CASE WHEN count(*) FILTER ({c} < 0 OR {c} > 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count(*) FILTER ({c} < 0 OR {c} > 1) AS VARCHAR) AS detail FROM x"
                for c in ("origin_nas_rate_last7", "origin_weather_rate_last7")
            ]
            + [
                "SELECT 'required', 'Origin', 'PASS', ''",
                "SELECT 'required', 'flightnum_od_otp_rate_last14d', 'FAIL', ''",
                "SELECT 'forbidden', 'od_pair', 'FAIL', ''",
                "SELECT 'coverage', 'carrier_depdelay_mean_last7', CASE WHEN count(carrier_depdelay_mean_last7) / count(*) BETWEEN 0.8 AND 1 THEN 'PASS' ELSE 'WARN' END, printf('%.4f', count(carrier_depdelay_mean_last7) / count(*) + 1e-9) FROM x",
            ]
        ),
        x=FEATURES,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.range_checks(
        _features(spark, sf),
        ["origin_nas_rate_last7", "origin_weather_rate_last7", "absent_rate"],
        ["Origin", "flightnum_od_otp_rate_last14d"],
        ["od_pair"],
        {"carrier_depdelay_mean_last7": (0.8, 1.0)},
    )


@query(
    "rederived_feature",
    "Q07 W11",
    b.sql(
        "flights",
        "SELECT count(*) FILTER (a IS NOT NULL) AS n_checked, count(*) FILTER (a IS NOT NULL) AS n_agree, CAST(0 AS DOUBLE) AS worst, CAST(1 AS DOUBLE) AS share FROM s",
        k=f"SELECT *, CAST(DepDelayMinutes <= 15 AS DOUBLE) AS ok FROM flights WHERE {KNOWN} AND coalesce(Cancelled, 0) = 0",
        s0=f"SELECT {', '.join(FN_OD)}, FlightDate, avg(ok) {_between(FN_OD, 14)} AS a FROM k",
        s=f"SELECT DISTINCT {', '.join(FN_OD)}, FlightDate, a FROM s0",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The on-time rate from the range window against the same share from a join on earlier days."""
    f = b.flights(spark, sf)
    made = lags.otp_stats(f)
    kept = f.filter((F.coalesce("Cancelled", F.lit(0.0)) == 0) & F.col("DepDelayMinutes").isNotNull())
    daily = kept.groupBy(*FN_OD, "FlightDate").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("DepDelayMinutes") <= 15).cast("double")).alias("ok"))
    # Each day is laid out onto the 14 days it serves, and meets only the days that exist.
    served = daily.select(*FN_OD, F.explode(F.sequence(F.date_add("FlightDate", 1), F.date_add("FlightDate", 14))).alias("FlightDate"), "n", "ok")
    again = served.groupBy(*FN_OD, "FlightDate").agg((F.sum("ok") / F.sum("n")).alias("flightnum_od_otp_rate_last14d"))
    both = daily.select(*FN_OD, "FlightDate").join(again, [*FN_OD, "FlightDate"], "left")
    return plain(quality.rederive(made, both, [*FN_OD, "FlightDate"], "flightnum_od_otp_rate_last14d"))


@query(
    "leakage_proxy",
    "Q08",
    b.sql(
        "flights",
        "SELECT count(*) AS n_first_day, round(avg(CAST(carrier_depdelay_mean_last7 IS NOT NULL AS DOUBLE)), 6) + 0.0 AS known_share FROM x WHERE FlightDate = (SELECT min(FlightDate) FROM x)",
        x=FEATURES,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(quality.leakage_proxy(_features(spark, sf), "carrier_depdelay_mean_last7"))


@query(
    "clock_invariants",
    "Q09 P06",
    b.sql(
        "flights airports",
        "SELECT 'hour_matches_hhmm' AS \"check\", 'table' AS subject, CASE WHEN n1 = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n1 AS VARCHAR) AS detail FROM n "
        "UNION ALL SELECT 'hour_in_range', 'table', 'PASS', '0' FROM n UNION ALL SELECT 'peak_flag', 'table', CASE WHEN n2 = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(n2 AS VARCHAR) FROM n "
        "UNION ALL SELECT 'weekday', 'table', 'PASS', '0' FROM n",
        t=local_sql(),
        n="SELECT count(*) FILTER (hour(dep) <> CRSDepTime // 100) AS n1, count(*) FILTER (Dest = 'ATL' AND hour(dep) NOT BETWEEN 16 AND 20) AS n2 FROM t",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from tarmac.operators.joins import local_times

    made = local_times(b.flights(spark, sf), b.airport_dim(spark, sf))
    peak = F.when(F.col("sched_dep_hour").isNotNull() & (F.col("Dest") == "ATL"), F.lit(1)).otherwise(calendar.is_peak_hour(F.col("sched_dep_hour")))
    return quality.clock_invariants(made.withColumn("is_peak_hour", peak))


@query(
    "hour_shifts",
    "Q09",
    b.sql(
        "flights",
        "SELECT Origin, CAST(sum(n) AS BIGINT) AS n_rows, round(sum(n) FILTER (d <> 0) / sum(n), 6) + 0.0 AS shifted_share, CAST(arg_max(d, n * 1000 - d) AS BIGINT) AS modal_delta FROM c GROUP BY Origin HAVING sum(n) >= 20 AND sum(n) FILTER (d <> 0) / sum(n) > 0.02",
        c="SELECT Origin, CASE WHEN Origin IN ('LAX', 'SEA') THEN 2 WHEN l > 6 AND Origin = 'DEN' THEN 1 ELSE 0 END AS d, count(*) AS n FROM (SELECT *, CAST(TaxiIn AS INT) AS l FROM flights) WHERE CRSDepTime IS NOT NULL GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    shift = F.when(F.col("Origin").isin("LAX", "SEA"), 2).when((F.col("TaxiIn") > 6) & (F.col("Origin") == "DEN"), 1).otherwise(0)
    f = b.flights(spark, sf).withColumn("sched_dep_hour", F.floor(F.col("CRSDepTime") / 100) + shift)
    return plain(quality.hour_shift(f))


@query(
    "signal_gate",
    "Q10 A17",
    b.sql(
        "flights",
        "SELECT label, round(auc_a, 6) + 0.0 AS auc_a, round(auc_b, 6) + 0.0 AS auc_b, round(auc_b - auc_a, 6) + 0.0 AS delta, auc_b >= 0.55 AS signal FROM "
        "(SELECT label, max(a) FILTER (col = 'TaxiOut') AS auc_a, max(a) FILTER (col = 'ArrDelayMinutes') AS auc_b FROM "
        "(SELECT label, col, greatest(a0, 1 - a0) AS a FROM (SELECT label, col, (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS a0 FROM k GROUP BY label, col)) GROUP BY label)",
        x=FEATURES.replace(" FROM flights", ", TaxiOut, ArrDelayMinutes FROM flights"),
        m=" UNION ALL ".join(
            f"SELECT '{y}' AS label, '{c}' AS col, {y} AS y, {c} AS s FROM x WHERE {c} IS NOT NULL" for y in ("y_dep_ge15", "y_dep_ge60") for c in ("TaxiOut", "ArrDelayMinutes")
        ),
        k="SELECT *, rank() OVER (PARTITION BY label, col ORDER BY s) + (count(*) OVER (PARTITION BY label, col, s) - 1) / 2 AS rk FROM m",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf).withColumns(scoring.departure_labels(F.col("DepDelayMinutes")))
    return plain(quality.signal_gate(f, "TaxiOut", "ArrDelayMinutes", ["y_dep_ge15", "y_dep_ge60"]))


@query(
    "holiday_dates",
    "Q11 P12",
    b.sql("flights", "SELECT CAST(FlightDate AS VARCHAR) AS FlightDate FROM (SELECT DISTINCT FlightDate FROM flights) WHERE FlightDate IN (DATE '2024-01-01', DATE '2024-01-02', DATE '2024-01-14', DATE '2024-01-15', DATE '2024-01-16')"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf).withColumn("is_holiday", calendar.is_holiday(F.col("FlightDate")))
    return plain(quality.holiday_sample(f))
