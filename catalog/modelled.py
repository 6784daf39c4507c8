"""Spark ML models; their numbers are the library's own, so they have no SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import evaluate, models, ordered, sampling

from . import bindings as b
from .registry import plain, query

FEATS = models.Features(["TaxiOut", "AirTime", "CRSElapsedTime", "Distance"], ["Reporting_Airline", "Dest"])
LIMITS = [15, 30, 60, 120]
KEY = ["FlightDate", "Reporting_Airline", "Origin", "Dest", "CRSDepTime", "TaxiOut", "AirTime", "Tail_Number"]


def rows(spark: SparkSession, sf: str) -> DataFrame:
    delay = F.coalesce("DepDelayMinutes", F.lit(0.0))
    made = {f"y_dep_ge{t}": (delay >= t).cast("int") for t in LIMITS}
    return b.flights(spark, sf).withColumns({**made, "Cancelled": F.col("Cancelled").cast("int")})


@query("ordinal_scores", "M01 M02 M04")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All thresholds fitted and calibrated on early days, scored on the last ones."""
    train, test = sampling.split_last_days(rows(spark, sf), 60)
    fitted = models.fit_ordinal(train, [f"y_dep_ge{t}" for t in LIMITS], FEATS, KEY)
    scored = models.score(test, {t: fitted[f"y_dep_ge{t}"] for t in LIMITS}, FEATS, [7.5, 22.5, 45.0, 90.0, 150.0])
    cols = [c for c in scored.columns if c.startswith(("p_ge", "p_bin"))]
    return plain(scored.select("FlightDate", "Reporting_Airline", *cols, "expected_delay_minutes", "severity_score", "pred_bin", "delay_probabilities"))


STEPS = 40


@query(
    "isotonic_steps",
    "M02 P30",
    b.sql(
        "scored",
        # The fitted value is the largest, over starts, of the smallest mean up to any end.
        "SELECT s.step, s.n, round(s.total / s.n, 6) + 0.0 AS rate, round(max(low), 6) + 0.0 AS fitted FROM s JOIN least ON least.step = s.step GROUP BY s.step, s.n, s.total",
        s=f"SELECT CAST(least(floor(p * {STEPS}), {STEPS - 1}) AS INT) AS step, count(*) AS n, sum(y) AS total FROM scored GROUP BY 1",
        sums="SELECT a.step AS a, c.step AS c, sum(m.total) / sum(m.n) AS mean FROM s a JOIN s c ON c.step >= a.step JOIN s m ON m.step BETWEEN a.step AND c.step GROUP BY ALL",
        least="SELECT x.step, sums.a, min(sums.mean) AS low FROM s x JOIN sums ON sums.a <= x.step AND sums.c >= x.step GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(models.isotonic_steps(b.scored(spark, sf), "p", "y", STEPS))


@query("cancellation_model", "M03 A18")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Balanced class weights, calibration, and the cut with the largest TPR - FPR."""
    train, test = sampling.split_last_days(rows(spark, sf), 60)
    model = models.fit_cancellation(train, "Cancelled", FEATS, KEY)
    return plain(evaluate.youden(models.probability(model, test, FEATS, "p"), "Cancelled", "p"))


@query("feature_set_comparison", "M05")
def _(spark: SparkSession, sf: str) -> DataFrame:
    train, test = sampling.split_last_days(rows(spark, sf), 60)
    variants = {"base": models.Features(["TaxiOut"]), "with_airtime": models.Features(["TaxiOut", "AirTime"]), "with_carrier": models.Features(["TaxiOut"], ["Reporting_Airline"])}
    return plain(models.compare_feature_sets(train, test, "y_dep_ge15", variants))


@query("logistic_comparison", "M06")
def _(spark: SparkSession, sf: str) -> DataFrame:
    known = rows(spark, sf).na.drop(subset=["TaxiOut", "AirTime", "y_dep_ge60"])
    train, test = sampling.split_last_days(known, 60)
    return plain(models.logistic_lift(train, test, "y_dep_ge60", ["TaxiOut"], "AirTime"))


@query("cascade_model", "M07 A06 A07")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Whether an aircraft's day will see a spreading delay, from what is known beforehand."""
    legs = b.legs(spark, sf).withColumn("delayed", (F.coalesce("DepDelayMinutes", F.lit(0.0)) >= 15).cast("double"))
    days = ordered.cascade_daily(legs, "dep_dt_local", ["leg_id"], "delayed", "DepDelayMinutes").filter("n_legs >= 2")
    ahead = ordered.tail_schedule(ordered.turn_time(legs, ["leg_id"]))
    data = sampling.split_dates(days.join(ahead, ["Tail_Number", "FlightDate"]))
    feats = models.Features(["n_legs", "mean_turn", "min_sched_dep", "max_sched_dep", "n_airports", "mean_distance"])
    model = models.fit_threshold(data.filter("is_train"), "cascade", feats)
    scored = models.raw_probability(model, data.filter("not is_train"), feats, "p").withColumn("all", F.lit("all"))
    auc = evaluate.auc_table(scored, ["all"], "cascade", "p")
    return plain(auc.join(evaluate.average_precision(scored, "cascade", "p", ["all"]), ["all"]).drop("all"))


@query("per_carrier_models", "M08 L09")
def _(spark: SparkSession, sf: str) -> DataFrame:
    feats = models.Features(["TaxiOut", "AirTime", "CRSElapsedTime"])
    return plain(models.per_group(rows(spark, sf), "Reporting_Airline", b.CARRIERS, "y_dep_ge15", feats))


@query("feature_importance", "M09")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Importance per label, next to the share of rows where the feature is known."""
    data = rows(spark, sf)
    parts = []
    for y in [f"y_dep_ge{t}" for t in LIMITS]:
        model = models.fit_threshold(data, y, FEATS)
        parts.append(models.importance(model).withColumn("label", F.lit(y)))
    every = reduce(lambda x, z: x.unionByName(z), parts)
    return plain(every.join(models.known_rates(data, FEATS), ["feature"], "left"))
