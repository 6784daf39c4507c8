"""Plans from files to files, models, and the catalog itself."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog.registry import load_all
from tarmac.operators import models
from tarmac.plans import arrival, departure, prepare

AIRPORTS = "IATA,Latitude,Longitude,Timezone\nDEN,39.8,-104.6,America/Denver\nLAS,36.0,-115.1,America/Los_Angeles\n"


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    (root / "airports.csv").write_text(AIRPORTS)
    rows = spark.range(3000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("FlightDate"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'AA' ELSE 'WN' END").alias("Reporting_Airline"),
        (F.col("id") % 5).alias("Flight_Number_Reporting_Airline"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'DEN' ELSE 'LAS' END").alias("Origin"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'LAS' ELSE 'DEN' END").alias("Dest"),
        F.expr("'N' || id % 9").alias("Tail_Number"),
        F.expr("CAST(id * 7 % 24 * 100 + id % 60 AS INT)").alias("CRSDepTime"),
        F.expr("CAST((id * 7 + 2) % 24 * 100 + id % 60 AS INT)").alias("CRSArrTime"),
        F.expr("CAST(id * 37 % 140 AS DOUBLE)").alias("DepDelayMinutes"),
        F.expr("CAST(id * 31 % 120 AS DOUBLE)").alias("ArrDelayMinutes"),
        F.lit(90.0).alias("CRSElapsedTime"),
        F.expr("CAST(80 + id % 30 AS DOUBLE)").alias("ActualElapsedTime"),
        F.expr("CAST(60 + id % 30 AS DOUBLE)").alias("AirTime"),
        F.expr("CAST(id * 7 % 24 * 100 + (id + 9) % 60 AS INT)").alias("WheelsOff"),
        *[F.expr(f"CAST(id % {k} AS DOUBLE)").alias(n) for n, k in (("CarrierDelay", 2), ("WeatherDelay", 3), ("NASDelay", 4), ("LateAircraftDelay", 29))],
        F.expr("CAST(id % 50 = 0 AS DOUBLE)").alias("Cancelled"),
        F.expr("CAST(id % 70 = 0 AS DOUBLE)").alias("Diverted"),
    )
    rows.write.parquet(str(root / "raw/Year=2024"))
    spark.createDataFrame(
        [("E1", "WN", "airline_wide", "ALL", dt.date(2024, 2, 1), None, 3)],
        "event_id string, airline_iata string, scope string, affected_airports string, action_start_date date, action_end_date date, severity int",
    ).write.parquet(str(root / "actions"))
    out = {n: str(root / n) for n in ("enriched", "pool", "dep", "arr")}
    config = {
        "airports_csv": str(root / "airports.csv"),
        "input_flights_path": [str(root / "raw/Year=2024")],
        "airlines": ["WN"],
        "start_date": "2024-01-20",
        "end_date": "2024-02-09",
        "history_lookback_days": 60,
        "strike": {"enabled": True, "cache_path": str(root / "actions")},
        "output_enriched_unbalanced_path": out["enriched"],
        "history_output_path": out["pool"],
        "features_dep": {
            "hub_spillover": {"hubs": ["DEN", "LAS"]},
            "delay_median_last1": {"enabled": True},
            "cancel_rate_last1d": {"enabled": True},
            "divert_rate_last14d": {"enabled": True},
            "otp_rate_last14d": {"enabled": True},
            "cancel_anomaly_7d": {"enabled": True},
            "tail_history": {"enabled": True},
            "strike": {"enabled": True, "cache_path": str(root / "actions")},
        },
        "output_features_unbalanced_path": out["dep"],
        "balance": {"thresholds": [15, 60]},
        "feature_balance": {
            "output_template": str(root / "train_ge{thr}"),
            "thresholds": [15, 60],
            "pos_frac": 0.4,
            "eval": {"by": "last_days", "last_days": 5, "output_path": str(root / "eval")},
        },
    }
    return root, config, out


def test_prepare_departure_arrival(spark, world):
    root, config, out = world
    prepare.run(spark, config)
    enriched, pool = spark.read.parquet(out["enriched"]), spark.read.parquet(out["pool"])
    assert {r[0] for r in enriched.select("Reporting_Airline").distinct().collect()} == {"WN"}
    # The pool spans every carrier and reaches back before the first flight.
    assert pool.select("Reporting_Airline").distinct().count() == 2
    assert pool.agg(F.min("FlightDate")).first()[0] == dt.date(2024, 1, 1)
    assert enriched.filter("strike_severity = 3").select("FlightDate").distinct().collect()[0][0] == dt.date(2024, 2, 1)
    assert enriched.select(F.round(F.avg("Distance"))).first()[0] == pytest.approx(628, abs=5)

    departure.run(spark, config)
    dep = spark.read.parquet(out["dep"])
    assert dep.count() == enriched.count()
    for c in ("carrier_depdelay_mean_last14", "hub_1_depdelay_mean_last7", "flightnum_od_otp_rate_last14d", "tail_min_turn_time", "origin_congestion_3h_total", "days_to_strike", "hub_max_lateaircraft_last1", "y_dep_ge60"):
        assert dep.filter(F.col(c).isNotNull()).count() > 0, c
    held = spark.read.parquet(str(root / "eval"))
    assert held.agg(F.min("FlightDate")).first()[0] == dt.date(2024, 2, 5)
    train = spark.read.parquet(str(root / "train_ge60"))
    assert train.agg(F.max("FlightDate")).first()[0] == dt.date(2024, 2, 4)
    assert train.agg(F.avg("y_dep_ge60")).first()[0] == pytest.approx(0.4, abs=0.02)
    assert spark.read.json(out["dep"] + "_stats").filter("feature = 'Distance'").count() == 1

    arrival.run(
        spark,
        {
            **{k: config[k] for k in ("output_enriched_unbalanced_path", "history_output_path", "start_date", "end_date")},
            "arrdelay_median_14d": {"enabled": True},
            "elapsed_time_ratio": {"enabled": True},
            "output_features_unbalanced_path": out["arr"],
        },
    )
    arr = spark.read.parquet(out["arr"])
    assert arr.count() == enriched.count()
    for c in ("arrdelay_median_14d_car_od", "elapsed_time_ratio_last14d", "airtime_mean_14d_fn_od", "wo_slip_mean_14d_origin_blk", "dest_arrivals_pm60_eta", "y_arr_ge120"):
        assert arr.filter(F.col(c).isNotNull()).count() > 0, c


def test_scored_columns_add_up(spark):
    df = spark.createDataFrame([(0.9, 0.5, 0.2, 0.1), (0.1, 0.2, 0.0, 0.0)], "p_ge15 double, p_ge30 double, p_ge60 double, p_ge120 double")
    got = models.describe(df, [15, 30, 60, 120]).collect()
    bins = [c for c in got[0].asDict() if c.startswith("p_bin")]
    assert bins == ["p_bin0_lt15min", "p_bin1_15-30min", "p_bin2_30-60min", "p_bin3_60-120min", "p_bin4_ge120min"]
    for r in got:
        assert sum(r[c] for c in bins) == pytest.approx(1.0)
    assert got[0].pred_bin == "15-30 min" and got[1].pred_bin == "< 15 min"
    assert got[0].expected_delay_minutes == pytest.approx(0.1 * 7.5 + 0.4 * 22.5 + 0.3 * 45 + 0.1 * 90 + 0.1 * 150)


def test_importance_comes_with_the_share_of_rows_where_the_feature_is_known(spark, tmp_path):
    columns = "l_orderkey l_partkey l_suppkey l_linenumber".split()
    rows = spark.range(400).select(
        *[(F.col("id") % (50 + i)).alias(c) for i, c in enumerate(columns)], F.to_timestamp(F.lit("1992-02-03")).alias("l_shipdate"),
        F.expr("CASE WHEN id % 4 > 0 THEN 'R' END").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        (F.col("id") % 50).cast("double").alias("l_quantity"), F.expr("CASE WHEN id % 2 = 0 THEN 0.0 ELSE 0.05 END").alias("l_discount"),
        F.lit(0.01).alias("l_tax"), F.rand(1).alias("l_extendedprice"),
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(60).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    made = load_all()["feature_importance"].run(spark, str(tmp_path)).collect()
    assert len(made) == 24 and {r.label for r in made} == {f"y_dep_ge{t}" for t in (15, 30, 60, 120)}
    # Every second flight has no air time and every fourth no carrier.
    want = {"TaxiOut": 1.0, "AirTime": 0.5, "CRSElapsedTime": 1.0, "Distance": 1.0, "Reporting_Airline": 0.75, "Dest": 1.0}
    assert {(r.feature, r.known_rate) for r in made} == set(want.items())


def test_catalog_names_and_sql():
    entries = load_all()
    assert len(entries) > 180
    without = {n for n, e in entries.items() if e.sql is None}
    assert without == {
        "ordinal_scores",
        "cancellation_model",
        "feature_set_comparison",
        "logistic_comparison",
        "cascade_model",
        "per_carrier_models",
        "feature_importance",
    }
