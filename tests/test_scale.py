"""Rows are not gathered by a class, a feature or a month: plans and small counts."""

from __future__ import annotations

import contextlib
import statistics

import pytest
from pyspark.sql import functions as F

from tarmac.operators import history, models, ranks, sampling, stats
from tarmac.plans import departure


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(spark, df):
    """The plan as it is when no side's size is known to be small."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        return df._jdf.queryExecution().executedPlan().toString()


def labelled(spark):
    return spark.createDataFrame([(i, i % 5 == 0, float(i % 7), "g") for i in range(200)], "id int, yes boolean, v double, g string").selectExpr("id", "int(yes) y", "v", "g")


@pytest.mark.parametrize("made", [
    lambda df: sampling.balance(df, "y", 0.5, ["id"]),
    lambda df: sampling.presample(df, "y", 0.5, 0.15, ["id"]),
    lambda df: sampling.cap_rows(df, "y", 20, ["id"]),
    lambda df: sampling.stratified_split(df, "y", [0.6, 0.2, 0.2], ["a", "b", "c"], ["id"]),
])
def test_samples_do_not_gather_a_class(spark, made):
    text = plan(spark, made(labelled(spark)))
    joins = [line for line in text.splitlines() if "SortMergeJoin [_class#" in line and ("LeftOuter" in line or "LeftSemi" in line)]
    assert not joins


def test_bins_do_not_gather_a_feature(spark):
    df = labelled(spark)
    for made in (ranks.quantile_bins(df, ["v"], 4, ["y"]), ranks.quantile_bins(df, ["v"], 4, ["y"], ["g"])):
        assert not [line for line in plan(spark, made).splitlines() if "SortMergeJoin" in line and "_range#" not in line]
    curve = {r["bin"]: (r["n"], r["median"]) for r in stats.decile_curve(df, ["v"], "y", 2).collect()}
    low = [i % 7 for i in range(200) if i % 7 <= 3]
    assert curve[0] == (len(low), 1.5) and curve[1][0] == 200 - len(low)


def test_a_month_is_written_by_several_tasks(spark, tmp_path):
    from catalog.registry import load_all

    day = F.to_timestamp(F.lit("1992-02-03"))
    columns = "l_orderkey l_partkey l_suppkey l_linenumber".split()
    rows = spark.range(40_000).select(*[(F.col("id") % (10_000 + i)).alias(c) for i, c in enumerate(columns)], day.alias("l_shipdate"), F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        (F.col("id") % 50).cast("double").alias("l_quantity"), F.lit(0.05).alias("l_discount"), F.lit(0.01).alias("l_tax"), F.rand(1).alias("l_extendedprice"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(100).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    with settings(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}):
        made = load_all()["raw_month_files"].run(spark, str(tmp_path))
        assert made.count() == 40_000
    assert len(made.inputFiles()) > 2


def test_flight_history_joins_no_times(spark):
    rows = spark.sql(
        "SELECT 'C' AS Reporting_Airline, 1 AS Flight_Number_Reporting_Airline, 'A' AS Origin, 'B' AS Dest, date'2024-01-01' + int(id % 2) AS FlightDate, "
        "timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(int(id % 2), 0, int(id), 0) AS dep_dt_local, double(id) AS DepDelayMinutes, id FROM range(300)"
    )
    asked = rows.withColumns(history.local_clock())
    assert "Join" not in plan(spark, history.flight_history_stats(asked, rows, [1, 2]))
    made = {r["id"]: r for r in history.flight_history(rows, rows, [1, 2]).collect()}
    # Flight 7 follows all of the day before (even numbers) and 1, 3 and 5 of its own day.
    seen = [float(i) for i in range(0, 300, 2)] + [1.0, 3.0, 5.0]
    assert made[7]["flightnum_od_support_count_last2d"] == len(seen)
    assert made[7]["flightnum_od_depdelay_median_last1"] == statistics.median(seen)
    assert made[0]["flightnum_od_support_count_last2d"] == 0 and made[0]["flightnum_od_depdelay_mean_last1"] is None


def test_equal_rows_are_boosted_once(spark, monkeypatch):
    given = []
    fit = models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, df, params=None: given.append(df.agg(F.count("*"), F.sum("_rows")).first()) or fit(self, df, params))
    df = labelled(spark).withColumn("v", F.when(F.col("v") != 6, F.col("v")))
    model = models.fit_threshold(df, "y", models.Features(["v"], ["g"]), params={"maxIter": 2})
    assert given == [(12, 200.0)]  # six values, as the unknown one is filled with the median, and two labels
    assert len(models.raw_probability(model, df, models.Features(["v"], ["g"]), "p").collect()) == 200


def test_class_weights_do_not_gather_a_class(spark):
    assert "SortMergeJoin" not in plan(spark, models.class_weight(labelled(spark), "y"))


def test_queries_keep_generated_methods_small_enough_to_be_compiled(spark):
    from catalog import registry

    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, "65535")
    seen = []
    try:
        registry.query("_limit_of_methods", "")(lambda session, sf: seen.append(session.conf.get(name)))
        registry.ENTRIES["_limit_of_methods"].run(spark, "")
    finally:
        registry.ENTRIES.pop("_limit_of_methods", None)
        spark.conf.set(name, "8000")
    assert seen == ["8000"]


def test_a_small_grain_is_sent_to_the_rows_and_comes_in_its_place(spark, monkeypatch):
    from tarmac.operators import joins

    fact = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, None, 8), (4, "a", None)], "id int, k string, o int")
    by_k = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    by_o = spark.createDataFrame([(7, 10)], "o int, w int")
    # Null keys find nothing in a step's own table, though the grain is matched null-safely.
    want = {1: (1, 10), 2: (None, 10), 3: (None, None), 4: (1, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for cells, sent in ((joins.SENT_CELLS, 1), (0, 0)):
            monkeypatch.setattr(joins, "SENT_CELLS", cells)
            steps = [joins.Step(["k"], by_k), joins.Step(["o"], by_o)]
            made = joins.attach_by_grain(fact, [["k", "o"]], steps)
            assert made.columns == ["id", "k", "o", "v", "w"]
            assert {r.id: (r.v, r.w) for r in made.collect()} == want
            plan = made._jdf.queryExecution().sparkPlan().toString()
            assert plan.count("BroadcastHashJoin") == sent
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_correlation_is_the_same_by_either_way_back_to_the_rows(spark, monkeypatch):
    from tarmac.operators import stats

    cells = [("g", float(i % 5), float(i * 7 % 11) if i % 4 else None, float(-i) if i % 3 else None) for i in range(60)]
    cells += [("h", -0.0, 2.0, None), ("h", 0.0, 1.0, 3.0), ("h", 4.0, 1.0, 5.0), ("h", None, None, None)]
    df = spark.createDataFrame(cells, "g string, a double, b double, c double")
    pairs = [("a", "b"), ("a", "c"), ("b", "c")]
    got, sent = [], []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (stats.SENT_CELLS, 0):
            monkeypatch.setattr(stats, "SENT_CELLS", most)
            made = stats.spearman(df, pairs, ["g"])
            got.append(sorted((r.g, r.feature, r.target, r.n, None if r.rho is None else round(r.rho, 9)) for r in made.collect()))
            sent.append(made._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got[0] == got[1] and len(got[0]) == 6
    assert sent == [3, 0]


def test_the_first_leg_of_a_key_is_found_on_narrow_rows(spark):
    """Sorting whole feature rows by their key took most of the arrival table's merge."""
    rows = [(0, "a", 1, 20), (1, "a", 1, 10), (2, "b", 1, None), (3, None, 1, 5), (4, "c", 2, 7), (5, "c", 2, 7), (6, "a", 2, 3)]
    base = spark.createDataFrame(rows, "_row long, k string, d int, leg_id long").withColumn("wide", F.struct("k", "d"))
    made = departure.first_rows(base, ["k", "d"], "leg_id")
    got = {r["_row"] for r in made.collect()}
    assert got in ({1, 4, 6}, {1, 5, 6}) and {r["_first"] for r in made.collect()} == {True}
    text = plan(spark, made)
    assert "SortAggregate" not in text and "wide" not in text


def by_parts(monkeypatch):
    """Small tables as if they were large: nothing is sent, and work is cut into parts of a few rows."""
    from tarmac.operators import joins

    monkeypatch.setattr(joins, "SENT_CELLS", 0)
    monkeypatch.setattr(joins, "PART_ROWS", 80)


def some_flights(spark, n=150):
    return spark.sql(
        f"""SELECT date'2024-01-01' + int(id % 6) AS FlightDate, CASE WHEN id % 3 = 0 THEN 'AA' ELSE 'WN' END AS Reporting_Airline, id % 4 AS Flight_Number_Reporting_Airline,
        CASE WHEN id % 19 = 0 THEN NULL WHEN id % 2 = 0 THEN 'DEN' ELSE 'LAS' END AS Origin, CASE WHEN id % 2 = 0 THEN 'LAS' ELSE 'DEN' END AS Dest,
        CASE WHEN id % 11 > 0 THEN 'N' || id % 5 END AS Tail_Number, int(id * 7 % 24 * 100 + id % 60) AS CRSDepTime, int((id * 7 + 2) % 24 * 100 + id % 60) AS CRSArrTime,
        double(id * 37 % 140) AS DepDelayMinutes, double(id * 31 % 120) AS ArrDelayMinutes, 90d AS CRSElapsedTime, double(80 + id % 30) AS ActualElapsedTime, double(60 + id % 30) AS AirTime,
        int(id * 7 % 24 * 100 + (id + 9) % 60) AS WheelsOff, double(id % 2) AS CarrierDelay, double(id % 3) AS WeatherDelay, double(id % 4) AS NASDelay, double(id % 29) AS LateAircraftDelay,
        double(id % 13 = 0) AS Cancelled, double(id % 17 = 0) AS Diverted, id AS leg_id FROM (SELECT explode(array(id, id)) AS id0, id FROM range({n}))"""
    ).drop("id0")


def timed_flights(spark):
    from tarmac.operators import joins

    airports = spark.createDataFrame([("DEN", 39.8, -104.6, "America/Denver"), ("LAS", 36.0, -115.1, "America/Los_Angeles")], "IATA string, Latitude double, Longitude double, Timezone string")
    return joins.local_times(some_flights(spark), airports)


def sorted_rows(df):
    cols = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(repr, df.select(*cols).collect()))


TABLE = {"rolling_windows_days": [1, 3], "dest_rolling": False, "otp_rate_last14d": True, "tail_history": True, "prior_leg": True}


def test_a_departure_table_by_row_has_the_same_rows_and_shuffles_none_of_them(spark, monkeypatch):
    by_parts(monkeypatch)
    pool = timed_flights(spark)
    # Rows that come twice are told apart by nothing but their number, so they must not be ordered by it.
    pool = pool.dropDuplicates(["leg_id"])
    want = departure.features(pool, pool, TABLE, ties=["leg_id"])
    made = departure.features(pool, pool, TABLE, ties=["leg_id"], by_row=True)
    assert made.columns == want.columns and made.count() == 150
    assert sorted_rows(made) == sorted_rows(want)
    assert "Exchange" not in plan(spark, made)


def test_each_row_is_numbered_once_whatever_the_parts(spark, monkeypatch):
    by_parts(monkeypatch)
    made = departure.number_rows(some_flights(spark))
    assert made.count() == 300 and made.select("_row").distinct().count() == 300
    assert sorted_rows(made.drop("_row")) == sorted_rows(some_flights(spark))


def test_the_first_leg_of_a_key_is_merged_without_dealing_its_own_row(spark, monkeypatch):
    from tarmac.operators import joins

    by_parts(monkeypatch)
    rows = [(0, "a", 20, 1), (1, "a", 10, 2), (2, "b", None, 3), (3, None, 5, 4), (4, "c", 7, 5), (5, "a", 30, 6), (6, "c", 7, 7)]
    from tarmac.session import materialise_rows

    df = materialise_rows([spark.createDataFrame(rows, "_row long, k string, leg_id long, v int")], "t", "_row", 6)
    first = joins.leaders(df, ["k"], "leg_id", "_row")
    # Of two with the same tie the one numbered last leads.
    assert {(r["_row"], r["_at"]) for r in first.collect()} == {(0, 1), (1, 1), (4, 6), (5, 1), (6, 6)}
    made = joins.merge_first(df.drop("v"), df.withColumn("w", F.col("v") * 10), first, "_row")
    assert {r["_row"]: r["w"] for r in made.collect()} == {0: 20, 1: 20, 2: None, 3: None, 4: 70, 5: 20, 6: 70}


def test_an_arrival_table_by_row_has_the_same_rows(spark, monkeypatch):
    from tarmac.operators import joins
    from tarmac.plans import arrival

    by_parts(monkeypatch)
    pool = timed_flights(spark).dropDuplicates(["leg_id"])
    config = {"arrdelay_median_14d": True, "elapsed_time_ratio": True}
    flown = pool.filter("Cancelled = 0")
    # Some keys come twice: flights 120 numbers apart.
    extra = pool.na.drop(subset=arrival.MERGE_KEYS).groupBy(*arrival.MERGE_KEYS).agg(F.min("leg_id").alias("extra"))
    want = arrival.features(pool, flown, config, extra)
    numbered = departure.number_rows(pool)
    first = joins.leaders(numbered, arrival.MERGE_KEYS, "leg_id", "_row")
    made = arrival.features(numbered, numbered.filter("Cancelled = 0"), config, numbered.withColumn("extra", F.col("leg_id")), first=first)
    assert sorted_rows(made.select(*want.columns)) == sorted_rows(want)


def test_what_is_written_leaves_no_shuffle_files(spark):
    import glob
    import os
    import time

    from tarmac.session import materialise

    folder = spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())
    seen = lambda: {p for p in glob.glob(f"{os.path.dirname(folder)}/**/shuffle_*.data", recursive=True)}
    before = seen()
    assert materialise(spark.range(1000).repartition(7, "id"), "t").count() == 1000
    for _ in range(50):
        if seen() <= before:
            break
        time.sleep(0.1)
    assert not [p for p in seen() - before if os.path.getsize(p) > 500]
