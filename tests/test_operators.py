"""Operators against brute force on small rows with gaps, ties, nulls and hot keys."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tarmac.operators import actions as act
from tarmac.operators import congestion, evaluate, history, joins, lags, ordered, quality, ranks, sampling, stats

DAY0 = dt.date(2024, 1, 1)


# Hours from the airports' clocks to UTC.
ZONE = {"AAA": 5, "BBB": 6}


def make_legs(spark, n=240, seed=1):
    """Legs with a hot tail, ties in time, nulls and day gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tail = "HOT" if i % 3 == 0 else f"T{rng.randrange(8)}"
        day = rng.choice([0, 1, 2, 4, 5, 9])
        minute = rng.randrange(0, 1440, 5)
        dep = dt.datetime.combine(DAY0, dt.time()) + dt.timedelta(days=day, minutes=minute)
        origin, dest = rng.choice(["AAA", "BBB"]), rng.choice(["AAA", "BBB"])
        arr = dep + dt.timedelta(minutes=rng.choice([30, 60, 95]))
        rows.append(
            (
                i,
                (DAY0 + dt.timedelta(days=day)),
                tail if i % 17 else None,
                f"C{i % 2}",
                i % 3,
                origin,
                dest,
                dep,
                arr,
                None if i % 13 == 0 else float(rng.randrange(0, 90)),
                dep + dt.timedelta(hours=ZONE[origin]),
                arr + dt.timedelta(hours=ZONE[dest]),
            )
        )
    schema = (
        "id int, FlightDate date, Tail_Number string, Reporting_Airline string, Flight_Number_Reporting_Airline int, Origin string, Dest string, "
        "dep_dt_local timestamp_ntz, arr_dt_local timestamp_ntz, DepDelayMinutes double, dep_utc timestamp_ntz, arr_utc timestamp_ntz"
    )
    return spark.createDataFrame(rows, schema), rows


def test_row_calendar_and_range_lags_differ(spark):
    days = {0: 10.0, 1: 20.0, 4: 40.0, 5: None}
    rows = [(DAY0 + dt.timedelta(days=d), "WN", "DEN", v) for d, v in days.items()]
    hist = spark.createDataFrame(rows, "FlightDate date, Reporting_Airline string, Origin string, DepDelayMinutes double")
    fact = hist.select("FlightDate", "Reporting_Airline", "Origin")
    got = {r.FlightDate.day: r for r in lags.carrier_baselines(fact, hist, [1, 7]).collect()}
    assert got[5].carrier_depdelay_mean_last1 == 20.0 and got[5].carrier_depdelay_mean_last7 == 15.0
    assert got[1].carrier_depdelay_mean_last7 is None and got[2].carrier_depdelay_std_last7 is None
    # A day whose flights have no known delay has no row of its own, although earlier days exist.
    assert got[6].carrier_depdelay_mean_last7 is None
    yesterday = {r.FlightDate.day: r.carrier_depdelay_median_last1 for r in lags.median_last1(fact.withColumn("Dest", F.lit("DEN")), hist).collect()}
    assert yesterday == {1: None, 2: 10.0, 5: None, 6: 40.0}
    spans = lags.range_stats(hist, ["Origin"], "DepDelayMinutes", {3: ("m", "n")}, {3: "med"})
    got = {r.FlightDate.day: (r.m, r.n, r.med) for r in spans.collect()}
    assert got == {1: (None, 0, None), 2: (10.0, 1, 10.0), 5: (20.0, 1, 20.0)}


def test_hub_spine_counts_empty_days(spark):
    rows = [(0, "A", 10.0), (1, "B", 5.0), (2, "A", 30.0), (3, "B", 7.0)]
    hist = spark.createDataFrame([(DAY0 + dt.timedelta(days=d), o, v, 20.0) for d, o, v in rows], "FlightDate date, Origin string, DepDelayMinutes double, LateAircraftDelay double")
    got = {r.FlightDate.day: r for r in lags.hub_stats(hist, ["A", "B"], [1, 2]).collect()}
    assert got[2].hub_0_depdelay_mean_last1 == 10.0 and got[3].hub_0_depdelay_mean_last1 is None
    assert got[4].hub_0_depdelay_mean_last2 == 30.0 and got[4].hub_1_depdelay_mean_last2 == 5.0


def test_cube_gives_the_same_statistics(spark):
    _, rows = make_legs(spark)
    legs = spark.createDataFrame([r[1:2] + r[3:4] + r[5:6] + r[9:10] + (float(r[0] % 2),) for r in rows], "FlightDate date, Reporting_Airline string, Origin string, DepDelayMinutes double, Cancelled double")
    held = F.col("Cancelled") == 0
    cube = lags.station_cube(legs, held)
    direct = lags.daily_mean(legs.filter(held), ["Origin"], "DepDelayMinutes", "v")
    made = lags.from_cube(cube, ["Origin"], {"v": ("s_delay", "n_delay")}, "n_delay")
    key = lambda df: sorted((r.Origin, r.FlightDate, round(r.v, 9)) for r in df.collect())
    assert key(direct) == key(made)
    med = lags.median_from(lags.value_cube(legs.filter(held)), ["Origin"], "v")
    assert key(lags.daily_median(legs.filter(held), ["Origin"], "DepDelayMinutes", "v")) == key(med)


def test_flight_history_against_brute_force(spark):
    legs, rows = make_legs(spark, 200)
    made = {r.id: r for r in history.flight_history(legs, legs, [1, 3], low_support=2).collect()}
    for r in rows:
        for w in (1, 3):
            seen = [
                h[9]
                for h in rows
                if h[3:7] == r[3:7] and h[9] is not None and 0 <= (r[1] - h[1]).days <= w and (h[1] < r[1] or h[7] < r[7])
            ]
            got = made[r[0]]
            if not seen:
                assert got[f"flightnum_od_depdelay_mean_last{w}"] is None and got[f"flightnum_od_depdelay_median_last{w}"] is None
                continue
            assert got[f"flightnum_od_depdelay_mean_last{w}"] == pytest.approx(statistics.fmean(seen))
            assert got[f"flightnum_od_depdelay_median_last{w}"] == pytest.approx(statistics.median(seen))
            if w == 3:
                want = statistics.pstdev(seen) if len(seen) > 1 else None
                assert got.flightnum_od_depdelay_std_last3 == (pytest.approx(want) if want is not None else None)
                assert got.flightnum_od_support_count_last3d == len(seen)
                assert got.flightnum_od_low_support_last3d == int(len(seen) <= 2)


@pytest.mark.parametrize("segment", ["minute", "hour", "year"])
def test_ordered_operators_on_hot_keys(spark, segment):
    legs, rows = make_legs(spark)
    legs_no = {r.id: r.tail_leg_num_day for r in ordered.tail_leg_number(legs, ["id"], segment).collect()}
    turns = {r.id: r.turn_time_hours for r in ordered.turn_time(legs, ["id"], ["Tail_Number"], segment).collect()}
    recent = {r.id: r.has_recent_arrival_turn_5h for r in ordered.recent_arrival(legs, ["id"], segment=segment).collect()}
    assert len(legs_no) == len(turns) == len(recent) == len(rows)
    by_order = sorted((r for r in rows if r[2]), key=lambda r: (r[2], r[10], r[0]))
    last, count = {}, {}
    for r in by_order:
        count[(r[2], r[1])] = count.get((r[2], r[1]), 0) + 1
        assert legs_no[r[0]] == count[(r[2], r[1])]
        before = last.get(r[2])
        gap = (r[10] - before[11]).total_seconds() / 3600 if before else None
        linked = before is not None and before[6] == r[5]
        assert turns[r[0]] == (pytest.approx(min(48.0, max(0.0, gap))) if linked else None)
        assert recent[r[0]] == int(linked and 0 <= gap <= 5)
        last[r[2]] = r
    assert all(legs_no[r[0]] is None and recent[r[0]] == 0 for r in rows if not r[2])


def test_flight_number_in_two_zones(spark):
    at = lambda h: dt.datetime.combine(DAY0, dt.time(h))
    rows = [(1, "WN", 7, at(8), at(13)), (2, "WN", 7, at(10), at(16))]
    legs = spark.createDataFrame(rows, "id int, Reporting_Airline string, Flight_Number_Reporting_Airline int, dep_dt_local timestamp_ntz, dep_utc timestamp_ntz")
    got = {r.id: r.flightnum_hours_since_first_departure_today for r in ordered.hours_since_first(legs).collect()}
    assert got == {1: 0.0, 2: 3.0}


@pytest.mark.parametrize("block,segment", [(10, "minute"), (100_000, "hour")])
def test_row_rolling_in_blocks(spark, block, segment):
    legs, rows = make_legs(spark)
    made = ordered.row_rolling(legs, ["Origin"], "dep_dt_local", ["id"], F.col("id").cast("double"), "v", 7, block, segment)
    got = {r.id: r.v for r in made.collect()}
    for origin in ("AAA", "BBB"):
        ids = [r[0] for r in sorted((r for r in rows if r[5] == origin), key=lambda r: (r[7], r[0]))]
        for i, one in enumerate(ids):
            assert got[one] == pytest.approx(statistics.fmean(ids[max(0, i - 6) : i + 1]))


def test_congestion_against_brute_force(spark):
    legs, rows = make_legs(spark)
    got = {r.id: r for r in congestion.departure_congestion(legs, legs).collect()}
    for r in rows:
        near = [h for h in rows if h[5] == r[5] and h[1] == r[1] and abs((h[7] - r[7]).total_seconds()) <= 10800]
        assert got[r[0]].origin_congestion_3h_total == len(near) - 1
        assert got[r[0]].origin_airline_congestion_3h_total == sum(h[3] == r[3] for h in near) - 1
    shifted = legs.withColumn("arrdelay_mean_7d_car_od", F.expr("CASE WHEN id % 4 = 0 THEN NULL ELSE id % 7 + 0.37D END"))
    got = {r.id: r for r in congestion.arrival_congestion(shifted).collect()}
    for r in rows:
        late = 0.0 if r[0] % 4 == 0 else r[0] % 7 + 0.37
        eta = r[8] + dt.timedelta(minutes=late)
        pool = [h for h in rows if h[6] == r[6] and h[8].date() == r[8].date()]
        assert got[r[0]].dest_arrivals_pm60_sched == sum(abs((h[8] - r[8]).total_seconds()) <= 3600 for h in pool) - 1
        assert got[r[0]].dest_arrivals_pm60_eta == max(0, sum(abs((h[8] - eta).total_seconds()) <= 3600 for h in pool) - 1)


def test_asof_keeps_rows_without_day(spark):
    right = spark.createDataFrame([("a", DAY0, 1.0), ("a", DAY0 + dt.timedelta(days=3), None), ("b", DAY0, 9.0)], "k string, FlightDate date, v double")
    left = spark.createDataFrame([(1, "a", DAY0), (2, "a", DAY0 + dt.timedelta(days=2)), (3, "a", DAY0 + dt.timedelta(days=9)), (4, "a", None), (5, "c", DAY0), (6, "b", DAY0 - dt.timedelta(days=1))], "id int, k string, FlightDate date")
    got = {r.id: r.v for r in joins.attach_asof(left, right, ["k"]).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: None, 4: None, 5: None, 6: None}


def test_quantiles_and_ranks(spark):
    rng = random.Random(3)
    rows = [("a", float(rng.randrange(20))) for _ in range(101)] + [("b", 7.0)] * 4 + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q1, r.q2) for r in ranks.quantiles(df, ["k"], "v", [0.25, 0.9], ["q1", "q2"]).collect()}
    a = sorted(v for k, v in rows if k == "a")
    assert got == {"a": (a[25], a[90]), "b": (7.0, 7.0)}
    shared = {r.v: r["rank"] for r in ranks.average_ranks(df.filter("k = 'a'"), ["k"], "v").collect()}
    for v, rank in shared.items():
        at = [i + 1 for i, x in enumerate(a) if x == v]
        assert rank == pytest.approx(statistics.fmean(at))


def test_bins_with_equal_edges(spark):
    df = spark.createDataFrame([(0.0,)] * 5 + [(1.0,), (2.0,), (3.0,), (4.0,)], "v double").withColumn("y", (F.col("v") > 0).cast("int"))
    # Quarter edges are 0, 0, 0, 2, 4: the first two bins merge, and bins are closed on the right.
    got = {r.bin: (r.n, r.rate, r.median) for r in stats.decile_curve(df, ["v"], "y", 4).collect()}
    assert got == {0: (7, pytest.approx(2 / 7), 0.0), 1: (2, 1.0, 3.5)}


def test_auc_with_ties_and_one_class(spark):
    rows = [("t", 1, 0.5), ("t", 0, 0.5), ("t", 1, 0.9), ("t", 0, 0.1), ("one", 1, 0.2), ("one", 1, 0.3)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r.g: r.auc for r in evaluate.auc_table(df, ["g"], "y", "s").collect()}
    assert got == {"t": 0.875, "one": None}


def test_cramers_v_with_empty_cells(spark):
    df = spark.createDataFrame([("a", 0)] * 6 + [("b", 1)] * 4, "c string, y int")
    got = stats.cramers_v(df, [("c", "y")]).first()
    # Continuity-corrected chi-square of the diagonal table ((6, 0), (0, 4)).
    want = sum((abs(o - e) - 0.5) ** 2 / e for o, e in ((6, 3.6), (0, 2.4), (0, 2.4), (4, 1.6)))
    assert got.chi2 == pytest.approx(want)


def test_two_sided_p(spark):
    # Tail areas of Student's t to ten digits, and of the normal law for many degrees of freedom.
    known = [(2.0, 10.0, 0.0733880348), (0.0, 5.0, 1.0), (0.1, 3.0, 0.9266518), (-2.0, 10.0, 0.0733880348), (12.706204736, 1.0, 0.05), (1.959963985, 1e9, 0.05), (3.0, 1e6, 0.0026999), (0.5, 2.5, 0.6570), (40.0, 50.0, 0.0)]
    rows = spark.createDataFrame([(i, t, df) for i, (t, df, _) in enumerate(known)], "i int, t double, df double")
    got = {r.i: r.p for r in rows.select("i", stats.two_sided_p(F.col("t"), F.col("df")).alias("p")).collect()}
    for i, (t, df, p) in enumerate(known):
        def density(u, df=df):
            return math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - (df + 1) / 2 * math.log1p(u * u / df)) / math.sqrt(df * math.pi)

        if df < 1e5:
            steps = 20_000
            h = abs(t) / steps
            inside = sum((1 if k in (0, steps) else 4 if k % 2 else 2) * density(k * h) for k in range(steps + 1)) * h / 3
            p = 1 - 2 * inside
        assert got[i] == pytest.approx(p, abs=1e-6)


def test_samples_are_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 5 == 0).cast("int").alias("y"), F.date_add(F.lit(DAY0), (F.col("id") % 7).cast("int")).alias("FlightDate"))
    one = {r.id for r in sampling.take_exact(df, 137, ["id"], 1).collect()}
    two = {r.id for r in sampling.take_exact(df.repartition(13), 137, ["id"], 1).collect()}
    assert len(one) == 137 and one == two
    assert sampling.take_exact(df, 5000, ["id"], 1).count() == 1000 and sampling.take_exact(df, 0, ["id"], 1).count() == 0
    for frac, want in ((0.5, (200, 200)), (0.1, (89, 800))):
        got = {r.y: r["count"] for r in sampling.balance(df, "y", frac, ["id"]).groupBy("y").count().collect()}
        assert (got[1], got[0]) == want
    assert sampling.balance(df.filter("y = 1"), "y", 0.5, ["id"]).count() == 200
    assert sampling.balance(df, "y", 0.5, ["id"], max_rows=50).count() == 50
    with pytest.raises(ValueError):
        sampling.balance(df, "y", 1.0, ["id"])
    late = sampling.split_latest(df, 0.25, ["id"])
    assert late.filter("is_eval").count() == 250
    assert late.filter("is_eval").agg(F.min("FlightDate")).first()[0] >= late.filter("not is_eval").agg(F.max("FlightDate")).first()[0]
    parts = {(r.y, r.split): r["count"] for r in sampling.stratified_split(df, "y", [0.6, 0.2, 0.2], ["a", "b", "c"], ["id"]).groupBy("y", "split").count().collect()}
    assert parts == {(1, "a"): 120, (1, "b"): 40, (1, "c"): 40, (0, "a"): 480, (0, "b"): 160, (0, "c"): 160}
    rest, held = sampling.split_last_days(df, 2)
    assert (rest.count(), held.count()) == (df.filter(F.col("FlightDate") <= DAY0 + dt.timedelta(days=4)).count(), df.filter(F.col("FlightDate") > DAY0 + dt.timedelta(days=4)).count())


def test_actions_either_and_both(spark):
    fields = "event_id string, airline_iata string, scope string, affected_airports string, action_start_date date, action_end_date date, severity int, worker_type string, cooling_off_start date"
    d = lambda n: DAY0 + dt.timedelta(days=n)
    calendar = spark.createDataFrame(
        [
            ("wide", "WN", "airline_wide", "ALL", d(5), None, 3, "pilot", d(0)),
            ("spot", "AA", "airport_specific", "DEN, LAS", d(5), d(6), 2, "atc", None),
            ("all", "ALL", "system_wide", "ALL", d(20), d(20), 5, "ground_crew", None),
        ],
        fields,
    )
    fact = spark.createDataFrame([(i, c, o, d(n)) for i, (c, o, n) in enumerate([("WN", "DEN", 5), ("AA", "DEN", 6), ("UA", "BOS", 5), ("UA", "LAS", 6), ("UA", "BOS", 20), ("UA", "BOS", 1)])], "id int, Reporting_Airline string, Origin string, FlightDate date")
    both = {r.id: r.strike_severity for r in act.action_severity(fact, calendar).collect()}
    assert both == {0: 3, 1: 2, 2: 0, 3: 0, 4: 5, 5: 0}
    either = {r.id: r.strike_severity for r in act.action_severity(fact, calendar, "as_written").collect()}
    assert either == {0: 3, 1: 2, 2: 3, 3: 2, 4: 5, 5: 0}
    full = {r.id: r for r in act.action_features(fact, calendar).collect()}
    assert full[0].strike_worker_type == "atc" and full[2].strike_worker_type == "pilot" and full[5].strike_worker_type == "none"
    assert (full[0].in_cooling_off, full[0].cooling_off_days_remaining) == (1, 25)
    assert (full[5].days_to_strike, full[0].days_to_strike, full[1].days_since_strike_end) == (19, 0, 0)
    assert full[3].strike_spillover_origin == 1 and full[1].strike_spillover_origin == 0
    with pytest.raises(ValueError):
        act.action_severity(fact, calendar, "neither")


def test_actions_of_any_length_against_brute_force(spark):
    """Overlapping intervals, some without end in sight, against every pair of flight and action."""
    rng = random.Random(4)
    fields = "event_id string, airline_iata string, scope string, affected_airports string, action_start_date date, action_end_date date, severity int, worker_type string, cooling_off_start date"
    rows = []
    for i in range(40):
        start = DAY0 + dt.timedelta(days=rng.randrange(-20, 60))
        end = rng.choice([None, start, start + dt.timedelta(days=rng.randrange(1, 30)), start - dt.timedelta(days=2), dt.date(9999, 12, 31)])
        spots = rng.choice(["ALL", "DEN", "DEN, LAS", "BOS"])
        cool = rng.choice([None, start - dt.timedelta(days=rng.randrange(0, 40))])
        rows.append((f"E{i}", rng.choice(["WN", "AA", "ALL"]), rng.choice(["airport_specific", "airline_wide"]), spots, start, end, rng.randrange(1, 6), rng.choice(["pilot", "atc", None]), cool))
    asked = [(c, o, DAY0 + dt.timedelta(days=d)) for c in ("WN", "UA") for o in ("DEN", "BOS") for d in range(0, 70, 3)]
    fact = spark.createDataFrame(asked, "Reporting_Airline string, Origin string, FlightDate date")
    calendar = spark.createDataFrame(rows, fields)
    got = {(r.Reporting_Airline, r.Origin, r.FlightDate): r for r in act.action_features(fact, calendar).collect()}
    worst = {(r.Reporting_Airline, r.Origin, r.FlightDate): r.strike_severity for r in act.action_severity(fact, calendar).collect()}
    for c, o, day in asked:
        def at(a, c=c, o=o):
            wide = a[2] == "airline_wide" or a[3] == "ALL"
            return a[1] in ("ALL", c), wide or o in a[3].split(", ")

        on = [a for a in rows if a[4] <= day <= (a[5] or a[4])]
        r = got[c, o, day]
        assert worst[c, o, day] == max([a[6] for a in on if all(at(a))], default=0)
        assert r.strike_severity == max([a[6] for a in on if any(at(a))], default=0)
        assert r.strike_active_carrier == int(any(at(a)[0] for a in on)) and r.strike_active_origin == int(any(at(a)[1] for a in on))
        ahead = [(a[4] - day).days for a in rows if at(a)[0] and 0 <= (a[4] - day).days <= 90]
        since = [(day - (a[5] or a[4])).days for a in rows if at(a)[0] and 0 <= (day - (a[5] or a[4])).days <= 90]
        left = [30 - (day - a[8]).days for a in rows if a[8] and at(a)[0] and 0 <= (day - a[8]).days <= 30]
        assert (r.days_to_strike, r.days_since_strike_end, r.cooling_off_days_remaining) == tuple(min(x, default=None) for x in (ahead, since, left))
        assert r.strike_spillover_origin == int(any(at(a)[1] and a[1] not in ("ALL", c) for a in on))


def test_steps_meet_on_their_grain(spark):
    fact = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", None), (4, None, "y")], "id int, k string, o string")
    by_k = spark.createDataFrame([("a", 10), ("b", 20)], "k string, v int")
    by_o = spark.createDataFrame([("x", 1.5), ("y", 2.5)], "o string, w double")
    steps = [joins.Step(["k"], by_k), joins.Step(["o"], by_o), joins.Step(["k", "o"], lambda t: t.withColumn("both", F.concat_ws("-", "k", "o")))]
    got = {r.id: (r.v, r.w, r.both) for r in joins.attach_by_grain(fact, [["k", "o"], ["id"]], steps).collect()}
    assert got == {1: (10, 1.5, "a-x"), 2: (10, 1.5, "a-x"), 3: (20, None, "b"), 4: (None, 2.5, "y")}
    with pytest.raises(ValueError):
        joins.attach_by_grain(fact, [["k"]], [joins.Step(["o"], by_o)])


def test_pooling_against_the_minimax_formula():
    from tarmac.operators import models

    rng = random.Random(9)
    for _ in range(50):
        counts = [(rng.randrange(1, 9), 0) for _ in range(rng.randrange(1, 12))]
        counts = [(n, rng.randrange(0, n + 1)) for n, _ in counts]
        mean = lambda a, c: sum(t for _, t in counts[a : c + 1]) / sum(n for n, _ in counts[a : c + 1])
        want = [max(min(mean(a, c) for c in range(i, len(counts))) for a in range(i + 1)) for i in range(len(counts))]
        assert models.pool(counts) == pytest.approx(want)
    assert models.pool([]) == []


def test_empty_and_incomplete_tables_fail(spark):
    empty = spark.createDataFrame([], "Origin string, Distance double")
    got = {(r.check, r.status) for r in quality.validate_features(empty, ["Origin"]).collect()}
    assert got == {("row_count", "FAIL"), ("expected_columns", "PASS")}
    some = spark.createDataFrame([("DEN", 100.0)] * 20 + [("Den", 7000.0)], "Origin string, Distance double")
    findings = {(r.check, r.subject): r.status for r in quality.validate_features(some, ["Dest"]).collect()}
    assert findings[("expected_columns", "table")] == "FAIL"
    assert findings[("codes", "Origin")] == "FAIL" and findings[("range", "Distance")] == "FAIL"
    assert quality.roll_up(quality.validate_features(some)).first().status == "FAIL"
    assert quality.rule_for("hub_DEN_depdelay_mean_last14").high == 5000 and quality.rule_for("unheard_of") is None
    unknown = "carrier_depdelay_median_last14 hub_ZZZ_depdelay_median_last14 hub_9_lateaircraft_rate_last7 origin_dep_temperature_2m_max"
    assert not [n for n in unknown.split() if quality.rule_for(n)]
    assert quality.rule_for("hub_3_depdelay_median_last1") and quality.rule_for("hub_DEN_depdelay_median_last1") is None


def test_merge_may_repeat_rows(spark):
    left = spark.createDataFrame([(1, "A")], "k int, x string")
    right = spark.createDataFrame([(1, "B", 5), (1, "C", 6)], "k int, x string, y int")
    assert sorted(r.y for r in joins.merge_features(left, right, ["k", "absent"]).collect()) == [5, 6]
    assert joins.duplicate_keys(right, ["k"]).count() == 1


@pytest.mark.parametrize("n", [0, 1, 10, 155, 1000, 2000])
def test_samples_are_exact_where_rows_share_ids(spark, n):
    df = spark.range(1000).selectExpr("id % 100 as key", "id % 7 as v", "cast(id % 3 = 0 as int) as y", "date_add(date'2024-01-01', cast(id % 4 as int)) as FlightDate")
    assert sampling.take_exact(df, n, ["key"], 3).count() == min(n, 1000)
    split = sampling.stratified_split(df, "y", [0.55, 0.25, 0.2], ["a", "b", "c"], ["key"])
    got = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert [got[1, s] for s in "abc"] == [184, 83, 67] and [got[0, s] for s in "abc"] == [366, 167, 133]
    assert sampling.split_latest(df, 0.333, ["key"]).filter("is_eval").count() == 333
    again = sampling.take_exact(df.repartition(7), n, ["key"], 3)
    assert again.exceptAll(sampling.take_exact(df, n, ["key"], 3)).count() == 0
