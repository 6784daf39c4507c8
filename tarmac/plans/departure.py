"""Departure features, labels, holdout and balanced training sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, scoring
from ..functions.parse import between_days, clean_tail, flown, hhmm_hour, key_int, norm_keys, num, od_pair
from ..functions.weather import row_max, weather_units, wind_x_precip
from ..operators import actions as act
from ..operators import congestion, history, joins, lags, ordered, sampling, stats
from ..session import materialise, materialise_rows
from ..sources import sinks
from .config import enabled, option

DATE, CARRIER, ORIGIN, DEST = "FlightDate", "Reporting_Airline", "Origin", "Dest"
FLIGHT_NUM, TAIL = "Flight_Number_Reporting_Airline", "Tail_Number"
Part = tuple[Sequence[str], DataFrame]
ROW_ID = [DATE, CARRIER, FLIGHT_NUM, ORIGIN, DEST, "CRSDepTime"]


def base_columns(fact: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """Keys, route, clock, holidays and weather units."""
    out = norm_keys(fact, [CARRIER, ORIGIN, DEST], [DATE]).withColumn(FLIGHT_NUM, key_int(FLIGHT_NUM))
    made = {
        "od_pair": od_pair(),
        "is_holiday": calendar.is_holiday(
            F.col(DATE),
            int(option(config, "holiday_windows", "thanksgiving", 2)),
            int(option(config, "holiday_windows", "christmas", 3)),
        ),
        "is_spring_break": calendar.is_spring_break(F.col(DATE)),
        "flight_month": F.month(DATE),
    }
    if TAIL in out.columns:
        made[TAIL] = clean_tail(TAIL)
    if "sched_dep_hour" not in out.columns:
        made |= {"sched_dep_hour": hhmm_hour("CRSDepTime"), "dep_dow": calendar.weekday(F.col(DATE))}
    block = F.upper(F.trim("DepTimeBlk")) if "DepTimeBlk" in out.columns else F.lit("Unknown")
    made["DepTimeBlk"] = block
    for src, dst in (("origin_weathercode", "origin_daily_weathercode"), ("origin_dep_weathercode", "origin_dep_hour_weathercode")):
        if src in out.columns:
            made[dst] = num(src).cast("bigint").cast("string")
    out = weather_units(out.withColumns(made))
    return out.withColumns({"is_peak_hour": calendar.is_peak_hour(F.col("sched_dep_hour")), "wind_x_precip": wind_x_precip(out)})


def with_clocks(base: DataFrame) -> DataFrame:
    """The days, minutes and hours of departure that families of columns are keyed by."""
    out = base.withColumns(congestion.local_minute()).withColumns(history.local_clock())
    return out.withColumn("_hour", F.date_trunc("hour", "dep_utc")) if "dep_utc" in out.columns else out


def station_parts(cube: DataFrame, values: DataFrame | None, config: Mapping[str, Any], windows: Sequence[int]) -> list[Part]:
    """Statistics keyed by some of carrier, origin and day, all from the two cubes.

    Delay statistics rest on the rows the cube marks as held, rates on all of them. Each set of keys has
    one table for all rolling measures, and one for what is asked of exactly yesterday.
    """

    def delay(prefix: str) -> lags.Lag:
        return lags.Lag(f"{prefix}_mean", "s_delay", "n_delay", "n_delay", windows, f"{prefix}_std")

    def rate(prefix: str, top: str) -> lags.Lag:
        return lags.Lag(prefix, top, "n_held", "n_held", windows)

    rolling: dict[str, list[lags.Lag]] = {
        CARRIER: [delay("carrier_depdelay"), rate("carrier_lateaircraft_rate", "n_late")],
        ORIGIN: [
            delay("origin_depdelay"),
            rate("origin_nas_rate", "n_nas"),
            rate("origin_lateaircraft_rate", "n_late"),
            rate("origin_weather_rate", "n_weather"),
        ],
    }
    if enabled(config, "divert_rate_last14d"):
        rolling[ORIGIN].append(lags.Lag("divert_rate_origin", "n_diverted", "n_all", "n_all", [14], suffix="d"))
    if enabled(config, "cancel_anomaly_7d"):
        score = ("airline_cancel_rate_anomaly_7d", lags.cancel_z)
        rolling[CARRIER].append(lags.Lag("", "s_cancelled", "n_all", "n_all", score=score))
    if enabled(config, "strike"):
        score = ("carrier_delay_rate_anomaly_7d", lags.carrier_z)
        rolling[CARRIER].append(lags.Lag("", "n_carrier_all", "n_all", "n_all", score=score))
    parts: list[Part] = [([key, DATE], lags.cube_lags(cube, [key], own)) for key, own in rolling.items()]
    parts.append(([CARRIER, ORIGIN, DATE], lags.cube_lags(cube, [CARRIER, ORIGIN], [delay("carrier_origin_depdelay")])))

    yesterday = {}
    if enabled(config, "nas_rate_last1d"):
        yesterday["origin_nasdelay_rate_last1d"] = ("n_nas_all", "n_all")
    if enabled(config, "cancel_rate_last1d"):
        yesterday["cancel_rate_origin_last1d"] = ("n_cancelled", "n_all")
    if yesterday:
        parts.append(([ORIGIN, DATE], lags.next_day(lags.from_cube(cube, [ORIGIN], yesterday))))
    hubs = option(config, "hub_spillover", "hubs", [])
    if hubs and enabled(config, "hub_spillover", True):
        daily = lags.from_cube(cube, [ORIGIN], {"_v": ("s_delay", "n_delay"), "_late": ("n_late", "n_held")}, "n_held")
        parts.append(([DATE], lags.hub_lags(daily, hubs, windows)))
    if values is not None:
        for keys, name in (([CARRIER], "carrier_depdelay_median_last1"), ([CARRIER, ORIGIN], "carrier_origin_depdelay_median_last1")):
            parts.append(([*keys, DATE], lags.next_day(lags.median_from(values, keys, name))))
        if hubs:
            parts.append(([DATE], lags.hub_median_wide(lags.median_from(values, [ORIGIN], "_m"), hubs)))
    return parts


def dest_parts(cube: DataFrame, values: DataFrame | None, config: Mapping[str, Any], windows: Sequence[int]) -> list[Part]:
    parts: list[Part] = []
    if enabled(config, "dest_rolling", True):
        daily = lags.from_cube(cube, [ORIGIN], {"_v": ("s_delay", "n_delay"), "_late": ("n_late_known", "n_delay")}, "n_delay")
        named = {"dest_depdelay_mean": "_v", "dest_lateaircraft_rate": "_late"}
        parts.append(([DEST, DATE], lags.row_lags(daily, [ORIGIN], named, windows).withColumnRenamed(ORIGIN, DEST)))
    if values is not None:
        med = lags.next_day(lags.median_from(values, [ORIGIN], "dest_depdelay_median_last1"))
        parts.append(([DEST, DATE], med.withColumnRenamed(ORIGIN, DEST)))
    return parts


# What the columns of a departure depend on; the finest grain is the row itself.
STATION, AT_DEST, OF_TAIL = [CARRIER, ORIGIN, DATE], [DEST, DATE], [TAIL, DATE]
HOUR, MINUTE = [ORIGIN, "_hour"], [ORIGIN, CARRIER, "_d", "_m"]
FLIGHT = [*lags.FLIGHT_OD, DATE, "_day", "_t"]
ROW = ["_row"]
GRAINS = [STATION, AT_DEST, OF_TAIL, HOUR, MINUTE, FLIGHT, ROW]
LEG = [*ROW, DATE, CARRIER, FLIGHT_NUM, TAIL, ORIGIN, DEST, "dep_dt_local", ordered.DEP, ordered.ARR]


def leg_columns(base: DataFrame, ties: Sequence[str]) -> DataFrame:
    """What follows from the order of an aircraft's and a flight number's legs, one row per row of ``base``.

    Only keys and times go through the windows; the result joins the wide table once, by its row.
    """
    legs = base.select(*LEG, *[t for t in ties if t not in LEG])
    legs = ordered.recent_arrival(ordered.tail_leg_number(legs, ties), ties)
    legs = ordered.hours_since_first(materialise(ordered.turn_time(legs, ties), "legs"))
    return ordered.tail_cascade(legs).drop(*[c for c in [*LEG, *ties] if c not in ROW])


def leg_columns_by_row(base: DataFrame, ties: Sequence[str], rows: int) -> DataFrame:
    """``leg_columns``, worked out for some flight numbers and then for some aircraft at a time, and stored by row."""
    legs = base.select(*LEG, *[t for t in ties if t not in LEG])
    turn, since = "turn_time_hours", "flightnum_hours_since_first_departure_today"
    by_number = (ordered.turn_time(ordered.hours_since_first(p(legs)), ties).select(*ROW, turn, since) for p in joins.cuts([CARRIER, FLIGHT_NUM], rows))
    numbers = materialise_rows(by_number, "numbers", "_row", rows)
    order, near = "tail_leg_num_day", "has_recent_arrival_turn_5h"
    day = ["tail_n_legs_scheduled", "tail_min_turn_time", "tail_has_tight_turn"]
    timed = joins.attach(legs, numbers.select(*ROW, turn), ROW)
    by_tail = (
        ordered.tail_cascade(ordered.recent_arrival(ordered.tail_leg_number(p(timed), ties), ties)).select(*ROW, order, near, *day)
        for p in joins.cuts([TAIL], rows)
    )
    return joins.attach(materialise_rows(by_tail, "tails", "_row", rows), numbers, ROW).select(*ROW, order, near, turn, since, *day)


def number_rows(fact: DataFrame) -> DataFrame:
    """The fact with ``_row``, stored by it."""
    return joins.numbered_rows(fact, [c for c in ROW_ID if c in fact.columns], "_row")


def first_rows(base: DataFrame, keys: Sequence[str], tie: str) -> DataFrame:
    """The row of each key that comes first by ``tie``, marked ``_first``; keys with an unknown part have none."""
    picked = base.na.drop(subset=list(keys)).groupBy(*keys).agg(F.min_by("_row", tie).alias("_row"))
    return picked.filter(F.col("_row").isNotNull()).select("_row", F.lit(True).alias("_first"))


def features(
    fact: DataFrame,
    hist: DataFrame,
    config: Mapping[str, Any],
    ties: Sequence[str] = ("CRSDepTime",),
    actions: DataFrame | None = None,
    hub_weather: tuple[DataFrame, Sequence[str], Sequence[str]] | None = None,
    reports: DataFrame | None = None,
    delays_flown_only: bool = True,
    thresholds: Sequence[int] = scoring.THRESHOLDS,
    first_of: Sequence[str] = (),
    by_row: bool = False,
) -> DataFrame:
    """The departure feature table.

    ``config`` is the feature block of a configuration, and ``ties`` orders flights that leave at the
    same minute. The history is read once into two small cubes per station and day, which are written
    down. Every family of columns names the keys it depends on; families of one grain are put together
    on its distinct values, and the fact is joined once per grain (``joins.attach_by_grain``). The base
    is written once with a number for each row, so that what is looked up starts from stored rows.

    With ``first_of`` only the first row (by the first of ``ties``) of each value of these keys is given
    out, after all rows have had their part in the statistics. It is found on keys and numbers alone.

    With ``by_row`` the base is stored in buckets of its row numbers, and so is every family of columns that
    is too large to be sent to it, so that no wide row is shuffled when they are put together. That suits a
    table of which all columns are read. A history that is the fact itself is then read from the base. The fact
    may come from ``number_rows``; then ``_row`` is given out as well.
    """
    windows = [int(w) for w in config.get("rolling_windows_days", lags.WINDOWS)]
    count = 0
    if by_row:
        # Only what is given is stored; what follows from it is worked out as it is read.
        base = with_clocks(base_columns(fact if "_row" in fact.columns else number_rows(fact), config))
        count = base.count()
        # Rows that come twice keep the order in which they were numbered.
        ties = [*ties, "_row"]
    else:
        base = materialise(with_clocks(base_columns(fact, config)).withColumn("_row", F.monotonically_increasing_id()), "base")
    if by_row and hist is fact:
        hist = base
    else:
        hist = norm_keys(hist, [CARRIER, ORIGIN, DEST], [DATE]).withColumn(FLIGHT_NUM, key_int(FLIGHT_NUM))
        if TAIL in hist.columns:
            hist = hist.withColumn(TAIL, clean_tail(TAIL))
    held = flown() if delays_flown_only and "Cancelled" in hist.columns else F.lit(True)
    delays = hist.filter(held)
    steps: list[joins.Step] = []
    tails = enabled(config, "tail_history") and TAIL in base.columns
    rows = None
    if tails:
        rows = leg_columns_by_row(base, ties, count) if by_row else leg_columns(base, ties)
    if first_of:
        first = first_rows(base, first_of, ties[0])
        rows = first if rows is None else joins.attach(rows, first, ROW)
    if rows is not None:
        steps.append(joins.Step(ROW, rows))
    if reports is not None and "_hour" in base.columns:
        steps.append(joins.Step(HOUR, materialise(joins.hourly_visibility(reports), "hours")))
    if by_row:
        minutes = materialise(congestion.minute_counts(base), "minutes")
        flights = minutes if hist is base else materialise(congestion.minute_counts(hist.withColumns(congestion.local_minute())), "minutes")
        counts = materialise(congestion.departure_counts(minutes, flights), "counts")
    else:
        counts = congestion.departure_counts(base, hist)
    steps.append(joins.Step(MINUTE, counts))
    low = int(config.get("low_support_leq", 2))
    of_rows = history.history_of_rows if by_row else history.with_history
    steps.append(joins.Step(FLIGHT, lambda asked, past: of_rows(asked, past, windows, low), delays, history.KEYS))
    cube = materialise(lags.station_cube(hist, held), "cube")
    values = materialise(lags.value_cube(delays), "values") if enabled(config, "delay_median_last1") else None
    for on, part in [*station_parts(cube, values, config, windows), *dest_parts(cube, values, config, windows)]:
        steps.append(joins.Step(on, part))
    if enabled(config, "otp_rate_last14d"):
        steps.append(joins.Step([*lags.FLIGHT_OD, DATE], lags.otp_stats(hist), cut=lags.FLIGHT_OD))
    if actions is not None and enabled(config, "strike"):
        steps.append(joins.Step([CARRIER, DATE], lambda asked: act.days_to_action(asked, actions)))
    if tails and TAIL in hist.columns:
        steps.append(joins.Step(OF_TAIL, lags.tail_stats(delays, windows), cut=[TAIL]))
    inbound = enabled(config, "prior_leg") and TAIL in hist.columns
    if inbound:
        order = [t for t in ties if t in hist.columns]
        if by_row:
            parts = [materialise(ordered.prior_leg_sums(p(delays), order), "prior") for p in joins.cuts([TAIL], count)]
            sums = reduce(DataFrame.unionByName, parts)
        else:
            sums = ordered.prior_leg_sums(delays, order)
        prior = ordered.prior_leg_lags(sums, [w for w in windows if w > 1])
        steps.append(joins.Step([CARRIER, FLIGHT_NUM, ORIGIN, DATE], prior, cut=[CARRIER, FLIGHT_NUM, ORIGIN]))
    if hub_weather is not None:
        steps.append(joins.Step([DATE], lags.hub_weather_days(*hub_weather)))
    out = joins.attach_by_grain(base, GRAINS, steps, base, "_row" if by_row else None)
    out = out.withColumns(congestion.other_departures()).drop("_all", "_mine")
    if inbound:
        out = out.withColumn("is_first_leg_of_day", ordered.first_leg(out))
    if first_of:
        out = out.filter("_first").drop("_first")
    out = out.drop(*({"_row"} - set(fact.columns)), "_hour", "_d", "_m", "_day", "_t")
    return out.withColumns(
        {
            "hub_max_lateaircraft_last1": row_max(out, r"hub_.*_lateaircraft_rate_last1"),
            **scoring.departure_labels(F.col("DepDelayMinutes"), thresholds),
        }
    )


def holdout(df: DataFrame, config: Mapping[str, Any], ids: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(training pool, holdout) by random share or by last days."""
    block = config.get("eval") or {}
    if not block.get("enabled", True):
        return df, None
    if block.get("by", "last_days") == "random":
        marked = sampling.split_random(df, float(block.get("eval_frac", 0.15)), ids, int(block.get("seed", 42)))
        return marked.filter("not is_eval").drop("is_eval"), marked.filter("is_eval").drop("is_eval")
    days = int(block.get("last_days", 0))
    return sampling.split_last_days(df, days) if days > 0 else (df, None)


def write_training_sets(stored: DataFrame, config: Mapping[str, Any], label: str, ids: Sequence[str]) -> None:
    """Holdout and one balanced set per threshold, from the stored feature table."""
    block = config.get("feature_balance") or {}
    if not block.get("output_template"):
        return
    pool, held = holdout(stored, block, ids)
    if held is not None and (block.get("eval") or {}).get("output_path"):
        sinks.write_stage(held, block["eval"]["output_path"])
    for thr in block.get("thresholds", scoring.THRESHOLDS):
        picked = sampling.balance(
            pool,
            label.format(thr=thr),
            float(block.get("pos_frac", 0.5)),
            ids,
            int(block.get("seed", 42)),
            block.get("max_rows"),
        )
        sinks.write_stage(picked, block["output_template"], thr=thr)


def run(spark: SparkSession, config: Mapping[str, Any]) -> str:
    """Features, statistics and training sets from the stored enriched fact and history pool."""
    fact = spark.read.parquet(config["output_enriched_unbalanced_path"])
    fact = fact.filter(between_days(DATE, config.get("start_date"), config.get("end_date")))
    hist = spark.read.parquet(config["history_output_path"])
    block = config.get("features_dep") or {}
    actions = None
    if enabled(block, "strike") and option(block, "strike", "cache_path", None):
        actions = spark.read.parquet(block["strike"]["cache_path"])
    thresholds = [int(t) for t in option(config, "balance", "thresholds", scoring.THRESHOLDS)]
    path = sinks.write_stage(
        features(fact, hist, block, actions=actions, thresholds=thresholds, by_row=True), config["output_features_unbalanced_path"]
    )
    # Sampling scans its input several times: it starts from the stored table, not from the plan.
    stored = spark.read.parquet(path)
    numeric = [n for n, t in stored.dtypes if t in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    sinks.write_report(sinks.json_safe(stats.numeric_stats(stored, numeric)), f"{path}_stats")
    write_training_sets(stored, config, "y_dep_ge{thr}", ROW_ID)
    return path
