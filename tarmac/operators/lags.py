"""Statistics of earlier days, attached to a fact.

Four readings of "the last w days" live side by side and are kept apart by name:

* ``row_lags``: the w earlier days on which the key has a row; gaps do not count.
* ``spine_lags``: w earlier rows of a date spine shared by several series.
* ``next_day``: exactly yesterday.
* ``range_stats``: the calendar days ``[d - w, d - 1]``.

All of them aggregate to one row per key and day first, so a window holds days, never flights.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import day_number, flown, hhmm_minutes, num, time_block, wrap_diff
from ..session import materialise
from .daily import daily_agg, daily_mean, daily_median, daily_rate, late_aircraft
from .joins import Step, attach, attach_asof_parts, attach_by_grain, attach_through

DATE = "FlightDate"
WINDOWS = (1, 7, 14)
CARRIER, ORIGIN, DEST = "Reporting_Airline", "Origin", "Dest"
FLIGHT_NUM, TAIL = "Flight_Number_Reporting_Airline", "Tail_Number"
FLIGHT_OD = [CARRIER, FLIGHT_NUM, ORIGIN, DEST]
CARRIER_OD = [CARRIER, ORIGIN, DEST]


def _before(keys: Sequence[str], w: int, date: str = DATE):
    return Window.partitionBy(*keys).orderBy(date).rowsBetween(-w, -1)


def row_mean(value: str, keys: Sequence[str], w: int, least: int = 1) -> Column:
    frame = _before(keys, w)
    return F.when(F.count(value).over(frame) >= least, F.avg(value).over(frame))


def row_std(value: str, keys: Sequence[str], w: int, least: int = 2) -> Column:
    frame = _before(keys, w)
    return F.when(F.count(value).over(frame) >= least, F.stddev_samp(value).over(frame))


def row_lags(
    daily: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, str],
    windows: Sequence[int] = WINDOWS,
    stds: Mapping[str, str] | None = None,
    suffix: str = "",
) -> DataFrame:
    """Rolling mean (and sample deviation, for w > 1) over the previous w observed days.

    ``means`` and ``stds`` map an output prefix to a column of ``daily``.
    """
    out = [row_mean(v, keys, w).alias(f"{p}_last{w}{suffix}") for p, v in means.items() for w in windows]
    out += [
        row_std(v, keys, w).alias(f"{p}_last{w}{suffix}")
        for p, v in (stds or {}).items()
        for w in windows
        if w > 1
    ]
    return daily.select(*keys, DATE, *out)


def next_day(daily: DataFrame) -> DataFrame:
    """The statistic of a day, dated to the day after it."""
    return daily.withColumn(DATE, F.date_add(DATE, 1))


# --- rolling delay statistics over observed days ------------------------------------------------


def _delay_lags(hist: DataFrame, keys: Sequence[str], prefix: str, windows: Sequence[int]) -> DataFrame:
    daily = daily_mean(hist, keys, "DepDelayMinutes", "_v")
    return row_lags(daily, keys, {f"{prefix}_mean": "_v"}, windows, {f"{prefix}_std": "_v"})


def carrier_stats(hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    return _delay_lags(hist, [CARRIER], "carrier_depdelay", windows)


def carrier_origin_stats(hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    return _delay_lags(hist, [CARRIER, ORIGIN], "carrier_origin_depdelay", windows)


def carrier_baselines(fact: DataFrame, hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Carrier and carrier-at-origin means and deviations."""
    cube = station_cube(hist)

    def part(keys: list[str], prefix: str) -> tuple[list[str], DataFrame]:
        daily = from_cube(cube, keys, {"_v": ("s_delay", "n_delay")}, "n_delay")
        return [*keys, DATE], row_lags(daily, keys, {f"{prefix}_mean": "_v"}, windows, {f"{prefix}_std": "_v"})

    parts = [part([CARRIER], "carrier_depdelay"), part([CARRIER, ORIGIN], "carrier_origin_depdelay")]
    return attach_through(fact, [CARRIER, ORIGIN, DATE], parts)


def origin_stats(hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    return _delay_lags(hist, [ORIGIN], "origin_depdelay", windows)


def origin_baselines(fact: DataFrame, hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    return attach(fact, origin_stats(hist, windows), [ORIGIN, DATE])


def _delay_and_late_daily(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = hist.filter(num("DepDelayMinutes").isNotNull())
    measures = {"_v": F.avg(num("DepDelayMinutes"))}
    if "LateAircraftDelay" in hist.columns:
        measures["_late"] = F.avg(late_aircraft().cast("double"))
    else:
        measures["_late"] = F.max(F.lit(None).cast("double"))
    return daily_agg(known, keys, measures)


def tail_stats(hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    known = hist.filter(F.col(TAIL).isNotNull())
    daily = _delay_and_late_daily(known, [TAIL])
    return row_lags(daily, [TAIL], {"tail_depdelay_mean": "_v", "tail_lateaircraft_rate": "_late"}, windows)


def tail_history(fact: DataFrame, hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Tail means; tail numbers must already be cleaned, with NULL for unknown."""
    return attach(fact, tail_stats(hist, windows), [TAIL, DATE])


def dest_stats(hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    daily = _delay_and_late_daily(hist, [ORIGIN])
    named = {"dest_depdelay_mean": "_v", "dest_lateaircraft_rate": "_late"}
    return row_lags(daily, [ORIGIN], named, windows).withColumnRenamed(ORIGIN, DEST)


def dest_rolling(fact: DataFrame, hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """How departures from the destination airport have been running."""
    return attach(fact, dest_stats(hist, windows), [DEST, DATE])


def cause_rate_stats(hist: DataFrame, windows: Sequence[int] = WINDOWS) -> tuple[DataFrame, DataFrame]:
    """Origin rates (NAS, late aircraft, weather) and carrier rate (late aircraft)."""
    flags = {
        "_nas": F.coalesce(num("NASDelay"), F.lit(0.0)) > 0,
        "_late": late_aircraft(),
        "_wx": F.coalesce(num("WeatherDelay"), F.lit(0.0)) > 0,
    }
    rates = {k: F.avg(v.cast("double")) for k, v in flags.items()}
    at_origin = row_lags(
        daily_agg(hist, [ORIGIN], rates),
        [ORIGIN],
        {
            "origin_nas_rate": "_nas",
            "origin_lateaircraft_rate": "_late",
            "origin_weather_rate": "_wx",
        },
        windows,
    )
    by_carrier = row_lags(
        daily_agg(hist, [CARRIER], {"_late": rates["_late"]}),
        [CARRIER],
        {"carrier_lateaircraft_rate": "_late"},
        windows,
    )
    return at_origin, by_carrier


def cause_rates(fact: DataFrame, hist: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    at_origin, by_carrier = cause_rate_stats(hist, windows)
    parts = [([ORIGIN, DATE], at_origin), ([CARRIER, DATE], by_carrier)]
    return attach_through(fact, [CARRIER, ORIGIN, DATE], parts)


# --- one pass over the history ------------------------------------------------------------------


def station_cube(hist: DataFrame, delays_from: Column | None = None) -> DataFrame:
    """Counts and sums per carrier, origin and day, from which coarser daily statistics follow.

    ``delays_from`` marks the rows that feed delay statistics (flown ones, as a rule); rates of
    cancelled and diverted flights use every row. A statistic over millions of flights then starts
    from a few rows per station and day, and the history is read once for all of them.
    """
    held = delays_from if delays_from is not None else F.lit(True)
    delay = F.when(held, num("DepDelayMinutes"))

    def n(cond: Column, among: Column = F.lit(True)) -> Column:
        return F.sum((F.coalesce(cond, F.lit(False)) & among).cast("bigint"))

    def flag(c: str) -> Column:
        return num(c) > 0 if c in hist.columns else F.lit(False)

    late = late_aircraft() if "LateAircraftDelay" in hist.columns else F.lit(False)
    cancelled = F.coalesce(num("Cancelled"), F.lit(0.0)) if "Cancelled" in hist.columns else F.lit(0.0)
    measures = {
        "n_all": F.count(F.lit(1)),
        "n_held": n(held),
        "n_delay": F.count(delay),
        "s_delay": F.coalesce(F.sum(delay), F.lit(0.0)),
        "n_nas": n(flag("NASDelay"), held),
        "n_late": n(late, held),
        "n_late_known": n(late, delay.isNotNull()),
        "n_weather": n(flag("WeatherDelay"), held),
        "n_nas_all": n(flag("NASDelay")),
        "n_carrier_all": n(flag("CarrierDelay")),
        "s_cancelled": F.sum(cancelled),
        "n_cancelled": n(cancelled != 0),
        "n_diverted": n(flag("Diverted")),
    }
    dated = hist.filter(F.col(DATE).isNotNull())
    return dated.groupBy(CARRIER, ORIGIN, DATE).agg(*[e.alias(n_) for n_, e in measures.items()])


def from_cube(cube: DataFrame, keys: Sequence[str], ratios: Mapping[str, tuple[str, str]], require: str | None = None) -> DataFrame:
    """Daily ratios of two sums at a coarser key; days without any ``require`` have no row."""
    cols = {c for pair in ratios.values() for c in pair} | ({require} if require else set())
    sums = cube.na.drop(subset=list(keys)).groupBy(*keys, DATE).agg(*[F.sum(c).alias(c) for c in sorted(cols)])
    if require:
        sums = sums.filter(F.col(require) > 0)
    return sums.select(
        *keys, DATE, *[(F.col(a) / F.nullif(b, F.lit(0))).alias(out) for out, (a, b) in ratios.items()]
    )


@dataclass(frozen=True)
class Lag:
    """One daily ratio of a cube's sums and what is wanted of its earlier days.

    Only days whose ``counts_if`` sum is positive count as observed. ``score`` names a column and a
    function of the key columns and the ratio's name (``cancel_z``, ``carrier_z``).
    """

    prefix: str
    top: str
    bottom: str
    counts_if: str
    windows: Sequence[int] = ()
    std: str | None = None
    suffix: str = ""
    score: tuple[str, Callable[[str, Sequence[str]], Column]] | None = None


def cube_lags(cube: DataFrame, keys: Sequence[str], measures: Sequence[Lag]) -> DataFrame:
    """Rolling statistics of many measures, one row per key and day, from one shuffle of the cube.

    Measures are observed on days of their own. The observed days of a measure are numbered, and its
    frames run over those numbers, so that all measures share one table of days and one partitioning;
    on a day that isn't observed a measure is NULL.
    """
    sums = sorted({c for m in measures for c in (m.top, m.bottom, m.counts_if)})
    # Partitioned by the key alone, which serves the sums per day and all windows.
    days = cube.na.drop(subset=list(keys)).repartition(*keys).groupBy(*keys, DATE).agg(*[F.sum(c).alias(c) for c in sums])
    so_far = Window.partitionBy(*keys).orderBy(DATE).rowsBetween(Window.unboundedPreceding, 0)
    numbers = {c: F.count(F.when(F.col(c) > 0, 1)).over(so_far).alias(f"_at_{c}") for c in {m.counts_if for m in measures}}
    values = [
        F.when(F.col(m.counts_if) > 0, F.col(m.top) / F.nullif(m.bottom, F.lit(0))).alias(f"_v{i}") for i, m in enumerate(measures)
    ]
    days = days.select(*keys, DATE, *sorted({m.counts_if for m in measures}), *[numbers[c] for c in sorted(numbers)], *values)
    out = []
    for i, m in enumerate(measures):
        seen = F.col(m.counts_if) > 0
        for w in m.windows:
            frame = Window.partitionBy(*keys).orderBy(f"_at_{m.counts_if}").rangeBetween(-w, -1)
            out.append(F.when(seen, F.avg(f"_v{i}").over(frame)).alias(f"{m.prefix}_last{w}{m.suffix}"))
            if m.std and w > 1:
                spread = F.when(F.count(f"_v{i}").over(frame) >= 2, F.stddev_samp(f"_v{i}").over(frame))
                out.append(F.when(seen, spread).alias(f"{m.std}_last{w}{m.suffix}"))
        if m.score:
            name, made = m.score
            out.append(made(f"_v{i}", keys).alias(name))
    return days.select(*keys, DATE, *out)


def value_cube(hist: DataFrame) -> DataFrame:
    """Flights per carrier, origin, day and distinct delay, from which every median follows."""
    known = hist.withColumn("_x", num("DepDelayMinutes")).na.drop(subset=[DATE, "_x"])
    return known.groupBy(CARRIER, ORIGIN, DATE, "_x").agg(F.count(F.lit(1)).alias("_n"))


def median_from(values: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    known = values.na.drop(subset=list(keys))
    return known.groupBy(*keys, DATE).agg(F.expr("percentile(_x, 0.5, _n)").alias(out))


# --- hubs: rows of a shared date spine ----------------------------------------------------------


def hub_stats(
    hist: DataFrame, hubs: Sequence[str], windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """One row per date seen at any hub, with ``hub_{i}_*`` columns for each hub.

    A hub without flights on a spine date has no value there, but the date still counts in w.
    """
    at_hub = hist.filter(F.col(ORIGIN).isin(list(hubs)))
    daily = daily_agg(
        at_hub,
        [ORIGIN],
        {"_v": F.avg(num("DepDelayMinutes")), "_late": F.avg(late_aircraft().cast("double"))},
    )
    return hub_lags(daily, hubs, windows)


def hub_lags(daily: DataFrame, hubs: Sequence[str], windows: Sequence[int] = WINDOWS) -> DataFrame:
    """The same from a daily table with ``_v`` and ``_late`` per origin."""
    wide = hub_wide(daily.filter(F.col(ORIGIN).isin(list(hubs))), hubs, ["_v", "_late"])
    frames = {w: Window.partitionBy(F.lit(0)).orderBy(DATE).rowsBetween(-w, -1) for w in windows}
    out = []
    for i in range(len(hubs)):
        for w in windows:
            out.append(F.avg(f"_v_{i}").over(frames[w]).alias(f"hub_{i}_depdelay_mean_last{w}"))
            out.append(F.avg(f"_late_{i}").over(frames[w]).alias(f"hub_{i}_lateaircraft_rate_last{w}"))
    return wide.select(DATE, *out)


def hub_wide(daily: DataFrame, hubs: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A hub series pivoted by hub number: one row per date, columns ``{value}_{i}``."""
    picks = [
        F.max(F.when(F.col(ORIGIN) == hub, F.col(v))).alias(f"{v}_{i}")
        for v in values
        for i, hub in enumerate(hubs)
    ]
    return daily.groupBy(DATE).agg(*picks)


def hub_spillover(
    fact: DataFrame, hist: DataFrame, hubs: Sequence[str], windows: Sequence[int] = WINDOWS
) -> DataFrame:
    return attach(fact, hub_stats(hist, hubs, windows), [DATE])


def hub_medians(hist: DataFrame, hubs: Sequence[str]) -> DataFrame:
    """Yesterday's flight-level median of every hub, one row per date."""
    at_hub = hist.filter(F.col(ORIGIN).isin(list(hubs)))
    return hub_median_wide(daily_median(at_hub, [ORIGIN], "DepDelayMinutes", "_m"), hubs)


def hub_median_wide(daily: DataFrame, hubs: Sequence[str]) -> DataFrame:
    wide = hub_wide(next_day(daily.filter(F.col(ORIGIN).isin(list(hubs)))), hubs, ["_m"])
    return wide.select(
        DATE, *[F.col(f"_m_{i}").alias(f"hub_{i}_depdelay_median_last1") for i in range(len(hubs))]
    )


def hub_weather_days(weather: DataFrame, hubs: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Weather at each hub today and yesterday, on a gap-free range of days, one row per day.

    ``weather`` holds one row per ``airport`` and ``FlightDate``. A day missing from the range gives
    NULL for both, as yesterday is the calendar day before.
    """
    at_hub = weather.filter(F.col("airport").isin(list(hubs)))
    span = at_hub.groupBy("airport").agg(F.min(DATE).alias("_a"), F.max(DATE).alias("_b"))
    spine = span.select("airport", F.explode(F.sequence("_a", "_b")).alias(DATE))
    known = at_hub.select("airport", DATE, *variables)
    today = spine.join(known, ["airport", DATE], "left")
    prior = Window.partitionBy("airport").orderBy(DATE)
    both = today.select(
        "airport",
        DATE,
        *[F.col(v).alias(f"{v}_today") for v in variables],
        *[F.lag(v).over(prior).alias(f"{v}_yesterday") for v in variables],
    )
    picks = [
        F.max(F.when(F.col("airport") == hub, F.col(f"{v}_{when}"))).alias(f"hub_{hub}_{v}_{when}")
        for hub in hubs
        for v in variables
        for when in ("today", "yesterday")
    ]
    return both.groupBy(DATE).agg(*picks)


def hub_weather(fact: DataFrame, weather: DataFrame, hubs: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """``hub_weather_days`` on the fact's day, through the fact's distinct days."""
    days = hub_weather_days(weather, hubs, variables)
    return attach_through(fact, [DATE], [([DATE], days)])


# --- exactly yesterday --------------------------------------------------------------------------


def median_last1(fact: DataFrame, hist: DataFrame, hubs: Sequence[str] = ()) -> DataFrame:
    """Yesterday's flight-level medians for the carrier, carrier at origin, destination and hubs."""
    values = value_cube(hist)

    def yesterday(keys: list[str], name: str) -> DataFrame:
        return next_day(median_from(values, keys, name))

    at_dest = yesterday([ORIGIN], "dest_depdelay_median_last1").withColumnRenamed(ORIGIN, DEST)
    parts = [
        ([CARRIER, DATE], yesterday([CARRIER], "carrier_depdelay_median_last1")),
        ([CARRIER, ORIGIN, DATE], yesterday([CARRIER, ORIGIN], "carrier_origin_depdelay_median_last1")),
    ]
    if hubs:
        parts.append(([DATE], hub_median_wide(median_from(values, [ORIGIN], "_m"), hubs)))
    return attach(attach_through(fact, [CARRIER, ORIGIN, DATE], parts), at_dest, [DEST, DATE])


def nas_rate_last1d(hist: DataFrame) -> DataFrame:
    held = F.coalesce(num("NASDelay") > 0, F.lit(False))
    return next_day(daily_rate(hist, [ORIGIN], held, "origin_nasdelay_rate_last1d"))


def cancel_rate_last1d(hist: DataFrame) -> DataFrame:
    return next_day(daily_rate(hist, [ORIGIN], ~flown(), "cancel_rate_origin_last1d"))


def prior_day_rates(fact: DataFrame, hist: DataFrame) -> DataFrame:
    """Yesterday's NAS-delay and cancellation rates at the origin."""
    parts = [([ORIGIN, DATE], nas_rate_last1d(hist)), ([ORIGIN, DATE], cancel_rate_last1d(hist))]
    return attach_through(fact, [ORIGIN, DATE], parts)


def divert_stats(hist: DataFrame, w: int = 14) -> DataFrame:
    daily = daily_rate(hist, [ORIGIN], F.coalesce(num("Diverted"), F.lit(0.0)) > 0, "_r")
    return row_lags(daily, [ORIGIN], {"divert_rate_origin": "_r"}, [w], suffix="d")


def divert_rate(fact: DataFrame, hist: DataFrame, w: int = 14) -> DataFrame:
    return attach(fact, divert_stats(hist, w), [ORIGIN, DATE])


# --- z-scores -----------------------------------------------------------------------------------


def cancel_anomaly_stats(hist: DataFrame) -> DataFrame:
    return cancel_score(daily_agg(hist, [CARRIER], {"_r": F.avg(F.coalesce(num("Cancelled"), F.lit(0.0)))}))


def cancel_z(rate: str, keys: Sequence[str]) -> Column:
    """Mean rate of 7 days against 60, in deviations; every day of the key counts."""
    return (row_mean(rate, keys, 7) - row_mean(rate, keys, 60, 7)) / F.nullif(row_std(rate, keys, 60, 7), F.lit(0.0))


def cancel_score(daily: DataFrame) -> DataFrame:
    return daily.select(CARRIER, DATE, cancel_z("_r", [CARRIER]).alias("airline_cancel_rate_anomaly_7d"))


def cancel_anomaly(fact: DataFrame, hist: DataFrame) -> DataFrame:
    """Carrier cancellation rate of 7 days against 60, in deviations; no spread gives NULL."""
    return attach(fact, cancel_anomaly_stats(hist), [CARRIER, DATE])


def carrier_anomaly_stats(hist: DataFrame) -> DataFrame:
    held = F.coalesce(num("CarrierDelay"), F.lit(0.0)) > 0
    return carrier_score(daily_rate(hist, [CARRIER], held, "_r"))


def carrier_z(rate: str, keys: Sequence[str]) -> Column:
    """The same with the deviation floored at 0.01 and more days asked for."""
    spread = row_std(rate, keys, 60, 14)
    floored = F.when(spread.isNotNull(), F.greatest(spread, F.lit(0.01)))
    return (row_mean(rate, keys, 7, 3) - row_mean(rate, keys, 60, 14)) / floored


def carrier_score(daily: DataFrame) -> DataFrame:
    return daily.select(CARRIER, DATE, carrier_z("_r", [CARRIER]).alias("carrier_delay_rate_anomaly_7d"))


def carrier_anomaly(fact: DataFrame, hist: DataFrame) -> DataFrame:
    """Carrier-delay rate of 7 days against 60, with the deviation floored at 0.01."""
    return attach(fact, carrier_anomaly_stats(hist), [CARRIER, DATE])


# --- calendar ranges ----------------------------------------------------------------------------


def _range(keys: Sequence[str], days: int):
    return Window.partitionBy(*keys).orderBy("_day").rangeBetween(-days, -1)


def otp_stats(hist: DataFrame, days: int = 14, late_after: float = 15.0) -> DataFrame:
    """Share of flights on time in ``[d - 14, d - 1]``, each flight weighing the same."""
    kept = hist.filter(flown()) if "Cancelled" in hist.columns else hist
    kept = kept.filter(num("DepDelayMinutes").isNotNull()).na.drop(subset=FLIGHT_OD)
    daily = daily_agg(
        kept,
        FLIGHT_OD,
        {"_n": F.count(F.lit(1)), "_ok": F.sum((num("DepDelayMinutes") <= late_after).cast("double"))},
    ).withColumn("_day", day_number(DATE))
    frame = _range(FLIGHT_OD, days)
    rate = F.sum("_ok").over(frame) / F.sum("_n").over(frame)
    return daily.select(*FLIGHT_OD, DATE, rate.alias(f"flightnum_od_otp_rate_last{days}d"))


def otp_rate(fact: DataFrame, hist: DataFrame, days: int = 14) -> DataFrame:
    return attach(fact, otp_stats(hist, days), [*FLIGHT_OD, DATE])


def range_stats(
    hist: DataFrame,
    keys: Sequence[str],
    value: str,
    means: Mapping[int, tuple[str, str]],
    medians: Mapping[int, str] | None = None,
) -> DataFrame:
    """Mean, count and median over ``[d - w, d - 1]``, one row per key and history day.

    ``means`` maps a number of days to the names of the mean and the count, ``medians`` to a name.
    Several rows on one day see the same earlier days.
    """
    known = (
        hist.filter(num(value).isNotNull() & F.col(DATE).isNotNull())
        .na.drop(subset=list(keys))
        .withColumns({"_x": num(value), "_day": day_number(DATE)})
    )
    at_day = [*keys, DATE, "_day"]
    if medians:
        # One row per key, day and distinct value: the frames hold values, not flights. Mean, count
        # and median come from one window, whose partitioning also serves the last step.
        rows = known.groupBy(*at_day, "_x").agg(F.count(F.lit(1)).alias("_n"))
        total = F.col("_n") * F.col("_x")
    else:
        rows = known.groupBy(*at_day).agg(F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_s"))
        total = F.col("_s")
    out = {}
    for w, (mean, count) in means.items():
        frame = _range(keys, w)
        n = F.sum("_n").over(frame)
        out[mean], out[count] = F.sum(total).over(frame) / n, F.coalesce(n, F.lit(0))
    for w, name in (medians or {}).items():
        out[name] = F.expr("percentile(_x, 0.5, _n)").over(_range(keys, w))
    stats = rows.select(*keys, DATE, *[e.alias(n) for n, e in out.items()])
    return stats.groupBy(*keys, DATE).agg(*[F.max(n).alias(n) for n in out]) if medians else stats


Parts = list[tuple[list[str], DataFrame]]


def route_arrival_parts(
    hist: DataFrame, mean_windows: Sequence[int] = (7, 14), median_windows: Sequence[int] = (7,)
) -> Parts:
    return [
        (
            keys,
            range_stats(
                hist,
                keys,
                "ArrDelayMinutes",
                {w: (f"arrdelay_mean_{w}d_{tag}", f"arrdelay_n_{w}d_{tag}") for w in mean_windows},
                {w: f"arrdelay_median_{w}d_{tag}" for w in median_windows},
            ),
        )
        for keys, tag in ((FLIGHT_OD, "fn_od"), (CARRIER_OD, "car_od"))
    ]


def route_arrival_stats(
    fact: DataFrame,
    hist: DataFrame,
    mean_windows: Sequence[int] = (7, 14),
    median_windows: Sequence[int] = (7,),
) -> DataFrame:
    """Arrival delay of the flight number and of the carrier on the route, carried forward."""
    return attach_asof_parts(fact, route_arrival_parts(hist, mean_windows, median_windows))


def elapsed_ratio_parts(hist: DataFrame, days: int = 14) -> Parts:
    ratio = num("ActualElapsedTime") / F.nullif(num("CRSElapsedTime"), F.lit(0.0))
    names = {days: (f"elapsed_time_ratio_last{days}d", f"elapsed_time_ratio_n_last{days}d")}
    return [(FLIGHT_OD, range_stats(hist.withColumn("_ratio", ratio), FLIGHT_OD, "_ratio", names))]


def elapsed_ratio_stats(fact: DataFrame, hist: DataFrame, days: int = 14) -> DataFrame:
    """Actual over scheduled elapsed time of the flight number on the route."""
    return attach_asof_parts(fact, elapsed_ratio_parts(hist, days))


def airtime_parts(hist: DataFrame, windows: Sequence[int] = (7, 14)) -> Parts:
    return [
        (keys, range_stats(hist, keys, "AirTime", {w: (f"airtime_mean_{w}d_{tag}", f"airtime_n_{w}d_{tag}") for w in windows}))
        for keys, tag in ((FLIGHT_OD, "fn_od"), (CARRIER_OD, "car_od"))
    ]


def airtime_stats(fact: DataFrame, hist: DataFrame, windows: Sequence[int] = (7, 14)) -> DataFrame:
    return attach_asof_parts(fact, airtime_parts(hist, windows))


def with_time_block(df: DataFrame) -> DataFrame:
    return df if "DepTimeBlk" in df.columns else df.withColumn("DepTimeBlk", time_block("CRSDepTime"))


def wheels_off_slip_parts(hist: DataFrame, windows: Sequence[int] = (7, 14)) -> Parts:
    slip = wrap_diff(hhmm_minutes("WheelsOff"), hhmm_minutes("CRSDepTime"))
    slipped = with_time_block(hist).withColumn("_slip", slip)
    return [
        (
            keys,
            range_stats(slipped, keys, "_slip", {w: (f"wo_slip_mean_{w}d_{tag}", f"wo_slip_n_{w}d_{tag}") for w in windows}),
        )
        for keys, tag in ((FLIGHT_OD, "fn_od"), ([ORIGIN, "DepTimeBlk"], "origin_blk"))
    ]


def wheels_off_slip_stats(fact: DataFrame, hist: DataFrame, windows: Sequence[int] = (7, 14)) -> DataFrame:
    """Minutes from scheduled departure to wheels off, per flight number and per origin hour block."""
    return attach_asof_parts(with_time_block(fact), wheels_off_slip_parts(hist, windows))


# --- trial features -----------------------------------------------------------------------------


def trial_rolling(
    df: DataFrame, keys: Sequence[str], value: Column, prefix: str, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Rolling mean over observed days of any measure; a day without a value keeps its place."""
    daily = daily_agg(df, keys, {"_v": F.avg(value)})
    return row_lags(daily, keys, {prefix: "_v"}, windows, suffix="d")


def trial_cube(df: DataFrame) -> DataFrame:
    """Sums and known counts of the trial measures per carrier, route and day; one pass over the flights."""

    def late(c: str) -> Column:
        return (F.coalesce(num(c), F.lit(0.0)) > 0).cast("double")

    values = {
        "taxi_out": (["TaxiOut"], lambda: num("TaxiOut")),
        "taxi_in": (["TaxiIn"], lambda: num("TaxiIn")),
        "cancelled": (["Cancelled"], lambda: num("Cancelled")),
        "diverted": (["Diverted"], lambda: num("Diverted")),
        "ratio": (["ActualElapsedTime", "CRSElapsedTime"], lambda: num("ActualElapsedTime") / F.nullif(num("CRSElapsedTime"), F.lit(0.0))),
        "weather": (["WeatherDelay"], lambda: late("WeatherDelay")),
        "nas": (["NASDelay"], lambda: late("NASDelay")),
        "gate": (["TotalAddGTime"], lambda: F.coalesce(num("TotalAddGTime"), F.lit(0.0))),
    }
    sums = [F.count(F.lit(1)).alias("n_all")]
    for name, (needs, value) in values.items():
        if set(needs) <= set(df.columns):
            v = value()
            sums += [F.coalesce(F.sum(v), F.lit(0.0)).alias(f"s_{name}"), F.count(v).alias(f"n_{name}")]
    return df.filter(F.col(DATE).isNotNull()).groupBy(CARRIER, ORIGIN, DEST, DATE).agg(*sums)


_TRIAL = [
    ([ORIGIN], "taxi_out", "taxi_out_mean_origin", WINDOWS),
    ([DEST], "taxi_in", "taxi_in_mean_dest", WINDOWS),
    ([ORIGIN], "cancelled", "cancel_rate_origin", WINDOWS),
    ([CARRIER], "cancelled", "cancel_rate_carrier", (1, 7)),
    ([ORIGIN], "diverted", "divert_rate_origin", (7, 14)),
    ([ORIGIN, DEST], "ratio", "elapsed_time_ratio", (14,)),
    ([CARRIER], "weather", "carrier_wxdelay_rate", (1, 7)),
    ([ORIGIN], "nas", "origin_nasdelay_rate", (1, 7)),
    ([ORIGIN], "gate", "gate_hold_mean_origin", (1, 7)),
]


def trial_features(df: DataFrame) -> DataFrame:
    """The trial set: taxi times, cancel, divert, weather and NAS rates, elapsed ratio, gate hold.

    The flights are read into one cube per carrier, route and day. Every key set of it gives one table
    for all of its measures, and the fact is joined once, through its distinct routes and days. Days
    without a value keep their place.
    """
    cube = materialise(trial_cube(df), "trial")
    steps = []
    for keys in ([ORIGIN], [DEST], [CARRIER], [ORIGIN, DEST]):
        own = [Lag(p, f"s_{v}", f"n_{v}", "n_all", w, suffix="d") for k, v, p, w in _TRIAL if k == keys and f"n_{v}" in cube.columns]
        if own:
            steps.append(Step([*keys, DATE], cube_lags(cube, keys, own)))
    return attach_by_grain(df, [[CARRIER, ORIGIN, DEST, DATE]], steps, cube)


def signal_variants(fact: DataFrame, hist: DataFrame, late_from: float = 15.0) -> DataFrame:
    """Readings compared in the signal study, on the fact.

    Late-aircraft rates of yesterday at a threshold, on-time share from unweighted daily means, and the
    cancellation z-score dated one more day later. All come from one cube per flight number, route and
    day, and reach the fact in one join.
    """
    late = (F.coalesce(num("LateAircraftDelay"), F.lit(0.0)) >= late_from).cast("bigint")
    known = flown() & num("DepDelayMinutes").isNotNull()
    cube = hist.filter(F.col(DATE).isNotNull()).groupBy(*FLIGHT_OD, DATE).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.sum(late).alias("n_late"),
        F.coalesce(F.sum(F.coalesce(num("Cancelled"), F.lit(0.0))), F.lit(0.0)).alias("s_cancelled"),
        F.count(F.when(known, 1)).alias("n_known"),
        F.count(F.when(known & (num("DepDelayMinutes") <= 15), 1)).alias("n_ontime"),
    )
    cube = materialise(cube, "signals")
    z = Lag("", "s_cancelled", "n_all", "n_all", score=("airline_cancel_rate_anomaly_7d", cancel_z))
    ontime = Lag("otp_rate_unweighted", "n_ontime", "n_known", "n_known", [14])
    steps = [
        Step([ORIGIN, DATE], next_day(from_cube(cube, [ORIGIN], {"origin_la_rate": ("n_late", "n_all")}))),
        Step([CARRIER, DATE], next_day(from_cube(cube, [CARRIER], {"carrier_la_rate": ("n_late", "n_all")}))),
        Step([*FLIGHT_OD, DATE], cube_lags(cube, FLIGHT_OD, [ontime])),
        Step([CARRIER, DATE], next_day(cube_lags(cube, [CARRIER], [z]))),
    ]
    return attach_by_grain(fact, [[*FLIGHT_OD, DATE]], steps)
