"""Checks of a feature table, as jobs that return findings.

A finding has ``check``, ``subject``, ``status`` (PASS, WARN, FAIL) and ``detail``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranks import long_form, quantiles
from .sets import column_report

FINDING = ["check", "subject", "status", "detail"]


@dataclass(frozen=True)
class Rule:
    """Type and range of one feature."""

    kind: str = "num"
    low: float = 0.0
    high: float = 1.0


# Features without a range.
CATEGORIES = [
    "FlightDate",
    "Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "Tail_Number",
    "od_pair",
    "Origin",
    "Dest",
    "DepTimeBlk",
    "origin_daily_weathercode",
    "origin_dep_hour_weathercode",
    "dep_dow",
    "sched_dep_hour",
    "sched_arr_hour",
    "is_holiday",
    "is_spring_break",
    "has_recent_arrival_turn_5h",
    "flight_month",
]
# Least and greatest value of each feature.
RANGES = {
    "DepDelayMinutes": (0, 5000),
    "ArrDelayMinutes": (0, 5000),
    "origin_temp_max_K": (180, 340),
    "origin_temp_min_K": (180, 340),
    "origin_daily_precip_sum_mm": (0, 500),
    "origin_daily_windspeed_max_kmh": (0, 400),
    "origin_daily_windgusts_max_kmh": (0, 500),
    "origin_dep_temp_K": (180, 340),
    "origin_dep_precip_mm": (0, 300),
    "origin_dep_windspeed_kmh": (0, 400),
    "origin_dep_windgusts_kmh": (0, 500),
    "origin_dep_visibility_m": (0, 100000),
    "origin_dep_cape_jkg": (0, 10000),
    "origin_dep_log1p_cape": (0, 15),
    "origin_dep_cloudcover_pct": (0, 100),
    "dest_arr_temperature_2m": (-60, 60),
    "dest_arr_precipitation": (0, 300),
    "dest_arr_windspeed_10m": (0, 400),
    "dest_arr_windgusts_10m": (0, 500),
    "dest_arr_visibility": (0, 100000),
    "dest_arr_cape": (0, 10000),
    "dest_arr_cloudcover": (0, 100),
    "flightnum_od_support_count_last14d": (0, 500),
    "flightnum_od_low_support_last14d": (0, 1),
    "flightnum_od_otp_rate_last14d": (0, 1),
    "origin_congestion_3h_total": (0, 1000),
    "origin_airline_congestion_3h_total": (0, 1000),
    "flightnum_hours_since_first_departure_today": (0, 24),
    "CRSDepTime": (0, 2400),
    "CRSArrTime": (0, 2400),
    "CRSElapsedTime": (-200, 1000),
    "Distance": (0, 6000),
    "dest_arrivals_pm60_sched": (0, 800),
    "dest_airline_arrivals_pm60_sched": (0, 800),
    "dest_arrivals_pm60_eta": (0, 800),
    "dest_airline_arrivals_pm60_eta": (0, 800),
    "is_peak_hour": (0, 1),
    "hub_max_lateaircraft_last1": (0, 1),
    "wind_x_precip": (0, 200000),
    "strike_severity": (0, 5),
    "days_to_strike": (0, 90),
    "carrier_delay_rate_anomaly_7d": (-10, 10),
    "airline_cancel_rate_anomaly_7d": (-10, 10),
    "origin_nasdelay_rate_last1d": (0, 1),
    "cancel_rate_origin_last1d": (0, 1),
    "divert_rate_origin_last14d": (0, 1),
    "elapsed_time_ratio_last14d": (0, 10),
    "elapsed_time_ratio_n_last14d": (0, 500),
    "origin_temperature_2m_max": (-500, 100000),
    "origin_temperature_2m_min": (-500, 100000),
    "origin_precipitation_sum": (-500, 100000),
    "origin_windspeed_10m_max": (-500, 100000),
    "origin_windgusts_10m_max": (-500, 100000),
    "origin_weathercode": (-500, 100000),
    "origin_dep_temperature_2m": (-500, 100000),
    "origin_dep_precipitation": (-500, 100000),
    "origin_dep_windspeed_10m": (-500, 100000),
    "origin_dep_weathercode": (-500, 100000),
    "origin_dep_windgusts_10m": (-500, 100000),
    "origin_dep_visibility": (-500, 100000),
    "origin_dep_cape": (-500, 100000),
    "origin_dep_cloudcover": (-500, 100000),
}
# Features of a window of days, the windows that exist, and their range.
WINDOWED = {
    "flightnum_od_depdelay_mean_last{days}": ([1, 7, 14], -30, 5000),
    "flightnum_od_depdelay_median_last{days}": ([1, 7, 14], -30, 5000),
    "flightnum_od_depdelay_std_last{days}": ([7, 14], 0, 5000),
    "carrier_depdelay_mean_last{days}": ([1, 7, 14], -30, 5000),
    "carrier_depdelay_median_last{days}": ([1], -30, 5000),
    "carrier_depdelay_std_last{days}": ([7, 14], 0, 5000),
    "carrier_lateaircraft_rate_last{days}": ([1, 7, 14], 0, 1),
    "carrier_origin_depdelay_mean_last{days}": ([1, 7, 14], -30, 5000),
    "carrier_origin_depdelay_median_last{days}": ([1], -30, 5000),
    "carrier_origin_depdelay_std_last{days}": ([7, 14], 0, 5000),
    "origin_depdelay_mean_last{days}": ([1, 7, 14], -30, 5000),
    "origin_depdelay_median_last{days}": ([1], -30, 5000),
    "origin_depdelay_std_last{days}": ([7, 14], 0, 5000),
    "origin_lateaircraft_rate_last{days}": ([1, 7, 14], 0, 1),
    "origin_nas_rate_last{days}": ([1, 7, 14], 0, 1),
    "origin_weather_rate_last{days}": ([1, 7, 14], 0, 1),
    "dest_depdelay_mean_last{days}": ([1, 7, 14], -30, 5000),
    "dest_depdelay_median_last{days}": ([1], -30, 5000),
    "dest_lateaircraft_rate_last{days}": ([1, 7, 14], 0, 1),
    "prior_leg_depdelay_mean_last{days}": ([7, 14], -30, 5000),
    "arrdelay_mean_{days}d_fn_od": ([7, 14], -30, 5000),
    "arrdelay_median_{days}d_fn_od": ([7, 14], -30, 5000),
    "arrdelay_n_{days}d_fn_od": ([7, 14], 0, 500),
    "arrdelay_mean_{days}d_car_od": ([7, 14], -30, 5000),
    "arrdelay_median_{days}d_car_od": ([7, 14], -30, 5000),
    "arrdelay_n_{days}d_car_od": ([7, 14], 0, 500),
    "airtime_mean_{days}d_fn_od": ([7, 14], 0, 1000),
    "airtime_n_{days}d_fn_od": ([7, 14], 0, 500),
    "airtime_mean_{days}d_car_od": ([7, 14], 0, 1000),
    "airtime_n_{days}d_car_od": ([7, 14], 0, 500),
    "wo_slip_mean_{days}d_fn_od": ([7, 14], -900, 800),
    "wo_slip_n_{days}d_fn_od": ([7, 14], 0, 500),
    "wo_slip_mean_{days}d_origin_blk": ([7, 14], -600, 500),
    "wo_slip_n_{days}d_origin_blk": ([7, 14], 0, 1200),
}
# The same for features of a hub, by its rank or by its code.
HUB_RANKS = ["0", "1", "2", "3", "4"]
HUB_CODES = ["DEN", "PHX", "BWI", "MDW", "BNA"]
OF_EACH_HUB = {
    "hub_{hub}_depdelay_mean_last{days}": ([1, 7, 14], -30, 5000),
    "hub_{hub}_lateaircraft_rate_last{days}": ([1, 7, 14], 0, 1),
}
OF_RANKED_HUBS = {"hub_{hub}_depdelay_median_last{days}": ([1], -30, 5000)}


def build_registry(ranks: Sequence[str] = HUB_RANKS, codes: Sequence[str] = HUB_CODES) -> dict[str, Rule]:
    """The rule of every known feature by its exact name, for the given hubs."""
    rules = {name: Rule("cat") for name in CATEGORIES}
    rules |= {name: Rule("num", low, high) for name, (low, high) in RANGES.items()}
    for family, hubs in ((WINDOWED, [""]), (OF_EACH_HUB, [*ranks, *codes]), (OF_RANKED_HUBS, ranks)):
        for name, (windows, low, high) in family.items():
            rules |= {name.format(hub=h, days=d): Rule("num", low, high) for h in hubs for d in windows}
    return rules


REGISTRY = build_registry()
CODE_PATTERNS = {"Origin": ("^[A-Z]{3}$", "FAIL"), "Dest": ("^[A-Z]{3}$", "FAIL"), "Reporting_Airline": ("^[A-Z0-9]{2}$", "WARN")}


def rule_for(name: str, registry: Mapping[str, Rule] = REGISTRY) -> Rule | None:
    return registry.get(name)


def _finding(check: Column | str, subject: Column | str, status: Column, detail: Column) -> Column:
    def text(c: Column | str) -> Column:
        return F.lit(c) if isinstance(c, str) else c

    return F.struct(
        text(check).alias("check"), text(subject).alias("subject"), status.alias("status"), detail.alias("detail")
    )


def _text(c: Column) -> Column:
    return F.format_string("%.2f", c)


def validate_features(
    df: DataFrame,
    expected: Sequence[str] = (),
    null_limit: float = 0.5,
    registry: Mapping[str, Rule] = REGISTRY,
) -> DataFrame:
    """Row count, expected columns, unknown values, types, ranges and code shapes, in one scan."""
    types = {f.name: f.dataType for f in df.schema.fields}
    known = {c: r for c in df.columns if (r := rule_for(c, registry))}
    aggs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for c in df.columns:
        aggs.append(F.count(c).alias(f"_n:{c}"))
    for c, r in known.items():
        if r.kind == "num" and isinstance(types[c], T.NumericType):
            aggs += [F.min(c).cast("double").alias(f"_lo:{c}"), F.max(c).cast("double").alias(f"_hi:{c}")]
        elif c in CODE_PATTERNS:
            odd = F.col(c).isNotNull() & ~F.col(c).cast("string").rlike(CODE_PATTERNS[c][0])
            aggs.append(F.sum(odd.cast("bigint")).alias(f"_odd:{c}"))
    one = df.agg(*aggs)

    rows = F.col("_rows")
    pass_, warn, fail = F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")
    size = F.when(rows == 0, fail).when(rows < 10, warn).otherwise(pass_)
    found = [_finding("row_count", "table", size, rows.cast("string"))]
    if expected:
        missing = column_report(df, expected)["missing"]
        found.append(
            _finding("expected_columns", "table", F.lit("FAIL" if missing else "PASS"), F.lit(",".join(missing)))
        )
    for c in df.columns:
        share = 1 - F.col(f"`_n:{c}`") / F.nullif(rows, F.lit(0))
        status = F.when(share > null_limit, warn).otherwise(pass_)
        found.append(_finding("null_fraction", c, status, F.format_string("%.4f", share)))
    for c, r in known.items():
        if r.kind == "num":
            if not isinstance(types[c], T.NumericType):
                found.append(_finding("type", c, fail, F.lit(types[c].simpleString())))
                continue
            lo, hi = F.col(f"`_lo:{c}`"), F.col(f"`_hi:{c}`")
            status = F.when(lo.isNull(), warn).when((lo < r.low) | (hi > r.high), fail).otherwise(pass_)
            span = F.concat(F.lit("["), _text(lo), F.lit(", "), _text(hi), F.lit("]"))
            found.append(_finding("range", c, status, F.coalesce(span, F.lit("all null"))))
        elif c in CODE_PATTERNS:
            odd = F.col(f"`_odd:{c}`")
            bad = F.lit(CODE_PATTERNS[c][1])
            found.append(_finding("codes", c, F.when(odd > 0, bad).otherwise(pass_), odd.cast("string")))
        else:
            empty = F.col(f"`_n:{c}`") == 0
            found.append(_finding("category", c, F.when(empty, warn).otherwise(pass_), F.col(f"`_n:{c}`").cast("string")))
    found.append(_finding("feature_coverage", "table", pass_, F.lit(f"{len(known)} registered features")))
    table = one.select("_rows", F.inline(F.array(*found)))
    # An empty table has one finding only.
    return table.filter((F.col("_rows") > 0) | F.col("check").isin("row_count", "expected_columns")).drop("_rows")


# Limits of the 95th percentile for means and medians, by window tag.
P95_LIMITS = {"last7": (120.0, 60.0), "last14": (100.0, 60.0), "_7d_": (120.0, 60.0), "_14d_": (100.0, 60.0)}
P99_LIMITS = (200.0, 150.0)
OTHER_SCALES = ("airtime_", "wo_slip_")


def _averages(columns: Sequence[str]) -> dict[str, tuple[str, bool]]:
    """Multi-day delay means and medians: window tag, and whether it is a median.

    Names are told apart by text, so ``mean_last14`` counts as a ``mean_last1`` name and is left out.
    """
    out = {}
    for c in columns:
        mean = "mean" in c and "mean_last1" not in c
        median = "median" in c and "median_last1" not in c
        tag = next((t for t in P95_LIMITS if t in c), None)
        if tag and (mean or median) and not c.startswith(OTHER_SCALES):
            out[c] = (tag, median)
    return out


def _percentile_check(df: DataFrame, name: str, p: float, limits: Mapping[str, float], least: int) -> DataFrame:
    rows = long_form(df, list(limits)).filter(F.col("value").isNotNull())
    cut = quantiles(rows, ["feature"], "value", [p], ["_p"]).filter(F.col("n") >= least)
    limit = F.lit(None).cast("double")
    for c, value in limits.items():
        limit = F.when(F.col("feature") == c, F.lit(value)).otherwise(limit)
    status = F.when(F.col("_p") > limit, F.lit("WARN")).otherwise(F.lit("PASS"))
    return cut.select(
        F.lit(name).alias("check"), F.col("feature").alias("subject"), status.alias("status"), F.format_string("%.2f", "_p").alias("detail")
    )


def magnitude_check(df: DataFrame, least: int = 20) -> DataFrame:
    """The 95th percentile of multi-day averages, which a sum in place of a mean would push up."""
    limits = {c: P95_LIMITS[tag][1 if median else 0] for c, (tag, median) in _averages(df.columns).items()}
    return _percentile_check(df, "multiday_magnitude", 0.95, limits, least)


def p99_check(df: DataFrame, least: int = 50) -> DataFrame:
    limits = {c: P99_LIMITS[1 if median else 0] for c, (_, median) in _averages(df.columns).items()}
    return _percentile_check(df, "p99_spot_check", 0.99, limits, least)


def roll_up(findings: DataFrame) -> DataFrame:
    """Counts per status and the overall verdict."""
    def n(s: str) -> Column:
        return F.count(F.when(F.col("status") == s, 1))

    one = findings.agg(n("PASS").alias("n_pass"), n("WARN").alias("n_warn"), n("FAIL").alias("n_fail"))
    verdict = F.when(F.col("n_fail") > 0, "FAIL").when(F.col("n_warn") > 0, "WARN").otherwise("PASS")
    return one.withColumn("status", verdict)


def label_invariants(
    df: DataFrame, labels: Sequence[str], bands: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Labels in order of rising threshold: base rates do not rise, each implies the one before.

    ``bands`` adds a plausible range per label.
    """
    pairs = list(zip(labels[:-1], labels[1:]))
    aggs = [F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(labels)]
    aggs += [
        F.sum(F.coalesce((F.col(b) == 1) & (F.col(a) == 0), F.lit(False)).cast("bigint")).alias(f"_v{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    one = df.agg(*aggs)
    ok, fail = F.lit("PASS"), F.lit("FAIL")
    found = []
    for i, (a, b) in enumerate(pairs):
        falls = F.when(F.col(f"_m{i}") >= F.col(f"_m{i + 1}"), ok).otherwise(fail)
        gap = F.format_string("%.4f", F.col(f"_m{i}") - F.col(f"_m{i + 1}"))
        found.append(_finding("base_rate_order", f"{a}>={b}", falls, gap))
        nested = F.when(F.col(f"_v{i}") == 0, ok).otherwise(fail)
        found.append(_finding("label_nesting", f"{b}->{a}", nested, F.col(f"_v{i}").cast("string")))
    for c, (low, high) in (bands or {}).items():
        rate = F.col(f"_m{list(labels).index(c)}")
        found.append(
            _finding("base_rate_band", c, F.when(rate.between(low, high), ok).otherwise(F.lit("WARN")), F.format_string("%.4f", rate))
        )
    return one.select(F.inline(F.array(*found)))


def range_checks(
    df: DataFrame,
    rates: Sequence[str],
    required: Sequence[str] = (),
    forbidden: Sequence[str] = (),
    coverage: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Rates within [0, 1], columns that must or must not exist, share of known values."""
    coverage = coverage or {}
    report = column_report(df, required, forbidden)
    present = [c for c in rates if c in df.columns]
    outside = [F.sum(F.coalesce(~F.col(c).between(0, 1), F.lit(False)).cast("bigint")).alias(f"_o{i}") for i, c in enumerate(present)]
    known = [F.avg(F.col(c).isNotNull().cast("double")).alias(f"_k{i}") for i, c in enumerate(coverage)]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *outside, *known)
    ok, fail = F.lit("PASS"), F.lit("FAIL")
    found = [
        _finding("rate_bounds", c, F.when(F.col(f"_o{i}") == 0, ok).otherwise(fail), F.col(f"_o{i}").cast("string"))
        for i, c in enumerate(present)
    ]
    found += [_finding("required", c, fail if c in report["missing"] else ok, F.lit("")) for c in required]
    found += [_finding("forbidden", c, fail if c in report["forbidden"] else ok, F.lit("")) for c in forbidden]
    found += [
        _finding(
            "coverage",
            c,
            F.when(F.col(f"_k{i}").between(*band), ok).otherwise(F.lit("WARN")),
            F.format_string("%.4f", F.col(f"_k{i}")),
        )
        for i, (c, band) in enumerate(coverage.items())
    ]
    return one.select(F.inline(F.array(*found)))


def rederive(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.05) -> DataFrame:
    """Share of rows on which two derivations of a feature agree."""
    both = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), list(keys))
    near = F.abs(F.col("_a") - F.col("_b")) < tolerance
    checked = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    one = both.agg(
        F.count(F.when(checked, 1)).alias("n_checked"),
        F.count(F.when(checked & near, 1)).alias("n_agree"),
        F.max(F.abs(F.col("_a") - F.col("_b"))).alias("worst"),
    )
    return one.withColumn("share", F.col("n_agree") / F.nullif("n_checked", F.lit(0)))


def leakage_proxy(df: DataFrame, feature: str, date: str = "FlightDate") -> DataFrame:
    """Share of first-day rows that already have the feature: only earlier days can supply it."""
    first = df.agg(F.min(date)).scalar()
    return df.filter(F.col(date) == first).agg(
        F.count(F.lit(1)).alias("n_first_day"), F.avg(F.col(feature).isNotNull().cast("double")).alias("known_share")
    )


def clock_invariants(df: DataFrame, hour: str = "sched_dep_hour", hhmm: str = "CRSDepTime") -> DataFrame:
    """Local hour against HHMM, hour range, peak flag and weekday: rows that break each rule."""
    from ..functions.parse import hhmm_hour, num

    h, t = F.col(hour), hhmm_hour(hhmm)
    rules = {"hour_matches_hhmm": h != t, "hour_in_range": ~h.between(0, 23)}
    if "is_peak_hour" in df.columns:
        rules["peak_flag"] = F.col("is_peak_hour") != h.between(16, 20).cast("int")
    if "dep_dow" in df.columns:
        rules["weekday"] = (F.col("dep_dow") != F.weekday("FlightDate")) & (num(hhmm) < 2400)
    one = df.agg(*[F.sum(F.coalesce(bad, F.lit(False)).cast("bigint")).alias(n) for n, bad in rules.items()])
    found = [
        _finding(n, "table", F.when(F.col(n) == 0, "PASS").otherwise(F.lit("FAIL")), F.col(n).cast("string"))
        for n in rules
    ]
    return one.select(F.inline(F.array(*found)))


def hour_shift(df: DataFrame, hour: str = "sched_dep_hour", hhmm: str = "CRSDepTime", origin: str = "Origin") -> DataFrame:
    """Airports whose local hour is moved by a constant: over 2 % of at least 20 rows.

    The most frequent shift comes from counts per shift, the smallest one on ties.
    """
    from ..functions.parse import hhmm_hour

    delta = (F.col(hour) - hhmm_hour(hhmm)).alias("_delta")
    counts = df.select(origin, delta).filter("_delta is not null").groupBy(origin, "_delta").agg(F.count(F.lit(1)).alias("_n"))
    per = counts.groupBy(origin).agg(
        F.sum("_n").alias("n_rows"),
        (F.sum(F.when(F.col("_delta") != 0, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("shifted_share"),
        F.max_by("_delta", F.struct("_n", -F.col("_delta"))).alias("modal_delta"),
    )
    return per.filter((F.col("n_rows") >= 20) & (F.col("shifted_share") > 0.02))


def signal_gate(df: DataFrame, a: str, b: str, labels: Sequence[str], limit: float = 0.55) -> DataFrame:
    """Per label, the folded AUC of two columns and their difference; the gate wants any b at the limit."""
    from .evaluate import auc_table

    cells = F.array(
        *[
            F.struct(F.lit(y).alias("label"), F.lit(c).alias("col"), F.col(y).cast("int").alias("y"), F.col(c).cast("double").alias("s"))
            for y in labels
            for c in (a, b)
        ]
    )
    auc = auc_table(df.select(F.inline(cells)), ["label", "col"], "y", "s", fold=True, least=100)
    wide = auc.groupBy("label").agg(
        F.max(F.when(F.col("col") == a, F.col("auc"))).alias("auc_a"), F.max(F.when(F.col("col") == b, F.col("auc"))).alias("auc_b")
    )
    return wide.withColumns({"delta": F.col("auc_b") - F.col("auc_a"), "signal": F.coalesce(F.col("auc_b") >= limit, F.lit(False))})


def holiday_sample(df: DataFrame, k: int = 5) -> DataFrame:
    return df.filter("is_holiday = 1").select("FlightDate").distinct().orderBy("FlightDate").limit(k)
