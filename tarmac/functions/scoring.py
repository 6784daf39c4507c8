"""Labels, bins and the columns that describe a scored flight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import num

THRESHOLDS = (15, 30, 60, 120)
BIN_MINUTES = (7.5, 22.5, 45.0, 90.0, 150.0)
BIN_SEVERITY = (0.0, 1.0, 2.0, 3.0, 4.0)


def departure_labels(delay: Column, thresholds: Sequence[int] = THRESHOLDS) -> dict[str, Column]:
    """``y_dep_ge{t}``; an unknown delay counts as no delay."""
    known = F.coalesce(num(delay), F.lit(0.0))
    return {f"y_dep_ge{t}": (known >= t).cast("int") for t in thresholds}


def arrival_labels(delay: Column, thresholds: Sequence[int] = THRESHOLDS) -> dict[str, Column]:
    return {f"y_arr_ge{t}": F.coalesce(num(delay) >= t, F.lit(False)).cast("int") for t in thresholds}


def cut(value: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """Label of the bin between fixed edges; NULL outside the edges.

    ``right`` closes each bin on its upper edge, otherwise on its lower one.
    """
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        inside = (value > low) & (value <= high) if right else (value >= low) & (value < high)
        out = F.when(inside, F.lit(label)).otherwise(out)
    return out


def bin_labels(thresholds: Sequence[int] = THRESHOLDS) -> list[str]:
    middle = [f"{a}-{b} min" for a, b in zip(thresholds[:-1], thresholds[1:])]
    return [f"< {thresholds[0]} min", *middle, f">= {thresholds[-1]} min"]


def true_bin(delay: Column, thresholds: Sequence[int] = THRESHOLDS) -> Column:
    """How many thresholds the delay reaches; an unknown delay reaches none."""
    known = F.coalesce(num(delay), F.lit(0.0))
    passed = F.lit(0)
    for t in thresholds:
        passed = passed + (known >= t).cast("int")
    return passed


def bin_label(index: Column, thresholds: Sequence[int] = THRESHOLDS) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in bin_labels(thresholds)]), index.cast("int") + 1)


def monotone(ps: Sequence[Column]) -> list[Column]:
    """Cumulative probabilities made non-increasing by a running minimum."""
    return [ps[0]] + [F.least(*ps[: i + 1]) for i in range(1, len(ps))]


def bin_distribution(ps: Sequence[Column]) -> Column:
    """Array of N+1 bin probabilities from N cumulative ones, summing to 1 unless all are 0."""
    m = monotone(ps)
    steps = [1.0 - m[0]]
    steps += [F.greatest(F.lit(0.0), a - b) for a, b in zip(m[:-1], m[1:])]
    steps += [F.greatest(F.lit(0.0), m[-1])]
    total = steps[0]
    for s in steps[1:]:
        total = total + s
    safe = F.when(total == 0, F.lit(1.0)).otherwise(total)
    return F.array(*[s / safe for s in steps])


def weighted_sum(dist: Column, weights: Sequence[float]) -> Column:
    pairs = F.zip_with(dist, F.array(*[F.lit(float(w)) for w in weights]), lambda p, w: p * w)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def likeliest_bin(dist: Column) -> Column:
    """Index of the largest probability, the first one on ties."""
    return (F.array_position(dist, F.array_max(dist)) - 1).cast("int")


# Sentences that explain a score, in order of precedence.
REASONS = {
    "flightnum_od_low_support": "limited flight-number history",
    "flightnum_od_depdelay_mean_lastN": "this flight/route often departs late",
    "carrier_depdelay_mean_lastNdays": "carrier delays elevated recently",
    "carrier_origin_depdelay_mean_lastNdays": "origin station running late recently",
    "origin_congestion_3h_total": "busy origin (recent congestion)",
    "od_month_load_factor_prev1": "typically high load factor (prior month)",
    "origin_daily_weathercode": "weather that day",
}
NO_REASON = "no strong delay signals detected"


def reason(columns: Sequence[str]) -> Column:
    """The first three sentences whose rule holds, over the columns that are present."""
    rules = {
        "flightnum_od_low_support": lambda c: num(c).cast("int") == 1,
        "flightnum_od_depdelay_mean_lastN": lambda c: num(c) >= 10,
        "carrier_depdelay_mean_lastNdays": lambda c: num(c) >= 10,
        "carrier_origin_depdelay_mean_lastNdays": lambda c: num(c) >= 10,
        "origin_congestion_3h_total": lambda c: num(c) >= 30,
        "od_month_load_factor_prev1": lambda c: num(c) >= 0.85,
        "origin_daily_weathercode": lambda c: F.col(c).isNotNull(),
    }
    held = [F.when(rules[c](c), F.lit(text)) for c, text in REASONS.items() if c in columns]
    if not held:
        return F.lit(NO_REASON)
    texts = F.slice(F.array_compact(F.array(*held)), 1, 3)
    return F.when(F.size(texts) == 0, F.lit(NO_REASON)).otherwise(F.array_join(texts, "; "))


def probability_text(ps: Sequence[Column], thresholds: Sequence[int] = THRESHOLDS) -> Column:
    parts = [
        F.when(p.isNull(), F.lit(f"P>={t}=nan")).otherwise(F.format_string(f"P>={t}=%.3f", p))
        for t, p in zip(thresholds, ps)
    ]
    return F.concat_ws(", ", *parts)


def block_minutes(departure: Column, arrival: Column) -> Column:
    return F.timestamp_diff("MINUTE", departure, arrival)
