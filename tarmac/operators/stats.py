"""Descriptive statistics, correlation and group comparison."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .joins import SENT_CELLS
from .ranks import long_form, quantile_bins, quantiles, running_totals

PERCENTILES = (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)


def _rate(c: str | Column) -> Column:
    return F.avg((F.col(c) if isinstance(c, str) else c).cast("double"))


# --- rate tables --------------------------------------------------------------------------------


def rate_by(df: DataFrame, cats: Sequence[str], target: str, min_n: int = 1) -> DataFrame:
    """Mean of the target and rows per category, for categories with enough rows."""
    table = df.groupBy(*cats).agg(_rate(target).alias("rate"), F.count(target).alias("n"))
    return table.filter(F.col("n") >= min_n)


def crosstab_mean(df: DataFrame, row: str, col: str, values: Sequence, target: str) -> DataFrame:
    """Mean of the target per row category, one column per listed value of ``col``."""
    return df.groupBy(row).pivot(col, list(values)).agg(_rate(target))


def scalar_summary(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row of shares and means."""
    return df.agg(*[e.alias(n) for n, e in measures.items()])


# --- column profiles ----------------------------------------------------------------------------


def _wide(df: DataFrame, cols: Sequence[str], measures: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per column with aggregates of it as a double: one wide aggregate, then laid out."""
    made = [m(F.col(c).cast("double")).alias(f"_{i}_{n}") for i, c in enumerate(cols) for n, m in measures.items()]
    rows = [F.struct(F.lit(c).alias("feature"), *[F.col(f"_{i}_{n}").alias(n) for n in measures]) for i, c in enumerate(cols)]
    return df.agg(*made).select(F.inline(F.array(*rows)))


def numeric_stats(df: DataFrame, cols: Sequence[str], sample_std: bool = False) -> DataFrame:
    """One row per numeric column: counts, range, mean, median, deviation, exact percentiles.

    All but the percentiles come from one wide aggregate; those need the counts of distinct values.
    """
    base = _wide(
        df,
        cols,
        {
            "count": lambda v: F.count(F.lit(1)),
            "non_null_count": F.count,
            "min": F.min,
            "max": F.max,
            "mean": F.avg,
            "std": F.stddev_samp if sample_std else F.stddev_pop,
        },
    )
    names = [f"p{round(p * 100):02d}" for p in PERCENTILES]
    cuts = quantiles(long_form(df, cols), ["feature"], "value", PERCENTILES, names).drop("n")
    share = 100.0 * (F.col("count") - F.col("non_null_count")) / F.col("count")
    return (
        base.filter(F.col("count") > 0)
        .join(cuts, ["feature"], "left")
        .withColumns({"null_count": F.col("count") - F.col("non_null_count"), "null_pct": share, "median": F.col("p50")})
    )


def top_values(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """The k most frequent values of every column; equal counts are ordered by value."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = (
        df.select(F.inline(cells)).filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    # A top-k filter on row_number keeps k rows per task before the shuffle.
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def categorical_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts, nulls and distinct values of each column.

    Distinct values come from a group-by on (column, value), which spreads over the cluster.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.inline(cells)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(
        F.sum("n").alias("count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("unique_count"),
    )


def dataset_stats(df: DataFrame, date: str = "FlightDate", carrier: str = "Reporting_Airline") -> DataFrame:
    """Rows, columns, date span and carriers in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min(date).alias("date_min"),
        F.max(date).alias("date_max"),
        F.array_join(F.array_sort(F.collect_set(F.col(carrier).cast("string"))), ",").alias("airlines"),
    )


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """The exact median of each column, 0 where no value is known."""
    if not cols:
        return {}
    found = {r["feature"]: r["m"] for r in quantiles(long_form(df, cols), ["feature"], "value", [0.5], ["m"]).collect()}
    return {c: float(found.get(c) or 0.0) for c in cols}


def impute_median(df: DataFrame, cols: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Unknown numbers replaced by the exact median of the training rows, or 0 if none is known."""
    source = fitted_on if fitted_on is not None else df
    middle = quantiles(long_form(source, cols), ["feature"], "value", [0.5], ["m"])
    one = middle.agg(*[F.max(F.when(F.col("feature") == c, F.col("m"))).alias(f"m{i}") for i, c in enumerate(cols)])
    known = df.withColumn("_medians", one.select(F.struct("*")).scalar())
    made = {c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[f"m{i}"], F.lit(0.0)) for i, c in enumerate(cols)}
    return known.withColumns(made).drop("_medians")


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, sample deviation and bias-corrected skewness per column, from one wide aggregate."""
    made = _wide(df, cols, {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "skew": F.skewness})
    n = F.col("n")
    fixed = F.when(n > 2, F.col("skew") * F.sqrt(n * (n - 1)) / (n - 2))
    return made.select("feature", "n", "mean", "std", fixed.alias("skew"))


# --- equal-count bins ---------------------------------------------------------------------------


def decile_curve(df: DataFrame, feats: Sequence[str], target: str, q: int = 10) -> DataFrame:
    """Rows, target rate, its standard error and the bin's median value, per feature and bin."""
    binned = quantile_bins(df.filter(F.col(target).isNotNull()), feats, q, [target])
    keys = ["feature", "bin"]
    curve = binned.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        _rate(target).alias("rate"),
        (F.stddev_samp(F.col(target).cast("double")) / F.sqrt(F.count(F.lit(1)))).alias("sem"),
    )
    middle = quantiles(binned, keys, "value", [0.5], ["median"]).drop("n")
    return curve.join(middle, keys)


def _bin_of(df: DataFrame, feats: Sequence[str], q: int, keep: Sequence[str]) -> DataFrame:
    """Wide rows with a bin column per feature, from edges computed once for all features."""
    names = [f"_e{i}" for i in range(q + 1)]
    cuts = quantiles(long_form(df, feats), ["feature"], "value", [i / q for i in range(q + 1)], names)
    one = cuts.agg(
        *[
            F.max(F.when(F.col("feature") == f, F.array_distinct(F.array(*names)))).alias(f"_edges_{i}")
            for i, f in enumerate(feats)
        ]
    )
    # One row of edges, read as a scalar subquery: no join, and nothing passes through the driver.
    wide = df.select(*keep, *feats, one.select(F.struct("*")).scalar().alias("_edges"))

    def number(i: int, f: str) -> Column:
        edges = F.col("_edges")[f"_edges_{i}"]
        below = F.size(F.filter(edges, lambda e: e < F.col(f).cast("double")))
        return F.when(F.col(f).isNotNull() & (F.size(edges) > 1), F.greatest(below - 1, F.lit(0)))

    made = {f"_b{i}": number(i, f) for i, f in enumerate(feats)}
    made |= {f"_top{i}": F.size(F.col("_edges")[f"_edges_{i}"]) - 2 for i, _ in enumerate(feats)}
    return wide.withColumns(made).drop("_edges")


def heat2d(df: DataFrame, x: str, y: str, target: str, n: int = 5) -> DataFrame:
    """Target rate by equal-count bins of two features, bins of x across."""
    valid = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(target).isNotNull())
    b = _bin_of(valid, [x, y], n, [target])
    table = b.groupBy(F.col("_b1").alias("y_bin")).pivot("_b0", list(range(n))).agg(_rate(target))
    return table.withColumnsRenamed({str(i): f"x_bin{i}" for i in range(n)})


def interaction_scores(
    df: DataFrame, feats: Sequence[str], target: str, low_is_worst: Sequence[str] = (), q: int = 5
) -> DataFrame:
    """Rate where both features are at their worst, against what independence predicts.

    All pairs are read off one aggregate over one binned scan; bins come from the rows where every
    feature is known.
    """
    valid = df.na.drop(subset=[*feats, target])
    b = _bin_of(valid, feats, q, [target])
    worst = {f: (F.col(f"_b{i}") == (0 if f in low_is_worst else F.col(f"_top{i}"))) for i, f in enumerate(feats)}
    y = F.col(target).cast("double")
    aggs = [F.avg(y).alias("_base")] + [F.avg(F.when(worst[f], y)).alias(f"_m{i}") for i, f in enumerate(feats)]
    pairs = list(combinations(range(len(feats)), 2))
    aggs += [F.avg(F.when(worst[feats[i]] & worst[feats[j]], y)).alias(f"_j{i}_{j}") for i, j in pairs]
    one = b.agg(*aggs)
    rows = []
    for i, j in pairs:
        expected = F.col(f"_m{i}") * F.col(f"_m{j}") / F.nullif("_base", F.lit(0.0))
        score = F.when(expected > 0, F.col(f"_j{i}_{j}") / expected).otherwise(F.lit(1.0))
        rows.append(
            F.struct(
                F.lit(feats[i]).alias("feature_a"),
                F.lit(feats[j]).alias("feature_b"),
                F.col(f"_j{i}_{j}").alias("joint_worst"),
                expected.alias("expected"),
                score.alias("score"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def sensitivity_slopes(df: DataFrame, feats: Sequence[str], target: str, group: str, q: int = 5) -> DataFrame:
    """Slope of the target rate over the bin medians, per 1000 units, for each group and feature.

    Fewer than 100 rows or a single bin give 0.
    """
    valid = df.filter(F.col(target).isNotNull() & F.col(group).isNotNull())
    binned = quantile_bins(valid, feats, q, [target], [group])
    keys = [group, "feature", "bin"]
    points = binned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), _rate(target).alias("rate"))
    middle = quantiles(binned, keys, "value", [0.5], ["median"]).drop("n")
    line = points.join(middle, keys).groupBy(group, "feature").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("_bins"), F.regr_slope("rate", "median").alias("_slope")
    )
    ok = (F.col("n") >= 100) & (F.col("_bins") >= 2)
    return line.select(group, "feature", "n", F.when(ok, F.col("_slope") * 1000).otherwise(F.lit(0.0)).alias("slope_per_1000"))


# --- correlation --------------------------------------------------------------------------------


def pearson(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Pearson (point-biserial, for a 0/1 column) correlation of many pairs in one scan."""
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
        aggs += [F.corr(x, y).alias(f"_r{i}"), F.count(F.when(both, 1)).alias(f"_n{i}")]
    one = df.groupBy(*by).agg(*aggs)
    rows = [
        F.struct(
            F.lit(a).alias("feature"), F.lit(b).alias("target"), F.col(f"_r{i}").alias("r"), F.col(f"_n{i}").alias("n")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(*by, F.inline(F.array(*rows)))


def _null_classes(rows: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """A number for each column, equal for columns that are unknown in the same rows.

    Each column has one 64-bit fingerprint of the rows in which it is unknown.
    """
    prints = rows.agg(*[F.bit_xor(F.when(F.col(c).isNull(), F.xxhash64("_row"))).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    seen: dict[object, int] = {}
    return {c: seen.setdefault(prints[i], len(seen)) for i, c in enumerate(cols)}


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Spearman correlation of many pairs, each over the rows where both are known.

    Within those rows a column's ranks depend on which rows its partner lacks, and on nothing else of
    it. So each column is ranked once for every set of rows that some column lacks (once in all, if none
    has unknown values), all in one pass over its distinct values. The ranks, less their mean, go back to
    the rows, by broadcast where few values are distinct, and one aggregate sums the products of all pairs.
    Rows are laid out once per column, not per pair, and equal rows count as one with a weight.
    """
    cols = sorted({c for pair in pairs for c in pair})
    known = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    known = known.na.drop(subset=list(by)) if by else known
    rows = known.groupBy(*by, *cols).agg(F.count(F.lit(1)).alias("_w"))
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    of = _null_classes(rows, cols)
    example = {k: c for c, k in of.items()}
    sets = sorted(example)
    # Weight of a row in each set of rows: zero where the set's columns are unknown.
    weights = [F.when(F.col(example[k]).isNotNull(), F.col("_w")).otherwise(0).alias(f"_n{k}") for k in sets]
    cells = F.array(*[F.struct(F.lit(c).alias("_feature"), F.col(c).alias("_value")) for c in cols])
    long = rows.select(*by, "_row", *weights, F.inline(cells)).filter("_value is not null")
    keys = [*by, "_feature"]
    counts = long.groupBy(*keys, "_value").agg(*[F.sum(f"_n{k}").alias(f"_n{k}") for k in sets])
    totals = running_totals(counts, keys, ["_value"], [f"_n{k}" for k in sets])
    # The mean rank is (N + 1) / 2, so what is left of before + (n + 1) / 2 is this.
    centred = [(F.col(f"before__n{k}") + (F.col(f"_n{k}") - F.col(f"total__n{k}")) / 2).alias(f"_c{k}") for k in sets]
    ranks = materialise(totals.select(*keys, "_value", *centred), "ranks")
    wanted = sorted({(a, of[b]) for a, b in pairs} | {(b, of[a]) for a, b in pairs})
    place = {cell: f"_r{i}" for i, cell in enumerate(wanted)}
    if ranks.count() * len(ranks.columns) <= SENT_CELLS:
        # Few distinct values: each column's ranks are sent to the rows, which neither move nor multiply.
        full = rows
        for c in cols:
            named = [F.col(f"_c{k}").alias(place[a, k]) for a, k in wanted if a == c]
            own = ranks.filter(F.col("_feature") == c).select(*by, F.col("_value").alias(c), *named)
            full = full.join(F.broadcast(own), [*by, c], "left")
    else:
        ranked = long.select(*keys, "_value", "_row").join(ranks, [*keys, "_value"])
        wide = ranked.groupBy("_row").agg(*[F.max(F.when(F.col("_feature") == c, F.col(f"_c{k}"))).alias(place[c, k]) for c, k in wanted])
        full = rows.join(wide, "_row")
    # A rank is kept in the rows of its set alone; what several pairs ask of it is then summed once.
    full = full.withColumns({place[c, k]: F.when(F.col(example[k]).isNotNull(), F.col(place[c, k])) for c, k in wanted})
    sums = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(place[a, of[b]]), F.col(place[b, of[a]])
        for name, product in (("xy", x * y), ("xx", x * x), ("yy", y * y)):
            sums.append(F.sum(F.col("_w") * product).alias(f"_{name}{i}"))
        sums.append(F.sum(F.when(x.isNotNull(), F.col("_w"))).alias(f"_n{i}"))
    one = full.groupBy(*by).agg(*sums)
    out = []
    for i, (a, b) in enumerate(pairs):
        rho = F.col(f"_xy{i}") / F.nullif(F.sqrt(F.col(f"_xx{i}") * F.col(f"_yy{i}")), F.lit(0.0))
        out.append(F.struct(F.lit(a).alias("feature"), F.lit(b).alias("target"), F.col(f"_n{i}").alias("n"), rho.alias("rho")))
    return one.select(*by, F.inline(F.array(*out))).filter("n > 0")


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long correlation matrix, both triangles and no diagonal."""
    half = spearman(df, list(combinations(cols, 2)))
    flipped = half.select(F.col("target").alias("feature"), F.col("feature").alias("target"), "n", "rho")
    return half.unionByName(flipped)


def partial_spearman(df: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """Rank correlation of what is left of x and y after a straight-line fit on z."""
    valid = df.na.drop(subset=[x, y, z]).select(*[F.col(c).cast("double").alias(c) for c in (x, y, z)])
    fit = valid.agg(
        F.regr_slope(x, z).alias("_ax"),
        F.regr_intercept(x, z).alias("_bx"),
        F.regr_slope(y, z).alias("_ay"),
        F.regr_intercept(y, z).alias("_by"),
    )
    both = valid.withColumn("_fit", fit.select(F.struct("*")).scalar())
    line = {c: F.col("_fit")[c] for c in ("_ax", "_bx", "_ay", "_by")}
    # Equal inputs must give equal residuals, so that ties stay ties.
    rest = both.select(
        F.round(F.col(x) - (line["_ax"] * F.col(z) + line["_bx"]), 9).alias("rest_x"),
        F.round(F.col(y) - (line["_ay"] * F.col(z) + line["_by"]), 9).alias("rest_y"),
    )
    return spearman(rest, [("rest_x", "rest_y")]).select(F.col("rho").alias("partial_rho"), "n")


def redundant_pairs(df: DataFrame, cols: Sequence[str], limit: float = 0.85) -> DataFrame:
    return spearman(df, list(combinations(cols, 2))).filter(F.abs("rho") > limit)


def best_partner(df: DataFrame, candidates: Sequence[str], existing: Sequence[str], limit: float = 0.85) -> DataFrame:
    """The existing column each candidate follows most closely."""
    rho = spearman(df, [(c, e) for c in candidates for e in existing]).filter("n >= 100")
    rank = F.struct(F.abs("rho"), F.col("target"))
    best = rho.groupBy("feature").agg(
        F.max_by("target", rank).alias("partner"), F.max_by("rho", rank).alias("rho")
    )
    return best.withColumn("redundant", F.abs("rho") > limit)


def drop_rules(importance: DataFrame, correlation: DataFrame, nulls: DataFrame) -> DataFrame:
    """Why a feature could go: little importance, a stronger twin, many unknown values.

    ``importance`` is (feature, importance), ``correlation`` a long matrix, ``nulls`` (feature,
    null_rate).
    """
    rank = F.struct(F.abs("rho"), F.col("target"))
    twin = correlation.groupBy("feature").agg(
        F.max_by("target", rank).alias("partner"), F.max_by("rho", rank).alias("partner_rho")
    )
    weight = importance.select(F.col("feature").alias("partner"), F.col("importance").alias("_partner_importance"))
    all_ = importance.join(twin, ["feature"], "left").join(weight, ["partner"], "left").join(nulls, ["feature"], "left")
    low = F.col("importance") < 0.5
    twinned = (F.abs("partner_rho") > 0.90) & (F.col("importance") < F.coalesce("_partner_importance", F.lit(0.0)))
    sparse = F.col("null_rate") > 0.30
    reasons = F.array_compact(
        F.array(F.when(low, "low_importance"), F.when(twinned, "redundant"), F.when(sparse, "high_null"))
    )
    return all_.select(
        "feature",
        "importance",
        "null_rate",
        "partner",
        "partner_rho",
        F.array_join(reasons, ",").alias("reasons"),
        (F.size(reasons) > 0).alias("recommend_drop"),
    )


# --- group comparison ---------------------------------------------------------------------------


def compare_groups(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Value with the flag set against not set: means, Welch t, Cohen's d, late rates and lift."""
    v = F.col(value).cast("double")
    on, off = F.col(flag) == 1, ~(F.coalesce(F.col(flag), F.lit(0)) == 1)
    late = F.coalesce(v >= 15, F.lit(False)).cast("double")
    one = df.agg(
        F.sum(on.cast("bigint")).alias("n_active"),
        F.sum(off.cast("bigint")).alias("n_inactive"),
        F.avg(F.when(on, v)).alias("mean_active"),
        F.avg(F.when(off, v)).alias("mean_inactive"),
        F.var_samp(F.when(on, v)).alias("_va"),
        F.var_samp(F.when(off, v)).alias("_vi"),
        F.count(F.when(on, v)).alias("_na"),
        F.count(F.when(off, v)).alias("_ni"),
        F.stddev_samp(v).alias("_std"),
        F.avg(F.when(on, late)).alias("rate_active"),
        F.avg(F.when(off, late)).alias("rate_inactive"),
        F.corr(F.when(v.isNotNull(), F.col(flag).cast("double")), v).alias("point_biserial_r"),
    )
    diff = F.col("mean_active") - F.col("mean_inactive")
    a, b = F.col("_va") / F.col("_na"), F.col("_vi") / F.col("_ni")
    freedom = (a + b) * (a + b) / (a * a / (F.col("_na") - 1) + b * b / (F.col("_ni") - 1))
    return one.select(
        "n_active",
        "n_inactive",
        "mean_active",
        "mean_inactive",
        diff.alias("mean_diff"),
        (diff / F.sqrt(a + b)).alias("welch_t"),
        freedom.alias("welch_df"),
        two_sided_p(diff / F.sqrt(a + b), freedom).alias("p_value"),
        (diff / F.nullif("_std", F.lit(0.0))).alias("cohens_d"),
        "rate_active",
        "rate_inactive",
        (F.col("rate_active") / F.nullif("rate_inactive", F.lit(0.0))).alias("lift"),
        "point_biserial_r",
    )


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of x > 0, by Stirling's series at x + 10."""
    z = x + 10
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    shifted = F.log(reduce(lambda a, b: a * b, [x + k for k in range(10)]))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shifted


# Steps of the continued fraction; it converges in far fewer where it is used.
FRACTION_STEPS = 300


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, from its last step to its first."""

    def step(acc: Column, m: Column) -> Column:
        # One odd and one even coefficient for each step.
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        inner = F.lit(1.0) + odd / acc
        return F.when(m == 0, inner).otherwise(F.lit(1.0) + even / inner)

    steps = F.transform(F.sequence(F.lit(FRACTION_STEPS), F.lit(0), F.lit(-1)), lambda m: m.cast("double"))
    return F.lit(1.0) / F.aggregate(steps, F.lit(1.0), step)


def two_sided_p(t: Column, freedom: Column) -> Column:
    """Two-sided p-value of a Student t with that many degrees of freedom.

    It is the regularised incomplete beta function at df / (df + t^2), or one less that of the
    mirrored point where the fraction converges faster.
    """
    a, b = freedom / 2, F.lit(0.5)
    x = freedom / (freedom + t * t)
    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(x) + b * F.log1p(-x))
    near = front * _beta_fraction(a, b, x) / a
    far = 1 - front * _beta_fraction(b, a, 1 - x) / b
    inside = F.when(x < (a + 1) / (a + b + 2), near).otherwise(far)
    return F.when(t == 0, F.lit(1.0)).when(t.isNotNull() & (freedom > 0), inside)


def continuous_effect(df: DataFrame, feature: str, value: str) -> DataFrame:
    """Pearson, Spearman, and the mean value in the first and last quarter of the feature."""
    valid = df.na.drop(subset=[feature, value])
    r = pearson(valid, [(feature, value)]).select("feature", "r", "n")
    rho = spearman(valid, [(feature, value)]).select("feature", "rho")
    binned = quantile_bins(valid.withColumn("_v", F.col(value).cast("double")), [feature], 4, ["_v"])
    ends = binned.groupBy("feature").agg(
        F.avg(F.when(F.col("bin") == 0, F.col("_v"))).alias("mean_q1"),
        F.avg(F.when(F.col("bin") == F.col("n_bins") - 1, F.col("_v"))).alias("mean_q4"),
    )
    return r.join(rho, ["feature"]).join(ends, ["feature"], "left").withColumn(
        "diff_q4_q1", F.col("mean_q4") - F.col("mean_q1")
    )


def by_level(df: DataFrame, level: str, value: str) -> DataFrame:
    """Rows, mean and late share per level of an ordinal column."""
    late = F.coalesce(F.col(value) >= 15, F.lit(False)).cast("double")
    return df.filter(F.col(level).isNotNull()).groupBy(level).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_delay"), (100 * F.avg(late)).alias("delay_rate_15")
    )


def cramers_v(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Chi-square and Cramer's V of each pair of categories, from joint and marginal counts.

    A two-by-two table gets Yates' continuity correction.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("feature"),
                F.lit(b).alias("label"),
                F.col(a).cast("string").alias("u"),
                F.col(b).cast("string").alias("v"),
            )
            for a, b in pairs
        ]
    )
    keys = ["feature", "label"]
    joint = df.select(F.inline(cells)).filter("u is not null and v is not null").groupBy(*keys, "u", "v").agg(
        F.count(F.lit(1)).cast("double").alias("o")
    )
    us = joint.groupBy(*keys, "u").agg(F.sum("o").alias("nu"))
    vs = joint.groupBy(*keys, "v").agg(F.sum("o").alias("nv"))
    shape = us.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r"), F.sum("nu").alias("n")).join(
        vs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")), keys
    )
    # Cells that never occur count through the identity sum(e) = n, so no pair is laid out.
    full = joint.join(us, [*keys, "u"]).join(vs, [*keys, "v"]).join(shape, keys)
    e = F.col("nu") * F.col("nv") / F.col("n")
    plain = F.sum(F.col("o") * F.col("o") / e) - F.max("n")
    gap = F.abs(F.col("o") - e)
    fixed = gap - F.least(F.lit(0.5), gap)
    small = (F.col("_r") == 2) & (F.col("_c") == 2)
    table = full.groupBy(*keys).agg(
        plain.alias("_plain"),
        F.sum(fixed * fixed / e).alias("_seen"),
        F.count(F.lit(1)).alias("_cells"),
        F.max("n").alias("n"),
        F.max("_r").alias("_r"),
        F.max("_c").alias("_c"),
        (F.max("n") - F.sum(e)).alias("_unseen_e"),
    )
    # Empty cells of a two-by-two table (one, or the two of a diagonal) have equal expectations.
    empty = 4 - F.col("_cells")
    each = F.col("_unseen_e") / F.nullif(empty, F.lit(0))
    lost = each - F.least(F.lit(0.5), each)
    unseen = empty * lost * lost / F.nullif(each, F.lit(0.0))
    chi2 = F.when(small, F.col("_seen") + F.coalesce(unseen, F.lit(0.0))).otherwise(F.greatest("_plain", F.lit(0.0)))
    dim = F.least("_r", "_c") - 1
    v = F.when(dim > 0, F.sqrt(chi2 / (F.col("n") * dim))).otherwise(0.0)
    return table.select(*keys, F.col("n").cast("bigint").alias("n"), chi2.alias("chi2"), v.alias("cramers_v"))


def mutual_information(df: DataFrame, feats: Sequence[str], label: str, q: int = 10) -> DataFrame:
    """Mutual information of each binned feature with a class, in nats, from joint counts."""
    valid = df.filter(F.col(label).isNotNull())
    joint = quantile_bins(valid, feats, q, [label]).groupBy("feature", "bin", label).agg(F.count(F.lit(1)).alias("o"))
    nb = joint.groupBy("feature", "bin").agg(F.sum("o").alias("nb"))
    ny = joint.groupBy("feature", label).agg(F.sum("o").alias("ny"))
    n = joint.groupBy("feature").agg(F.sum("o").alias("n"))
    full = joint.join(nb, ["feature", "bin"]).join(ny, ["feature", label]).join(n, ["feature"])
    o = F.col("o").cast("double")
    term = o / F.col("n") * F.log(o * F.col("n") / (F.col("nb").cast("double") * F.col("ny")))
    return full.groupBy("feature").agg(F.sum(term).alias("mi"), F.max("n").alias("n"))


def ks_statistic(df: DataFrame, cols: Sequence[str], flag: str) -> DataFrame:
    """Largest distance between the two groups' distribution functions, per column."""
    from .ranks import running_totals

    rows = long_form(df.filter(F.col(flag).isNotNull()), cols, [flag]).filter(F.col("value").isNotNull())
    on = F.col(flag).cast("int") == 1
    counts = rows.groupBy("feature", "value").agg(
        F.sum(on.cast("bigint")).alias("a"), F.sum((~on).cast("bigint")).alias("b")
    )
    t = running_totals(counts, ["feature"], ["value"], ["a", "b"])
    fa = (F.col("before_a") + F.col("a")) / F.nullif("total_a", F.lit(0))
    fb = (F.col("before_b") + F.col("b")) / F.nullif("total_b", F.lit(0))
    return t.groupBy("feature").agg(
        F.max(F.abs(fa - fb)).alias("ks"), F.max("total_a").alias("n_flagged"), F.max("total_b").alias("n_other")
    )


# --- spread of delays along an aircraft's day ---------------------------------------------------


def propagation(df: DataFrame, now: str = "delayed", before: str = "prev_delayed") -> DataFrame:
    """Chance of a delay after a delayed leg and after a punctual one, and their ratio."""
    one = df.filter(F.col(before).isNotNull()).agg(
        F.avg(F.when(F.col(before) == 1, F.col(now))).alias("p_after_delayed"),
        F.avg(F.when(F.col(before) == 0, F.col(now))).alias("p_after_ok"),
    )
    return one.withColumn("lift", F.col("p_after_delayed") / F.greatest("p_after_ok", F.lit(0.001)))


def absorption(df: DataFrame, min_n: int = 30) -> DataFrame:
    """How often a delay goes on, by turn time and by size of the earlier delay."""
    from ..functions.scoring import cut

    after = df.filter(F.col("prev_delayed") == 1)
    turns = cut(
        F.col("turn_time_hours"),
        [0, 0.5, 0.75, 1.0, 1.5, 2.0, 4.0, 24.0],
        ["<30m", "30-45m", "45-60m", "1-1.5h", "1.5-2h", "2-4h", "4h+"],
    )
    sizes = cut(
        F.col("prev_delay_min"), [0, 15, 30, 45, 60, 120, 500], ["0-15", "15-30", "30-45", "45-60", "60-120", "120+"]
    )
    cells = F.array(
        F.struct(F.lit("turn_time").alias("by"), turns.alias("bin")),
        F.struct(F.lit("prev_delay").alias("by"), sizes.alias("bin")),
    )
    rows = after.select("delayed", F.inline(cells)).filter(F.col("bin").isNotNull())
    return (
        rows.groupBy("by", "bin")
        .agg(_rate("delayed").alias("cascade_rate"), F.count("delayed").alias("n"))
        .filter(F.col("n") > min_n)
    )


def persistence(df: DataFrame, key: str, target: str, date: str = "FlightDate", min_n: int = 20) -> DataFrame:
    """Per key, the rate before and from the median date on, where both halves have enough rows."""
    dates = df.filter(F.col(date).isNotNull()).withColumn(
        "_day", F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    )
    # The median runs over (day, rows of the day), so the aggregate holds days only.
    middle = dates.groupBy("_day").agg(F.count(F.lit(1)).alias("_n")).agg(F.expr("percentile(_day, 0.5, _n)"))
    marked = dates.withColumn("_mid", middle.scalar())
    first = F.col("_day") < F.col("_mid")
    y = F.col(target).cast("double")
    return (
        marked.groupBy(key)
        .agg(
            F.avg(F.when(first, y)).alias("rate_before"),
            F.avg(F.when(~first, y)).alias("rate_after"),
            F.count(F.when(first, y)).alias("n_before"),
            F.count(F.when(~first, y)).alias("n_after"),
        )
        .filter((F.col("n_before") > min_n) & (F.col("n_after") > min_n))
    )


def persistence_corr(table: DataFrame) -> DataFrame:
    return table.agg(F.corr("rate_before", "rate_after").alias("r"), F.count(F.lit(1)).alias("n"))


# --- seasons, regions, carriers, domains --------------------------------------------------------


def monthly_means(df: DataFrame, month: Column, target: str, others: Sequence[str]) -> DataFrame:
    return df.groupBy(month.alias("month")).agg(
        _rate(target).alias("delay_rate"), *[F.avg(c).alias(f"mean_{c}") for c in others]
    )


def top_by_month(df: DataFrame, key: str, month: Column, target: str, k: int = 20) -> DataFrame:
    """Rate per month of the k keys with most rows, one column per month."""
    busiest = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), key).limit(k).select(key)
    kept = df.withColumn("_m", month).join(busiest, [key], "left_semi")
    table = kept.groupBy(key).pivot("_m", list(range(1, 13))).agg(_rate(target))
    return table.withColumnsRenamed({str(m): f"m{m}" for m in range(1, 13)})


def shared_severe(
    df: DataFrame, severe: Column, airport: str, carrier: str, carriers: Sequence[str], target: str, at_least: int = 3
) -> DataFrame:
    """Rates by carrier at airports where several carriers met severe weather."""
    rough = df.filter(severe)
    shared = rough.groupBy(airport).agg(F.countDistinct(carrier).alias("_n")).filter(F.col("_n") >= at_least)
    return rough.join(shared, [airport], "left_semi").groupBy(airport).pivot(carrier, list(carriers)).agg(_rate(target))


def rate_spread(df: DataFrame, kind: str, key: str, target: str, min_n: int = 1) -> DataFrame:
    """Largest minus smallest rate over the keys of each kind."""
    rates = rate_by(df, [kind, key], target, min_n)
    return rates.groupBy(kind).agg(
        (F.max("rate") - F.min("rate")).alias("spread"), F.count(F.lit(1)).alias("n_keys")
    )


def domain_ratios(df: DataFrame, hour: str, low_cost: str) -> DataFrame:
    """Crew delays late against daytime, ramp delays low-cost against others, technical peak hour.

    Hourly rates are averaged over hours, so every hour weighs the same.
    """
    hourly = df.groupBy(hour).agg(
        _rate("is_delayed_Crew").alias("crew"), _rate("is_delayed_Aircraft-Tech").alias("tech")
    )
    clock = hourly.agg(
        F.coalesce(F.avg(F.when(F.col(hour) >= 22, F.col("crew"))), F.lit(0.0)).alias("late"),
        F.coalesce(F.avg(F.when(F.col(hour).between(6, 17), F.col("crew"))), F.lit(0.0)).alias("day"),
        (F.max("tech") / F.nullif(F.avg("tech"), F.lit(0.0))).alias("peak"),
    )
    ramp = F.col("is_delayed_Airline-Ramp").cast("double")
    cost = df.agg(
        F.avg(F.when(F.col(low_cost) == 1, ramp)).alias("_lcc"),
        F.avg(F.when(F.col(low_cost) == 0, ramp)).alias("_fsc"),
    )
    floor = F.lit(0.01)
    both = cost.withColumn("_clock", clock.select(F.struct("*")).scalar())
    at = F.col("_clock")
    return both.select(
        (at["late"] / F.greatest(at["day"], floor)).alias("late_evening_vs_daytime_ratio"),
        (F.col("_lcc") / F.greatest("_fsc", floor)).alias("lcc_vs_fsc_ratio"),
        at["peak"].alias("tech_concentration_ratio"),
    )
