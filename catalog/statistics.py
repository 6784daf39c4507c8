"""Bins, correlations and group comparison."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import lookups
from tarmac.operators import stats

from . import bindings as b
from .aggregates import LAB, labelled
from .registry import plain, query
from .scalars import CAUSES, causes

FEATS = ["TaxiOut", "AirTime", "CRSElapsedTime"]


def bins_sql(source: str, feats: list[str], q: int, keep: str, by: str = "", where: str = "true") -> str:
    """Long rows with bins: edges by interpolated quantiles, equal edges dropped, closed on the right."""
    key = f"{by}, " if by else ""
    arms = []
    for f in feats:
        qs = ", ".join(str(i / q) for i in range(q + 1))
        over = f"(SELECT {key}list_sort(list_distinct(quantile_cont(CAST({f} AS DOUBLE), [{qs}]))) AS e FROM {source} WHERE {f} IS NOT NULL AND {where} GROUP BY ALL)"
        join = f"JOIN {over} USING ({by})" if by else f", {over}"
        arms.append(
            f"SELECT {key}{keep}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, greatest(len(list_filter(e, lambda x: x < {f})) - 1, 0) AS bin, len(e) - 1 AS n_bins "
            f"FROM {source} {join} WHERE {f} IS NOT NULL AND {where} AND len(e) > 1"
        )
    return " UNION ALL ".join(arms)


@query(
    "decile_curve",
    "A13",
    b.sql(
        "flights",
        "SELECT feature, CAST(bin AS INT) AS bin, count(*) AS n, round(avg(y), 6) + 0.0 AS rate, round(stddev_samp(y) / sqrt(count(*)), 6) + 0.0 AS sem, "
        "round(quantile_cont(value, 0.5), 6) + 0.0 AS median FROM q GROUP BY ALL",
        l=LAB,
        q=bins_sql("l", FEATS, 10, "y"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.decile_curve(labelled(spark, sf), FEATS, "y"))


_WIDE = (
    "SELECT l.*, "
    + ", ".join(f"greatest(len(list_filter(e{i}, lambda x: x < {f})) - 1, 0) AS b{i}, len(e{i}) - 2 AS t{i}" for i, f in enumerate(FEATS))
    + " FROM l, e WHERE "
    + " AND ".join(f"{f} IS NOT NULL" for f in FEATS)
)
_EDGES = (
    "SELECT "
    + ", ".join(f"list_sort(list_distinct(quantile_cont(CAST({f} AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e{i}" for i, f in enumerate(FEATS))
    + " FROM l WHERE "
    + " AND ".join(f"{f} IS NOT NULL" for f in FEATS)
)


@query(
    "heat_table",
    "A14",
    b.sql(
        "flights",
        "SELECT CAST(b1 AS INT) AS y_bin, " + ", ".join(f"round(avg(y) FILTER (b0 = {i}), 6) + 0.0 AS x_bin{i}" for i in range(5)) + " FROM w GROUP BY b1",
        l=LAB,
        e=_EDGES.replace(" AND CRSElapsedTime IS NOT NULL", ""),
        w=_WIDE.replace(" AND CRSElapsedTime IS NOT NULL", ""),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.heat2d(labelled(spark, sf), "TaxiOut", "AirTime", "y"))


def _worst(i: int, low: bool) -> str:
    return f"b{i} = {'0' if low else f't{i}'}"


_LOW = {"AirTime"}


@query(
    "interaction_scores",
    "A15",
    b.sql(
        "flights",
        " UNION ALL ".join(
            f"SELECT '{FEATS[i]}' AS feature_a, '{FEATS[j]}' AS feature_b, round(j{i}{j}, 6) + 0.0 AS joint_worst, round(m{i} * m{j} / base, 6) + 0.0 AS expected, "
            f"round(j{i}{j} / (m{i} * m{j} / base), 6) + 0.0 AS score FROM a"
            for i, j in combinations(range(3), 2)
        ),
        l=LAB,
        e=_EDGES,
        w=_WIDE,
        a="SELECT avg(y) AS base, "
        + ", ".join(f"avg(y) FILTER ({_worst(i, f in _LOW)}) AS m{i}" for i, f in enumerate(FEATS))
        + ", "
        + ", ".join(
            f"avg(y) FILTER ({_worst(i, FEATS[i] in _LOW)} AND {_worst(j, FEATS[j] in _LOW)}) AS j{i}{j}" for i, j in combinations(range(3), 2)
        )
        + " FROM w",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.interaction_scores(labelled(spark, sf), FEATS, "y", ["AirTime"]))


PAIRS = [("TaxiOut", "y"), ("AirTime", "y"), ("AirTime", "DepDelayMinutes"), ("NASDelay", "ArrDelayMinutes")]


@query(
    "pearson_table",
    "A21",
    b.sql(
        "flights",
        " UNION ALL ".join(
            f"SELECT '{x}' AS feature, '{y}' AS target, round(corr({x}, {y}), 6) + 0.0 AS r, count(*) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM l" for x, y in PAIRS
        ),
        l=LAB,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.pearson(labelled(spark, sf), PAIRS))


def rho_sql(source: str, x: str, y: str, by: str = "") -> str:
    """Rank both columns over the rows where both are known, ties averaged, then correlate."""
    part = f"PARTITION BY {by}" if by else ""
    key = f"{by}, " if by else ""
    tie = f"PARTITION BY {key}" if by else "PARTITION BY "
    return (
        f"SELECT {key}'{x}' AS feature, '{y}' AS target, count(*) AS n, corr(rx, ry) AS rho FROM (SELECT {key}rank() OVER ({part} ORDER BY {x}) + (count(*) OVER ({tie}{x}) - 1) / 2 AS rx, "
        f"rank() OVER ({part} ORDER BY {y}) + (count(*) OVER ({tie}{y}) - 1) / 2 AS ry FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) GROUP BY ALL"
    )


@query(
    "spearman_table",
    "A22",
    b.sql(
        "flights",
        "SELECT feature, target, n, round(rho, 6) + 0.0 AS rho FROM (" + " UNION ALL ".join(rho_sql("l", x, y) for x, y in PAIRS) + ")",
        l=LAB,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.spearman(labelled(spark, sf), PAIRS))


@query(
    "spearman_by_group",
    "A22",
    b.sql(
        "flights",
        "SELECT region, feature, target, n, round(rho, 6) + 0.0 AS rho FROM (" + " UNION ALL ".join(rho_sql("l", x, y, "region") for x, y in PAIRS[:2]) + ")",
        l=LAB,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.spearman(labelled(spark, sf), PAIRS[:2], ["region"]))


MATRIX = ["AirTime", "ActualElapsedTime", "CRSElapsedTime", "TaxiOut", "TaxiIn"]
_HALF = " UNION ALL ".join(rho_sql("flights", x, y) for x, y in combinations(MATRIX, 2))


@query(
    "spearman_matrix",
    "A22",
    b.sql(
        "flights",
        "SELECT feature, target, n, round(rho, 6) + 0.0 AS rho FROM h UNION ALL SELECT target, feature, n, round(rho, 6) + 0.0 FROM h",
        h=_HALF,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.spearman_matrix(b.flights(spark, sf), MATRIX))


# Every numeric column of the flights; some are unknown in rows of their own.
NUMERIC = (
    "CRSDepTime CRSArrTime WheelsOff DepDelayMinutes ArrDelayMinutes CarrierDelay WeatherDelay NASDelay LateAircraftDelay Cancelled Diverted "
    "CRSElapsedTime ActualElapsedTime AirTime TaxiOut TaxiIn Distance"
).split()


@query(
    "spearman_every_pair",
    "A22 A33",
    b.sql(
        "flights",
        "SELECT feature, target, n, round(rho, 6) + 0.0 AS rho FROM h",
        h=" UNION ALL ".join(rho_sql("flights", x, y) for x, y in combinations(NUMERIC, 2)),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.spearman(b.flights(spark, sf), list(combinations(NUMERIC, 2))))


@query(
    "partial_spearman",
    "A23",
    b.sql(
        "flights",
        "SELECT round(rho, 4) + 0.0 AS partial_rho, n FROM (" + rho_sql("res", "ex", "ey") + ")",
        v="SELECT AirTime AS x, DepDelayMinutes AS yv, TaxiOut AS z FROM flights WHERE AirTime IS NOT NULL AND DepDelayMinutes IS NOT NULL AND TaxiOut IS NOT NULL",
        fit="SELECT regr_slope(x, z) AS ax, regr_intercept(x, z) AS bx, regr_slope(yv, z) AS ay, regr_intercept(yv, z) AS by_ FROM v",
        res="SELECT round(x - (ax * z + bx), 9) AS ex, round(yv - (ay * z + by_), 9) AS ey FROM v, fit",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.partial_spearman(b.flights(spark, sf), "AirTime", "DepDelayMinutes", "TaxiOut"), 4)


@query(
    "group_comparison",
    "A24",
    b.sql(
        "flights",
        "SELECT n_active, n_inactive, round(ma, 6) + 0.0 AS mean_active, round(mi, 6) + 0.0 AS mean_inactive, round(ma - mi, 6) + 0.0 AS mean_diff, round((ma - mi) / sqrt(va + vi), 6) + 0.0 AS welch_t, "
        "round((va + vi) * (va + vi) / (va * va / (na - 1) + vi * vi / (ni - 1)), 4) + 0.0 AS welch_df, round((ma - mi) / s, 6) + 0.0 AS cohens_d, round(ra, 6) + 0.0 AS rate_active, "
        "round(ri, 6) + 0.0 AS rate_inactive, round(ra / ri, 6) + 0.0 AS lift, round(r, 6) + 0.0 AS point_biserial_r, "
        "round(2 * exp(lgamma((nu + 1) / 2) - lgamma(nu / 2)) / sqrt(pi()) * area, 6) + 0.0 AS p_value FROM g, w, tail",
        x="SELECT DepDelayMinutes AS v, CAST(CarrierDelay > 0 AS INT) AS f, CAST(coalesce(DepDelayMinutes >= 15, false) AS DOUBLE) AS late FROM flights",
        g="SELECT count(*) FILTER (f = 1) AS n_active, count(*) FILTER (f = 0) AS n_inactive, avg(v) FILTER (f = 1) AS ma, avg(v) FILTER (f = 0) AS mi, "
        "var_samp(v) FILTER (f = 1) / (count(v) FILTER (f = 1)) AS va, var_samp(v) FILTER (f = 0) / (count(v) FILTER (f = 0)) AS vi, count(v) FILTER (f = 1) AS na, count(v) FILTER (f = 0) AS ni, "
        "stddev_samp(v) AS s, avg(late) FILTER (f = 1) AS ra, avg(late) FILTER (f = 0) AS ri, corr(f, v) AS r FROM x",
        # The tail of Student's t by Simpson's rule over the angle whose tangent is t / sqrt(nu).
        w="SELECT abs(ma - mi) / sqrt(va + vi) AS t, (va + vi) * (va + vi) / (va * va / (na - 1) + vi * vi / (ni - 1)) AS nu FROM g",
        steps="SELECT atan(t / sqrt(nu)) AS low, (pi() / 2 - atan(t / sqrt(nu))) / 40000 AS h, nu, unnest(range(0, 40001)) AS i FROM w",
        tail="SELECT sum(CASE WHEN i IN (0, 40000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(greatest(cos(low + i * h), 0), nu - 1)) * any_value(h) / 3 AS area FROM steps",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf).withColumn("f", (F.col("CarrierDelay") > 0).cast("int"))
    made = plain(stats.compare_groups(f, "f", "DepDelayMinutes"))
    return made.withColumn("welch_df", F.round("welch_df", 4))


@query(
    "continuous_effect",
    "A25",
    b.sql(
        "flights",
        "SELECT 'AirTime' AS feature, n, round(r, 6) + 0.0 AS r, round(rho, 6) + 0.0 AS rho, round(m1, 6) + 0.0 AS mean_q1, round(m4, 6) + 0.0 AS mean_q4, round(m4 - m1, 6) + 0.0 AS diff_q4_q1 "
        "FROM p, s, c",
        v="SELECT AirTime, DepDelayMinutes FROM flights WHERE AirTime IS NOT NULL AND DepDelayMinutes IS NOT NULL",
        p="SELECT corr(AirTime, DepDelayMinutes) AS r FROM v",
        s=rho_sql("v", "AirTime", "DepDelayMinutes"),
        q=bins_sql("v", ["AirTime"], 4, "DepDelayMinutes"),
        c="SELECT avg(DepDelayMinutes) FILTER (bin = 0) AS m1, avg(DepDelayMinutes) FILTER (bin = n_bins - 1) AS m4 FROM q",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.continuous_effect(b.flights(spark, sf), "AirTime", "DepDelayMinutes"))


@query(
    "severity_levels",
    "A26",
    b.sql(
        "flights",
        "SELECT CAST(l_level AS INT) AS level, count(*) AS n, round(avg(DepDelayMinutes), 6) + 0.0 AS mean_delay, round(100 * avg(CAST(coalesce(DepDelayMinutes >= 15, false) AS DOUBLE)), 6) + 0.0 AS delay_rate_15 "
        "FROM (SELECT *, CASE WHEN TaxiIn < 7 THEN TaxiIn END AS l_level FROM flights) WHERE l_level IS NOT NULL GROUP BY l_level",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf).withColumn("level", F.expr("CAST(CASE WHEN TaxiIn < 7 THEN TaxiIn END AS INT)"))
    return plain(stats.by_level(f, "level", "DepDelayMinutes"))


def _chi(a: str, c: str) -> str:
    return (
        f"SELECT '{a}' AS feature, '{c}' AS label, CAST(max(n) AS BIGINT) AS n, sum(pow(abs(o - e) - CASE WHEN max_r = 2 AND max_c = 2 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e) AS chi2, min(least(max_r, max_c)) - 1 AS dim FROM "
        f"(SELECT coalesce(o, 0) AS o, nu * nv / n AS e, n, max_r, max_c FROM (SELECT u, count(*) AS nu FROM (SELECT {a} AS u FROM l) GROUP BY u), (SELECT v, count(*) AS nv FROM (SELECT {c} AS v FROM l) GROUP BY v), "
        f"(SELECT count(*) AS n, count(DISTINCT {a}) AS max_r, count(DISTINCT {c}) AS max_c FROM l) LEFT JOIN (SELECT {a} AS u2, {c} AS v2, count(*) AS o FROM l GROUP BY ALL) ON u = u2 AND v = v2) GROUP BY ALL"
    )


@query(
    "cramers_v",
    "A28",
    b.sql(
        "flights",
        "SELECT feature, label, n, round(chi2, 6) + 0.0 AS chi2, round(CASE WHEN dim > 0 THEN sqrt(chi2 / (n * dim)) ELSE 0 END, 6) + 0.0 AS cramers_v FROM ("
        + " UNION ALL ".join(f"SELECT feature, label, n, sum(chi2) AS chi2, min(dim) AS dim FROM ({_chi(a, c)}) GROUP BY ALL" for a, c in (("Origin", "y"), ("Reporting_Airline", "Dest"), ("cancelled_flag", "y")))
        + ")",
        l0=LAB,
        l="SELECT *, CAST(Cancelled AS INT) AS cancelled_flag FROM l0",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = labelled(spark, sf).withColumn("cancelled_flag", F.col("Cancelled").cast("int"))
    return plain(stats.cramers_v(f, [("Origin", "y"), ("Reporting_Airline", "Dest"), ("cancelled_flag", "y")]))


@query(
    "mutual_information",
    "A29",
    b.sql(
        "flights",
        "SELECT feature, round(sum(o / n * ln(o * n / (nb * ny))), 6) + 0.0 AS mi, CAST(max(n) AS BIGINT) AS n FROM "
        "(SELECT feature, o, CAST(sum(o) OVER (PARTITION BY feature) AS DOUBLE) AS n, CAST(sum(o) OVER (PARTITION BY feature, bin) AS DOUBLE) AS nb, CAST(sum(o) OVER (PARTITION BY feature, y) AS DOUBLE) AS ny "
        "FROM (SELECT feature, bin, y, CAST(count(*) AS DOUBLE) AS o FROM q GROUP BY ALL)) GROUP BY feature",
        l=LAB,
        q=bins_sql("l", FEATS, 10, "y"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.mutual_information(labelled(spark, sf), FEATS, "y"))


@query(
    "ks_statistic",
    "A30",
    b.sql(
        "flights",
        "SELECT feature, round(max(abs(ca / na - cb / nb)), 6) + 0.0 AS ks, CAST(max(na) AS BIGINT) AS n_flagged, CAST(max(nb) AS BIGINT) AS n_other FROM (SELECT feature, sum(a) OVER w AS ca, sum(z) OVER w AS cb, "
        "sum(a) OVER (PARTITION BY feature) AS na, sum(z) OVER (PARTITION BY feature) AS nb FROM g WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY feature",
        l=LAB,
        g=" UNION ALL ".join(
            f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, count(*) FILTER (y = 1) AS a, count(*) FILTER (y = 0) AS z FROM l WHERE {f} IS NOT NULL GROUP BY {f}" for f in FEATS
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.ks_statistic(labelled(spark, sf), FEATS, "y"))


@query(
    "distribution_moments",
    "A31",
    b.sql(
        "flights",
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, count({f}) AS n, round(avg({f}), 6) + 0.0 AS mean, round(stddev_samp({f}), 6) + 0.0 AS std, round(skewness({f}), 6) + 0.0 AS skew FROM flights" for f in FEATS
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.moments(b.flights(spark, sf), FEATS))


@query(
    "sensitivity_slopes",
    "A32",
    b.sql(
        "flights",
        "SELECT region, feature, CAST(sum(n) AS BIGINT) AS n, round(CASE WHEN sum(n) >= 100 AND count(*) >= 2 THEN regr_slope(rate, med) * 1000 ELSE 0 END, 4) + 0.0 AS slope_per_1000 "
        "FROM (SELECT region, feature, bin, count(*) AS n, avg(y) AS rate, quantile_cont(value, 0.5) AS med FROM q GROUP BY ALL) GROUP BY ALL",
        l=LAB,
        q=bins_sql("l", FEATS, 5, "y", "region"),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    made = stats.sensitivity_slopes(labelled(spark, sf), FEATS, "y", "region")
    return made.withColumn("slope_per_1000", F.round("slope_per_1000", 4) + F.lit(0.0))


@query(
    "redundant_pairs",
    "A33",
    b.sql("flights", "SELECT feature, target, n, round(rho, 6) + 0.0 AS rho FROM h WHERE abs(rho) > 0.85", h=_HALF),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.redundant_pairs(b.flights(spark, sf), MATRIX))


@query(
    "best_partner",
    "A33",
    b.sql(
        "flights",
        "SELECT feature, arg_max(target, abs(rho)) AS partner, round(arg_max(rho, abs(rho)), 6) + 0.0 AS rho, max(abs(rho)) > 0.85 AS redundant FROM h GROUP BY feature",
        h=" UNION ALL ".join(rho_sql("flights", x, y) for x in ("AirTime", "TaxiIn") for y in ("CRSElapsedTime", "ActualElapsedTime", "TaxiOut")),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.best_partner(b.flights(spark, sf), ["AirTime", "TaxiIn"], ["CRSElapsedTime", "ActualElapsedTime", "TaxiOut"]))


@query(
    "drop_rules",
    "A33",
    b.sql(
        "flights",
        "SELECT h.feature, i.importance, round(u.null_rate, 6) + 0.0 AS null_rate, h.partner, round(h.rho, 6) + 0.0 AS partner_rho, concat_ws(',', CASE WHEN i.importance < 0.5 THEN 'low_importance' END, "
        "CASE WHEN abs(h.rho) > 0.9 AND i.importance < j.importance THEN 'redundant' END, CASE WHEN u.null_rate > 0.3 THEN 'high_null' END) AS reasons, "
        "(i.importance < 0.5 OR (abs(h.rho) > 0.9 AND i.importance < j.importance) OR u.null_rate > 0.3) AS recommend_drop FROM h JOIN i ON i.feature = h.feature JOIN i j ON j.feature = h.partner JOIN u ON u.feature = h.feature",
        h0=_HALF,
        h1="SELECT feature, target, rho FROM h0 UNION ALL SELECT target, feature, rho FROM h0",
        h="SELECT feature, arg_max(target, abs(rho)) AS partner, arg_max(rho, abs(rho)) AS rho FROM h1 GROUP BY feature",
        i=" UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}) / 60, 3) AS importance FROM flights" for c in MATRIX),
        u=" UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CAST({c} IS NULL AS DOUBLE)) AS null_rate FROM flights" for c in MATRIX),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    from tarmac.operators.ranks import long_form

    f = b.flights(spark, sf)
    per = long_form(f, MATRIX).groupBy("feature").agg(
        F.round(F.avg("value") / 60, 3).alias("importance"), F.avg(F.col("value").isNull().cast("double")).alias("null_rate")
    )
    made = stats.drop_rules(per.select("feature", "importance"), stats.spearman_matrix(f, MATRIX), per.select("feature", "null_rate"))
    return plain(made)


@query(
    "split_half_persistence",
    "A36",
    b.sql(
        "flights",
        "SELECT Tail_Number, round(avg(y) FILTER (d < m), 6) + 0.0 AS rate_before, round(avg(y) FILTER (d >= m), 6) + 0.0 AS rate_after, count(*) FILTER (d < m) AS n_before, count(*) FILTER (d >= m) AS n_after "
        "FROM (SELECT *, date_diff('day', DATE '1970-01-01', FlightDate) AS d FROM l), (SELECT quantile_cont(date_diff('day', DATE '1970-01-01', FlightDate), 0.5) AS m FROM l) GROUP BY Tail_Number "
        "HAVING count(*) FILTER (d < m) > 20 AND count(*) FILTER (d >= m) > 20",
        l=LAB,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.persistence(labelled(spark, sf), "Tail_Number", "y"))


@query(
    "monthly_means",
    "A37",
    b.sql("flights", "SELECT month, round(avg(y), 6) + 0.0 AS delay_rate, round(avg(TaxiOut), 6) + 0.0 AS \"mean_TaxiOut\", round(avg(AirTime), 6) + 0.0 AS \"mean_AirTime\" FROM l GROUP BY month", l=LAB),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.monthly_means(labelled(spark, sf), F.col("month"), "y", ["TaxiOut", "AirTime"]))


@query(
    "regional_rates",
    "A37 A12",
    b.sql("flights", "SELECT region, round(avg(y), 6) + 0.0 AS rate, count(y) AS n FROM l GROUP BY region", l=LAB),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.rate_by(labelled(spark, sf), ["region"], "y"))


@query(
    "busiest_by_month",
    "A37 L11",
    b.sql(
        "flights",
        "SELECT Origin, " + ", ".join(f"round(avg(y) FILTER (month = {m}), 6) + 0.0 AS m{m}" for m in range(1, 13)) + " FROM l JOIN t USING (Origin) GROUP BY Origin",
        l=LAB,
        t="SELECT Origin FROM l GROUP BY Origin ORDER BY count(*) DESC, Origin LIMIT 10",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.top_by_month(labelled(spark, sf), "Origin", F.col("month"), "y", 10))


@query(
    "shared_severe_weather",
    "A38 P40 U05",
    b.sql(
        "flights",
        "SELECT Origin, " + ", ".join(f"round(avg(y) FILTER (Reporting_Airline = '{c}'), 6) + 0.0 AS {c}" for c in b.CARRIERS) + " FROM s JOIN k USING (Origin) GROUP BY Origin",
        l=LAB,
        s="SELECT * FROM l WHERE WeatherDelay > 45",
        k="SELECT Origin FROM s GROUP BY Origin HAVING count(DISTINCT Reporting_Airline) >= 3",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.shared_severe(labelled(spark, sf), F.col("WeatherDelay") > 45, "Origin", "Reporting_Airline", b.CARRIERS, "y"))


@query(
    "rate_spread",
    "A38",
    b.sql(
        "flights",
        "SELECT Reporting_Airline, round(max(r) - min(r), 6) + 0.0 AS spread, count(*) AS n_keys FROM (SELECT Reporting_Airline, Origin, avg(y) AS r FROM l GROUP BY ALL HAVING count(y) >= 50) GROUP BY ALL",
        l=LAB,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.rate_spread(labelled(spark, sf), "Reporting_Airline", "Origin", "y", 50))


@query(
    "domain_ratios",
    "A41",
    b.sql(
        "",
        "SELECT round(coalesce(late, 0) / greatest(coalesce(dayt, 0), 0.01), 6) + 0.0 AS late_evening_vs_daytime_ratio, round(lcc / greatest(fsc, 0.01), 6) + 0.0 AS lcc_vs_fsc_ratio, "
        "round(peak, 6) + 0.0 AS tech_concentration_ratio FROM (SELECT avg(crew) FILTER (hour >= 22) AS late, avg(crew) FILTER (hour BETWEEN 6 AND 17) AS dayt, max(tech) / avg(tech) AS peak FROM h), "
        "(SELECT avg(CAST(delay_domain = 'Airline-Ramp' AS DOUBLE)) FILTER (is_lcc = 1) AS lcc, avg(CAST(delay_domain = 'Airline-Ramp' AS DOUBLE)) FILTER (is_lcc = 0) AS fsc FROM c)",
        c=CAUSES,
        h="SELECT hour, avg(CAST(delay_domain = 'Crew' AS DOUBLE)) AS crew, avg(CAST(delay_domain = 'Aircraft-Tech' AS DOUBLE)) AS tech FROM c GROUP BY hour",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.domain_ratios(causes(spark, sf), "hour", "is_lcc"))


_DOMAIN_PAIRS = [(f, f"is_delayed_{d}") for f in ("value", "hour") for d in lookups.DOMAINS]


@query(
    "domain_correlation",
    "A42",
    b.sql(
        "",
        "SELECT feature, target, n, round(rho, 6) + 0.0 AS rho FROM ("
        + " UNION ALL ".join(rho_sql("w", f, f'"{t}"').replace(f"'\"{t}\"'", f"'{t}'") for f, t in _DOMAIN_PAIRS)
        + ")",
        c=CAUSES,
        w="SELECT *, " + ", ".join(f"CAST(delay_domain = '{d}' AS INT) AS \"is_delayed_{d}\"" for d in lookups.DOMAINS) + " FROM c",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.spearman(causes(spark, sf), _DOMAIN_PAIRS))
