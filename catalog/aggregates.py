"""Rate tables, profiles and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import lookups
from tarmac.operators import daily, evaluate, joins, stats

from . import bindings as b
from .registry import plain, query

LATE = "(DepDelayMinutes >= 15)"
Y = "CAST(coalesce(DepDelayMinutes, 0) >= 15 AS INT)"


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    y = (F.coalesce("DepDelayMinutes", F.lit(0.0)) >= 15).cast("int")
    return b.flights(spark, sf).withColumns({"y": y, "month": F.month("FlightDate"), "region": lookups.us_region(F.col("Origin"))})


_REGION = lookups.REGION
_REGION_SQL = "CASE Origin " + " ".join(f"WHEN '{a}' THEN '{_REGION.get(a, 'Other')}'" for a in b.AIRPORTS) + " END"
LAB = f"SELECT *, {Y} AS y, CAST(month(FlightDate) AS INT) AS month, {_REGION_SQL} AS region FROM flights"


@query(
    "rate_by_category",
    "A08",
    b.sql(
        "flights",
        "SELECT Origin, Dest, round(avg(y), 6) + 0.0 AS rate, count(y) AS n FROM l GROUP BY ALL HAVING count(y) >= 400",
        l=LAB,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.rate_by(labelled(spark, sf), ["Origin", "Dest"], "y", 400))


@query(
    "rate_crosstab",
    "A09",
    b.sql(
        "flights",
        "SELECT Origin, " + ", ".join(f"round(avg(y) FILTER (Reporting_Airline = '{c}'), 6) + 0.0 AS {c}" for c in b.CARRIERS) + " FROM l GROUP BY Origin",
        l=LAB,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.crosstab_mean(labelled(spark, sf), "Origin", "Reporting_Airline", b.CARRIERS, "y"))


NUMERIC = ["DepDelayMinutes", "ArrDelayMinutes", "NASDelay", "TaxiOut", "CRSDepTime"]


def _profile(std: str) -> str:
    arms = []
    for c in NUMERIC:
        cuts = ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) + 0.0 AS p{round(p * 100):02d}" for p in stats.PERCENTILES)
        arms.append(
            f"SELECT '{c}' AS feature, count(*) AS count, count({c}) AS non_null_count, count(*) - count({c}) AS null_count, "
            f"round(100.0 * (count(*) - count({c})) / count(*), 6) + 0.0 AS null_pct, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"round(avg({c}), 6) + 0.0 AS mean, round({std}({c}), 6) + 0.0 AS std, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) + 0.0 AS median, {cuts} FROM flights"
        )
    return b.sql("flights", " UNION ALL ".join(arms))


@query("numeric_profile", "A10", _profile("stddev_pop"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.numeric_stats(b.flights(spark, sf), NUMERIC))


@query("health_profile", "A11", _profile("stddev_samp"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.numeric_stats(b.flights(spark, sf), NUMERIC, sample_std=True))


TEXTS = ["Origin", "Dest", "Reporting_Airline", "Tail_Number"]


@query(
    "categorical_profile",
    "A10",
    b.sql(
        "flights",
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count(*) AS count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS unique_count FROM flights" for c in TEXTS
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return stats.categorical_stats(b.flights(spark, sf), TEXTS)


@query(
    "top_values",
    "A12 L11",
    b.sql(
        "flights",
        " UNION ALL ".join(
            f"SELECT * FROM (SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INT) AS rank "
            f"FROM flights WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 5"
            for c in [*TEXTS, "CRSDepTime"]
        ),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_values(b.flights(spark, sf), [*TEXTS, "CRSDepTime"])


@query(
    "dataset_profile",
    "A10 A11",
    b.sql(
        "flights",
        f"SELECT count(*) AS row_count, CAST({len(b._FLIGHT) + 3} AS INT) AS column_count, CAST(min(FlightDate) AS VARCHAR) AS date_min, CAST(max(FlightDate) AS VARCHAR) AS date_max, "
        "(SELECT string_agg(c, ',' ORDER BY c) FROM (SELECT DISTINCT Reporting_Airline AS c FROM flights)) AS airlines FROM flights",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stats.dataset_stats(b.flights(spark, sf)))


# --- metrics ------------------------------------------------------------------------------------


@query(
    "reliability_table",
    "A16",
    b.sql(
        "scored",
        "SELECT bin, count(*) AS count, round(avg(p), 6) + 0.0 AS mean_pred, round(avg(y), 6) + 0.0 AS empirical_pos_rate, round((bin - 1) / 10, 6) + 0.0 AS bin_left, "
        "round(bin / 10, 6) + 0.0 AS bin_right, round((2 * bin - 1) / 20, 6) + 0.0 AS bin_mid FROM (SELECT *, CAST(ceil(p * 10) AS INT) AS bin FROM scored) WHERE bin > 0 GROUP BY bin",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(evaluate.reliability(b.scored(spark, sf), "y", "p"))


_AUC = (
    "SELECT lang, sum(y) AS n_pos, count(*) - sum(y) AS n_neg, "
    "(sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS a FROM "
    "(SELECT *, rank() OVER w0 + (count(*) OVER w1 - 1) / 2 AS rk FROM scored WINDOW w0 AS (PARTITION BY lang ORDER BY p), w1 AS (PARTITION BY lang, p)) GROUP BY lang"
)


@query(
    "auc_by_group",
    "A17",
    b.sql(
        "scored",
        "SELECT lang, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN a END, 6) + 0.0 AS auc FROM s",
        s=_AUC,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(evaluate.auc_table(b.scored(spark, sf), ["lang"], "y", "p"))


@query(
    "auc_folded",
    "A17",
    b.sql(
        "scored",
        "SELECT lang, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, round(CASE WHEN n_pos > 0 AND n_neg > 0 AND n_pos + n_neg >= 20 THEN greatest(a, 1 - a) END, 6) + 0.0 AS auc FROM s",
        s=_AUC,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(evaluate.auc_table(b.scored(spark, sf), ["lang"], "y", "p", fold=True, least=20))


@query(
    "youden_cut",
    "A18",
    b.sql(
        "scored",
        "SELECT round(threshold, 6) + 0.0 AS threshold, round(tpr, 6) + 0.0 AS tpr, round(fpr, 6) + 0.0 AS fpr FROM c ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1",
        t="SELECT sum(y) AS np, count(*) - sum(y) AS nn FROM scored",
        c="SELECT p AS threshold, (sum(sum(y)) OVER w) / np AS tpr, (sum(count(*) - sum(y)) OVER w) / nn AS fpr FROM scored, t GROUP BY p, np, nn WINDOW w AS (ORDER BY p DESC)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(evaluate.youden(b.scored(spark, sf), "y", "p"))


_KEPT = "greatest(0.000001, least(0.999999, p))"


@query(
    "score_metrics",
    "A19",
    b.sql(
        "scored",
        f"SELECT source, count(*) AS n, round(avg(-(y * ln({_KEPT}) + (1 - y) * ln(1 - {_KEPT}))), 6) + 0.0 AS log_loss, round(avg((p - y) * (p - y)), 6) + 0.0 AS brier FROM scored GROUP BY source",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(evaluate.score_metrics(b.scored(spark, sf), "y", "p", ["source"]))


@query(
    "average_precision",
    "A19",
    b.sql(
        "scored",
        "SELECT source, round(sum(dp / np * cp / (cp + cn)), 6) + 0.0 AS average_precision FROM c GROUP BY source",
        g="SELECT source, p, sum(y) AS dp, count(*) - sum(y) AS dn FROM scored GROUP BY ALL",
        c="SELECT source, dp, sum(dp) OVER (PARTITION BY source) AS np, sum(dp) OVER w AS cp, sum(dn) OVER w AS cn FROM g WINDOW w AS (PARTITION BY source ORDER BY p DESC)",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(evaluate.average_precision(b.scored(spark, sf), "y", "p", ["source"]))


@query(
    "multiclass_metrics",
    "A19 P28 P32",
    b.sql(
        "",
        "SELECT count(*) AS n, round(avg(-ln(greatest(1e-15, least(1 - 1e-15, CASE t WHEN 0 THEN a WHEN 1 THEN bb WHEN 2 THEN c ELSE d END)))), 6) + 0.0 AS log_loss, "
        "round(avg(CAST(t = g AS DOUBLE)), 6) + 0.0 AS accuracy FROM x",
        x="SELECT l_linenumber % 4 AS t, l_suppkey % 4 AS g, (1 + l_partkey % 3) / 10.0 AS a, 0.2 AS bb, 0.3 AS c, (4 - l_partkey % 3) / 10.0 AS d FROM lineitem",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = b.table(spark, sf, "lineitem").select(
        F.expr("l_linenumber % 4").alias("t"),
        F.expr("CAST(l_suppkey % 4 AS INT)").alias("g"),
        F.expr("array((1 + l_partkey % 3) / 10.0D, 0.2D, 0.3D, (4 - l_partkey % 3) / 10.0D)").alias("dist"),
    )
    return plain(evaluate.multiclass_metrics(t, "t", "dist", "g"))


@query(
    "confusion_matrix",
    "A20",
    b.sql("scored", "SELECT y AS actual, CAST(p >= 0.3 AS INT) AS predicted, count(*) AS n FROM scored GROUP BY ALL"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(b.scored(spark, sf).withColumn("hat", (F.col("p") >= 0.3).cast("int")), "y", "hat")


@query(
    "class_report",
    "A20",
    b.sql(
        "scored",
        " UNION ALL ".join(
            f"SELECT CAST({k} AS INT) AS label, round(coalesce(count(*) FILTER (y = {k} AND h = {k}) / nullif(count(*) FILTER (h = {k}), 0), 0), 6) + 0.0 AS precision, "
            f"round(coalesce(count(*) FILTER (y = {k} AND h = {k}) / nullif(count(*) FILTER (y = {k}), 0), 0), 6) + 0.0 AS recall, "
            f"round(coalesce(2 * count(*) FILTER (y = {k} AND h = {k}) / nullif(count(*) FILTER (y = {k}) + count(*) FILTER (h = {k}), 0), 0), 6) + 0.0 AS f1, "
            f"count(*) FILTER (y = {k}) AS support FROM x"
            for k in (0, 1)
        ),
        x="SELECT y, CAST(p >= 0.3 AS INT) AS h FROM scored",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(evaluate.class_report(b.scored(spark, sf).withColumn("hat", (F.col("p") >= 0.3).cast("int")), "y", "hat"))


# --- parity and gate ----------------------------------------------------------------------------

_SNAP_KEYS = ["Reporting_Airline", "Origin", "FlightDate"]


def snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two feature tables on one key: means, and the same disturbed on some keys."""
    base = b.flights(spark, sf).groupBy(*_SNAP_KEYS).agg(
        F.avg("DepDelayMinutes").alias("carrier_mean"), F.sum("TaxiOut").alias("taxi"), F.max("Dest").alias("dest")
    )
    served = base.select(
        *_SNAP_KEYS,
        F.expr("CASE WHEN day(FlightDate) % 3 = 0 THEN carrier_mean + 1.5D WHEN day(FlightDate) % 7 = 0 THEN NULL ELSE carrier_mean END").alias("carrier_mean"),
        F.expr("CASE WHEN Origin = 'DEN' THEN taxi * 2 ELSE taxi END").alias("taxi"),
        F.expr("CASE WHEN Origin = 'ATL' THEN 'XXX' ELSE dest END").alias("dest"),
    )
    return base, served


SNAP_A = "SELECT Reporting_Airline, Origin, FlightDate, avg(DepDelayMinutes) AS carrier_mean, sum(TaxiOut) AS taxi, max(Dest) AS dest FROM flights GROUP BY ALL"
SNAP_B = (
    "SELECT Reporting_Airline, Origin, FlightDate, CASE WHEN day(FlightDate) % 3 = 0 THEN carrier_mean + 1.5 WHEN day(FlightDate) % 7 = 0 THEN NULL ELSE carrier_mean END AS carrier_mean, "
    "CASE WHEN Origin = 'DEN' THEN taxi * 2 ELSE taxi END AS taxi, CASE WHEN Origin = 'ATL' THEN 'XXX' ELSE dest END AS dest FROM sa"
)


def diff_sql() -> str:
    arms = []
    for c, text in (("carrier_mean", False), ("taxi", False), ("dest", True)):
        delta = "CAST(NULL AS DOUBLE)" if text else f"sb.{c} - sa.{c}"
        match = f"sa.{c} = sb.{c}" if text else "CAST(NULL AS BOOLEAN)"
        arms.append(
            f"SELECT sa.Reporting_Airline, sa.Origin, sa.FlightDate, '{c}' AS feature, sa.{c} IS NOT NULL AS ka, sb.{c} IS NOT NULL AS kb, {delta} AS delta, {match} AS match "
            "FROM sa JOIN sb USING (Reporting_Airline, Origin, FlightDate)"
        )
    return " UNION ALL ".join(arms)


@query(
    "snapshot_diff",
    "J16",
    b.sql(
        "flights",
        "SELECT Reporting_Airline, Origin, CAST(FlightDate AS VARCHAR) AS FlightDate, feature, CAST(ka AS INT) AS ka, CAST(kb AS INT) AS kb, round(delta, 6) + 0.0 AS delta, CAST(match AS INT) AS match FROM d",
        sa=SNAP_A,
        sb=SNAP_B,
        d=diff_sql(),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, c = snapshots(spark, sf)
    d = joins.diff_snapshots(a, c, _SNAP_KEYS, ["carrier_mean", "taxi"], ["dest"])
    known = d.withColumns(
        {
            "ka": F.col("trained").isNotNull().cast("int"),
            "kb": F.col("served").isNotNull().cast("int"),
            "match": F.col("match").cast("int"),
        }
    )
    return plain(known.select(*_SNAP_KEYS, "feature", "ka", "kb", "delta", "match"))


@query(
    "parity_summary",
    "A39",
    b.sql(
        "flights",
        "SELECT feature, count(*) AS n_total, count(*) FILTER (ka AND kb) AS n_both_present, count(*) FILTER (ka AND NOT kb) AS n_only_trained, count(*) FILTER (NOT ka AND kb) AS n_only_served, "
        "count(*) FILTER (coalesce(match, abs(delta) < 1e-9)) AS n_match, count(*) FILTER (coalesce(NOT match, abs(delta) >= 0.001)) AS n_mismatch, "
        "round(avg(delta), 6) + 0.0 AS delta_mean, round(avg(abs(delta)), 6) + 0.0 AS abs_delta_mean, round(quantile_cont(abs(delta), 0.95), 6) + 0.0 AS abs_delta_p95, "
        "round(max(abs(delta)), 6) + 0.0 AS abs_delta_max, round(round(count(*) FILTER (coalesce(match, abs(delta) < 1e-9)) / greatest(count(*) FILTER (ka AND kb), 1), 4), 6) + 0.0 AS match_rate "
        "FROM d GROUP BY feature",
        sa=SNAP_A,
        sb=SNAP_B,
        d=diff_sql(),
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, c = snapshots(spark, sf)
    return plain(evaluate.parity_summary(joins.diff_snapshots(a, c, _SNAP_KEYS, ["carrier_mean", "taxi"], ["dest"])))


def _gate_rows(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    return f.select("Reporting_Airline", "DepDelayMinutes", *[F.expr(f"(TaxiOut + {t} / 15) / 60.0D").alias(f"p_ge{t}") for t in (15, 60)])


@query(
    "auc_gate",
    "A40",
    b.sql(
        "flights",
        "SELECT carrier, thr, count(*) AS n, round(avg(y), 6) + 0.0 AS actual_rate, round(avg(p), 6) + 0.0 AS pred_rate, round(avg((p - y) * (p - y)), 6) + 0.0 AS brier, "
        "round((sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) + 0.0 AS auc, 0.5 + max(ascii(carrier)) / 1000.0 AS reference_auc, "
        "round((sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) - (0.5 + max(ascii(carrier)) / 1000.0), 6) + 0.0 AS auc_gap FROM k GROUP BY ALL",
        x=" UNION ALL ".join(
            f"SELECT Reporting_Airline AS carrier, CAST({t} AS INT) AS thr, CAST(DepDelayMinutes >= {t} AS INT) AS y, (TaxiOut + {t} / 15) / 60.0 AS p FROM flights WHERE DepDelayMinutes IS NOT NULL"
            for t in (15, 60)
        ),
        k="SELECT *, rank() OVER (PARTITION BY carrier, thr ORDER BY p) + (count(*) OVER (PARTITION BY carrier, thr, p) - 1) / 2 AS rk FROM x",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = _gate_rows(spark, sf)
    reference = rows.select(F.col("Reporting_Airline").alias("carrier")).distinct().select(
        "carrier", F.explode(F.array(F.lit(15), F.lit(60))).alias("thr"), (0.5 + F.ascii("carrier") / 1000.0).alias("reference_auc")
    )
    return plain(evaluate.gate(rows, "DepDelayMinutes", {15: "p_ge15", 60: "p_ge60"}, reference))


@query(
    "family_override",
    "J17",
    b.sql(
        "flights",
        "SELECT 'none' AS config, round(sum(carrier_mean), 4) AS carrier_mean, sum(taxi) AS taxi FROM sa "
        "UNION ALL SELECT 'rolling', round(sum(sb.carrier_mean), 4), sum(sa.taxi) FROM sa JOIN sb USING (Reporting_Airline, Origin, FlightDate) "
        "UNION ALL SELECT 'schedule', round(sum(sa.carrier_mean), 4), sum(sb.taxi) FROM sa JOIN sb USING (Reporting_Airline, Origin, FlightDate) "
        "UNION ALL SELECT 'all', round(sum(carrier_mean), 4), sum(taxi) FROM sb",
        sa=SNAP_A,
        sb=SNAP_B,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, c = snapshots(spark, sf)
    made = joins.override_families(a.drop("dest"), c.drop("dest"), _SNAP_KEYS, {"rolling": ["carrier_mean"], "schedule": ["taxi"]})
    parts = [
        df.agg(F.lit(n).alias("config"), F.round(F.sum("carrier_mean"), 4).alias("carrier_mean"), F.sum("taxi").alias("taxi")) for n, df in made.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("config", "carrier_mean", "taxi")


@query(
    "scalar_shares",
    "A43",
    b.sql(
        "flights",
        "SELECT round(avg(CAST(WeatherDelay = 0 AS DOUBLE)), 6) + 0.0 AS zero_share, round(avg(CAST(CRSDepTime IS NULL AS DOUBLE)), 6) + 0.0 AS unknown_share, "
        "round(avg(CAST(DepDelayMinutes >= 60 AS DOUBLE)), 6) + 0.0 AS severe_share FROM flights",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(
        stats.scalar_summary(
            b.flights(spark, sf),
            {
                "zero_share": F.avg((F.col("WeatherDelay") == 0).cast("double")),
                "unknown_share": F.avg(F.col("CRSDepTime").isNull().cast("double")),
                "severe_share": F.avg((F.col("DepDelayMinutes") >= 60).cast("double")),
            },
        )
    )


@query(
    "schedule_buffer",
    "J18",
    b.sql(
        "flights",
        "SELECT Origin, Dest, CAST(FlightDate AS VARCHAR) AS FlightDate, round(CRSElapsedTime - m, 6) + 0.0 AS schedule_buffer_min FROM flights LEFT JOIN s USING (Origin, Dest)",
        s="SELECT Origin, Dest, quantile_cont(ActualElapsedTime, 0.5) AS m FROM flights GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(joins.schedule_buffer(b.flights(spark, sf)).select("Origin", "Dest", "FlightDate", "schedule_buffer_min"))


@query(
    "version_comparison",
    "J15",
    b.sql(
        "flights",
        "SELECT Origin, CAST(FlightDate AS VARCHAR) AS FlightDate, round(x.v, 6) + 0.0 AS value_a, round(z.v, 6) + 0.0 AS value_b FROM x JOIN z USING (Origin, FlightDate)",
        x="SELECT Origin, FlightDate, avg(CAST(coalesce(LateAircraftDelay, 0) > 0 AS DOUBLE)) AS v FROM flights GROUP BY ALL",
        z="SELECT Origin, FlightDate, avg(CAST(coalesce(LateAircraftDelay, 0) >= 15 AS DOUBLE)) AS v FROM flights GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = b.flights(spark, sf)
    late = F.coalesce("LateAircraftDelay", F.lit(0.0))
    a = f.select("Origin", "FlightDate", (late > 0).cast("double").alias("v"))
    c = f.select("Origin", "FlightDate", (late >= daily.LATE_AIRCRAFT_MINUTES).cast("double").alias("v"))
    return plain(joins.compare_versions(a, c, ["Origin", "FlightDate"], "v"))
