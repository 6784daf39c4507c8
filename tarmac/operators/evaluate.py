"""Metrics of probabilities and classes against the truth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import running_totals

EPS = 1e-6


def reliability(df: DataFrame, y: str, p: str, bins: int = 10) -> DataFrame:
    """Rows, mean prediction and positive rate of equal-width bins closed on the right.

    A prediction of exactly 0 lies outside the first bin, whose lower edge is open.
    """
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(p).cast("double")))
    number = F.ceil(clipped * bins).cast("int")
    rows = df.filter(F.col(p).isNotNull()).select(F.col(y).cast("double").alias("_y"), clipped.alias("_p"), number.alias("bin"))
    table = (
        rows.filter("bin > 0")
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("_p").alias("mean_pred"), F.avg("_y").alias("empirical_pos_rate"))
    )
    right = F.col("bin") / bins
    left = (F.col("bin") - 1) / bins
    return table.select(
        "bin",
        "count",
        "mean_pred",
        "empirical_pos_rate",
        left.alias("bin_left"),
        right.alias("bin_right"),
        ((left + right) / 2).alias("bin_mid"),
    )


def _class_counts(df: DataFrame, keys: Sequence[str], y: str, score: str) -> DataFrame:
    positive = F.col(y).cast("int") == 1
    return (
        df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())
        .groupBy(*keys, F.col(score).alias("_score"))
        .agg(
            F.sum(positive.cast("bigint")).alias("pos"),
            F.sum((~positive).cast("bigint")).alias("neg"),
        )
    )


def auc_table(
    df: DataFrame, keys: Sequence[str], y: str, score: str, fold: bool = False, least: int = 0
) -> DataFrame:
    """Area under the ROC curve per key, ties sharing their average rank.

    NULL with a single class or fewer than ``least`` rows. ``fold`` reports ``max(a, 1 - a)``.
    """
    t = running_totals(_class_counts(df, keys, y, score), keys, ["_score"], ["pos", "neg"])
    wins = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0))
    both = t.groupBy(*keys).agg(
        wins.alias("_wins"), F.max("total_pos").alias("n_pos"), F.max("total_neg").alias("n_neg")
    )
    area = F.col("_wins") / (F.col("n_pos").cast("double") * F.col("n_neg"))
    enough = (F.col("n_pos") > 0) & (F.col("n_neg") > 0) & (F.col("n_pos") + F.col("n_neg") >= least)
    area = F.when(enough, F.greatest(area, 1 - area) if fold else area)
    return both.select(*keys, "n_pos", "n_neg", area.alias("auc"))


def youden(df: DataFrame, y: str, p: str, keys: Sequence[str] = ()) -> DataFrame:
    """The cut with the largest TPR - FPR, counting scores at or above it as positive.

    On equal distance the highest cut wins.
    """
    keys = list(keys) or ["_all"]
    df = df.withColumn("_all", F.lit(0)) if keys == ["_all"] else df
    t = running_totals(_class_counts(df, keys, y, p), keys, ["_score"], ["pos", "neg"])
    tpr = (F.col("total_pos") - F.col("before_pos")) / F.col("total_pos")
    fpr = (F.col("total_neg") - F.col("before_neg")) / F.col("total_neg")
    rows = t.select(*keys, F.col("_score").alias("threshold"), tpr.alias("tpr"), fpr.alias("fpr"))
    rank = F.struct((F.col("tpr") - F.col("fpr")).alias("j"), F.col("threshold"))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct("threshold", "tpr", "fpr"), rank).alias("_b"))
    return best.select(*[k for k in keys if k != "_all"], "_b.threshold", "_b.tpr", "_b.fpr")


def score_metrics(df: DataFrame, y: str, p: str, keys: Sequence[str] = ()) -> DataFrame:
    """Log loss with probabilities kept 1e-6 away from 0 and 1, and Brier score."""
    kept = F.greatest(F.lit(EPS), F.least(F.lit(1 - EPS), F.col(p)))
    truth = F.col(y).cast("double")
    loss = -(truth * F.log(kept) + (1 - truth) * F.log(1 - kept))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(loss).alias("log_loss"),
        F.avg((F.col(p) - truth) * (F.col(p) - truth)).alias("brier"),
    )


def average_precision(df: DataFrame, y: str, p: str, keys: Sequence[str]) -> DataFrame:
    """Sum over cuts of the recall gained times the precision there."""
    t = running_totals(_class_counts(df, keys, y, p), keys, ["_score"], ["pos", "neg"])
    above_pos = F.col("total_pos") - F.col("before_pos")
    above_neg = F.col("total_neg") - F.col("before_neg")
    gained = F.col("pos") / F.col("total_pos") * above_pos / (above_pos + above_neg)
    return t.groupBy(*keys).agg(F.sum(gained).alias("average_precision"))


def multiclass_metrics(df: DataFrame, truth: str, dist: str, predicted: str) -> DataFrame:
    """Log loss of the true bin's probability, and accuracy."""
    p = F.element_at(F.col(dist), F.col(truth).cast("int") + 1)
    kept = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), p))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(-F.log(kept)).alias("log_loss"),
        F.avg((F.col(truth) == F.col(predicted)).cast("double")).alias("accuracy"),
    )


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Precision, recall, F1 and support of each class; an empty ratio is 0."""
    cells = confusion(df, y, yhat)
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("a"), F.lit(0).cast("bigint").alias("b")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b")),
    )
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    rows = cells.select(hit.alias("_hit"), F.inline(sides))
    # Each matching cell is seen from both sides.
    per = rows.groupBy("label").agg(
        (F.sum("_hit") / 2).alias("_tp"), F.sum("a").alias("support"), F.sum("b").alias("_called")
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.col("_tp") / F.nullif("_called", F.lit(0)), zero)
    recall = F.coalesce(F.col("_tp") / F.nullif("support", F.lit(0)), zero)
    f1 = F.coalesce(2 * F.col("_tp") / F.nullif(F.col("_called") + F.col("support"), F.lit(0)), zero)
    return per.select("label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def gate(
    df: DataFrame,
    delay: str,
    probabilities: Mapping[int, str],
    reference: DataFrame,
    carrier: str = "Reporting_Airline",
    least: int = 3,
) -> DataFrame:
    """Per carrier and threshold: actual and predicted rates, Brier score, AUC and its gap.

    ``reference`` holds ``carrier``, ``thr`` and ``reference_auc``.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("thr"),
                F.when(F.col(delay).isNotNull(), (F.col(delay) >= t).cast("int")).alias("y"),
                F.col(c).cast("double").alias("p"),
            )
            for t, c in probabilities.items()
        ]
    )
    rows = df.select(F.col(carrier).alias("carrier"), F.inline(cells)).filter("y is not null and p is not null")
    keys = ["carrier", "thr"]
    rates = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("y").cast("double")).alias("actual_rate"),
        F.avg("p").alias("pred_rate"),
        F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))).alias("brier"),
    )
    area = auc_table(rows, keys, "y", "p").select(*keys, "auc")
    table = rates.filter(F.col("n") >= least).join(area, keys, "left").join(reference, keys, "left")
    return table.withColumn("auc_gap", F.col("auc") - F.col("reference_auc"))


def mean_gap(table: DataFrame) -> DataFrame:
    """Mean AUC gap over the cells where both sides have one."""
    return table.agg(F.avg("auc_gap").alias("mean_gap"), F.count("auc_gap").alias("n_cells"))


def parity_summary(diff: DataFrame) -> DataFrame:
    """Per feature: how often both sides are known, agree, and how far numbers lie apart.

    The 95th percentile is exact and its state grows with distinct differences, so differences are
    counted first and ranked through running totals.
    """
    from .ranks import quantiles

    a, b = F.col("trained").isNotNull(), F.col("served").isNotNull()
    size = F.abs(F.col("delta"))
    is_text = F.col("match").isNotNull()
    base = diff.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum((a & b).cast("bigint")).alias("n_both_present"),
        F.sum((a & ~b).cast("bigint")).alias("n_only_trained"),
        F.sum((~a & b).cast("bigint")).alias("n_only_served"),
        F.sum(F.coalesce(F.when(is_text, F.col("match")).otherwise(size < 1e-9), F.lit(False)).cast("bigint")).alias(
            "n_match"
        ),
        F.sum(
            F.coalesce(F.when(is_text, ~F.col("match")).otherwise(size >= 0.001), F.lit(False)).cast("bigint")
        ).alias("n_mismatch"),
        F.avg("delta").alias("delta_mean"),
        F.avg(size).alias("abs_delta_mean"),
        F.max(size).alias("abs_delta_max"),
    )
    p95 = quantiles(diff.withColumn("_abs", size), ["feature"], "_abs", [0.95], ["abs_delta_p95"]).drop("n")
    rate = F.round(F.col("n_match") / F.greatest(F.col("n_both_present"), F.lit(1)), 4)
    return base.join(p95, ["feature"], "left").withColumn("match_rate", rate)

