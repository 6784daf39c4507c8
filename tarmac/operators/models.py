"""Threshold models with Spark ML: fitting, calibration, scoring and comparison.

Fits run on the executors. Results are close to, but not equal to, those of other boosting libraries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from ..functions.parse import as_category
from ..session import materialise
from .evaluate import auc_table, score_metrics
from .sampling import stratified_split
from .stats import medians

# Scores are calibrated on a grid of so many equal steps from 0 to 1.
GRID = 1000


@dataclass(frozen=True)
class Features:
    numeric: Sequence[str]
    categorical: Sequence[str] = ()


@dataclass
class ThresholdModel:
    """A fitted classifier with its calibration curve and decision cut."""

    label: str
    pipeline: PipelineModel
    curve: list[float] | None = None
    names: list[str] = field(default_factory=list)
    filled: dict[str, float] = field(default_factory=dict)


def prepare(df: DataFrame, feats: Features, filled: Mapping[str, float]) -> DataFrame:
    """Numbers as double, unknown ones as ``filled`` says, and categories with "missing" folded to one value."""
    made = {f"{c}_filled": F.coalesce(F.col(c).cast("double"), F.lit(filled[c])) for c in feats.numeric}
    made |= {c: as_category(c) for c in feats.categorical}
    return df.withColumns(made)


def assembly(feats: Features) -> tuple[list, list[str]]:
    """Stages that index categories and put the features together."""
    indexed = [f"{c}_index" for c in feats.categorical]
    stages: list = []
    if feats.categorical:
        stages.append(
            StringIndexer(inputCols=list(feats.categorical), outputCols=indexed, handleInvalid="keep")
        )
    stages.append(VectorAssembler(inputCols=[*[f"{c}_filled" for c in feats.numeric], *indexed], outputCol="features"))
    return stages, [*feats.numeric, *feats.categorical]


def fit_threshold(
    train: DataFrame,
    label: str,
    feats: Features,
    stop: str | None = None,
    weight: str | None = None,
    params: Mapping[str, object] | None = None,
) -> ThresholdModel:
    """One boosted classifier; ``stop`` names a boolean column whose rows decide when to stop.

    Equal rows (in features, label, ``stop`` and weight) go through the trees as one with their summed
    weight; medians and the order of categories come from all rows.
    """
    stages, names = assembly(feats)
    options = {"maxIter": 20, "maxDepth": 4, "seed": 42, "maxBins": 256, **(params or {})}
    booster = GBTClassifier(featuresCol="features", labelCol="_label", **options)
    if stop:
        booster = booster.setValidationIndicatorCol(stop)
    # The exact medians of the training rows serve every later split.
    filled = medians(train, feats.numeric)
    ready = prepare(train, feats, filled).withColumn("_label", F.col(label).cast("double"))
    keys = [*[f"{c}_filled" for c in feats.numeric], *feats.categorical, "_label", *([stop] if stop else [])]
    once = ready.groupBy(*keys, *([weight] if weight else [])).agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    rows = F.col("_rows") * F.col(weight) if weight else F.col("_rows")
    # Every round of the trees reads it.
    once = materialise(once.select(*keys, rows.alias("_rows")), "once")
    indexers = Pipeline(stages=stages[:-1]).fit(ready).stages
    ahead = PipelineModel(stages=[*indexers, stages[-1]])
    fitted = booster.setWeightCol("_rows").fit(ahead.transform(once))
    return ThresholdModel(label, PipelineModel(stages=[*ahead.stages, fitted]), None, names, filled)


def raw_probability(model: ThresholdModel, df: DataFrame, feats: Features, out: str) -> DataFrame:
    scored = model.pipeline.transform(prepare(df, feats, model.filled))
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(out))


def grid_step(score: Column, grid: int = GRID) -> Column:
    """The step of the grid in which a score lies, from 0; 1 lies in the last."""
    return F.least(F.floor(score * grid), F.lit(grid - 1)).cast("int")


def pool(counts: Sequence[tuple[float, float]]) -> list[float]:
    """Non-decreasing rates closest to the given (rows, sum) in turn: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for rows, total in counts:
        blocks.append([rows, total, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            rows_, total_, steps = blocks.pop()
            blocks[-1] = [blocks[-1][0] + rows_, blocks[-1][1] + total_, blocks[-1][2] + steps]
    return [total / rows for rows, total, steps in blocks for _ in range(int(steps))]


def isotonic_steps(df: DataFrame, score: str, label: str, grid: int = GRID) -> DataFrame:
    """(step, n, rate, fitted) of every step of the score grid that has rows.

    Rows are counted per step by Spark; the table that is pooled has at most ``grid`` rows.
    """
    known = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(grid_step(F.col(score), grid).alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("total")
    )
    rows = counts.orderBy("step").collect()
    fitted = pool([(r["n"], r["total"]) for r in rows])
    made = [(r["step"], r["n"], r["total"] / r["n"], f) for r, f in zip(rows, fitted)]
    return df.sparkSession.createDataFrame(made, "step int, n bigint, rate double, fitted double")


def calibrate(model: ThresholdModel, held: DataFrame, feats: Features, grid: int = GRID) -> ThresholdModel:
    """Isotonic curve from raw to observed probability, fitted on rows kept out of training.

    Steps without rows lie on the straight line between their neighbours.
    """
    steps = isotonic_steps(raw_probability(model, held, feats, "_raw"), "_raw", model.label, grid).orderBy("step").collect()
    if steps:
        at, fitted = [r["step"] for r in steps], [r["fitted"] for r in steps]
        model.curve = np.interp(range(grid), at, fitted).tolist()
    return model


def probability(model: ThresholdModel, df: DataFrame, feats: Features, out: str) -> DataFrame:
    """Calibrated probability; raw when the model has no curve."""
    scored = raw_probability(model, df, feats, "_raw")
    if model.curve is None:
        return scored.withColumnRenamed("_raw", out)
    curve = F.array(*[F.lit(p) for p in model.curve])
    return scored.select(*df.columns, F.element_at(curve, grid_step(F.col("_raw"), len(model.curve)) + 1).alias(out))


def fit_ordinal(
    train: DataFrame,
    labels: Sequence[str],
    feats: Features,
    ids: Sequence[str],
    overrides: Mapping[str, Mapping[str, object]] | None = None,
    seed: int = 42,
) -> dict[str, ThresholdModel]:
    """One classifier per threshold, stopped early on a fifth and calibrated on another fifth."""
    out = {}
    for label in labels:
        # Read for the medians, the indexes, the fit and the curve.
        split = materialise(stratified_split(train, label, [0.6, 0.2, 0.2], ["fit", "stop", "cal"], ids, seed), "split")
        fit = split.filter("split != 'cal'").withColumn("_stop", F.col("split") == "stop")
        model = fit_threshold(fit, label, feats, "_stop", None, (overrides or {}).get(label))
        out[label] = calibrate(model, split.filter("split = 'cal'"), feats)
    return out


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Adds weights under which both classes count the same."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    total = df.agg(F.count(F.lit(1))).scalar()
    # Two rows, sent to the others: a join by label would put all rows of a class into one task.
    return df.join(F.broadcast(sizes), [label]).withColumn("_weight", total / (2.0 * F.col("_size"))).drop("_size")


def fit_cancellation(
    train: DataFrame, label: str, feats: Features, ids: Sequence[str], params: Mapping[str, object] | None = None
) -> ThresholdModel:
    """Cancellation classifier with balanced class weights and a calibration curve."""
    split = materialise(stratified_split(train, label, [0.8, 0.2], ["fit", "cal"], ids), "split")
    weighted = class_weight(split.filter("split = 'fit'"), label)
    model = fit_threshold(weighted, label, feats, None, "_weight", params)
    return calibrate(model, split.filter("split = 'cal'"), feats)


def score(
    df: DataFrame, models: Mapping[int, ThresholdModel], feats: Features, minutes: Sequence[float] | None = None
) -> DataFrame:
    """Cumulative probabilities, bin distribution, expected minutes, severity, reason and text."""
    out = df
    for threshold, model in models.items():
        out = probability(model, out, feats, f"p_ge{threshold}")
    return describe(out, list(models), minutes)


def describe(df: DataFrame, thresholds: Sequence[int], minutes: Sequence[float] | None = None) -> DataFrame:
    """The columns that follow from ``p_ge{threshold}``."""
    ps = [F.col(f"p_ge{t}") for t in thresholds]
    labels = scoring.bin_labels(thresholds)
    dist = F.col("_dist")
    index = scoring.likeliest_bin(dist)

    def name(i: int, label: str) -> str:
        return f"p_bin{i}_{label.replace(' ', '').replace('<', 'lt').replace('>=', 'ge')}"

    named: dict[str, Column] = {name(i, text): dist[i] for i, text in enumerate(labels)}
    named |= {
        "expected_delay_minutes": scoring.weighted_sum(dist, minutes or scoring.BIN_MINUTES),
        "severity_score": scoring.weighted_sum(dist, scoring.BIN_SEVERITY),
        "pred_bin": scoring.bin_label(index, thresholds),
        "delay_explanation": scoring.reason(df.columns),
        "delay_probabilities": scoring.probability_text(ps, thresholds),
    }
    return df.withColumn("_dist", scoring.bin_distribution(ps)).withColumns(named).drop("_dist")


def importance(model: ThresholdModel) -> DataFrame:
    """Share of the gain per feature; the model holds one number per feature."""
    from pyspark.sql import SparkSession

    weights = model.pipeline.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(model.names, weights)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def known_rates(df: DataFrame, feats: Features) -> DataFrame:
    """Share of rows, of all of ``df``, in which each feature is known: no null number, no spelling of "missing"."""
    known = {c: F.col(c).cast("double").isNotNull() for c in feats.numeric}
    known |= {c: as_category(c) != "Unknown" for c in feats.categorical}
    cells = [F.struct(F.lit(c).alias("feature"), F.avg(held.cast("double")).alias("known_rate")) for c, held in known.items()]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def compare_feature_sets(
    train: DataFrame, test: DataFrame, label: str, variants: Mapping[str, Features], params: Mapping[str, object] | None = None
) -> DataFrame:
    """AUC and log loss of the same booster on different feature sets, one row per variant."""
    rows = None
    for name, feats in variants.items():
        model = fit_threshold(train, label, feats, params=params)
        scored = raw_probability(model, test, feats, "p").select(F.lit(name).alias("variant"), F.col(label).alias("y"), "p")
        rows = scored if rows is None else rows.unionByName(scored)
    area = auc_table(rows, ["variant"], "y", "p").select("variant", "auc")
    return area.join(score_metrics(rows, "y", "p", ["variant"]), ["variant"])


def logistic_lift(train: DataFrame, test: DataFrame, label: str, base: Sequence[str], added: str) -> DataFrame:
    """Log loss of a logistic model without and with one more feature."""
    rows = None
    for name, cols in (("base", list(base)), ("with", [*base, added])):
        stages = [VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip")]
        fit = LogisticRegression(featuresCol="features", labelCol="_label", maxIter=100)
        model = Pipeline(stages=[*stages, fit]).fit(train.withColumn("_label", F.col(label).cast("double")))
        scored = model.transform(test).select(
            F.lit(name).alias("variant"), F.col(label).alias("y"), vector_to_array("probability")[1].alias("p")
        )
        rows = scored if rows is None else rows.unionByName(scored)
    loss = score_metrics(rows, "y", "p", ["variant"])
    one = loss.agg(
        F.max(F.when(F.col("variant") == "base", F.col("log_loss"))).alias("log_loss_base"),
        F.max(F.when(F.col("variant") == "with", F.col("log_loss"))).alias("log_loss_with"),
        F.max("n").alias("n"),
    )
    return one.withColumn("delta", F.col("log_loss_base") - F.col("log_loss_with"))


def per_group(
    df: DataFrame, group: str, values: Sequence[str], label: str, feats: Features, params: Mapping[str, object] | None = None
) -> DataFrame:
    """A model per listed group, trained on the first 80 % of its days and measured on the rest."""
    from .sampling import split_dates

    rows = None
    for value in values:
        split = split_dates(df.filter(F.col(group) == value))
        model = fit_threshold(split.filter("is_train"), label, feats, params=params)
        scored = raw_probability(model, split.filter("not is_train"), feats, "p")
        part = scored.select(F.col(group), F.col(label).alias("y"), "p")
        rows = part if rows is None else rows.unionByName(part)
    return auc_table(rows, [group], "y", "p")
