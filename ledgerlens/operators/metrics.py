"""Evaluation of a scored table: truth, prediction, probability in; one row out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.running import running_totals

CONFUSION = ("true_negatives", "false_positives", "false_negatives", "true_positives")
SCORES = ("accuracy", "precision", "recall", "f1")
RANKING = ("roc_auc", "average_precision")
METRICS = (*SCORES, *RANKING, *CONFUSION)
COMPARED = ("average_precision", "roc_auc", "recall", "precision", "f1")


def confusion_cells(truth: str, prediction: str) -> dict[str, Column]:
    t, p = F.col(truth), F.col(prediction)
    return {
        "true_negatives": F.count_if((t == 0) & (p == 0)),
        "false_positives": F.count_if((t == 0) & (p == 1)),
        "false_negatives": F.count_if((t == 1) & (p == 0)),
        "true_positives": F.count_if((t == 1) & (p == 1)),
    }


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def score_columns() -> dict[str, Column]:
    """Accuracy, precision, recall and F1 from the four cells; 0 when undefined."""
    tn, fp, fn, tp = (F.col(c) for c in CONFUSION)
    return {
        "accuracy": _ratio(tn + tp, tn + fp + fn + tp),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def confusion(
    scored: DataFrame, truth: str = "truth", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return scored.groupBy(*by).agg(*[c.alias(n) for n, c in confusion_cells(truth, prediction).items()])


def scores(
    scored: DataFrame, truth: str = "truth", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    cells = confusion(scored, truth, prediction, by)
    return cells.select(*by, *[c.alias(n) for n, c in score_columns().items()])


def _by_score(grouped: DataFrame, probability: str, by: Sequence[str]) -> DataFrame:
    return running_totals(grouped, probability, ["_pos", "_neg"], by)


def _ranking() -> dict[str, Column]:
    """Sums over distinct scores; equal scores stand at one threshold.

    Positives and negatives are counted in ascending score, so what lies at or above
    a threshold is the total minus what came before.
    """
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    positives, negatives = F.col("_pos_total"), F.col("_neg_total")
    area = F.sum(pos * (F.col("_neg_before") + neg / 2))
    found = positives - F.col("_pos_before")
    reached = found + negatives - F.col("_neg_before")
    precise = F.sum(F.try_divide(pos * found, reached))
    return {
        "roc_auc": F.try_divide(area, F.max(positives.cast("double") * negatives)),
        "average_precision": F.coalesce(F.try_divide(precise, F.max(positives)), F.lit(0.0)),
    }


def _labelled() -> list[Column]:
    t = F.col("_truth")
    return [F.count_if(t == 1).alias("_pos"), F.count_if(t == 0).alias("_neg")]


def ranking(
    scored: DataFrame, truth: str = "truth", probability: str = "fraud_probability", by: Sequence[str] = ()
) -> DataFrame:
    """Area under ROC (ties count half; null with one class) and average precision."""
    grouped = (
        scored.withColumn("_truth", F.col(truth)).groupBy(*by, probability).agg(*_labelled())
    )
    run = _by_score(grouped, probability, by)
    return run.groupBy(*by).agg(*[c.alias(n) for n, c in _ranking().items()])


def evaluate(
    scored: DataFrame,
    truth: str = "truth",
    prediction: str = "prediction",
    probability: str = "fraud_probability",
    by: Sequence[str] = (),
) -> DataFrame:
    """All ten metrics, one row per group, from one aggregation by score."""
    cells = confusion_cells(truth, prediction)
    grouped = (
        scored.withColumn("_truth", F.col(truth))
        .groupBy(*by, probability)
        .agg(*_labelled(), *[c.alias(n) for n, c in cells.items()])
    )
    run = _by_score(grouped, probability, by)
    totals = run.groupBy(*by).agg(
        *[F.sum(n).cast("long").alias(n) for n in CONFUSION],
        *[c.alias(n) for n, c in _ranking().items()],
    )
    return totals.withColumns(score_columns()).select(*by, *METRICS)


def as_rows(metrics: DataFrame, prefix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., metric, value) with prefixed names and double values."""
    entries = [
        F.struct(F.lit(f"{prefix}{m}").alias("metric"), F.col(m).cast("double").alias("value"))
        for m in METRICS
        if m in metrics.columns
    ]
    return metrics.select(*keep, F.explode(F.array(*entries)).alias("r")).select(*keep, "r.*")


def best_run(runs: DataFrame, split: str = "validation") -> DataFrame:
    """The run with the highest validation average precision; the first listed wins ties.

    `runs` has one row per (model, spec_order, split).
    """
    eligible = runs.where((F.col("split") == split) & F.col("average_precision").isNotNull())
    return eligible.orderBy(F.desc("average_precision"), "spec_order").limit(1)


def comparison(runs: DataFrame, split: str = "validation") -> DataFrame:
    """(model, metric, value, best) over the five compared metrics."""
    judged = runs.where(F.col("split") == split)
    winner = best_run(runs, split).select(F.col("model").alias("_winner"))
    long = judged.unpivot(
        ["model"], [F.col(m) for m in COMPARED], "metric", "value"
    )
    return long.join(F.broadcast(winner), F.lit(True), "left").select(  # one row
        "model",
        "metric",
        "value",
        F.coalesce(F.col("model") == F.col("_winner"), F.lit(False)).alias("best"),
    )
