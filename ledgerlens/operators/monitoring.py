"""Service panels over the outcome log, and live quality against known truth.

The log has `logged_at`, `outcome`, and for successes `latency_ms`, `prediction` and
`fraud_probability`. Windows count exactly; they tumble unless a slide is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.metrics import CONFUSION, confusion, score_columns
from ledgerlens.operators.running import row_numbers
from ledgerlens.operators.scoring import COUNTED, SUCCESS

# Histogram bucket bounds, in seconds and as probabilities.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
PROBABILITY_BOUNDS = (0.0, 0.001, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)
TINY = 1e-9
ROLLING_ROWS = 50
HISTORY_ROWS = 500
RECENT_ROWS = 25


def _counted() -> Column:
    return F.col("outcome").isin(*COUNTED)


def _windowed(log: DataFrame, size: str, slide: str | None, *keys: str):
    return log.groupBy(F.window("logged_at", size, slide).alias("w"), *keys)


def _named(grouped: DataFrame, *columns: str | Column) -> DataFrame:
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *columns
    )


def request_rate(
    log: DataFrame, size: str = "1 minute", seconds: int = 60, slide: str | None = None
) -> DataFrame:
    """Requests per second in each window."""
    counted = _windowed(log.where(_counted()), size, slide).agg(F.count("*").alias("n"))
    return _named(counted, (F.col("n") / F.lit(float(seconds))).alias("requests_per_second"))


def quantile_from_buckets(fraction: float) -> Column:
    """Linear interpolation inside the bucket that holds the rank.

    A rank beyond the last bound reads as the last bound.
    """
    upto, total = F.col("upto"), F.col("total")
    rank = F.lit(float(fraction)) * total
    bounds = F.array(*[F.lit(b) for b in LATENCY_BOUNDS])
    at = F.size(F.filter(upto, lambda c: c < rank))
    lower = F.when(at > 0, F.get(bounds, at - 1)).otherwise(F.lit(0.0))
    below = F.when(at > 0, F.get(upto, at - 1)).otherwise(F.lit(0))
    share = (rank - below) / (F.get(upto, at) - below)
    inside = lower + (F.get(bounds, at) - lower) * share
    return F.when(at >= len(LATENCY_BOUNDS), F.lit(LATENCY_BOUNDS[-1])).otherwise(inside)


def latency_quantiles(log: DataFrame, size: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """p50, p95 and p99 of the latency in seconds, from cumulative bucket counts."""
    seconds = F.col("latency_ms") / F.lit(1000.0)
    served = log.where((F.col("outcome") == SUCCESS) & F.col("latency_ms").isNotNull())
    counts = _windowed(served, size, slide).agg(
        F.count("*").alias("total"), *[F.count_if(seconds <= b).alias(f"le{i}") for i, b in enumerate(LATENCY_BOUNDS)]
    )
    counts = counts.withColumn("upto", F.array(*[F.col(f"le{i}") for i in range(len(LATENCY_BOUNDS))]))
    return _named(counts, *[quantile_from_buckets(q / 100).alias(f"p{q}") for q in (50, 95, 99)])


def error_ratio(log: DataFrame, size: str = "5 minutes", slide: str | None = None) -> DataFrame:
    errors = F.count_if(F.col("outcome") != SUCCESS)
    counted = _windowed(log.where(_counted()), size, slide).agg(
        (errors / F.greatest(F.count("*").cast("double"), F.lit(TINY))).alias("error_ratio")
    )
    return _named(counted, "error_ratio")


def fraud_per_hour(log: DataFrame, size: str = "1 hour", slide: str | None = None) -> DataFrame:
    served = log.where(F.col("outcome") == SUCCESS)
    return _named(
        _windowed(served, size, slide).agg(F.count_if(F.col("prediction") == 1).alias("fraud_predictions")),
        "fraud_predictions",
    )


def mean_probability(log: DataFrame, size: str = "5 minutes", slide: str | None = None) -> DataFrame:
    served = log.where(F.col("outcome") == SUCCESS)
    mean = F.sum("fraud_probability") / F.greatest(F.count("fraud_probability").cast("double"), F.lit(TINY))
    return _named(_windowed(served, size, slide).agg(mean.alias("mean_probability")), "mean_probability")


def class_distribution(log: DataFrame, size: str = "1 hour", slide: str | None = None) -> DataFrame:
    served = log.where(F.col("outcome") == SUCCESS)
    return _named(
        _windowed(served, size, slide, "prediction").agg(F.count("*").alias("predictions")),
        "prediction",
        "predictions",
    )


def probability_histogram(log: DataFrame) -> DataFrame:
    """(le, requests): cumulative counts at the fixed bounds and +Inf."""
    p = F.col("fraud_probability")
    served = log.where((F.col("outcome") == SUCCESS) & p.isNotNull())
    row = served.agg(
        *[F.count_if(p <= b).alias(f"le{i}") for i, b in enumerate(PROBABILITY_BOUNDS)],
        F.count("*").alias("all"),
    )
    cells = [
        F.struct(F.lit(str(b)).alias("le"), F.col(f"le{i}").alias("requests"))
        for i, b in enumerate(PROBABILITY_BOUNDS)
    ]
    cells.append(F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("requests")))
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def outcome_counters(log: DataFrame) -> DataFrame:
    """(counter, label, value): requests by outcome and errors by reason."""
    by_outcome = log.where(_counted()).groupBy("outcome").agg(F.count("*").alias("value"))
    entries = F.array_compact(
        F.array(
            F.lit("requests"),
            F.when(F.col("outcome") != SUCCESS, F.lit("errors")),
        )
    )
    return by_outcome.select(
        F.explode(entries).alias("counter"), F.col("outcome").alias("label"), "value"
    )


def live_performance(log: DataFrame, truth: DataFrame, key: str = "event_id") -> DataFrame:
    """Scored count, accuracy, precision, recall, F1 and confusion of served requests."""
    served = log.where(F.col("outcome") == SUCCESS).select(key, "prediction")
    judged = served.join(truth.select(key, F.col("isFraud").alias("truth")), key)
    cells = confusion(judged)
    scored = sum((F.col(c) for c in CONFUSION), F.lit(0).cast("long"))
    return cells.withColumn("scored", scored).withColumns(score_columns())


def rolling_accuracy(
    results: DataFrame,
    order: str = "seq",
    by: Sequence[str] = (),
    rows: int = ROLLING_ROWS,
    block: int = 1 << 20,
) -> DataFrame:
    """Mean of `correct` over the last `rows` scored rows, from the first row on.

    One session may hold most of the log, so it is cut into blocks of consecutive
    rows. Each block also receives the `rows - 1` rows before it, so every mean is
    complete and no task holds more than a block.
    """
    block = max(block, rows)
    scored = results.where(F.col("correct").isNotNull())
    numbered = row_numbers(scored, order, by)
    own = F.floor(F.col("_row") / F.lit(block))
    near_end = F.pmod(F.col("_row"), F.lit(block).cast("long")) > block - rows
    copies = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("_own", own).withColumn("_block", F.explode(copies))
    last = Window.partitionBy(*by, "_block").orderBy("_row").rowsBetween(1 - rows, 0)
    mean = F.avg(F.col("correct").cast("int")).over(last)
    return (
        spread.withColumn("rolling_accuracy", mean)
        .where(F.col("_own") == F.col("_block"))
        .drop("_own", "_block", "_row")
    )


def last_results(results: DataFrame, n: int = HISTORY_ROWS, order: str = "seq") -> DataFrame:
    """The newest n results, newest first."""
    return results.orderBy(F.desc(order)).limit(n)
