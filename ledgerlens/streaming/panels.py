"""Service panels over a stream, from partial rows that can be added up.

Every micro-batch leaves one row of sums for each step of time that its log rows fall in,
as one committed batch. A window is the sum of its steps, whatever batches they came with:
late rows are counted, once, in any window; sliding windows add the same steps again; and
windows that are still open can be read at any time. Nothing reads the log twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import monitoring
from ledgerlens.operators.monitoring import LATENCY_BOUNDS, TINY
from ledgerlens.operators.scoring import COUNTED, SUCCESS
from ledgerlens.sources import batch_log
from ledgerlens.streaming.online import run_of

STEP_SECONDS = 60
_LATENCY = [f"le{i}" for i in range(len(LATENCY_BOUNDS))]
_COUNTS = ["counted", "errors", "served", "timed", *_LATENCY, "judged", "class_0", "class_1"]
PARTIALS = T.StructType(
    [
        T.StructField("step", T.LongType()),
        *(T.StructField(c, T.LongType()) for c in _COUNTS),
        T.StructField("probability", T.DoubleType()),
    ]
)


def partial_rows(log: DataFrame, step_seconds: int = STEP_SECONDS) -> DataFrame:
    """Sums of the outcome log per step; a row without `logged_at` is in no window."""
    outcome, served = F.col("outcome"), F.col("outcome") == SUCCESS
    seconds, timed = F.col("latency_ms") / F.lit(1000.0), served & F.col("latency_ms").isNotNull()
    step = F.floor(F.unix_seconds(F.col("logged_at").cast("timestamp")) / F.lit(step_seconds))
    sums = {
        "counted": F.count_if(outcome.isin(*COUNTED)),
        "errors": F.count_if(outcome.isin(*COUNTED) & ~served),
        "served": F.count_if(served),
        "timed": F.count_if(timed),
        **{f"le{i}": F.count_if(timed & (seconds <= b)) for i, b in enumerate(LATENCY_BOUNDS)},
        "judged": F.count_if(served & F.col("fraud_probability").isNotNull()),
        "class_0": F.count_if(served & (F.col("prediction") == 0)),
        "class_1": F.count_if(served & (F.col("prediction") == 1)),
        "probability": F.coalesce(F.sum(F.when(served, F.col("fraud_probability"))), F.lit(0.0)),
    }
    known = log.where(F.col("logged_at").isNotNull())
    return known.groupBy(step.alias("step")).agg(*[v.alias(k) for k, v in sums.items()]).select(*PARTIALS.names)


def merged(partials: DataFrame) -> DataFrame:
    return partials.groupBy("step").agg(*[F.sum(c).alias(c) for c in PARTIALS.names[1:]])


def write_into(path: str, step_seconds: int = STEP_SECONDS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function; a batch that is tried again is not added again."""

    def write(log: DataFrame, batch: int) -> None:
        batch_log.append(partial_rows(log, step_seconds), path, run_of(log.sparkSession), batch)

    return write


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("value", PARTIALS, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row of sums per step, of all batches committed so far."""
    return merged(_parsed(batch_log.lines(spark, path)))


def fold(spark: SparkSession, path: str) -> int:
    """Adds up the batches since the last fold; may run beside the stream."""
    return batch_log.fold(spark, path, lambda lines: merged(_parsed(lines)).select(F.to_json(F.struct("*")).alias("value")))


def _windows(partials: DataFrame, size: int, slide: int | None, step_seconds: int) -> DataFrame:
    """The sums of each window that has a row, as `window_start`, `window_end` and sums."""
    slide = slide or size
    if size % step_seconds or slide % step_seconds or size % slide:
        raise ValueError(f"windows of {size} s every {slide} s are no whole steps of {step_seconds} s")
    at = F.col("step") * step_seconds
    first = at - F.pmod(at, F.lit(slide).cast("long"))
    starts = F.sequence(first - (size - slide), first, F.lit(slide).cast("long"))
    grouped = partials.withColumn("start", F.explode(starts)).groupBy("start")
    sums = grouped.agg(*[F.sum(c).alias(c) for c in PARTIALS.names[1:]])

    def moment(seconds: Column) -> Column:
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            F.floor(seconds / 86400).cast("int"), secs=F.pmod(seconds, F.lit(86400).cast("long")).cast("decimal(18,6)")
        )

    return sums.withColumns({"window_start": moment(F.col("start")), "window_end": moment(F.col("start") + size)})


_ENDS = ("window_start", "window_end")


def request_rate(partials: DataFrame, size: int = 60, slide: int | None = None, step_seconds: int = STEP_SECONDS) -> DataFrame:
    rate = F.col("counted") / F.lit(float(size))
    return _windows(partials, size, slide, step_seconds).where("counted > 0").select(*_ENDS, rate.alias("requests_per_second"))


def latency_quantiles(partials: DataFrame, size: int = 300, slide: int | None = None, step_seconds: int = STEP_SECONDS) -> DataFrame:
    sums = _windows(partials, size, slide, step_seconds).where("timed > 0")
    ready = sums.withColumns({"total": F.col("timed"), "upto": F.array(*_LATENCY)})
    return ready.select(*_ENDS, *[monitoring.quantile_from_buckets(q / 100).alias(f"p{q}") for q in (50, 95, 99)])


def error_ratio(partials: DataFrame, size: int = 300, slide: int | None = None, step_seconds: int = STEP_SECONDS) -> DataFrame:
    ratio = F.col("errors") / F.greatest(F.col("counted").cast("double"), F.lit(TINY))
    return _windows(partials, size, slide, step_seconds).where("counted > 0").select(*_ENDS, ratio.alias("error_ratio"))


def fraud_per_hour(partials: DataFrame, size: int = 3600, slide: int | None = None, step_seconds: int = STEP_SECONDS) -> DataFrame:
    sums = _windows(partials, size, slide, step_seconds).where("served > 0")
    return sums.select(*_ENDS, F.col("class_1").alias("fraud_predictions"))


def mean_probability(partials: DataFrame, size: int = 300, slide: int | None = None, step_seconds: int = STEP_SECONDS) -> DataFrame:
    mean = F.when(F.col("judged") > 0, F.col("probability") / F.greatest(F.col("judged").cast("double"), F.lit(TINY)))
    return _windows(partials, size, slide, step_seconds).where("served > 0").select(*_ENDS, mean.alias("mean_probability"))


def class_distribution(partials: DataFrame, size: int = 3600, slide: int | None = None, step_seconds: int = STEP_SECONDS) -> DataFrame:
    classes = F.array(*[F.struct(F.lit(k).cast("long").alias("prediction"), F.col(f"class_{k}").alias("predictions")) for k in (0, 1)])
    rows = _windows(partials, size, slide, step_seconds).select(*_ENDS, F.explode(classes).alias("c"))
    return rows.select(*_ENDS, "c.*").where("predictions > 0")
