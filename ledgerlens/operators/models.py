"""Weighted classifiers on MLlib, their comparison and the run table."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ledgerlens.errors import ModelError
from ledgerlens.operators import boosting, metrics, versions
from ledgerlens.operators.scoring import score_vectors
from ledgerlens.schema import LABEL, MODEL_INPUTS, SPLITS, feature_version
from ledgerlens.session import scratch_path, shared_dir
from ledgerlens.sources import folders

SEED = 42
WEIGHT = "_weight"
# A forest of 100 trees caches some 1.6 KB a row: its draws and its nodes.
ROWS_A_TASK = 300_000


@dataclass(frozen=True)
class ClassCounts:
    """Train rows per class: all a weighting rule needs."""

    negatives: int
    positives: int

    @property
    def rows(self) -> int:
        return self.negatives + self.positives

    @property
    def positive_weight(self) -> float:
        return self.negatives / self.positives if self.positives else 1.0


def class_counts(train: DataFrame) -> DataFrame:
    """One row: negatives, positives and the weight of a positive."""
    counts = train.agg(
        F.count_if(F.col(LABEL) == 0).alias("negatives"), F.count_if(F.col(LABEL) == 1).alias("positives")
    )
    weight = F.try_divide(F.col("negatives").cast("double"), F.col("positives"))
    return counts.withColumn("positive_weight", F.coalesce(weight, F.lit(1.0)))


def balanced_weights(train: DataFrame, weight: str = "weight") -> DataFrame:
    """Adds rows / (2 x rows of the class) as the row's weight."""
    counts = class_counts(train)
    rows = (F.col("negatives") + F.col("positives")).cast("double")
    of_class = F.when(F.col(LABEL) == 1, F.col("positives")).otherwise(F.col("negatives"))
    return (
        train.crossJoin(F.broadcast(counts))  # one row
        .withColumn(weight, rows / (2 * of_class))
        .drop("negatives", "positives", "positive_weight")
    )


def standardize(df: DataFrame, fitted_on: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population std with the statistics of `fitted_on`; a constant stays at 0."""
    stats = fitted_on.agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns],
    )
    scaled = {}
    for c in columns:
        std = F.col(f"_std_{c}")
        scaled[c] = (F.col(c) - F.col(f"_mean_{c}")) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.crossJoin(F.broadcast(stats)).select(  # one row
        *[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns]
    )


def feature_order(columns: Sequence[str]) -> tuple[str, ...]:
    """Model inputs in their table order: all but the label and the split name."""
    return tuple(c for c in columns if c not in (LABEL, "split"))


def assemble(df: DataFrame, order: Sequence[str] = MODEL_INPUTS) -> DataFrame:
    """Adds the feature vector; the label must be there."""
    if LABEL not in df.columns:
        raise ModelError(f"column {LABEL!r} is missing")
    return VectorAssembler(inputCols=list(order), outputCol="features").transform(df)


def _assembler(order: Sequence[str], output: str = "features") -> VectorAssembler:
    # A ratio without a value (balance of exactly -1) must not end the job.
    return VectorAssembler(inputCols=list(order), outputCol=output, handleInvalid="keep")


def _logistic(order: Sequence[str], counts: ClassCounts) -> Estimator:
    # Balanced weights add up to the row count, which makes this the C = 1 penalty.
    return Pipeline(
        stages=[
            _assembler(order, "raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
            LogisticRegression(
                labelCol=LABEL, weightCol=WEIGHT, maxIter=200, regParam=1.0 / max(counts.rows, 1)
            ),
        ]
    )


def _forest(order: Sequence[str], counts: ClassCounts) -> Estimator:
    forest = RandomForestClassifier(
        labelCol=LABEL,
        weightCol=WEIGHT,
        numTrees=100,
        maxDepth=14,
        subsamplingRate=0.3,
        seed=SEED,
        maxMemoryInMB=1024,
        cacheNodeIds=True,
        checkpointInterval=10,
    )
    return Pipeline(stages=[_assembler(order), forest])


def _boosted(order: Sequence[str], **settings) -> Estimator:
    trees = boosting.BoostedTrees(
        inputCols=list(order), labelCol=LABEL, weightCol=WEIGHT, maxIter=200, stepSize=0.1, l2=1.0, **settings
    )
    return Pipeline(stages=[trees])


def _boosted_by_level(order: Sequence[str], counts: ClassCounts) -> Estimator:
    return _boosted(order, growth=boosting.LEVEL, maxDepth=6)


def _boosted_by_leaf(order: Sequence[str], counts: ClassCounts) -> Estimator:
    # Without the L2 penalty a large class weight ruins leaf-wise growth, the more the longer.
    return _boosted(order, growth=boosting.LEAF, maxLeaves=31, minRows=20, minHessian=1e-3)


@dataclass(frozen=True)
class ModelSpec:
    """A named estimator and how it weights rows: by class balance or positives only."""

    name: str
    build: Callable[[Sequence[str], ClassCounts], Estimator]
    balanced: bool


MODEL_SPECS = (
    ModelSpec("logistic_regression", _logistic, True),
    ModelSpec("random_forest", _forest, True),
    ModelSpec("boosted_level", _boosted_by_level, False),
    ModelSpec("boosted_leaf", _boosted_by_leaf, False),
)


def count_classes(train: DataFrame) -> ClassCounts:
    row = class_counts(train).first()
    return ClassCounts(row.negatives, row.positives)


def weighted(df: DataFrame, spec: ModelSpec, counts: ClassCounts) -> DataFrame:
    """Adds the weight column from counts that are already known."""
    if spec.balanced:
        one = counts.rows / (2 * counts.positives) if counts.positives else 1.0
        zero = counts.rows / (2 * counts.negatives) if counts.negatives else 1.0
    else:
        one, zero = counts.positive_weight, 1.0
    return df.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, F.lit(one)).otherwise(F.lit(zero)))


def dealt(train: DataFrame, counts: ClassCounts) -> DataFrame:
    """Train rows in even parts of at most ROWS_A_TASK, since the learners cache what a task
    reads; parts of a scan grow with the table. Small tables stay as they are."""
    tasks = -(-counts.rows // ROWS_A_TASK)
    if tasks <= 1:
        return train
    return train.repartition(max(tasks, train.sparkSession.sparkContext.defaultParallelism))


def fit(
    train: DataFrame,
    spec: ModelSpec,
    counts: ClassCounts | None = None,
    order: Sequence[str] = MODEL_INPUTS,
    share: boosting.Share | None = None,
) -> PipelineModel:
    """Fits one spec; tree learners cut their lineage in the shared folder.

    Who knows the counts has dealt the rows, too. Boosted trees that have the `share` in common
    bin the rows once.
    """
    shared_dir(train.sparkSession)
    if counts is None:
        counts = count_classes(train)
        train = dealt(train, counts)
    estimator = spec.build(order, counts)
    for stage in estimator.getStages() if isinstance(estimator, Pipeline) else (estimator,):
        if isinstance(stage, boosting.BoostedTrees):
            stage.share = share
    return estimator.fit(weighted(train, spec, counts))


def score(df: DataFrame, model: PipelineModel, version: str = "") -> DataFrame:
    return score_vectors(df, model, version)


@dataclass(frozen=True)
class Runs:
    """Fitted models by name and one metric row per (model, split)."""

    models: dict[str, PipelineModel]
    run_ids: dict[str, str]
    metrics: DataFrame


def train_compare(
    data: DataFrame,
    specs: Sequence[ModelSpec] = MODEL_SPECS,
    order: Sequence[str] = MODEL_INPUTS,
    parallelism: int = 4,
) -> Runs:
    """Fits every spec on train and scores validation and test with all of them.

    The held-out rows pass once through all models; the ten metrics of every
    (model, split) then come from one aggregation.
    """
    train = data.where(F.col("split") == "train").select(*order, LABEL)
    counts = count_classes(train)
    if not counts.rows:
        raise ModelError("the train split is empty")
    train = dealt(train, counts).persist()
    share = boosting.Share()
    try:
        # The fits share the cached rows and run side by side, like MLlib's own
        # cross-validation; Spark schedules their jobs.
        in_thread = inheritable_thread_target(train.sparkSession)
        with ThreadPoolExecutor(parallelism) as pool:
            jobs = [pool.submit(in_thread(fit), train, s, counts, order, share) for s in specs]
            models = {s.name: job.result() for s, job in zip(specs, jobs)}
    finally:
        share.close()
        train.unpersist()
    run_ids = {name: uuid.uuid4().hex for name in models}

    held_out = data.where(F.col("split").isin("validation", "test")).select(
        "split", F.col(LABEL).alias("truth"), *order
    )
    answers = []
    for i, (name, model) in enumerate(models.items()):
        held_out = score_vectors(held_out, model, "").withColumnsRenamed(
            {"prediction": f"_class{i}", "fraud_probability": f"_score{i}"}
        ).drop("model_version")
        answers.append(
            F.struct(
                F.lit(name).alias("model"),
                F.lit(i).alias("spec_order"),
                F.lit(run_ids[name]).alias("run_id"),
                F.col(f"_class{i}").alias("prediction"),
                F.col(f"_score{i}").alias("fraud_probability"),
            )
        )
    long = held_out.select("split", "truth", F.explode(F.array(*answers)).alias("r")).select(
        "split", "truth", "r.*"
    )
    table = metrics.evaluate(long, by=["model", "spec_order", "run_id", "split"])
    # Written once: every reader of these few rows would score all held-out rows anew.
    path = scratch_path(table.sparkSession, "runs")
    table.withColumn("feature_version", F.lit(feature_version())).write.parquet(path)
    return Runs(models, run_ids, table.sparkSession.read.parquet(path))


def parameters(model: PipelineModel) -> dict[str, str]:
    """Scalar settings of the last stage, as text."""
    stage = model.stages[-1]
    return {p.name: str(stage.getOrDefault(p)) for p in stage.params if stage.isDefined(p)}


def save_runs(runs: Runs, folder: str, order: Sequence[str] = MODEL_INPUTS) -> None:
    """Appends metrics, parameters and input order to the run tables; saves each model."""
    spark = runs.metrics.sparkSession
    runs.metrics.write.mode("append").parquet(f"{folder}/runs")
    described = [
        (runs.run_ids[name], name, feature_version(), list(order), json.dumps(parameters(model), sort_keys=True))
        for name, model in runs.models.items()
    ]
    spark.createDataFrame(
        described,
        "run_id string, model string, feature_version string, feature_names array<string>, parameters string",
    ).write.mode("append").parquet(f"{folder}/run_details")
    for name, model in runs.models.items():
        model.write().save(f"{folder}/models/{runs.run_ids[name]}")


def read_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The version table with the stage each version is in now; empty before the first one."""
    try:
        # A folder for each: writers of one folder at once would remove each other's work.
        each = {"recursiveFileLookup": "true"}
        known = spark.read.options(**each).schema(versions.VERSION_SCHEMA).parquet(f"{folder}/versions")
    except AnalysisException:
        return spark.createDataFrame([], versions.VERSION_SCHEMA)
    try:
        moves = spark.read.options(**each).schema(versions.MOVE_SCHEMA).parquet(f"{folder}/moves")
    except AnalysisException:
        return known
    return versions.moved(known, moves)


def _claimed(spark: SparkSession, folder: str, what: str, least: int = 1) -> int:
    """A number that no other caller gets: one more than any that is claimed."""
    taken = [int(n) for n in folders.names(spark, f"{folder}/claims/{what}", files=True) if n.isdigit()]
    number = max([least - 1, *taken]) + 1
    while not folders.create_once(spark, f"{folder}/claims/{what}/{number}"):
        number += 1
    return number


def register(spark: SparkSession, folder: str, name: str, run_id: str, stage: str = "None") -> str:
    """Gives the run the next version number of the name; of two callers at once each gets
    a number of its own."""
    known = versions.next_version(read_versions(spark, folder), name)
    version = str(_claimed(spark, folder, f"versions/{name}", int(known)))
    row = spark.createDataFrame([(name, version, run_id, stage)], versions.VERSION_SCHEMA)
    row.write.parquet(f"{folder}/versions/{name}/{version}")
    return version


def promote(
    spark: SparkSession, folder: str, name: str, version: str, stage: str = versions.PRODUCTION, archive: bool = True
) -> None:
    """Moves a version to a stage; with `archive` those that are there now leave it.

    A move is a row; the last row of a version counts, so moves at once do not mix.
    """
    named = read_versions(spark, folder).where(F.col("name") == name)
    if named.where(F.col("version") == version).isEmpty():
        raise ModelError(f"{name!r} has no version {version!r}")
    number = _claimed(spark, folder, f"moves/{name}")
    there = named.where((F.col("stage") == stage) & (F.col("version") != version)) if archive else named.limit(0)
    moves = there.select("name", "version", F.lit(versions.ARCHIVED).alias("stage"), F.lit(number).cast("long").alias("move"))
    moved = spark.createDataFrame([(name, version, stage, number)], versions.MOVE_SCHEMA)
    moves.unionByName(moved).coalesce(1).write.parquet(f"{folder}/moves/{name}/{number}")


def production_model(spark: SparkSession, folder: str, name: str) -> tuple[str, tuple[str, ...], PipelineModel]:
    """Version, input order and model of the newest version in Production."""
    version, run_id = versions.resolve(read_versions(spark, folder), name, versions.PRODUCTION)
    return version, load_feature_names(spark, folder, run_id), load_model(folder, run_id)


def load_model(folder: str, run_id: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/models/{run_id}")


def load_feature_names(spark: SparkSession, folder: str, run_id: str) -> tuple[str, ...]:
    """The ordered inputs the run was trained on."""
    try:
        details = spark.read.parquet(f"{folder}/run_details")
    except AnalysisException as error:
        raise ModelError(f"no runs are recorded in {folder}") from error
    row = details.where(F.col("run_id") == run_id).select("feature_names").first()
    if row is None:
        raise ModelError(f"run {run_id} is not recorded in {folder}")
    return tuple(row.feature_names)


def evaluate_version(
    spark: SparkSession, data: DataFrame, folder: str, name: str, run_id: str | None = None
) -> DataFrame:
    """Metrics of the given run, or of the latest version, on the test split."""
    version = ""
    if run_id is None:
        version, run_id = versions.resolve(read_versions(spark, folder), name)
    order = load_feature_names(spark, folder, run_id)
    test = data.where(F.col("split") == "test").select(F.col(LABEL).alias("truth"), *order)
    scored = score_vectors(test, load_model(folder, run_id), version)
    return metrics.evaluate(scored).withColumn("run_id", F.lit(run_id))


def check_splits(data: DataFrame) -> None:
    """Refuses a processed table that lacks a split or the label."""
    if LABEL not in data.columns:
        raise ModelError(f"column {LABEL!r} is missing")
    known = data.where(F.col("split").isin(*SPLITS)).select("split").distinct()
    found = {r.split for r in known.collect()}  # at most three rows
    absent = [s for s in SPLITS if s not in found]
    if absent:
        raise ModelError(f"processed data lacks the splits {absent}")
