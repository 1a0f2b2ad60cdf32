"""Training, selection, scoring and persistence of risk models on Spark ML."""

from __future__ import annotations

import json
import statistics
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from functools import cached_property

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import compiled
from riskloom.operators.attribution import Attribution, contributions
from riskloom.operators.evaluate import evaluate_scores
from riskloom.operators.explain import (
    background_means,
    background_rows,
    folded_factors,
)
from riskloom.operators.ordered import ordered_split
from riskloom.operators.prep import (
    balanced_weights,
    encoded_names,
    encoding_stages,
    impute,
    medians,
    most_frequent,
    positive_weight,
)
from riskloom.operators.presets import EVENT_TIME, TARGET
from riskloom.operators.validate import require_columns
from riskloom.session import keep_methods_compiled, shared_folder, spread, stage_table

# Candidates: boosted trees with balanced class weights, boosted trees with a positive-class
# weight, and a linear model.
TREES_BALANCED = "trees_balanced"
TREES_POSITIVE = "trees_positive"
LINEAR = "linear"
CANDIDATES = (TREES_BALANCED, TREES_POSITIVE)

SCORE = "prediction_score"
LABEL = "prediction_label"
_IN = "in_"


@dataclass(frozen=True)
class ModelSettings:
    """Fixed values of the training configuration."""

    trees: int = 300
    depth: int = 5
    learning_rate: float = 0.05
    row_share: float = 0.85
    column_share: float = 0.85
    min_leaf_rows: int = 3
    linear_iterations: int = 50
    linear_penalty: float = 0.01
    seed: int = 42
    threshold: float = 0.5


@dataclass
class ModelBundle:
    """A fitted pipeline and what is needed to feed it."""

    pipeline: PipelineModel
    kind: str
    target: str
    numerical: list[str]
    categorical: list[str]
    number_fill: dict[str, float | None]
    text_fill: dict[str, str | None]
    feature_names: list[str]
    threshold: float = 0.5
    settings: dict = field(default_factory=dict)

    @property
    def inputs(self) -> list[str]:
        return [*self.numerical, *self.categorical]

    def encode(self, df: DataFrame) -> DataFrame:
        """The input with the feature vector and the raw model output next to it."""
        require_columns(df, self.inputs, "scoring input")
        return self.pipeline.transform(impute(df, self.number_fill, self.text_fill, _IN))

    @cached_property
    def features(self) -> list[compiled.Feature]:
        """The encoded features, as expressions over the filled inputs."""
        names = [[f"{_IN}{c}" for c in part] for part in (self.numerical, self.categorical)]
        return compiled.encoded_features(self.pipeline.stages, *names)

    @cached_property
    def trees(self) -> list[tuple[float, compiled.Node]]:
        return compiled.read_trees(self.pipeline.stages[-1], SparkSession.getActiveSession())

    def _filled(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.inputs, "scoring input")
        return impute(df, self.number_fill, self.text_fill, _IN)

    def _scored(self, filled: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The given columns of the filled rows with score and label."""
        if self.kind == LINEAR:
            rows, margin = filled, compiled.linear_margin(self.features, self.linear.coefficients, self.linear.intercept)
        else:
            rows, margin = compiled.tree_scores(self.pipeline.stages[-1], filled, columns, self.features), F.col("_margin")
        scored = rows.select(*columns, compiled.logistic(margin).alias(SCORE))
        return scored.withColumn(LABEL, (F.col(SCORE) >= self.threshold).cast("int"))

    def score(self, df: DataFrame) -> DataFrame:
        """All input columns plus score and label."""
        return self._scored(self._filled(df), df.columns)

    @property
    def linear(self):
        if self.kind != LINEAR:
            raise ValueError("only the linear model has coefficients")
        return self.pipeline.stages[-1]

    def means(self, df: DataFrame, order: Sequence[str]) -> list[float]:
        """Background means of the first rows; only those rows are encoded. Trees carry their own background.

        The rows are landed first, as Spark would otherwise encode every row before it takes the first ones.
        """
        if self.kind != LINEAR:
            return []
        first = stage_table(background_rows(df.select(*dict.fromkeys([*order, *self.inputs])), order), "background")
        return background_means(self.encode(first), len(self.feature_names))

    @cached_property
    def attribution(self) -> Attribution:
        """Contributions of the trees to the log-odds."""
        return Attribution(self.trees, len(self.features), 2.0)

    def _contributions(self, means: Sequence[float]) -> Column:
        """One number for each encoded feature: parts of the log-odds, as an array."""
        values = [f.value() for f in self.features]
        if self.kind == LINEAR:
            return F.array(*[(v - F.lit(float(m))) * F.lit(float(c)) for v, c, m in zip(values, self.linear.coefficients, means, strict=True)])
        return contributions(self.attribution, values)

    def explain(self, df: DataFrame, order: Sequence[str], background: DataFrame | None = None) -> DataFrame:
        """Scored rows with their folded factors; for the linear model against the mean of the first rows of the background."""
        return self.explained(df, self.means(df if background is None else background, order))

    def explained(self, df: DataFrame, means: Sequence[float]) -> DataFrame:
        """Scored rows with their factors, for the linear model against given background means."""
        filled = self._filled(df).withColumn("_parts", self._contributions(means))
        scored = self._scored(filled, [*df.columns, "_parts"])
        parts = [F.col("_parts")[i] for i in range(len(self.features))]
        return scored.withColumn("factors", folded_factors(parts, self.feature_names)).drop("_parts")

    def contributions(self, df: DataFrame, order: Sequence[str], row_id: str, name: str = "contributions") -> DataFrame:
        """Row id and the contribution of every encoded feature, as an array."""
        return self._filled(df).select(row_id, self._contributions(self.means(df, order)).alias(name))

    def save(self, path: str) -> str:
        spark = SparkSession.getActiveSession()
        base = path.rstrip("/")
        self.pipeline.write().overwrite().save(f"{base}/model")
        meta = {k: v for k, v in self.__dict__.items() if k not in ("pipeline", "features", "trees", "attribution")}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/meta")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelBundle:
        base = path.rstrip("/")
        meta = json.loads(spark.read.text(f"{base}/meta").first()["value"])
        return cls(pipeline=PipelineModel.load(f"{base}/model"), **meta)


def _classifier(kind: str, settings: ModelSettings, target: str):
    common = {"featuresCol": "features", "labelCol": target, "weightCol": "_weight"}
    if kind in (TREES_BALANCED, TREES_POSITIVE):
        return GBTClassifier(
            **common,
            maxIter=settings.trees,
            maxDepth=settings.depth,
            stepSize=settings.learning_rate,
            subsamplingRate=settings.row_share,
            featureSubsetStrategy=str(settings.column_share),
            minInstancesPerNode=settings.min_leaf_rows,
            checkpointInterval=10,
            seed=settings.seed,
        )
    if kind == LINEAR:
        return LogisticRegression(**common, maxIter=settings.linear_iterations, regParam=settings.linear_penalty)
    raise ValueError(f"unsupported model kind: {kind}")


def _class_weights(train: DataFrame, kind: str, target: str) -> tuple[float, float]:
    """Weights of class 0 and class 1."""
    if kind == TREES_POSITIVE:
        return 1.0, positive_weight(train, target)
    weights = balanced_weights(train, target)
    return weights.get(0, 1.0), weights.get(1, 1.0)


@dataclass
class TrainingRows:
    """Training rows as every candidate takes them: filled inputs and label, and what was fitted to fill and encode them."""

    filled: DataFrame
    target: str
    numerical: list[str]
    categorical: list[str]
    number_fill: dict[str, float | None]
    text_fill: dict[str, str | None]
    encoder: PipelineModel
    seconds: float = 0.0

    def encoded(self, weight: Column) -> DataFrame:
        """Feature vector, label and weight. The vector is built from expressions, with the encoder's own description of it."""
        names = [[f"{_IN}{c}" for c in part] for part in (self.numerical, self.categorical)]
        values = [f.value() for f in compiled.encoded_features(self.encoder.stages, *names)]
        about = self.encoder.transform(self.filled).schema["features"].metadata
        return self.filled.select(
            array_to_vector(F.array(*values)).alias("features", metadata=about),
            F.col(self.target).cast("double").alias(self.target),
            weight.alias("_weight"),
        )


def training_rows(train: DataFrame, categorical: Sequence[str], numerical: Sequence[str], target: str = TARGET) -> TrainingRows:
    """Fit imputation values and encoding on the training rows only."""
    start = time.perf_counter()
    spark = train.sparkSession
    keep_methods_compiled(spark)
    shared_folder(spark)  # the tree trainer cuts its lineage there
    categorical = [c for c in categorical if c in train.columns]
    numerical = [c for c in numerical if c in train.columns]
    train = spread(train.select(*numerical, *categorical, target))
    number_fill = {c: v if v is not None else 0.0 for c, v in medians(train, numerical).items()}
    text_fill = most_frequent(train, categorical)
    inputs = [f"{_IN}{c}" for c in numerical], [f"{_IN}{c}" for c in categorical]
    filled = impute(train, number_fill, text_fill, _IN).select(*inputs[0], *inputs[1], target)
    encoder = Pipeline(stages=encoding_stages(*inputs)).fit(filled)
    return TrainingRows(filled, target, numerical, categorical, number_fill, text_fill, encoder, time.perf_counter() - start)


def fit(
    train: DataFrame | TrainingRows,
    categorical: Sequence[str],
    numerical: Sequence[str],
    kind: str = TREES_BALANCED,
    settings: ModelSettings = ModelSettings(),
    target: str = TARGET,
) -> ModelBundle:
    """Fit imputation values, encoding and model on the training rows only; rows prepared before serve several kinds."""
    rows = train if isinstance(train, TrainingRows) else training_rows(train, categorical, numerical, target)
    zero, one = _class_weights(rows.filled, kind, rows.target)
    prepared = rows.encoded(F.when(F.col(rows.target) == 1, F.lit(one)).otherwise(F.lit(zero)))
    pipeline = PipelineModel([*rows.encoder.stages, _classifier(kind, settings, rows.target).fit(prepared)])
    if kind == LINEAR:
        pipeline = _without_summary(pipeline)
    return ModelBundle(
        pipeline=pipeline,
        kind=kind,
        target=rows.target,
        numerical=rows.numerical,
        categorical=rows.categorical,
        number_fill=rows.number_fill,
        text_fill=rows.text_fill,
        feature_names=encoded_names(rows.numerical, rows.categorical, pipeline.stages),
        threshold=settings.threshold,
        settings=asdict(settings),
    )


def _without_summary(pipeline: PipelineModel) -> PipelineModel:
    """The pipeline with its linear model read back from the shared folder.

    A freshly fitted one carries a training summary that holds the session, and then cannot be
    sent to tasks once the session has observed a metric.
    """
    path = f"{shared_folder(SparkSession.getActiveSession()).rstrip('/')}/linear-{uuid.uuid4().hex}"
    pipeline.stages[-1].write().save(path)
    return PipelineModel([*pipeline.stages[:-1], LogisticRegressionModel.load(path)])


@dataclass
class TrainingResult:
    kind: str
    bundle: ModelBundle
    metrics_valid: dict
    metrics_test: dict
    sizes: dict[str, int]
    seconds: float


def scored_view(bundle: ModelBundle, df: DataFrame, row_id: str) -> DataFrame:
    """Row id, label and score: the shape the metrics take."""
    return bundle.score(df).select(
        F.col(row_id).alias("row_id"), F.col(bundle.target).cast("int").alias("y"), F.col(SCORE).alias("score")
    )


def metrics_of(bundle: ModelBundle, df: DataFrame, row_id: str) -> dict:
    """Metrics of one part; the scores are landed, as the metrics pass over them several times."""
    scores = stage_table(scored_view(bundle, df, row_id), "scores")
    row = evaluate_scores(scores, bundle.threshold).first()
    return row.asDict() if row else {}


def train(
    prepared: DataFrame,
    categorical: Sequence[str],
    numerical: Sequence[str],
    kind: str = TREES_BALANCED,
    *,
    index: str = "event_id",
    settings: ModelSettings = ModelSettings(),
    target: str = TARGET,
) -> TrainingResult:
    """Ordered split, fit on the first part, metrics on the other two. `prepared` should be a landed table."""
    return _train_each(prepared, categorical, numerical, [kind], index=index, settings=settings, target=target)[0]


def _train_each(
    prepared: DataFrame,
    categorical: Sequence[str],
    numerical: Sequence[str],
    kinds: Sequence[str],
    *,
    index: str = "event_id",
    settings: ModelSettings = ModelSettings(),
    target: str = TARGET,
) -> list[TrainingResult]:
    """Every kind on the same split and the same filled rows; what they share counts in the seconds of each."""
    keep_methods_compiled(prepared.sparkSession)
    split = prepared if "split" in prepared.columns else ordered_split(prepared, [index], index=index)
    parts = {s: split.where(F.col("split") == s) for s in ("train", "valid", "test")}
    sizes = {r[0]: r[1] for r in split.groupBy("split").agg(F.count(F.lit(1))).collect()}
    rows, results = training_rows(parts["train"], categorical, numerical, target), []
    for kind in kinds:
        start = time.perf_counter()
        bundle = fit(rows, categorical, numerical, kind, settings, target)
        seconds = rows.seconds + time.perf_counter() - start
        results.append(
            TrainingResult(
                kind=kind,
                bundle=bundle,
                metrics_valid=metrics_of(bundle, parts["valid"], index),
                metrics_test=metrics_of(bundle, parts["test"], index),
                sizes={s: sizes.get(s, 0) for s in parts},
                seconds=seconds,
            )
        )
    return results


def select_best(results: Sequence[TrainingResult], metric: str = "pr_auc") -> TrainingResult:
    return max(results, key=lambda r: r.metrics_valid[metric])


def train_and_select(
    prepared: DataFrame,
    categorical: Sequence[str],
    numerical: Sequence[str],
    candidates: Sequence[str] = CANDIDATES,
    *,
    publish_to: str | None = None,
    **options,
) -> tuple[TrainingResult, list[TrainingResult]]:
    """Train every candidate, take the best by validation average precision and publish it."""
    results = _train_each(prepared, categorical, numerical, candidates, **options)
    best = select_best(results)
    if publish_to:
        best.bundle.save(publish_to)
    return best, results


def selection_summary(spark: SparkSession, best: TrainingResult, results: Sequence[TrainingResult]) -> DataFrame:
    """One row per candidate: sizes, validation and test metrics, and whether it was chosen."""
    names = ["roc_auc", "pr_auc", "precision", "recall", "f1_score", "threshold", "alert_rate", "false_positive_rate"]
    schema = ", ".join(
        ["model_type string, is_best boolean, train_rows bigint, valid_rows bigint, test_rows bigint, train_time_sec double"]
        + [f"{part}_{n} double" for part in ("valid", "test") for n in names]
    )
    rows = [
        (
            r.kind,
            r is best,
            *[r.sizes[s] for s in ("train", "valid", "test")],
            float(r.seconds),
            *[r.metrics_valid.get(n) for n in names],
            *[r.metrics_test.get(n) for n in names],
        )
        for r in results
    ]
    return spark.createDataFrame(rows, schema)


def run_parameters(result: TrainingResult) -> dict:
    """Ledger parameters of a training run."""
    return {
        "model_type": result.kind,
        "target_column": result.bundle.target,
        **{f"n_{s}_rows": n for s, n in result.sizes.items()},
        "n_features_before_preprocessing": len(result.bundle.inputs),
        "n_features_after_preprocessing": len(result.bundle.feature_names),
        **result.bundle.settings,
    }


def run_metrics(result: TrainingResult) -> dict:
    return {
        **{f"valid_{k}": v for k, v in result.metrics_valid.items()},
        **{f"test_{k}": v for k, v in result.metrics_test.items()},
    }


def time_scoring(score: Callable[[DataFrame], DataFrame], df: DataFrame, repeats: int = 3, warmup_rows: int = 1000) -> DataFrame:
    """One row per timed repeat (batch_size, repeat, seconds): scoring into a sink that keeps nothing."""
    rows = df.count()
    score(df.limit(warmup_rows)).write.format("noop").mode("overwrite").save()
    runs = []
    for repeat in range(repeats):
        start = time.perf_counter()
        score(df).write.format("noop").mode("overwrite").save()
        runs.append((rows, repeat, time.perf_counter() - start))
    return df.sparkSession.createDataFrame(runs, "batch_size bigint, repeat int, seconds double")


def timing_summary(seconds: Sequence[float], rows: int) -> dict[str, float | None]:
    middle = statistics.median(seconds)
    return {
        "inference_time_sec_median": middle,
        "inference_time_sec_mean": statistics.mean(seconds),
        "inference_time_per_1000_sec": middle / rows * 1000 if rows else None,
        "records_per_second": rows / middle if middle > 0 else None,
    }


def model_input(df: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Only what the model reads; label and time are never inputs."""
    return df.select(*[c for c in bundle.inputs if c not in (bundle.target, EVENT_TIME)])
