"""End-to-end jobs: data check, features, training, benchmark, drift, scoring and explanations."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import applications, clean, drift, evaluate, explain, models, results, sequences, transfers
from riskloom.operators.models import ModelBundle, ModelSettings
from riskloom.operators.ordered import ordered_split, split_borders
from riskloom.operators.presets import ALERT_COLUMNS, TARGET
from riskloom.operators.review import with_band
from riskloom.operators.validate import ValidationReport, distinct_with_copies, full_validation
from riskloom.session import keep_methods_compiled, stage_table
from riskloom.sources import files, ledger


@dataclass
class Prepared:
    """A landed feature table with a position column, ready for splitting and training."""

    frame: DataFrame
    categorical: list[str]
    numerical: list[str]
    rows: int
    index: str = "event_id"


def check_data(raw: DataFrame, out: str | None = None) -> tuple[ValidationReport, DataFrame]:
    """Validate and clean a table, and save the result in its reproducible order."""
    report, cleaned = validated(raw)
    if out:
        files.write_table(clean.sorted_for_output(cleaned), out)
    return report, cleaned


def validated(raw: DataFrame) -> tuple[ValidationReport, DataFrame]:
    """Report and cleaned rows from one grouping of equal rows, landed so that it runs once."""
    keep_methods_compiled(raw.sparkSession)
    copies = stage_table(distinct_with_copies(raw), "distinct-rows")
    report = full_validation(raw, copies=copies)
    return report, clean.clean_distinct(copies.drop("_copies"))


def build_application_features(
    raw: DataFrame,
    tie: Sequence[str] = (),
    *,
    feature_set: str = "engineered",
    out: str | None = None,
    spec_out: str | None = None,
    partition_by: Sequence[str] = (),
) -> Prepared:
    """Validate, clean, derive features and land the table."""
    _, cleaned = validated(raw)
    build = applications.build_features(cleaned, tie, stage=False)
    frame, categorical, numerical = build.frame, build.categorical_columns, build.numerical_columns
    if feature_set == "raw":
        frame = frame.select(*raw.columns, "event_id")
        categorical, numerical = applications.raw_feature_lists(frame.columns, not_features=[*tie, "event_id"])
    elif feature_set != "engineered":
        raise ValueError(f"unknown feature set: {feature_set}")
    if spec_out:
        ledger.write_feature_spec(applications.feature_spec(build), spec_out)
    return Prepared(_land(frame, "application-features", out, partition_by), categorical, numerical, build.rows or 0)


def build_transfer_features(raw: DataFrame, tie: Sequence[str] = (), *, out: str | None = None) -> Prepared:
    keep_methods_compiled(raw.sparkSession)
    prepared = transfers.prepare_transfers(raw, tie, index="event_id")
    frame = _land(prepared, "transfer-features", out)
    categorical, numerical = transfers.transfer_feature_lists(frame.columns, ["event_id"])
    return Prepared(frame, categorical, numerical, frame.count())


def build_alert_features(
    alerts: DataFrame, transactions: DataFrame, tie: Sequence[str] = (), *, out: str | None = None, **options
) -> Prepared:
    """Alert features, positioned by date and alert id."""
    from riskloom.operators.ordered import with_row_index

    table = sequences.alert_features(alerts, transactions, tie, keep=["AlertID", "Date"], **options)
    landed = _land(table, "alert-features", None)
    indexed = with_row_index(landed, ["Date", "AlertID"], "event_id")
    frame = _land(indexed.frame, "alert-features-ordered", out)
    numerical = [c for c in frame.columns if c not in (TARGET, "event_id", *ALERT_COLUMNS)]
    return Prepared(frame, [], numerical, indexed.rows)


def _land(df: DataFrame, label: str, out: str | None, partition_by: Sequence[str] = ()) -> DataFrame:
    """A written table, so that several fits and passes read files rather than repeat the plan."""
    if out is None:
        return stage_table(df, label, list(partition_by))
    files.write_table(df, out, partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def run_training(
    prepared: Prepared,
    candidates: Sequence[str] = models.CANDIDATES,
    *,
    settings: ModelSettings = ModelSettings(),
    publish_to: str | None = None,
    runs_out: str | None = None,
) -> DataFrame:
    """Train and select; the summary has one row per candidate, the ledger gets every run."""
    spark = prepared.frame.sparkSession
    best, fitted = models.train_and_select(
        prepared.frame,
        prepared.categorical,
        prepared.numerical,
        candidates,
        publish_to=publish_to,
        index=prepared.index,
        settings=settings,
    )
    if runs_out:
        for result in fitted:
            rows = ledger.run_rows(spark, ledger.new_run_id(), models.run_parameters(result), models.run_metrics(result))
            ledger.append_run(rows, runs_out)
    return models.selection_summary(spark, best, fitted)


@dataclass(frozen=True)
class BenchmarkJob:
    scenario: str
    train_dataset: str
    eval_dataset: str
    model_type: str
    feature_set: str
    threshold: float = evaluate.DEFAULT_THRESHOLD

    @property
    def job_id(self) -> str:
        return f"{self.eval_dataset}_{self.model_type}_{self.feature_set}"

    @property
    def evaluation_mode(self) -> str:
        return "held_out_test" if self.train_dataset == self.eval_dataset else "external_dataset"


def _benchmark_jobs() -> list[BenchmarkJob]:
    """Ten jobs: both candidates on raw and engineered base data, on transfers, and on two variants."""
    plan = [
        ("Base", "base", "base", "raw"),
        ("Base", "base", "base", "engineered"),
        ("SAML-D", "samld", "samld", "engineered"),
        ("Variant I", "base", "variant_1", "engineered"),
        ("Variant II", "base", "variant_2", "engineered"),
    ]
    return [BenchmarkJob(s, t, e, kind, f) for s, t, e, f in plan for kind in models.CANDIDATES]


BENCHMARK_JOBS = _benchmark_jobs()


@dataclass
class BenchmarkResult:
    """Metric rows of a job: one at the default threshold, one per operating point."""

    row: DataFrame
    mode_rows: DataFrame
    bundle: ModelBundle
    evaluated: DataFrame = field(repr=False, default=None)


def run_benchmark_job(
    job: BenchmarkJob, train_on: Prepared, evaluate_on: Prepared | None = None, *, settings: ModelSettings = ModelSettings()
) -> BenchmarkResult:
    """Train, choose thresholds on the validation part, measure on the held-out part or an external table."""
    split = ordered_split(train_on.frame, [train_on.index], index=train_on.index)
    start = time.perf_counter()
    bundle = models.fit(
        split.where(F.col("split") == "train"), train_on.categorical, train_on.numerical, job.model_type, settings
    )
    train_time = time.perf_counter() - start
    external = job.evaluation_mode == "external_dataset"
    target = evaluate_on.frame if external else split.where(F.col("split") == "test")
    index = evaluate_on.index if external else train_on.index
    valid = stage_table(models.scored_view(bundle, split.where(F.col("split") == "valid"), train_on.index), "valid-scores")
    start = time.perf_counter()
    scored = stage_table(models.scored_view(bundle, target, index), "test-scores")
    inference_time = time.perf_counter() - start
    train_end, valid_end = split_borders(train_on.rows)
    identity = {
        "job_id": job.job_id,
        "scenario": job.scenario,
        "dataset": job.scenario,
        "train_dataset_name": job.train_dataset,
        "eval_dataset_name": job.eval_dataset,
        "evaluation_mode": job.evaluation_mode,
        "model_type": job.model_type,
        "feature_set": job.feature_set,
    }
    sizes = {
        "train_rows": train_end,
        "valid_rows": valid_end - train_end,
        "test_rows": evaluate_on.rows if external else train_on.rows - valid_end,
        "train_time_sec": float(train_time),
        "inference_time_sec": float(inference_time),
    }

    def finish(df: DataFrame) -> DataFrame:
        return evaluate.result_row(df, identity).withColumns({n: F.lit(v) for n, v in sizes.items()})

    row = evaluate.evaluate_scores(scored, job.threshold).withColumns(
        {"threshold_mode": F.lit(evaluate.MODE_DEFAULT), "threshold_selected_on": F.lit("fixed")}
    )
    modes = evaluate.apply_operating_points(valid, scored)
    return BenchmarkResult(finish(row), finish(modes), bundle, target)


def run_benchmark_suite(
    prepared: dict[tuple[str, str], Prepared],
    jobs: Sequence[BenchmarkJob] = tuple(BENCHMARK_JOBS),
    *,
    settings: ModelSettings = ModelSettings(),
    repeats: int = 3,
) -> dict[str, DataFrame]:
    """Run the jobs one after another on shared landed tables (by dataset and feature set); build all result tables."""
    rows, modes, runs = [], [], []
    for job in jobs:
        train_on = prepared[job.train_dataset, job.feature_set]
        result = run_benchmark_job(job, train_on, prepared.get((job.eval_dataset, job.feature_set)), settings=settings)
        rows.append(stage_table(result.row.withColumn("source_file", F.lit(f"{job.job_id}.csv")), "job-row"))
        modes.append(
            stage_table(result.mode_rows.withColumn("source_file", F.lit(f"{job.job_id}_threshold_modes.csv")), "job-modes")
        )
        if repeats:
            timed = models.time_scoring(result.bundle.score, result.evaluated, repeats)
            runs.append(timed.withColumn("job_id", F.lit(job.job_id)))
    timings = results.timing_table(reduce(DataFrame.unionByName, runs)) if runs else None
    return benchmark_tables(results.concat_results(rows), results.concat_results(modes), timings)


def benchmark_tables(rows: DataFrame, modes: DataFrame | None = None, timings: DataFrame | None = None) -> dict[str, DataFrame]:
    """All report tables from job rows, mode rows and timings."""
    every = results.coerce_results(rows)
    out = {
        "results_all": results.sort_by_scenario_rank(every),
        "results_by_name": results.sort_by_scenario_name(every),
        "best_by_pr_auc": results.sort_by_scenario_rank(results.best_per_scenario(every, ["pr_auc"])),
        "best_by_three": results.sort_by_scenario_name(
            results.best_per_scenario(every, ["pr_auc", "f1_score", "precision_at_100"])
        ),
        "overall_best": results.overall_best(every),
        "chapter": results.project_present(results.sort_by_scenario_rank(every), results.CHAPTER_COLUMNS),
        "lift": results.project_present(results.sort_by_scenario_rank(every), results.LIFT_COLUMNS),
    }
    if modes is not None:
        all_modes = results.coerce_results(modes)
        out["threshold_modes"] = results.sort_by_scenario_rank(all_modes)
        out["best_by_f1"] = results.sort_by_scenario_rank(
            results.best_per_scenario(all_modes, ["f1_score"], tie=["job_id", "threshold_mode"])
        )
        out["threshold_chapter"] = results.project_present(out["threshold_modes"], results.CHAPTER_COLUMNS)
    if timings is not None:
        out["timings"] = timings
        out["results_with_inference"] = results.join_timings(every, timings)
        out["performance"] = results.project_present(out["results_with_inference"], results.PERFORMANCE_COLUMNS)
    return out


def save_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    return {name: files.write_table(df.coalesce(1), f"{folder.rstrip('/')}/{name}.csv") for name, df in tables.items()}


def run_drift_check(
    reference: DataFrame, current: DataFrame, tie: Sequence[str] = (), *, out: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Validate, clean and derive both tables, then compare them: (column table, summary with retrain flag)."""
    sides = [build_application_features(side, tie).frame for side in (reference, current)]
    # The position says nothing about a row's content but how many rows there are.
    columns = drift.drift_columns(*sides, drop=(TARGET, "event_time", *tie))
    table = drift.drift_table(*sides, columns)
    summary = drift.retrain_decision(drift.drift_summary(table))
    if out:
        files.write_table(summary, out)
    return table, summary


def score_batch(
    requests: DataFrame,
    bundle: ModelBundle,
    *,
    row_id: str = "row_id",
    explainer: ModelBundle | None = None,
    log_to: str | None = None,
) -> DataFrame:
    """Clean, derive, score, band and explain requests; rows keep the caller's row id.

    Every request row gets a result, equal ones too. No input rows give no output rows.
    """
    started = time.perf_counter()
    keep_methods_compiled(requests.sparkSession)
    build = applications.build_features(clean.clean_distinct(requests), [row_id], stage=False)
    scored = with_band(bundle.score(build.frame))
    explainer = explainer or bundle
    shown = [row_id, models.SCORE, models.LABEL, "recommendation"]
    if explainer is not bundle:
        factors = explainer.explain(scored.drop(models.SCORE, models.LABEL), [row_id]).select(row_id, "factors")
        explained = scored.select(*shown).join(factors, row_id)
    else:
        explained = with_band(bundle.explain(build.frame, [row_id]))
    parts = explain.explanation_columns(F.col("factors"))
    out = explain.with_reasons(
        explained.select(*shown, *[parts[n].alias(n) for n in ("top_positive_factors", "top_negative_factors")])
    )
    if log_to:
        out = stage_table(out, "scored-requests")
        latency = (time.perf_counter() - started) * 1000
        log = ledger.prediction_log(out, "batch", bundle.kind, latency, batch_size=out.count())
        ledger.append_predictions(log, log_to)
    return out


def export_explanations(
    prepared: Prepared, bundle: ModelBundle, path: str | None = None, *, rows: int = 10, top_k: int = explain.TOP_FACTORS
) -> DataFrame:
    """Nested explanations of the first rows of a table."""
    from riskloom.operators.ordered import first_rows

    sample = first_rows(prepared.frame, [prepared.index], rows)
    explained = bundle.explain(sample, [prepared.index])
    parts = explain.explanation_columns(F.col("factors"), top_k)
    out = explain.with_reasons(
        explained.select(
            F.col(prepared.index).alias("row_index"), models.SCORE, models.LABEL, *[c.alias(n) for n, c in parts.items()]
        )
    )
    if path:
        explain.write_explanations(out, path)
    return out


def load_and_check_drift(spark: SparkSession, catalog, reference: str, current: str, **sources) -> tuple[DataFrame, DataFrame]:
    """The drift job on catalog datasets; each side may have its own source."""
    both = sources.get("source")
    left = catalog.load(spark, reference, sources.get("reference_source") or both)
    right = catalog.load(spark, current, sources.get("current_source") or both)
    return run_drift_check(left, right, sources.get("tie", ()), out=sources.get("out"))
