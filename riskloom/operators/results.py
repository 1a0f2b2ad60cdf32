"""Tables built from benchmark result rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import to_number
from riskloom.sources.files import path_exists, read_table

# Column lists of the result tables and the scenario order.
NUMERIC_RESULT_COLUMNS = [
    "threshold",
    "roc_auc",
    "pr_auc",
    "precision",
    "recall",
    "f1_score",
    "false_positive_rate",
    "alert_rate",
    "positive_share",
    "precision_at_100",
    "recall_at_100",
    "lift_at_100",
    "precision_at_500",
    "recall_at_500",
    "lift_at_500",
    "tp",
    "fp",
    "fn",
    "tn",
    "train_rows",
    "valid_rows",
    "test_rows",
    "train_time_sec",
    "inference_time_sec",
]
SCENARIO_ORDER = {"Base": 1, "SAML-D": 2, "Variant I": 3, "Variant II": 4}
CHAPTER_COLUMNS = [
    "scenario",
    "model_type",
    "feature_set",
    "threshold_mode",
    "threshold",
    "threshold_selected_on",
    "roc_auc",
    "pr_auc",
    "precision",
    "recall",
    "f1_score",
    "false_positive_rate",
    "alert_rate",
    "positive_share",
    "precision_at_100",
    "recall_at_100",
    "lift_at_100",
    "precision_at_500",
    "recall_at_500",
    "lift_at_500",
    "tp",
    "fp",
    "fn",
    "tn",
    "source_file",
]
LIFT_COLUMNS = [
    "scenario",
    "model_type",
    "feature_set",
    "positive_share",
    "precision_at_100",
    "recall_at_100",
    "lift_at_100",
    "precision_at_500",
    "recall_at_500",
    "lift_at_500",
    "source_file",
]
PERFORMANCE_COLUMNS = [
    "scenario",
    "model_type",
    "feature_set",
    "train_time_sec",
    "batch_size",
    "inference_time_sec_median",
    "inference_time_per_1000_sec",
    "records_per_second",
]
TIMING_COLUMNS = [
    "batch_size",
    "inference_repeats",
    "inference_time_sec_median",
    "inference_time_sec_mean",
    "inference_time_per_1000_sec",
    "records_per_second",
]


def read_results(spark: SparkSession, paths: Sequence[str], on_missing: str = "error") -> DataFrame:
    """Union of job result files with the file each row came from. Absent files raise or are skipped."""
    present = [p for p in paths if path_exists(spark, p)]
    absent = [p for p in paths if p not in present]
    if absent and on_missing == "error":
        raise FileNotFoundError(f"no result file: {absent}")
    if not present:
        raise FileNotFoundError("none of the result files exists")
    frames = [
        read_table(spark, p).withColumn("source_file", F.lit(p.rstrip("/").rsplit("/", 1)[-1])) for p in present
    ]
    return concat_results(frames)


def concat_results(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def coerce_results(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_RESULT_COLUMNS)) -> DataFrame:
    return df.withColumns({c: to_number(c) for c in columns if c in df.columns})


def scenario_rank(order: dict[str, int] | None = None):
    order = SCENARIO_ORDER if order is None else order
    ranks = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, F.col("scenario")), F.lit(99))


def _tie(df: DataFrame) -> list[Column]:
    """The last key of an order, so that equal metrics come in one order."""
    return [F.col("job_id")] if "job_id" in df.columns else []


def sort_by_scenario_rank(df: DataFrame, order: dict[str, int] | None = None) -> DataFrame:
    return df.orderBy(scenario_rank(order), F.col("pr_auc").desc_nulls_last(), F.col("roc_auc").desc_nulls_last(), *_tie(df))


def sort_by_scenario_name(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("scenario"),
        *[F.col(c).desc_nulls_last() for c in ("pr_auc", "f1_score", "precision_at_100")],
        *_tie(df),
    )


def scenario_tables(df: DataFrame, path: str) -> None:
    """One folder per scenario under the path."""
    df.write.mode("overwrite").partitionBy("scenario").parquet(path)


def scenario_slug(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def best_per_scenario(df: DataFrame, metrics: Sequence[str], tie: Sequence[str] = ("job_id",), by: str = "scenario") -> DataFrame:
    """The row with the highest metrics per scenario; the lowest tie key wins among equals.

    Rows without the first metric cannot win. A mergeable minimum, so a large scenario is no burden.
    """
    usable = df.where(F.col(metrics[0]).isNotNull())
    rank = F.struct(
        *[part for m in metrics for part in (F.col(m).isNull().cast("int"), -F.col(m).cast("double"))],
        *[F.col(t) for t in tie],
    )
    rest = [c for c in df.columns if c != by]
    best = usable.groupBy(by).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*[F.col(by) if c == by else F.col(f"_row.{c}").alias(c) for c in df.columns])


def overall_best(df: DataFrame, metrics: Sequence[str] = ("pr_auc", "roc_auc", "precision_at_100"), tie: str = "job_id") -> DataFrame:
    """The best row by each metric, all found in one aggregate."""
    whole = F.struct(*df.columns)
    best = df.agg(
        *[
            F.min_by(whole, F.when(F.col(m).isNotNull(), F.struct(-F.col(m).cast("double"), F.col(tie)))).alias(m)
            for m in metrics
        ]
    )
    rows = F.array(*[F.struct(F.lit(m).alias("best_by"), F.col(m).alias("row")) for m in metrics])
    return best.select(F.explode(rows).alias("e")).select("e.best_by", "e.row.*").where(F.col(tie).isNotNull())


def timing_table(runs: DataFrame, by: Sequence[str] = ("job_id",)) -> DataFrame:
    """Median and mean of repeated timings, seconds per 1000 rows and rows per second.

    `runs` holds one row per repeat: the group columns, batch_size and seconds.
    """
    median, size = F.col("inference_time_sec_median"), F.col("batch_size").cast("double")
    return (
        runs.groupBy(*by)
        .agg(
            F.max("batch_size").alias("batch_size"),
            F.count(F.lit(1)).alias("inference_repeats"),
            F.median("seconds").alias("inference_time_sec_median"),
            F.avg("seconds").alias("inference_time_sec_mean"),
        )
        .withColumns(
            {
                "inference_time_per_1000_sec": F.try_divide(median, size) * 1000,
                "records_per_second": F.try_divide(size, median),
            }
        )
    )


def join_timings(results: DataFrame, timings: DataFrame) -> DataFrame:
    return results.join(timings.select("job_id", *[c for c in TIMING_COLUMNS if c in timings.columns]), "job_id", "left")


def project_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A report projection; columns the table lacks are left out."""
    return df.select(*[c for c in columns if c in df.columns])


def scenario_like(df: DataFrame, text: str, columns: Sequence[str] = tuple(CHAPTER_COLUMNS)) -> DataFrame:
    """Rows whose scenario contains the text, whatever its case; the text is taken literally."""
    return project_present(df.where(F.contains(F.lower("scenario"), F.lit(text.lower()))), columns)
