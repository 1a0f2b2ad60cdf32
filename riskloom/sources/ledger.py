"""Append-only tables of predictions, metrics and runs, and the feature specification."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def prediction_log(
    results: DataFrame,
    mode: str,
    model_type: str,
    latency_ms: float,
    payload: Column | None = None,
    *,
    request_id: str | None = None,
    batch_size: int | None = None,
) -> DataFrame:
    """Log rows: request id, UTC time, mode, model, latency, payload and result as JSON.

    A batch is one request: with `batch_size` all rows carry the same id, and the payload is the size. Otherwise
    every row is a request of its own, unless an id is given, and `payload` says what it held.
    """
    if batch_size is not None:
        request_id = request_id or str(uuid.uuid4())
        payload = F.struct(F.lit(int(batch_size)).cast("bigint").alias("batch_size"))
    elif payload is None:
        raise ValueError("a log needs a payload or a batch size")
    identity = F.lit(request_id) if request_id else F.uuid()
    return results.select(
        identity.alias("request_id"),
        F.current_timestamp().alias("timestamp_utc"),
        F.lit(mode).alias("mode"),
        F.lit(model_type).alias("model_type"),
        F.lit(float(latency_ms)).alias("latency_ms"),
        F.to_json(payload).alias("payload"),
        F.to_json(F.struct(*results.columns)).alias("result"),
    )


def append_predictions(log: DataFrame, path: str) -> None:
    log.write.mode("append").partitionBy("mode").parquet(path)


def append_metrics(rows: DataFrame, path: str) -> None:
    """Metric rows, keyed by job_id."""
    if "job_id" not in rows.columns:
        raise ValueError("metric rows need a job_id")
    rows.write.mode("append").parquet(path)


def write_feature_spec(spec: DataFrame, path: str) -> None:
    spec.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def new_run_id() -> str:
    return uuid.uuid4().hex


def run_rows(spark: SparkSession, run_id: str, params: dict, metrics: dict) -> DataFrame:
    """A run as rows (run_id, kind, key, value): parameters and metrics, none of them missing."""
    rows = [(run_id, "param", k, str(v)) for k, v in params.items() if v is not None]
    rows += [(run_id, "metric", k, repr(float(v))) for k, v in metrics.items() if v is not None]
    return spark.createDataFrame(rows, "run_id string, kind string, key string, value string")


def append_run(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(path)
