"""Checks over tables: schema lists, counts, nulls, duplicates, target values, labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.operators.presets import APPLICATION_COLUMNS, REQUEST_SCHEMA, TARGET

SHOWN_VALUES = 20


class ValidationError(ValueError):
    """The table cannot be used; the message says why."""


@dataclass
class ValidationReport:
    is_valid: bool
    row_count: int
    column_count: int
    missing_columns: list[str]
    unexpected_columns: list[str]
    columns_with_nulls: list[str] = field(default_factory=list)
    duplicate_rows: int = 0
    message: str = ""


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def unexpected_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(expected)]


def require_columns(df: DataFrame, expected: Sequence[str], table: str = "table") -> DataFrame:
    absent = missing_columns(df, expected)
    if absent:
        raise ValidationError(f"{table} lacks required columns: {absent}")
    return df


def distinct_with_copies(df: DataFrame) -> DataFrame:
    """One row per distinct row with its number of copies; copies are counted before the shuffle."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))


def profile(df: DataFrame, target: str | None = None, copies: DataFrame | None = None) -> DataFrame:
    """One row: rows, duplicate rows, null count per column, and the target values that are not 0/1.

    Everything comes from the same grouping of equal rows, so the table is read and shuffled once.
    `copies` passes that grouping in where it is already at hand.
    """
    if copies is None:
        copies = distinct_with_copies(df)
    aggregates = [
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
        *[
            F.coalesce(F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("_copies"))), F.lit(0)).alias(f"nulls_{i}")
            for i, c in enumerate(df.columns)
        ],
    ]
    if target in df.columns:
        value = F.col(f"`{target}`").try_cast("double")
        bad = F.col(f"`{target}`").isNotNull() & ~F.coalesce(value.isin(0.0, 1.0), F.lit(False))
        aggregates += [
            F.count_if(bad).alias("bad_targets"),
            F.min(F.when(bad, F.col(f"`{target}`").cast("string"))).alias("bad_target_min"),
            F.max(F.when(bad, F.col(f"`{target}`").cast("string"))).alias("bad_target_max"),
        ]
    return copies.agg(*aggregates)


def schema_report(
    df: DataFrame, expected: Sequence[str] = tuple(APPLICATION_COLUMNS), target: str = TARGET
) -> DataFrame:
    """The validation report as a lazy one-row table."""
    absent, extra = missing_columns(df, expected), unexpected_columns(df, expected)
    valid = not absent and target in df.columns
    names = F.array(
        *[F.when(F.col(f"nulls_{i}") > 0, F.lit(c)) for i, c in enumerate(df.columns)]
    )
    return profile(df).select(
        F.lit(valid).alias("is_valid"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(absent).cast("array<string>").alias("missing_columns"),
        F.lit(extra).cast("array<string>").alias("unexpected_columns"),
        F.filter(names, lambda c: c.isNotNull()).alias("columns_with_nulls"),
        F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
        F.lit("schema is valid" if valid else "schema is not valid").alias("message"),
    )


def require_not_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValidationError("the table is empty")
    return df


def target_values(df: DataFrame, target: str = TARGET) -> list:
    """Distinct non-null target values; at most SHOWN_VALUES of them, for a message."""
    rows = df.select(target).where(F.col(target).isNotNull()).distinct().limit(SHOWN_VALUES).collect()
    return sorted((r[0] for r in rows), key=lambda v: (str(type(v)), v))


def require_binary_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    if target not in df.columns:
        raise ValidationError(f"target column '{target}' is missing")
    found = df.where(F.col(target).isNotNull() & ~F.coalesce(F.col(target).try_cast("double").isin(0.0, 1.0), F.lit(False)))
    if not found.isEmpty():
        raise ValidationError(f"target column '{target}' must hold 0 and 1 only, found {_shown_targets(df, target)}")
    return df


def _shown_targets(df: DataFrame, target: str) -> str:
    return _of_all(target_values(df, target), df.select(target).where(F.col(target).isNotNull()).distinct().count())


def _of_all(values: list, count: int) -> str:
    """The values for a message, with their real number where more exist."""
    return f"{values}" if count <= len(values) else f"{values} and {count - len(values)} more"


def full_validation(
    df: DataFrame,
    expected: Sequence[str] = tuple(APPLICATION_COLUMNS),
    target: str = TARGET,
    *,
    copies: DataFrame | None = None,
) -> ValidationReport:
    """Empty check, schema report and target check in one job; raises when the table cannot be used.

    Unexpected columns alone do not make a table invalid.
    """
    absent, extra = missing_columns(df, expected), unexpected_columns(df, expected)
    row = profile(df, target, copies).first()
    if row["row_count"] == 0:
        raise ValidationError("the table is empty")
    if target not in df.columns:
        raise ValidationError(f"target column '{target}' is missing")
    if row["bad_targets"]:
        raise ValidationError(f"target column '{target}' must hold 0 and 1 only, found {_shown_targets(df, target)}")
    report = ValidationReport(
        is_valid=not absent,
        row_count=int(row["row_count"]),
        column_count=len(df.columns),
        missing_columns=absent,
        unexpected_columns=extra,
        columns_with_nulls=[c for i, c in enumerate(df.columns) if row[f"nulls_{i}"]],
        duplicate_rows=int(row["duplicate_rows"]),
        message="schema is valid" if not absent else "schema is not valid",
    )
    if not report.is_valid:
        raise ValidationError(f"schema check failed; missing columns: {absent}; unexpected columns: {extra}")
    return report


def unknown_labels(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Label values outside the allowed set, with their row counts; a null label is one of them."""
    return (
        df.where(F.col(column).isNull() | ~F.col(column).isin(*allowed))
        .groupBy(F.col(column).cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def require_labels(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Raise on an unknown or a null label; the message lists the non-null ones, or some and how many more."""
    unknown = unknown_labels(df, column, allowed)
    found = unknown.limit(SHOWN_VALUES).collect()
    if found:
        labels = sorted(r["label"] for r in found if r["label"] is not None)
        every = unknown.where(F.col("label").isNotNull()).count() if len(found) == SHOWN_VALUES else len(labels)
        raise ValidationError(f"unknown values in '{column}': {_of_all(labels, every)}")
    return df


def select_model_columns(df: DataFrame, model_columns: Sequence[str]) -> DataFrame:
    """Model inputs in the model's order; other columns are dropped, absent ones are an error."""
    absent = missing_columns(df, model_columns)
    if absent:
        raise ValidationError(f"scoring input lacks columns: {absent}")
    return df.select(*model_columns)


def parse_requests(df: DataFrame, column: str, schema=REQUEST_SCHEMA) -> DataFrame:
    """Typed scoring requests from JSON text; a malformed record fails the read."""
    parsed = F.from_json(F.col(column), schema, {"mode": "FAILFAST"})
    return df.select(*[c for c in df.columns if c != column], parsed.alias("_request")).select(
        *[c for c in df.columns if c != column], "_request.*"
    )


def cast_requests(df: DataFrame, schema=REQUEST_SCHEMA) -> DataFrame:
    """Project a table on the request fields with their types; bad values fail the query."""
    require_columns(df, schema.fieldNames(), "request")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def count_while_writing(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """A frame that counts its rows as the next action passes over them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
