"""Distribution drift between two tables: population stability index per column, verdicts, summaries.

Values are counted per (column, value or bin) for both tables in one grouping, so only
counts are shuffled, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import to_number
from riskloom.operators.presets import EVENT_TIME, TARGET

COLUMN_THRESHOLD = 0.1
SHARE_THRESHOLD = 0.3
ZERO_SHARE = 1e-4
MAX_DISCRETE = 20
SUMMARY_BINS = 10
# Twenty values touch at most 20 of the estimator's 64 registers, for which its answer stays below
# 64 * ln(64 / 44) = 24. A higher estimate proves that a column has more values than that.
ESTIMATE_ERROR = 0.15
SURELY_MANY = 40


def drift_columns(reference: DataFrame, current: DataFrame, drop: Sequence[str] = (TARGET, EVENT_TIME)) -> list[str]:
    """Columns both tables have, sorted, without label and time."""
    common = sorted((set(reference.columns) & set(current.columns)) - set(drop))
    if not common:
        raise ValueError("the two tables have no column in common to check")
    return common


def sturges_bins(rows: int) -> int:
    return math.ceil(math.log2(rows)) + 1 if rows > 0 else 1


@dataclass(frozen=True)
class ColumnShape:
    """What is known of a column before counting: its kind, and pooled range and bins for numbers.

    `open` says that a number may have so few values that it is compared value by value.
    """

    name: str
    numeric: bool
    open: bool = False
    bins: int = 0
    low: float | None = None
    high: float | None = None


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType))


def _value(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.col(name).cast("double")
    return to_number(name) if _is_number(df, name) else F.col(name).cast("string")


def _pooled(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    sides = [
        side.select(*[_value(side, c).alias(c) for c in columns], F.lit(label).alias("_ref"))
        for side, label in ((reference, 1), (current, 0))
    ]
    return sides[0].unionByName(sides[1])


def column_shapes(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> list[ColumnShape]:
    """Count, range and an estimate of the distinct values per number, in one job over the pooled tables."""
    pooled = _pooled(reference, current, columns)
    numeric = [c for c in columns if _is_number(reference, c) and _is_number(current, c)]
    if not numeric:
        return [ColumnShape(c, False) for c in columns]
    ask = []
    for i, c in enumerate(numeric):
        ask += [
            F.count(c).alias(f"n{i}"),
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
            F.approx_count_distinct(c, ESTIMATE_ERROR).alias(f"d{i}"),
        ]
    seen = pooled.agg(*ask).first()
    shapes = {c: ColumnShape(c, False) for c in columns}
    for i, c in enumerate(numeric):
        few = seen[f"d{i}"] <= SURELY_MANY
        shapes[c] = ColumnShape(c, True, few, sturges_bins(seen[f"n{i}"]), seen[f"lo{i}"], seen[f"hi{i}"])
    return [shapes[c] for c in columns]


def equal_width_bin(value: Column, low: Column | float, high: Column | float, bins: Column | int) -> Column:
    """0-based bin on [low, high]; the right edge belongs to the last bin."""
    low, high, bins = (x if isinstance(x, Column) else F.lit(x) for x in (low, high, bins))
    place = F.floor(F.try_divide(bins * (value - low), high - low))
    return F.greatest(F.least(F.coalesce(place, F.lit(0)), bins - 1), F.lit(0)).cast("int")


def paired_counts(reference: DataFrame, current: DataFrame, shapes: Sequence[ColumnShape]) -> DataFrame:
    """Rows per column and label (value or bin) in both tables, and the number of bins (0: by value).

    One pass over the rows counts categories and open numbers by value, other numbers by bin. An open
    number with more than MAX_DISCRETE values is then binned from its value counts.
    """
    pooled = _pooled(reference, current, [s.name for s in shapes])
    entries = []
    for s in shapes:
        c = F.col(s.name)
        number = c if s.open else equal_width_bin(c, s.low, s.high, s.bins).cast("double") if s.numeric else F.lit(None)
        entries.append(
            F.struct(
                F.lit(s.name).alias("column"),
                (F.lit(None) if s.numeric else c).cast("string").alias("text"),
                F.when(c.isNotNull(), number).cast("double").alias("number"),
            )
        )
    counts = (
        pooled.select("_ref", F.explode(F.array(*entries)).alias("e"))
        .select("_ref", "e.*")
        .where(F.col("text").isNotNull() | F.col("number").isNotNull())
        .groupBy("column", "text", "number")
        .agg(F.sum("_ref").alias("reference_rows"), F.sum(1 - F.col("_ref")).alias("current_rows"))
    )
    facts = df_of_shapes(reference, shapes)
    # Per open number: how many values it really has. One row per column.
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("_values"))
    known = counts.join(F.broadcast(facts), "column").join(F.broadcast(sizes), "column")
    by_value = ~F.col("_numeric") | (F.col("_open") & (F.col("_values") <= MAX_DISCRETE))
    binned = F.when(F.col("_open"), equal_width_bin(F.col("number"), F.col("_low"), F.col("_high"), F.col("_bins")))
    label = F.when(~F.col("_numeric"), F.col("text")).when(by_value, F.col("number").cast("string"))
    return (
        known.select(
            "column",
            F.coalesce(label, F.coalesce(binned, F.col("number").cast("int")).cast("string")).alias("label"),
            F.when(by_value, 0).otherwise(F.col("_bins")).alias("bins"),
            "reference_rows",
            "current_rows",
        )
        .groupBy("column", "label", "bins")
        .agg(F.sum("reference_rows").alias("reference_rows"), F.sum("current_rows").alias("current_rows"))
    )


def df_of_shapes(df: DataFrame, shapes: Sequence[ColumnShape]) -> DataFrame:
    """The shapes as a table, one row per column."""
    rows = [(s.name, s.numeric, s.open, s.bins, s.low, s.high) for s in shapes]
    return df.sparkSession.createDataFrame(
        rows, "column string, _numeric boolean, _open boolean, _bins int, _low double, _high double"
    )


def psi_from_counts(counts: DataFrame, zero_share: float = ZERO_SHARE) -> DataFrame:
    """Stability index per column from paired counts; an empty share counts as `zero_share`."""
    extra = [c for c in ("bins",) if c in counts.columns]
    totals = counts.groupBy("column").agg(F.sum("reference_rows").alias("_r"), F.sum("current_rows").alias("_c"))

    def share(rows: str, total: str) -> Column:
        part = F.coalesce(F.try_divide(F.col(rows).cast("double"), F.col(total).cast("double")), F.lit(0.0))
        return F.when(part == 0, F.lit(zero_share)).otherwise(part)

    # One row per column: small, and a column with very many values must not meet in one task.
    shares = counts.join(F.broadcast(totals), "column").select(
        "column", *extra, share("reference_rows", "_r").alias("r"), share("current_rows", "_c").alias("c")
    )
    return shares.groupBy("column", *extra).agg(
        F.sum((F.col("r") - F.col("c")) * F.ln(F.col("r") / F.col("c"))).alias("drift_score")
    )


def drift_table(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    threshold: float = COLUMN_THRESHOLD,
) -> DataFrame:
    """One row per column: type, number of bins (0 for value by value), score and verdict."""
    columns = list(columns) if columns is not None else drift_columns(reference, current)
    shapes = column_shapes(reference, current, columns)
    scores = psi_from_counts(paired_counts(reference, current, shapes))
    kinds = F.create_map(*[x for s in shapes for x in (F.lit(s.name), F.lit("num" if s.numeric else "cat"))])
    return scores.select(
        F.col("column").alias("column_name"),
        F.try_element_at(kinds, F.col("column")).alias("column_type"),
        "bins",
        "drift_score",
        F.lit(float(threshold)).alias("stattest_threshold"),
        (F.col("drift_score") >= threshold).alias("drift_detected"),
    )


def drift_summary(table: DataFrame, *, share_threshold: float = SHARE_THRESHOLD) -> DataFrame:
    """One row: counts, drifted share, dataset verdict, and the sorted list of drifted columns."""
    drifted = F.count_if("drift_detected")
    return (
        table.agg(
            F.count(F.lit(1)).alias("number_of_columns"),
            drifted.alias("number_of_drifted_columns"),
            F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("column_name")))).alias("drifted_columns"),
        )
        .withColumn(
            "share_of_drifted_columns",
            F.coalesce(F.try_divide(F.col("number_of_drifted_columns").cast("double"), F.col("number_of_columns")), F.lit(0.0)),
        )
        .withColumn("drift_share", F.lit(float(share_threshold)))
        .withColumn("dataset_drift", F.col("share_of_drifted_columns") >= share_threshold)
    )


def retrain_decision(summary: DataFrame) -> DataFrame:
    return summary.withColumn("retrain", F.coalesce(F.col("dataset_drift"), F.lit(False)))


def distribution_summary(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, *, bins: int = SUMMARY_BINS
) -> DataFrame:
    """Long summary per column and side: ten equal-width bins with density, or counts per category.

    Numeric bins use the side's own range; bins without rows are there, but a side with one value has one
    bin. A row is (column, side, label, lower, upper, rows, density).
    """
    columns = list(columns) if columns is not None else drift_columns(reference, current)
    numeric = [c for c in columns if _is_number(reference, c) and _is_number(current, c)]
    pooled = _pooled(reference, current, columns)
    ranges = {r["_ref"]: r for r in pooled.groupBy("_ref").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in (("lo", F.min), ("hi", F.max))],
    ).collect()}

    def edge(prefix: str, i: int) -> Column:
        def of(side: int) -> Column:
            return F.lit(ranges[side][f"{prefix}{i}"] if side in ranges else None).cast("double")

        return F.when(F.col("_ref") == 1, of(1)).otherwise(of(0))

    none = F.lit(None).cast("double")
    entries = []
    for c in columns:
        if c in numeric:
            i = numeric.index(c)
            low, high = edge("lo", i), edge("hi", i)
            bin_ = equal_width_bin(F.col(c), low, high, bins)
            label = F.when(F.col(c).isNotNull(), F.format_string("%02d", bin_))
        else:
            low, high, label = none, none, F.col(c)
        entries.append(F.struct(F.lit(c).alias("column"), label.alias("label"), low.alias("low"), high.alias("high")))
    counted = (
        pooled.select("_ref", F.explode(F.array(*entries)).alias("e"))
        .select("_ref", "e.*")
        .where(F.col("label").isNotNull())
        .groupBy("_ref", "column", "label")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("low").alias("low"), F.max("high").alias("high"))
    )
    spans = [(side, c, r[f"lo{i}"], r[f"hi{i}"]) for side, r in ranges.items() for i, c in enumerate(numeric)]
    empty = [(s, c, f"{b:02d}", 0, lo, hi) for s, c, lo, hi in spans if lo is not None and lo < hi for b in range(bins)]
    grid = reference.sparkSession.createDataFrame(empty, "_ref int, column string, label string, rows long, low double, high double")
    counted = counted.unionByName(grid).groupBy("_ref", "column", "label").agg(*[f(c).alias(c) for f, c in ((F.sum, "rows"), (F.max, "low"), (F.max, "high"))])
    width = (F.col("high") - F.col("low")) / bins
    number = F.when(F.col("low").isNotNull(), F.col("label")).cast("int")
    # The totals have one row per column and side.
    totals = counted.groupBy("_ref", "column").agg(F.sum("rows").alias("total"))
    return counted.join(F.broadcast(totals), ["_ref", "column"]).select(
        "column",
        F.when(F.col("_ref") == 1, "reference").otherwise("current").alias("side"),
        "label",
        (F.col("low") + width * number).alias("lower"),
        (F.col("low") + width * (number + 1)).alias("upper"),
        "rows",
        F.when(
            F.col("low").isNotNull(), F.try_divide(F.col("rows").cast("double"), F.col("total") * width)
        ).alias("density"),
    )


def nested_distribution(summary: DataFrame) -> DataFrame:
    """Numeric columns only: the bins of a column and side as one array."""
    return (
        summary.where(F.col("lower").isNotNull())
        .groupBy("column", "side")
        .agg(F.sort_array(F.collect_list(F.struct("lower", "upper", "density"))).alias("distribution"))
    )


def report_roll_up(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Saved summaries side by side in name order; a report that cannot be read is left out."""
    names = ["dataset_drift", "share_of_drifted_columns", "number_of_drifted_columns", "number_of_columns"]
    out = None
    for path in sorted(paths):
        try:
            part = spark.read.parquet(path).select(F.lit(path.rstrip("/").rsplit("/", 1)[-1]).alias("report_file"), *names)
        except PySparkException:
            continue
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame(
            [], "report_file string, dataset_drift boolean, share_of_drifted_columns double, number_of_drifted_columns bigint, number_of_columns bigint"
        )
    return out.orderBy("report_file")


def ranked_columns(table: DataFrame) -> DataFrame:
    """Columns by score, the highest first."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("drift_score").desc(), F.col("column_name"))
    return table.withColumn("rank", F.row_number().over(w))
