"""Correlation matrix and feature ranking by correlation or variance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIRS_PER_PASS = 150


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations in long form (x, y, corr), null where a column is constant.

    A pair is measured on the rows that have both values. The table is read once for every
    PAIRS_PER_PASS pairs.
    """
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    passes = [pairs[i : i + PAIRS_PER_PASS] for i in range(0, len(pairs), PAIRS_PER_PASS)]
    return reduce(DataFrame.unionAll, [_pair_correlations(df, part) for part in passes])


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    row = df.agg(*[_corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            entries.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"p{i}").alias("corr")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _corr(a: str, b: str) -> Column:
    value = F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
    return F.when(~F.isnan(value), value)


def _one_per_column(df: DataFrame, columns: Sequence[str], measure, name: str) -> DataFrame:
    row = df.agg(*[measure(c).alias(f"m{i}") for i, c in enumerate(columns)])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias(name)) for i, c in enumerate(columns)])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def top_by_target_correlation(df: DataFrame, columns: Sequence[str], target: str, top: int = 30) -> DataFrame:
    """Features by absolute correlation with the target, one pass."""
    measured = _one_per_column(df, columns, lambda c: F.abs(_corr(c, target)), "abs_corr")
    return measured.orderBy(F.col("abs_corr").desc_nulls_last(), "feature").limit(top)


def top_by_variance(df: DataFrame, columns: Sequence[str], top: int = 30) -> DataFrame:
    """Features by sample variance, one pass."""
    measured = _one_per_column(df, columns, lambda c: F.var_samp(F.col(c).cast("double")), "variance")
    return measured.orderBy(F.col("variance").desc_nulls_last(), "feature").limit(top)


def select_top_features(df: DataFrame, columns: Sequence[str], target: str | None = None, top: int = 30) -> list[str]:
    """All columns when few, else the best by target correlation, or by variance without a target."""
    if len(columns) <= top:
        return list(columns)
    best = top_by_target_correlation(df, columns, target, top) if target else top_by_variance(df, columns, top)
    return [r["feature"] for r in best.collect()]
