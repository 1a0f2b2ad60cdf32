"""Cleaning and typing of raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import to_number
from riskloom.operators import ordered
from riskloom.operators.presets import (
    APPLICATION_CATEGORIES,
    APPLICATION_FLAGS,
    APPLICATION_ORDER,
    APPLICATION_TYPES,
    SENTINEL_COLUMNS,
    TARGET,
)

MISSING_TEXT = "nan"


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; copies meet map-side before the shuffle."""
    return df.dropDuplicates()


def first_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first under the order.

    A mergeable minimum rather than a window: a key with very many rows is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    position = F.struct(*[part for c in order for part in (F.col(c).isNull().cast("int"), F.col(c))])
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), position).alias("_row"))
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def sentinel_to_null(df: DataFrame, columns: Sequence[str] = tuple(SENTINEL_COLUMNS), marker: float = -1) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(marker).cast(df.schema[c].dataType)) for c in present})


def categories_to_text(df: DataFrame, columns: Sequence[str] = tuple(APPLICATION_CATEGORIES)) -> DataFrame:
    """Categories as text. A missing category becomes the text 'nan', so later imputation leaves it alone."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT)) for c in present})


def whole_number(c: Column) -> Column:
    """Cast to bigint; a fractional value is an error."""
    number = c.cast("double")
    return F.when(number != F.floor(number), F.raise_error(F.lit("a flag column holds a fractional value"))).otherwise(
        c.cast("bigint")
    )


def flags_to_integer(df: DataFrame, columns: Sequence[str] = tuple(APPLICATION_FLAGS)) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns(
        {
            c: F.col(c).cast("bigint") if isinstance(df.schema[c].dataType, (T.IntegralType, T.BooleanType)) else whole_number(F.col(c))
            for c in present
        }
    )


def reproducible_order(df: DataFrame, tie: Sequence[str] = (), candidates: Sequence[str] = tuple(APPLICATION_ORDER)) -> list[str]:
    """The order keys that exist in the table, then the tie keys."""
    return [c for c in candidates if c in df.columns] + [c for c in tie if c not in candidates]


def clean_applications(df: DataFrame) -> DataFrame:
    """Duplicates, sentinels, categories and flags. Rows get their order where a position is needed."""
    return clean_distinct(drop_duplicate_rows(df))


def clean_distinct(df: DataFrame) -> DataFrame:
    """The cleaning of rows that are known to be distinct: no shuffle."""
    return df.transform(sentinel_to_null).transform(categories_to_text).transform(flags_to_integer)


def sorted_for_output(df: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Rows in the reproducible order, missing keys last."""
    order = reproducible_order(df, tie)
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else df


def split_features_target(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    if target not in df.columns:
        raise ValueError(f"target column '{target}' is missing")
    return df.drop(target), df.select(target)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def unknown_category(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("unknown"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_numeric(df: DataFrame, keep: Sequence[str] = (TARGET,), value: float = 0) -> DataFrame:
    """Fill the numeric columns, all but the kept ones."""
    chosen = [c for c in numeric_columns(df) if c not in keep]
    return df.fillna(value, subset=chosen) if chosen else df


def map_labels(c: str, labels: dict[str, int]) -> Column:
    value = None
    for text, number in labels.items():
        value = (F if value is None else value).when(F.col(c) == text, F.lit(number))
    return value


def binary_target(c: str) -> Column:
    """Numeric text to 0/1; missing or unreadable counts as 0."""
    return F.coalesce(to_number(c), F.lit(0.0)).cast("int")


def put_first(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names, *[c for c in df.columns if c not in names])


def serving_payload(df: DataFrame, types: dict[str, str] | None = None, target: str = TARGET) -> DataFrame:
    """Typed request rows: integers rounded half to even, numbers, texts; nulls stay null numbers.

    A missing text becomes 'nan', as in categories_to_text.
    """
    types = types or APPLICATION_TYPES
    typed = {}
    for c in df.columns:
        kind = types.get(c)
        if kind in ("bigint", "int") and c != target:
            typed[c] = F.bround(to_number(c), 0).cast("bigint")
        elif kind == "double":
            typed[c] = to_number(c)
        elif kind == "string":
            typed[c] = F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT))
    return df.withColumns(typed).drop(target)


def first_rows(df: DataFrame, order: Sequence[str], limit: int | None) -> DataFrame:
    return ordered.first_rows(df, order, limit)
