"""Global order without a single-task window.

Spark's range exchange deals the rows over tasks by the order keys, every task sorts its own rows, and the result
is written to the shared folder with the place of each row in its task. From then on a row's range is a stored
value: counts and totals per range give offsets, and a lost task reads the same rows again. Nothing is gathered
but one number a range. Equal keys need not stay in one range, as a hash of the row and its place in the input
follow the keys in the order of positions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import stage_table

TOP_ROWS = 10_000  # above this a limit is taken by position, not gathered in one task
AT, RANGE = "_at", "_range"


@dataclass(frozen=True)
class Key:
    """One order component; missing values always come last."""

    name: str
    descending: bool = False


def keys(*specs: str | Key) -> list[Key]:
    """Names, a leading '-' asking for descending order."""
    return [s if isinstance(s, Key) else Key(s.lstrip("-"), s.startswith("-")) for s in specs]


def sort_columns(df: DataFrame, order: Sequence[str | Key]) -> list[Column]:
    """Sort expressions of an order: missing values last, values that are no numbers before them."""
    columns = []
    for key in keys(*order):
        value = F.col(key.name)
        if key.descending and isinstance(df.schema[key.name].dataType, (T.DoubleType, T.FloatType)):
            value = -value  # a value that is no number stays the largest
        elif key.descending:
            columns.append(value.desc_nulls_last())
            continue
        columns.append(value.asc_nulls_last())
    return columns


def in_ranges(df: DataFrame, order: Sequence[str | Key], label: str, *, ranges: int | None = None, spread_ties: bool = False) -> DataFrame:
    """The rows, written in ranges of an order, with `_range` and with `_at`, which rises along the order.

    One exchange. The number of ranges is that of the session's shuffle partitions, if `ranges` is not given.
    `spread_ties` continues the order with a hash of the row, then with the row's place in the input, so
    that neither equal keys nor equal rows have to share a range.
    """
    columns = sort_columns(df, order)
    rows = df
    if spread_ties:
        hashable = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
        rows = df.withColumn("_tie", F.xxhash64(*hashable)).withColumn("_input", F.monotonically_increasing_id())
        columns = [*columns, F.col("_tie"), F.col("_input")]
    dealt = rows.repartitionByRange(ranges, *columns) if ranges else rows.repartitionByRange(*columns)
    placed = dealt.sortWithinPartitions(*columns).select(*df.columns, F.monotonically_increasing_id().alias(AT))
    return stage_table(placed, label).withColumn(RANGE, F.shiftright(AT, 33).cast("int"))


@dataclass(frozen=True)
class IndexedFrame:
    frame: DataFrame
    rows: int


def with_row_index(
    df: DataFrame,
    order: Sequence[str | Key],
    name: str = "event_id",
    *,
    ranges: int | None = None,
    stage: bool = False,
) -> IndexedFrame:
    """Add the 0-based position under a global order; rows that tie in all keys follow a hash of the row.

    The rows are exchanged once, written and read; the counts per range go through the driver as offsets.
    The exchange reads the input twice, to choose its ranges and to deal the rows. With `stage` it is
    written first; ask for that when it is more than a scan.
    """
    if stage:
        df = stage_table(df, f"unordered-{name}")
    placed = in_ranges(df, order, f"ordered-{name}", ranges=ranges, spread_ties=True)
    shifts, before = {}, 0
    for r in placed.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), F.min(AT).alias("least")).orderBy(RANGE).collect():
        shifts[r[RANGE]] = before - r["least"]
        before += r["n"]
    listed = [shifts.get(i, 0) for i in range(max(shifts, default=0) + 1)]
    shift = F.element_at(F.from_json(F.lit(json.dumps(listed)), "array<bigint>"), F.col(RANGE) + 1)
    return IndexedFrame(placed.withColumn(name, F.col(AT) + shift).drop(AT, RANGE), before)


def running_sums(
    df: DataFrame,
    order: Sequence[str | Key],
    sums: dict[str, str],
    *,
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Inclusive running sums under a global order, per group of `by`.

    `sums` maps an output name to the column it accumulates. Groups of `by` may be of
    any size: a group is cut into ranges as the whole table is.
    """
    place = [*by, RANGE]
    placed = in_ranges(df, [*by, *order], "running", ranges=ranges)
    totals = placed.groupBy(*place).agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_j_{c}") for c in place], *[F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_o_{o}") for o in sums]
    )
    local = Window.partitionBy(*place).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.select("*", *[F.sum(c).over(local).alias(f"_l_{o}") for o, c in sums.items()])
    joined = out.join(offsets, on=_null_safe(place))
    return joined.select(*df.columns, *[(F.col(f"_l_{o}") + F.col(f"_o_{o}")).alias(o) for o in sums])


def _null_safe(columns: Sequence[str]) -> Column:
    condition = None
    for c in columns:
        part = F.col(c).eqNullSafe(F.col(f"_j_{c}"))
        condition = part if condition is None else condition & part
    return condition


def split_borders(rows: int, train: float = 0.7, valid: float = 0.15) -> tuple[int, int]:
    """Row borders of an ordered split: whole-number parts, the rest is the test part."""
    train_end = int(rows * train)
    return train_end, train_end + int(rows * valid)


def ordered_split(
    df: DataFrame,
    order: Sequence[str | Key],
    *,
    train: float = 0.7,
    valid: float = 0.15,
    name: str = "split",
    index: str | None = None,
) -> DataFrame:
    """Label rows 'train', 'valid' or 'test' by position. `index` names an existing position column."""
    if index is None:
        indexed = with_row_index(df, order, "_position")
        frame, rows, position = indexed.frame, indexed.rows, "_position"
    else:
        frame, rows, position = df, df.count(), index
    train_end, valid_end = split_borders(rows, train, valid)
    label = F.when(F.col(position) < train_end, "train").when(F.col(position) < valid_end, "valid").otherwise("test")
    out = frame.withColumn(name, label)
    return out if index else out.drop(position)


def first_rows(df: DataFrame, order: Sequence[str | Key], limit: int | None) -> DataFrame:
    """The first `limit` rows in an order, in that order; 0 or None keeps every row as it is."""
    if not limit or int(limit) <= 0:
        return df
    if int(limit) <= TOP_ROWS:
        return df.orderBy(*sort_columns(df, order)).limit(int(limit))
    return with_row_index(df, order, "_position").frame.filter(F.col("_position") < int(limit)).orderBy("_position").drop("_position")
