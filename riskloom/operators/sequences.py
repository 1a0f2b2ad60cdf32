"""Per-alert features of transaction sequences.

Most alerts hold few transactions: their rows meet in one task and every window
shares one shuffle and one sort. An alert with more than `hot_rows` transactions
is cut into ranges of (alert, time, tie) instead; each range is handled by its own
task, and what crosses a cut (rows before, neighbours, the run under way) comes
from a small table with one row per alert and range. Both ways give the same
numbers, and no task ever holds a whole large alert.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import (
    EPS,
    binary_entropy,
    cyclic,
    flag,
    missing_flag,
    seconds_between,
    to_number,
    to_time,
)
from riskloom.operators.clean import first_by_key, fill_numeric, map_labels
from riskloom.operators.ordered import in_ranges
from riskloom.operators.presets import ALERT_COLUMNS, ALERT_TRANSACTION_COLUMNS, TARGET
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.validate import require_columns, require_labels
from riskloom.session import stage_table

OUTCOMES = {"Report": 1, "Dismiss": 0}
HOT_ROWS = 5_000_000
MAX_HOT_GROUPS = 100_000
ID = "AlertID"
TIME = "Timestamp"


@dataclass(frozen=True)
class SizeCuts:
    """Cut-offs of the absolute amount over the whole transaction table."""

    p05: float | None
    p95: float | None
    p99: float | None


def size_cuts(tx: DataFrame, **options) -> SizeCuts:
    absolute = tx.select(F.abs(to_number("Size")).alias("size_abs"))
    return SizeCuts(*exact_quantiles(absolute, ["size_abs"], [0.05, 0.95, 0.99], **options)["size_abs"])


def usable_transactions(tx: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Typed transactions; rows without alert, time or amount are dropped."""
    require_columns(tx, ALERT_TRANSACTION_COLUMNS, "transactions")
    timed = tx if tx.schema[TIME].dataType.typeName() == "timestamp_ntz" else tx.withColumn(TIME, to_time(TIME))
    return timed.select(
        ID,
        TIME,
        F.coalesce(F.col("Entry").cast("string"), F.lit("None")).alias("Entry"),
        F.coalesce(F.col("Type").cast("string"), F.lit("None")).alias("Type"),
        to_number("Size").alias("Size"),
        *[c for c in tie if c not in ALERT_TRANSACTION_COLUMNS],
    ).dropna(subset=[ID, TIME, "Size"])


def row_indicators(tx: DataFrame) -> DataFrame:
    """Direction, type and sign flags, their combinations, masked amounts, square and log."""
    entry, kind, size = F.col("Entry"), F.col("Type"), F.col("Size")
    absolute = F.abs(size)
    credit, debit, wire, card = entry == "Credit", entry == "Debit", kind == "Wire", kind == "Card"

    def masked(condition: Column) -> Column:
        return F.when(condition, absolute).otherwise(F.lit(0.0))

    return tx.withColumns(
        {
            "is_credit": flag(credit),
            "is_debit": flag(debit),
            "is_wire": flag(wire),
            "is_card": flag(card),
            "credit_wire": flag(credit & wire),
            "credit_card": flag(credit & card),
            "debit_wire": flag(debit & wire),
            "debit_card": flag(debit & card),
            "size_abs": absolute,
            "size_positive": flag(size > 0),
            "size_negative": flag(size < 0),
            "size_squared": size * size,
            "size_abs_log1p": F.log1p(absolute),
            "size_abs_wire": masked(wire),
            "size_abs_card": masked(card),
            "size_abs_credit": masked(credit),
            "size_abs_debit": masked(debit),
        }
    )


def _in_order(part: Sequence[str], tie: Sequence[str]) -> Window:
    return Window.partitionBy(*part).orderBy(TIME, *tie)


def whole_group_context(tx: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Position, neighbours and group statistics for alerts that fit one task: one shuffle, one sort."""
    w = _in_order([ID], tie)
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return tx.withColumns(
        {
            "tx_order": F.row_number().over(w).cast("bigint"),
            "prev_timestamp": F.lag(TIME).over(w),
            "next_timestamp": F.lead(TIME).over(w),
            "prev_entry": F.lag("Entry").over(w),
            "prev_type": F.lag("Type").over(w),
            "prev_size": F.lag("Size").over(w),
            "_group_rows": F.count(F.lit(1)).over(every),
            "_first_time": F.min(TIME).over(every),
            "_abs_mean": F.avg(F.abs("Size")).over(every),
            "_abs_std": F.stddev_samp(F.abs("Size")).over(every),
        }
    )


def row_sequence_features(tx: DataFrame, cuts: SizeCuts) -> DataFrame:
    """Row features that follow from position, neighbours, group statistics and the global cut-offs.

    They come after the windows, so that only the raw columns are shuffled and sorted.
    """
    order = F.col("tx_order")
    from_end = F.col("_group_rows") - order + 1
    gap = F.coalesce(seconds_between("prev_timestamp", TIME), F.lit(0.0))
    next_gap = F.coalesce(seconds_between(TIME, "next_timestamp"), F.lit(0.0))
    since_start = seconds_between("_first_time", TIME)
    absolute = F.abs("Size")
    zscore = (absolute - F.col("_abs_mean")) / (F.coalesce(F.col("_abs_std"), F.lit(0.0)) + F.lit(EPS))

    def first(k: int) -> Column:
        return order <= k

    def last(k: int) -> Column:
        return F.col("tx_order_desc") <= k

    def only(condition: Column, value: str) -> Column:
        return F.when(condition, F.col(value)).otherwise(F.lit(0))

    def cut(value: float | None) -> Column:
        return F.lit(value).cast("double")

    step = row_indicators(tx).withColumns(
        {
            "tx_order_desc": from_end,
            "delta_seconds": gap,
            "next_delta_seconds": next_gap,
            "seconds_from_start": since_start,
            "size_abs_zscore": zscore,
        }
    )
    return step.withColumns(
        {
            "is_first_1": flag(first(1)),
            "is_first_3": flag(first(3)),
            "is_first_5": flag(first(5)),
            "is_last_1": flag(last(1)),
            "is_last_3": flag(last(3)),
            "size_abs_first_1": only(first(1), "size_abs"),
            "size_abs_first_3": only(first(3), "size_abs"),
            "size_abs_first_5": only(first(5), "size_abs"),
            "size_abs_last_1": only(last(1), "size_abs"),
            "size_abs_last_3": only(last(3), "size_abs"),
            "wire_first_3": only(first(3), "is_wire"),
            "wire_first_5": only(first(5), "is_wire"),
            "debit_first_3": only(first(3), "is_debit"),
            "debit_first_5": only(first(5), "is_debit"),
            "delta_is_zero": flag(F.col("delta_seconds") == 0),
            "delta_lt_10s": flag(F.col("delta_seconds") < 10),
            "delta_lt_60s": flag(F.col("delta_seconds") < 60),
            "delta_gt_1h": flag(F.col("delta_seconds") > 3600),
            "within_60s": flag(F.col("seconds_from_start") <= 60),
            "within_300s": flag(F.col("seconds_from_start") <= 300),
            "within_3600s": flag(F.col("seconds_from_start") <= 3600),
            "entry_switch": flag(F.col("Entry") != F.col("prev_entry")),
            "type_switch": flag(F.col("Type") != F.col("prev_type")),
            "sign_switch": flag((F.col("Size") > 0) != (F.col("prev_size") > 0)),
            "is_large_abs": flag(absolute > cut(cuts.p95)),
            "is_very_large_abs": flag(absolute > cut(cuts.p99)),
            "is_small_abs": flag(absolute < cut(cuts.p05)),
            "is_alert_outlier_abs": flag(F.abs(F.col("size_abs_zscore")) > 2.0),
        }
    )


def _run_starts(tx: DataFrame, part: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Position where the run under way began, for equal entries and equal types; null if not in this part."""
    so_far = _in_order(part, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def start(switch: str) -> Column:
        begins = (F.col(switch) == 1) | (F.col("tx_order") == 1)
        return F.max(F.when(begins, F.col("tx_order"))).over(so_far)

    return tx.withColumns({"entry_run_start": start("entry_switch"), "type_run_start": start("type_switch")})


def _run_length(kind: str) -> Column:
    return F.col("tx_order") - F.col(f"{kind}_run_start") + 1


# Named aggregates: output, function, input.
_SUMS = {
    "n_credit": "is_credit",
    "n_debit": "is_debit",
    "n_wire": "is_wire",
    "n_card": "is_card",
    "n_credit_wire": "credit_wire",
    "n_credit_card": "credit_card",
    "n_debit_wire": "debit_wire",
    "n_debit_card": "debit_card",
    "n_positive": "size_positive",
    "n_negative": "size_negative",
    "n_entry_switches": "entry_switch",
    "n_type_switches": "type_switch",
    "n_sign_switches": "sign_switch",
    "n_within_60s": "within_60s",
    "n_within_300s": "within_300s",
    "n_within_3600s": "within_3600s",
    "n_delta_zero": "delta_is_zero",
    "n_delta_lt_10s": "delta_lt_10s",
    "n_delta_lt_60s": "delta_lt_60s",
    "n_delta_gt_1h": "delta_gt_1h",
    "n_large_abs": "is_large_abs",
    "n_very_large_abs": "is_very_large_abs",
    "n_small_abs": "is_small_abs",
    "n_alert_outlier_abs": "is_alert_outlier_abs",
    "size_sum": "Size",
    "size_squared_sum": "size_squared",
    "size_abs_sum": "size_abs",
    "size_abs_wire_sum": "size_abs_wire",
    "size_abs_card_sum": "size_abs_card",
    "size_abs_credit_sum": "size_abs_credit",
    "size_abs_debit_sum": "size_abs_debit",
    "size_abs_first_1_sum": "size_abs_first_1",
    "size_abs_first_3_sum": "size_abs_first_3",
    "size_abs_first_5_sum": "size_abs_first_5",
    "size_abs_last_1_sum": "size_abs_last_1",
    "size_abs_last_3_sum": "size_abs_last_3",
    "n_wire_first_3": "wire_first_3",
    "n_wire_first_5": "wire_first_5",
    "n_debit_first_3": "debit_first_3",
    "n_debit_first_5": "debit_first_5",
}
_SPREADS = [
    ("size_mean", F.avg, "Size"),
    ("size_std", F.stddev_samp, "Size"),
    ("size_min", F.min, "Size"),
    ("size_max", F.max, "Size"),
    ("size_abs_mean", F.avg, "size_abs"),
    ("size_abs_std", F.stddev_samp, "size_abs"),
    ("size_abs_min", F.min, "size_abs"),
    ("size_abs_max", F.max, "size_abs"),
    ("size_abs_log1p_mean", F.avg, "size_abs_log1p"),
    ("delta_mean", F.avg, "delta_seconds"),
    ("delta_std", F.stddev_samp, "delta_seconds"),
    ("delta_min", F.min, "delta_seconds"),
    ("delta_max", F.max, "delta_seconds"),
    ("next_delta_mean", F.avg, "next_delta_seconds"),
    ("next_delta_std", F.stddev_samp, "next_delta_seconds"),
    ("first_timestamp", F.min, TIME),
    ("last_timestamp", F.max, TIME),
]


def _aggregates() -> list[Column]:
    at_first, at_last = F.col("tx_order") == 1, F.col("tx_order_desc") == 1
    ends = {
        "first_entry_credit": (at_first, "is_credit"),
        "first_type_wire": (at_first, "is_wire"),
        "last_entry_credit": (at_last, "is_credit"),
        "last_type_wire": (at_last, "is_wire"),
    }
    return [
        F.count(F.lit(1)).alias("n_transactions"),
        *[F.sum(source).alias(name) for name, source in _SUMS.items()],
        *[how(source).alias(name) for name, how, source in _SPREADS],
        *[F.max(F.when(where, F.col(source))).alias(name) for name, (where, source) in ends.items()],
        F.max(_run_length("entry")).alias("max_entry_run_len"),
        F.max(_run_length("type")).alias("max_type_run_len"),
    ]


def aggregate_alerts(tx: DataFrame) -> DataFrame:
    """62 aggregates per alert, with the longest and the mean run of equal entries and types.

    The mean run length needs no runs: it is the row count over one plus the number of switches.
    """
    out = tx.groupBy(ID).agg(*_aggregates())
    rows = F.col("n_transactions").cast("double")
    return out.withColumns(
        {
            "mean_entry_run_len": rows / (F.col("n_entry_switches") + 1),
            "mean_type_run_len": rows / (F.col("n_type_switches") + 1),
        }
    )


def _regular(tx: DataFrame, tie: Sequence[str], cuts: SizeCuts) -> DataFrame:
    rows = row_sequence_features(whole_group_context(tx, tie), cuts)
    return aggregate_alerts(_run_starts(rows, [ID], tie))


def _cut_context(tx: DataFrame, tie: Sequence[str], groups: DataFrame, ranges: int | None) -> DataFrame:
    """The context of whole_group_context for large alerts, worked out range by range."""
    placed = in_ranges(tx, [ID, TIME, *tie], "large-alert-rows", ranges=ranges).drop("_at")
    position = F.struct(TIME, *tie)
    seen = F.struct(F.col(TIME).alias("t"), F.col("Entry").alias("e"), F.col("Type").alias("k"), F.col("Size").alias("s"))
    along = Window.partitionBy(ID).orderBy("_range")
    # One row per large alert and range it touches: no more than the ranges plus the large alerts.
    edges = stage_table(
        placed.groupBy(ID, "_range")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max_by(seen, position).alias("last"),
            F.min(TIME).alias("first_time"),
        )
        .select(
            ID,
            "_range",
            F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.lag("last").over(along).alias("_carry"),
            F.lead("first_time").over(along).alias("_next_time"),
        ),
        "alert-range-edges",
    )
    w = _in_order([ID, "_range"], tie)
    local = (
        placed.join(F.broadcast(edges), [ID, "_range"])
        .join(F.broadcast(groups.select(ID, "_group_rows", "_first_time", "_abs_mean", "_abs_std")), ID)
        .withColumn("_rank", F.row_number().over(w))
        .withColumns(
            {
                "_lag": F.lag(seen).over(w),
                "_lead": F.lead(TIME).over(w),
            }
        )
    )
    before = F.coalesce(F.col("_lag"), F.col("_carry"))
    return local.withColumns(
        {
            "tx_order": F.col("_rank") + F.col("_before"),
            "prev_timestamp": before["t"],
            "next_timestamp": F.coalesce(F.col("_lead"), F.col("_next_time")),
            "prev_entry": before["e"],
            "prev_type": before["k"],
            "prev_size": before["s"],
        }
    ).drop("_rank", "_lag", "_lead", "_carry", "_before", "_next_time")


def _longest_cut_runs(rows: DataFrame) -> DataFrame:
    """Longest runs of large alerts: runs that cross a cut are completed from the earlier ranges."""
    pieces = rows.groupBy(ID, "_range").agg(
        *[
            column
            for kind in ("entry", "type")
            for column in (
                F.max(_run_length(kind)).alias(f"{kind}_inner"),
                F.max(F.when(F.col(f"{kind}_run_start").isNull(), F.col("tx_order"))).alias(f"{kind}_open"),
                F.max(f"{kind}_run_start").alias(f"{kind}_start"),
            )
        ]
    )
    earlier = Window.partitionBy(ID).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.withColumns({f"{k}_carried": F.max(f"{k}_start").over(earlier) for k in ("entry", "type")})
    return carried.groupBy(ID).agg(
        *[
            F.max(
                F.greatest(F.col(f"{k}_inner"), F.col(f"{k}_open") - F.col(f"{k}_carried") + 1)
            ).alias(f"max_{k}_run_len")
            for k in ("entry", "type")
        ]
    )


def _cut(tx: DataFrame, tie: Sequence[str], cuts: SizeCuts, groups: DataFrame, ranges: int | None) -> DataFrame:
    rows = row_sequence_features(_cut_context(tx, tie, groups, ranges), cuts)
    rows = _run_starts(rows, [ID, "_range"], tie)
    partial = aggregate_alerts(rows).drop("max_entry_run_len", "max_type_run_len")
    return partial.join(_longest_cut_runs(rows), ID)


def sequence_aggregates(
    tx: DataFrame,
    tie: Sequence[str],
    cuts: SizeCuts | None = None,
    *,
    hot_rows: int = HOT_ROWS,
    ranges: int | None = None,
) -> DataFrame:
    """Aggregates per alert from usable transactions; large alerts are cut into ranges."""
    cuts = cuts or size_cuts(tx)
    sizes = tx.groupBy(ID).agg(F.count(F.lit(1)).alias("_group_rows"))
    total, largest = sizes.agg(F.sum("_group_rows"), F.max("_group_rows")).first()
    if not total or largest <= hot_rows:
        return _regular(tx, tie, cuts)
    # No more than total/limit alerts can be large, so the large ones stay few enough to broadcast.
    limit = max(hot_rows, total // MAX_HOT_GROUPS)
    large = sizes.where(F.col("_group_rows") > limit).select(ID)
    groups = stage_table(
        tx.join(F.broadcast(large), ID, "left_semi")
        .groupBy(ID)
        .agg(
            F.count(F.lit(1)).alias("_group_rows"),
            F.min(TIME).alias("_first_time"),
            F.avg(F.abs("Size")).alias("_abs_mean"),
            F.stddev_samp(F.abs("Size")).alias("_abs_std"),
        ),
        "large-alerts",
    )
    names = F.broadcast(groups.select(ID))
    hot = tx.join(names, ID, "left_semi")
    regular = tx.join(names, ID, "left_anti")
    return _regular(regular, tie, cuts).unionByName(_cut(hot, tie, cuts, groups, ranges))


# Output share and the count it divides by the number of transactions.
_SHARES = {
    "credit_share": "n_credit",
    "debit_share": "n_debit",
    "wire_share": "n_wire",
    "card_share": "n_card",
    "credit_wire_share": "n_credit_wire",
    "credit_card_share": "n_credit_card",
    "debit_wire_share": "n_debit_wire",
    "debit_card_share": "n_debit_card",
    "positive_share": "n_positive",
    "negative_share": "n_negative",
    "entry_switch_share": "n_entry_switches",
    "type_switch_share": "n_type_switches",
    "sign_switch_share": "n_sign_switches",
    "delta_zero_share": "n_delta_zero",
    "delta_lt_10s_share": "n_delta_lt_10s",
    "delta_lt_60s_share": "n_delta_lt_60s",
    "delta_gt_1h_share": "n_delta_gt_1h",
    "large_abs_share": "n_large_abs",
    "very_large_abs_share": "n_very_large_abs",
    "small_abs_share": "n_small_abs",
    "alert_outlier_abs_share": "n_alert_outlier_abs",
}


def alert_ratios(agg: DataFrame) -> DataFrame:
    """Span, shares, rates, guarded ratios, differences and early shares."""
    rows = F.col("n_transactions")

    def per(a: str, b: str) -> Column:
        return F.col(a) / (F.col(b) + F.lit(EPS))

    spanned = agg.withColumn("time_span_seconds", seconds_between("first_timestamp", "last_timestamp"))
    span = F.col("time_span_seconds")
    return spanned.withColumns(
        {
            **{share: F.try_divide(F.col(count).cast("double"), rows.cast("double")) for share, count in _SHARES.items()},
            "tx_per_minute": rows / (span / 60 + F.lit(EPS)),
            "tx_per_hour": rows / (span / 3600 + F.lit(EPS)),
            "credit_to_debit_ratio": per("n_credit", "n_debit"),
            "wire_to_card_ratio": per("n_wire", "n_card"),
            "positive_to_negative_ratio": per("n_positive", "n_negative"),
            "signed_to_abs_ratio": per("size_sum", "size_abs_sum"),
            "wire_abs_share": per("size_abs_wire_sum", "size_abs_sum"),
            "card_abs_share": per("size_abs_card_sum", "size_abs_sum"),
            "credit_abs_share": per("size_abs_credit_sum", "size_abs_sum"),
            "debit_abs_share": per("size_abs_debit_sum", "size_abs_sum"),
            "credit_minus_debit": F.col("n_credit") - F.col("n_debit"),
            "wire_minus_card": F.col("n_wire") - F.col("n_card"),
            "positive_minus_negative": F.col("n_positive") - F.col("n_negative"),
            "credit_debit_abs_diff": F.abs(F.col("n_credit") - F.col("n_debit")),
            "wire_card_abs_diff": F.abs(F.col("n_wire") - F.col("n_card")),
            "wire_first_3_share": F.col("n_wire_first_3") / 3.0,
            "wire_first_5_share": F.col("n_wire_first_5") / 5.0,
            "debit_first_3_share": F.col("n_debit_first_3") / 3.0,
            "debit_first_5_share": F.col("n_debit_first_5") / 5.0,
            "first_last_entry_same": flag(F.col("first_entry_credit") == F.col("last_entry_credit")),
            "first_last_type_same": flag(F.col("first_type_wire") == F.col("last_type_wire")),
        }
    )


def alert_interactions(agg: DataFrame) -> DataFrame:
    """Products, entropies and rule flags over the ratios."""

    def above(name: str, value: float) -> Column:
        return F.col(name) > value

    short = F.col("time_span_seconds") < 300
    products = {
        "tx_per_minute_x_abs_sum": ("tx_per_minute", "size_abs_sum"),
        "wire_share_x_abs_sum": ("wire_share", "size_abs_sum"),
        "debit_share_x_abs_sum": ("debit_share", "size_abs_sum"),
        "entry_switch_share_x_tx_count": ("entry_switch_share", "n_transactions"),
        "type_switch_share_x_tx_count": ("type_switch_share", "n_transactions"),
        "delta_lt_10s_share_x_tx_count": ("delta_lt_10s_share", "n_transactions"),
        "large_abs_share_x_abs_sum": ("large_abs_share", "size_abs_sum"),
    }
    return agg.withColumns(
        {
            **{name: F.col(a) * F.col(b) for name, (a, b) in products.items()},
            "entry_entropy": binary_entropy("credit_share"),
            "type_entropy": binary_entropy("wire_share"),
            "sign_entropy": binary_entropy("positive_share"),
            "risk_many_wire_short_span": flag(above("wire_share", 0.7) & short),
            "risk_many_debit_short_span": flag(above("debit_share", 0.7) & short),
            "risk_high_burst": flag((F.col("n_transactions") >= 10) & (F.col("time_span_seconds") < 600)),
            "risk_high_switching": flag(above("entry_switch_share", 0.5)),
            "risk_extreme_size_variability": flag(F.col("size_abs_std") > F.col("size_abs_mean")),
            "risk_instant_dense_flow": flag(above("delta_lt_10s_share", 0.6) & (F.col("n_transactions") >= 8)),
            "risk_very_large_wire_dominance": flag(above("wire_share", 0.8) & above("very_large_abs_share", 0.1)),
            "risk_mostly_debit_and_negative": flag(above("debit_share", 0.8) & above("negative_share", 0.8)),
            "risk_many_outliers": flag(above("alert_outlier_abs_share", 0.2)),
        }
    )


RUN_AND_SPREAD_COLUMNS = [
    "size_std",
    "size_abs_std",
    "delta_std",
    "next_delta_std",
    "max_entry_run_len",
    "max_type_run_len",
    "mean_entry_run_len",
    "mean_type_run_len",
]


def alert_calendar(df: DataFrame, date: str = "Date") -> DataFrame:
    weekday, month = F.weekday(date), F.month(date)
    day_sin, day_cos = cyclic(weekday, 7)
    month_sin, month_cos = cyclic(month, 12)
    return df.withColumns(
        {
            "alert_month": month,
            "alert_day": F.dayofmonth(date),
            "alert_day_of_week": weekday,
            "alert_is_weekend": flag(weekday >= 5),
            "alert_day_sin": day_sin,
            "alert_day_cos": day_cos,
            "alert_month_sin": month_sin,
            "alert_month_cos": month_cos,
        }
    )


def labelled_alerts(alerts: DataFrame) -> DataFrame:
    """One row per alert (the first by date), with its 0/1 label; unknown outcomes are an error."""
    require_columns(alerts, ALERT_COLUMNS, "alerts")
    require_labels(alerts, "Outcome", list(OUTCOMES))
    dated = alerts if alerts.schema["Date"].dataType.typeName() == "timestamp_ntz" else alerts.withColumn(
        "Date", F.col("Date").try_cast("timestamp_ntz")
    )
    unique = first_by_key(dated, [ID], ["Date", "Outcome"])
    return unique.withColumn(TARGET, map_labels("Outcome", OUTCOMES))


def alert_features(
    alerts: DataFrame,
    transactions: DataFrame,
    tie: Sequence[str] = (),
    *,
    keep: Sequence[str] = (),
    cuts: SizeCuts | None = None,
    hot_rows: int = HOT_ROWS,
    ranges: int | None = None,
) -> DataFrame:
    """One row per alert with its sequence features. Alerts without transactions stay, filled with 0.

    `keep` names columns to carry along (AlertID, Date); they are no model features.
    """
    tx = usable_transactions(transactions, tie)
    agg = sequence_aggregates(tx, tie, cuts, hot_rows=hot_rows, ranges=ranges)
    wide = alert_interactions(alert_ratios(agg))
    joined = labelled_alerts(alerts).join(wide, ID, "left")
    out = alert_calendar(joined).withColumns({f"{c}_is_missing": missing_flag(c) for c in RUN_AND_SPREAD_COLUMNS})
    dropped = [c for c in ("Outcome", "Date", "first_timestamp", "last_timestamp", ID) if c not in keep]
    return fill_numeric(out.drop(*dropped), keep=[TARGET, ID])
