"""Alert sequence queries over two pairings: customers with events (long groups), orders with lines (short ones)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import sequences as seq
from workload.registry import ctes, number, query, whole
from workload.views import (
    ALERT_TRANSACTIONS,
    ALERTS,
    ORDER_ALERTS,
    ORDER_TIE,
    ORDER_TRANSACTIONS,
    alert_transactions,
    alerts,
    duck,
    view,
)


def one(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


ROW_FLAGS = {
    "is_credit": one("Entry = 'Credit'"),
    "is_debit": one("Entry = 'Debit'"),
    "is_wire": one("Type = 'Wire'"),
    "is_card": one("Type = 'Card'"),
    "credit_wire": one("Entry = 'Credit' AND Type = 'Wire'"),
    "credit_card": one("Entry = 'Credit' AND Type = 'Card'"),
    "debit_wire": one("Entry = 'Debit' AND Type = 'Wire'"),
    "debit_card": one("Entry = 'Debit' AND Type = 'Card'"),
    "size_positive": one("Size > 0"),
    "size_negative": one("Size < 0"),
}
ROW_AMOUNTS = {
    "size_abs": "abs(Size)",
    "size_squared": "Size * Size",
    "size_abs_log1p": "ln(1 + abs(Size))",
    "size_abs_wire": "CASE WHEN Type = 'Wire' THEN abs(Size) ELSE 0 END",
    "size_abs_card": "CASE WHEN Type = 'Card' THEN abs(Size) ELSE 0 END",
    "size_abs_credit": "CASE WHEN Entry = 'Credit' THEN abs(Size) ELSE 0 END",
    "size_abs_debit": "CASE WHEN Entry = 'Debit' THEN abs(Size) ELSE 0 END",
}
POSITION = {
    "is_first_1": one("tx_order <= 1"),
    "is_first_3": one("tx_order <= 3"),
    "is_first_5": one("tx_order <= 5"),
    "is_last_1": one("tx_order_desc <= 1"),
    "is_last_3": one("tx_order_desc <= 3"),
}
EARLY = {
    "size_abs_first_1": "CASE WHEN tx_order <= 1 THEN size_abs ELSE 0 END",
    "size_abs_first_3": "CASE WHEN tx_order <= 3 THEN size_abs ELSE 0 END",
    "size_abs_first_5": "CASE WHEN tx_order <= 5 THEN size_abs ELSE 0 END",
    "size_abs_last_1": "CASE WHEN tx_order_desc <= 1 THEN size_abs ELSE 0 END",
    "size_abs_last_3": "CASE WHEN tx_order_desc <= 3 THEN size_abs ELSE 0 END",
}
EARLY_COUNTS = {
    "wire_first_3": "CASE WHEN tx_order <= 3 THEN is_wire ELSE 0 END",
    "wire_first_5": "CASE WHEN tx_order <= 5 THEN is_wire ELSE 0 END",
    "debit_first_3": "CASE WHEN tx_order <= 3 THEN is_debit ELSE 0 END",
    "debit_first_5": "CASE WHEN tx_order <= 5 THEN is_debit ELSE 0 END",
}
GAP_FLAGS = {
    "delta_is_zero": one("delta_seconds = 0"),
    "delta_lt_10s": one("delta_seconds < 10"),
    "delta_lt_60s": one("delta_seconds < 60"),
    "delta_gt_1h": one("delta_seconds > 3600"),
}
START_FLAGS = {
    "within_60s": one("seconds_from_start <= 60"),
    "within_300s": one("seconds_from_start <= 300"),
    "within_3600s": one("seconds_from_start <= 3600"),
}
SWITCHES = {
    "entry_switch": one("Entry <> prev_entry"),
    "type_switch": one("Type <> prev_type"),
    "sign_switch": one("size_positive <> prev_sign"),
}
CUT_FLAGS = {
    "is_large_abs": one("size_abs > p95"),
    "is_very_large_abs": one("size_abs > p99"),
    "is_small_abs": one("size_abs < p05"),
}


def listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def parts(alerts_sql: str, tx_sql: str, tie: list[str]) -> dict[str, str]:
    order = ", ".join(['"Timestamp"', *tie])
    w = f"(PARTITION BY AlertID ORDER BY {order})"
    gap = "coalesce(date_diff('microsecond', {0}, {1}) / CAST(1000000 AS DOUBLE), 0)"
    return {
        "alerts": duck(alerts_sql),
        "tx": duck(tx_sql),
        "flagged": f"SELECT *, {listed(ROW_FLAGS)}, {listed(ROW_AMOUNTS)} FROM tx",
        "cuts": "SELECT quantile_cont(size_abs, 0.05) AS p05, quantile_cont(size_abs, 0.95) AS p95, quantile_cont(size_abs, 0.99) AS p99 FROM flagged",
        "placed": f"""SELECT *, row_number() OVER {w} AS tx_order, count(*) OVER (PARTITION BY AlertID) - row_number() OVER {w} + 1 AS tx_order_desc,
            lag("Timestamp") OVER {w} AS prev_timestamp, lead("Timestamp") OVER {w} AS next_timestamp,
            lag(Entry) OVER {w} AS prev_entry, lag(Type) OVER {w} AS prev_type, lag(size_positive) OVER {w} AS prev_sign,
            min("Timestamp") OVER (PARTITION BY AlertID) AS first_ts,
            (size_abs - avg(size_abs) OVER (PARTITION BY AlertID)) / (coalesce(stddev_samp(size_abs) OVER (PARTITION BY AlertID), 0) + 1e-6) AS size_abs_zscore
            FROM flagged""",
        "gaps": f"""SELECT *, {gap.format('prev_timestamp', '"Timestamp"')} AS delta_seconds, {gap.format('"Timestamp"', 'next_timestamp')} AS next_delta_seconds,
            date_diff('microsecond', first_ts, "Timestamp") / CAST(1000000 AS DOUBLE) AS seconds_from_start FROM placed""",
        "rows": f"""SELECT gaps.*, {listed(POSITION)}, {listed(EARLY)}, {listed(EARLY_COUNTS)}, {listed(GAP_FLAGS)}, {listed(START_FLAGS)},
            {listed(SWITCHES)}, {listed(CUT_FLAGS)}, {one('abs(size_abs_zscore) > 2')} AS is_alert_outlier_abs FROM gaps CROSS JOIN cuts""",
        "islands": f"""SELECT *, sum(entry_switch) OVER {w} AS entry_run, sum(type_switch) OVER {w} AS type_run FROM rows""",
        "entry_runs": "SELECT AlertID, max(n) AS max_entry_run_len, avg(n) AS mean_entry_run_len FROM (SELECT AlertID, entry_run, count(*) AS n FROM islands GROUP BY 1, 2) GROUP BY 1",
        "type_runs": "SELECT AlertID, max(n) AS max_type_run_len, avg(n) AS mean_type_run_len FROM (SELECT AlertID, type_run, count(*) AS n FROM islands GROUP BY 1, 2) GROUP BY 1",
        "aggregated": f"""SELECT AlertID, {listed(AGGREGATES)} FROM rows GROUP BY AlertID""",
        "with_runs": "SELECT aggregated.*, max_entry_run_len, mean_entry_run_len, max_type_run_len, mean_type_run_len FROM aggregated JOIN entry_runs USING (AlertID) JOIN type_runs USING (AlertID)",
        "spans": "SELECT *, date_diff('microsecond', first_timestamp, last_timestamp) / CAST(1000000 AS DOUBLE) AS time_span_seconds FROM with_runs",
        "ratios": f"SELECT *, {listed(SHARES)}, {listed(RATES)}, {listed(GUARDED)}, {listed(DIFFERENCES)}, {listed(EARLY_SHARES)}, {listed(ENDS)} FROM spans",
        "wide": f"SELECT *, {listed(PRODUCTS)}, {listed(ENTROPIES)}, {listed(RULES)} FROM ratios",
    }


SUMMED = {
    **{f"n_{n}": s for n, s in {
        "credit": "is_credit", "debit": "is_debit", "wire": "is_wire", "card": "is_card",
        "credit_wire": "credit_wire", "credit_card": "credit_card", "debit_wire": "debit_wire", "debit_card": "debit_card",
        "positive": "size_positive", "negative": "size_negative",
        "entry_switches": "entry_switch", "type_switches": "type_switch", "sign_switches": "sign_switch",
        "within_60s": "within_60s", "within_300s": "within_300s", "within_3600s": "within_3600s",
        "delta_zero": "delta_is_zero", "delta_lt_10s": "delta_lt_10s", "delta_lt_60s": "delta_lt_60s", "delta_gt_1h": "delta_gt_1h",
        "large_abs": "is_large_abs", "very_large_abs": "is_very_large_abs", "small_abs": "is_small_abs",
        "alert_outlier_abs": "is_alert_outlier_abs", "wire_first_3": "wire_first_3", "wire_first_5": "wire_first_5",
        "debit_first_3": "debit_first_3", "debit_first_5": "debit_first_5",
    }.items()},
    **{f"{n}_sum": n for n in (
        "size_squared", "size_abs", "size_abs_wire", "size_abs_card", "size_abs_credit", "size_abs_debit",
        "size_abs_first_1", "size_abs_first_3", "size_abs_first_5", "size_abs_last_1", "size_abs_last_3",
    )},
    "size_sum": "Size",
}
AGGREGATES = {
    "n_transactions": "count(*)",
    **{n: f"sum({s})" for n, s in SUMMED.items()},
    "size_mean": "avg(Size)",
    "size_std": "stddev_samp(Size)",
    "size_min": "min(Size)",
    "size_max": "max(Size)",
    "size_abs_mean": "avg(size_abs)",
    "size_abs_std": "stddev_samp(size_abs)",
    "size_abs_min": "min(size_abs)",
    "size_abs_max": "max(size_abs)",
    "size_abs_log1p_mean": "avg(size_abs_log1p)",
    "delta_mean": "avg(delta_seconds)",
    "delta_std": "stddev_samp(delta_seconds)",
    "delta_min": "min(delta_seconds)",
    "delta_max": "max(delta_seconds)",
    "next_delta_mean": "avg(next_delta_seconds)",
    "next_delta_std": "stddev_samp(next_delta_seconds)",
    "first_timestamp": 'min("Timestamp")',
    "last_timestamp": 'max("Timestamp")',
    "first_entry_credit": "max(CASE WHEN tx_order = 1 THEN is_credit END)",
    "first_type_wire": "max(CASE WHEN tx_order = 1 THEN is_wire END)",
    "last_entry_credit": "max(CASE WHEN tx_order_desc = 1 THEN is_credit END)",
    "last_type_wire": "max(CASE WHEN tx_order_desc = 1 THEN is_wire END)",
}


def over(a: str, b: str) -> str:
    return f"{a} / ({b} + 1e-6)"


SHARE_COUNTS = {
    "credit": "credit", "debit": "debit", "wire": "wire", "card": "card", "credit_wire": "credit_wire", "credit_card": "credit_card",
    "debit_wire": "debit_wire", "debit_card": "debit_card", "positive": "positive", "negative": "negative",
    "entry_switch": "entry_switches", "type_switch": "type_switches", "sign_switch": "sign_switches", "delta_zero": "delta_zero",
    "delta_lt_10s": "delta_lt_10s", "delta_lt_60s": "delta_lt_60s", "delta_gt_1h": "delta_gt_1h", "large_abs": "large_abs",
    "very_large_abs": "very_large_abs", "small_abs": "small_abs", "alert_outlier_abs": "alert_outlier_abs",
}
SHARES = {f"{s}_share": f"CAST(n_{n} AS DOUBLE) / n_transactions" for s, n in SHARE_COUNTS.items()}
RATES = {
    "tx_per_minute": "n_transactions / (time_span_seconds / 60 + 1e-6)",
    "tx_per_hour": "n_transactions / (time_span_seconds / 3600 + 1e-6)",
}
GUARDED = {
    "credit_to_debit_ratio": over("n_credit", "n_debit"),
    "wire_to_card_ratio": over("n_wire", "n_card"),
    "positive_to_negative_ratio": over("n_positive", "n_negative"),
    "signed_to_abs_ratio": over("size_sum", "size_abs_sum"),
    "wire_abs_share": over("size_abs_wire_sum", "size_abs_sum"),
    "card_abs_share": over("size_abs_card_sum", "size_abs_sum"),
    "credit_abs_share": over("size_abs_credit_sum", "size_abs_sum"),
    "debit_abs_share": over("size_abs_debit_sum", "size_abs_sum"),
}
DIFFERENCES = {
    "credit_minus_debit": "n_credit - n_debit",
    "wire_minus_card": "n_wire - n_card",
    "positive_minus_negative": "n_positive - n_negative",
    "credit_debit_abs_diff": "abs(n_credit - n_debit)",
    "wire_card_abs_diff": "abs(n_wire - n_card)",
}
EARLY_SHARES = {
    "wire_first_3_share": "n_wire_first_3 / CAST(3 AS DOUBLE)",
    "wire_first_5_share": "n_wire_first_5 / CAST(5 AS DOUBLE)",
    "debit_first_3_share": "n_debit_first_3 / CAST(3 AS DOUBLE)",
    "debit_first_5_share": "n_debit_first_5 / CAST(5 AS DOUBLE)",
}
ENDS = {
    "first_last_entry_same": one("first_entry_credit = last_entry_credit"),
    "first_last_type_same": one("first_type_wire = last_type_wire"),
}
PRODUCTS = {
    "tx_per_minute_x_abs_sum": "tx_per_minute * size_abs_sum",
    "wire_share_x_abs_sum": "wire_share * size_abs_sum",
    "debit_share_x_abs_sum": "debit_share * size_abs_sum",
    "entry_switch_share_x_tx_count": "entry_switch_share * n_transactions",
    "type_switch_share_x_tx_count": "type_switch_share * n_transactions",
    "delta_lt_10s_share_x_tx_count": "delta_lt_10s_share * n_transactions",
    "large_abs_share_x_abs_sum": "large_abs_share * size_abs_sum",
}


def entropy(share: str) -> str:
    p = f"least(greatest(coalesce({share}, CAST(0.5 AS DOUBLE)), 1e-6), CAST(1 AS DOUBLE) - 1e-6)"
    return f"-({p} * ln({p}) + (1 - {p}) * ln(1 - {p}))"


ENTROPIES = {"entry_entropy": entropy("credit_share"), "type_entropy": entropy("wire_share"), "sign_entropy": entropy("positive_share")}
RULES = {
    "risk_many_wire_short_span": one("wire_share > 7e-1 AND time_span_seconds < 300"),
    "risk_many_debit_short_span": one("debit_share > 7e-1 AND time_span_seconds < 300"),
    "risk_high_burst": one("n_transactions >= 10 AND time_span_seconds < 600"),
    "risk_high_switching": one("entry_switch_share > 5e-1"),
    "risk_extreme_size_variability": one("size_abs_std > size_abs_mean"),
    "risk_instant_dense_flow": one("delta_lt_10s_share > 6e-1 AND n_transactions >= 8"),
    "risk_very_large_wire_dominance": one("wire_share > 8e-1 AND very_large_abs_share > 1e-1"),
    "risk_mostly_debit_and_negative": one("debit_share > 8e-1 AND negative_share > 8e-1"),
    "risk_many_outliers": one("alert_outlier_abs_share > 2e-1"),
}
CALENDAR_WHOLE = {
    "alert_month": 'month("Date")',
    "alert_day": 'day("Date")',
    "alert_day_of_week": 'isodow("Date") - 1',
    "alert_is_weekend": one('isodow("Date") >= 6'),
}
CALENDAR_NUMBERS = {
    "alert_day_sin": 'sin(2 * pi() * (isodow("Date") - 1) / 7)',
    "alert_day_cos": 'cos(2 * pi() * (isodow("Date") - 1) / 7)',
    "alert_month_sin": 'sin(2 * pi() * month("Date") / 12)',
    "alert_month_cos": 'cos(2 * pi() * month("Date") / 12)',
}
MAYBE_MISSING = ["size_std", "size_abs_std", "delta_std", "next_delta_std", "max_entry_run_len", "max_type_run_len", "mean_entry_run_len", "mean_type_run_len"]

WHOLE_AGGREGATES = ["n_transactions", *[n for n in SUMMED if n.startswith("n_")], "first_entry_credit", "first_type_wire", "last_entry_credit", "last_type_wire"]
NUMBER_AGGREGATES = [n for n in AGGREGATES if n not in WHOLE_AGGREGATES and not n.endswith("_timestamp")]
WHOLE_WIDE = [*DIFFERENCES, *ENDS, *RULES]
NUMBER_WIDE = ["time_span_seconds", *SHARES, *RATES, *GUARDED, *EARLY_SHARES, *PRODUCTS, *ENTROPIES]

LONG = parts(ALERTS, ALERT_TRANSACTIONS, ["event_id"])
SHORT = parts(ORDER_ALERTS, ORDER_TRANSACTIONS, ORDER_TIE)


def upto(source: dict[str, str], last: str) -> dict[str, str]:
    names = list(source)
    return {n: source[n] for n in names[: names.index(last) + 1]}


def w(*names: str) -> str:
    return ", ".join(whole(n) for n in names)


def n(*names: str, digits: int = 6) -> str:
    return ", ".join(number(c, digits=digits) for c in names)


def row_sql(columns: str, last: str = "rows") -> str:
    return ctes(upto(LONG, last), f"SELECT {whole('event_id')}, {columns} FROM {last}")


def usable(spark, folder):
    return seq.usable_transactions(alert_transactions(spark, folder), ["event_id"])


def rows(spark, folder):
    tx = usable(spark, folder)
    context = seq.whole_group_context(tx, ["event_id"])
    return seq.row_sequence_features(context, seq.size_cuts(tx))


def row_query(key: str, whole_columns=(), number_columns=(), last: str = "rows", digits: int = 6):
    columns = ", ".join(x for x in (w(*whole_columns), n(*number_columns, digits=digits)) if x)

    def build(spark, folder):
        return rows(spark, folder).select("event_id", *whole_columns, *number_columns)

    query(key, row_sql(columns, last), digits)(build)


row_query("a01_indicators", [c for c in ROW_FLAGS], last="flagged")
row_query("a02_masked_amounts", (), ["size_abs_wire", "size_abs_card", "size_abs_credit", "size_abs_debit"], last="flagged")
row_query("a03_size_forms", (), ["size_abs", "size_squared", "size_abs_log1p"], last="flagged")
row_query("a04_positions", ["tx_order", "tx_order_desc"], last="placed")
row_query("a05_early_and_late", [*POSITION, *EARLY_COUNTS], [*EARLY])
row_query("a06_gaps", (), ["delta_seconds", "next_delta_seconds"], last="gaps")
row_query("a07_gap_flags", [*GAP_FLAGS])
row_query("a08_since_start", [*START_FLAGS], ["seconds_from_start"])
row_query("a09_switches", [*SWITCHES])
row_query("a11_group_zscore", ["is_alert_outlier_abs"], ["size_abs_zscore"])


@query("a10_size_cuts", ctes(upto(LONG, "cuts"), f"SELECT {n('p05', 'p95', 'p99')} FROM cuts"))
def a10(spark, folder):
    cuts = seq.size_cuts(usable(spark, folder))
    return spark.createDataFrame([(cuts.p05, cuts.p95, cuts.p99)], "p05 double, p95 double, p99 double")


row_query("a10_cut_flags", [*CUT_FLAGS])


def agg_sql(source: dict[str, str], last: str, columns: str) -> str:
    return ctes(upto(source, last), f"SELECT {whole('AlertID')}, {columns} FROM {last}")


@query(
    "a12_runs",
    ctes(
        upto(LONG, "type_runs"),
        f"SELECT {whole('AlertID')}, {w('max_entry_run_len', 'max_type_run_len')}, {n('mean_entry_run_len', 'mean_type_run_len')} FROM entry_runs JOIN type_runs USING (AlertID)",
    ),
)
def a12(spark, folder):
    agg = seq.sequence_aggregates(usable(spark, folder), ["event_id"])
    return agg.select("AlertID", "max_entry_run_len", "max_type_run_len", "mean_entry_run_len", "mean_type_run_len")


@query("a13_aggregates", agg_sql(LONG, "aggregated", f"{w(*WHOLE_AGGREGATES)}, {n(*NUMBER_AGGREGATES, digits=4)}"), digits=4)
def a13(spark, folder):
    return seq.sequence_aggregates(usable(spark, folder), ["event_id"]).select("AlertID", *WHOLE_AGGREGATES, *NUMBER_AGGREGATES)


@query("a14_aggregates_with_runs", agg_sql(LONG, "with_runs", f"{w('n_transactions', 'max_entry_run_len', 'max_type_run_len')}, {n('size_mean', 'mean_entry_run_len')}"))
def a14(spark, folder):
    agg = seq.sequence_aggregates(usable(spark, folder), ["event_id"])
    return agg.select("AlertID", "n_transactions", "max_entry_run_len", "max_type_run_len", "size_mean", "mean_entry_run_len")


def wide(spark, folder):
    agg = seq.sequence_aggregates(usable(spark, folder), ["event_id"])
    return seq.alert_interactions(seq.alert_ratios(agg))


def wide_query(key: str, whole_columns=(), number_columns=(), digits: int = 6):
    columns = ", ".join(x for x in (w(*whole_columns), n(*number_columns, digits=digits)) if x)

    def build(spark, folder):
        return wide(spark, folder).select("AlertID", *whole_columns, *number_columns)

    query(key, agg_sql(LONG, "wide", columns), digits)(build)


wide_query("a15_time_span", (), ["time_span_seconds"])
wide_query("a16_shares", (), [*SHARES])
wide_query("a17_rates", (), [*RATES])
wide_query("a18_ratios_and_differences", [*DIFFERENCES], [*GUARDED], digits=4)
wide_query("a19_early_shares", (), [*EARLY_SHARES])
wide_query("a20_same_ends", [*ENDS])
wide_query("a21_products", (), [*PRODUCTS], digits=4)
wide_query("a22_entropies", (), [*ENTROPIES])
wide_query("a23_rules", [*RULES])

JOINED_WHOLE = [*CALENDAR_WHOLE]


def final_sql(source: dict[str, str], digits: int = 4, leave: tuple[str, ...] = ()) -> str:
    numbers = [c for c in [*NUMBER_AGGREGATES, "mean_entry_run_len", "mean_type_run_len", *NUMBER_WIDE] if c not in leave]
    filled = [
        *[whole(f"coalesce({c}, 0)", c) for c in [*WHOLE_AGGREGATES, "max_entry_run_len", "max_type_run_len", *WHOLE_WIDE]],
        *[number(f"coalesce({c}, 0)", c, digits) for c in numbers],
        *[whole(e, c) for c, e in CALENDAR_WHOLE.items()],
        *[number(e, c, digits) for c, e in CALENDAR_NUMBERS.items()],
        *[whole(f"{c} IS NULL", f"{c}_is_missing") for c in MAYBE_MISSING],
    ]
    return ctes(
        source,
        f"""SELECT {whole('a.AlertID', 'AlertID')}, {whole("CASE WHEN Outcome = 'Report' THEN 1 ELSE 0 END", 'fraud_bool')}, {', '.join(filled)}
        FROM alerts a LEFT JOIN wide w ON a.AlertID = w.AlertID""",
    )


@query(
    "a24_alerts_left_join",
    ctes(LONG, f"SELECT {whole('a.AlertID', 'AlertID')}, {whole('coalesce(n_transactions, 0)', 'n_transactions')} FROM alerts a LEFT JOIN wide w ON a.AlertID = w.AlertID"),
)
def a24(spark, folder):
    out = seq.alert_features(alerts(spark, folder), alert_transactions(spark, folder), ["event_id"], keep=["AlertID"])
    return out.select("AlertID", "n_transactions")


@query(
    "a25_alert_calendar",
    ctes({"alerts": duck(ALERTS)}, f"SELECT {whole('AlertID')}, {', '.join(whole(e, c) for c, e in CALENDAR_WHOLE.items())}, {', '.join(number(e, c) for c, e in CALENDAR_NUMBERS.items())} FROM alerts"),
)
def a25(spark, folder):
    return seq.alert_calendar(alerts(spark, folder)).select("AlertID", *CALENDAR_WHOLE, *CALENDAR_NUMBERS)


@query(
    "a26_missing_flags",
    ctes(LONG, f"SELECT {whole('a.AlertID', 'AlertID')}, {', '.join(whole(f'{c} IS NULL', f'{c}_is_missing') for c in MAYBE_MISSING)} FROM alerts a LEFT JOIN wide w ON a.AlertID = w.AlertID"),
)
def a26(spark, folder):
    out = seq.alert_features(alerts(spark, folder), alert_transactions(spark, folder), ["event_id"], keep=["AlertID"])
    return out.select("AlertID", *[f"{c}_is_missing" for c in MAYBE_MISSING])


@query(
    "a27_finished_rows",
    ctes(LONG, f"SELECT {whole('count(*)', 'rows')}, {whole('sum(coalesce(n_wire, 0))', 'n_wire')}, {number('sum(coalesce(size_std, 0))', 'size_std', 4)}, CAST(143 AS BIGINT) AS columns FROM alerts a LEFT JOIN wide w ON a.AlertID = w.AlertID"),
    digits=4,
)
def a27(spark, folder):
    held = alerts(spark, folder)
    out = seq.alert_features(held.unionAll(held), alert_transactions(spark, folder), ["event_id"])
    return out.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_wire").alias("n_wire"), F.sum("size_std").alias("size_std"), F.lit(len(out.columns)).alias("columns")
    )


@query("a28_alert_features", final_sql(LONG), digits=4)
def a28(spark, folder):
    return seq.alert_features(alerts(spark, folder), alert_transactions(spark, folder), ["event_id"], keep=["AlertID"])


@query("a28_large_alerts", final_sql(LONG), digits=4)
def a28_large(spark, folder):
    """As a28, with alerts of more than 60 transactions cut into ranges."""
    return seq.alert_features(
        alerts(spark, folder), alert_transactions(spark, folder), ["event_id"], keep=["AlertID"], hot_rows=60, ranges=64
    )


def order_pair(spark, folder):
    return view(spark, folder, ORDER_ALERTS), view(spark, folder, ORDER_TRANSACTIONS)


# These grow so large that the order of addition shows; they are compared on the other pairing.
LARGE_NUMBERS = ("size_squared_sum", "tx_per_minute_x_abs_sum", "delta_std", "next_delta_std")


@query("a28_short_groups", final_sql(SHORT, 5, LARGE_NUMBERS), digits=5)
def a28_short(spark, folder):
    held, lines = order_pair(spark, folder)
    return seq.alert_features(held, lines, ORDER_TIE, keep=["AlertID"]).drop(*LARGE_NUMBERS)
