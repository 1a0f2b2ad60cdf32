"""Alert features against a plain pandas computation, for regular and for cut alerts."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from riskloom.operators import sequences as seq
from riskloom.operators.validate import ValidationError

SCHEMA = "AlertID bigint, Timestamp timestamp_ntz, Entry string, Type string, Size double, tie bigint"


def make(seed=5, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # One alert holds a third of the rows; others are short, some have one row.
        alert = 1 if i % 3 == 0 else 2 + min(int(rng.expovariate(0.08)), 60)
        moment = datetime(2024, 1, 1) + timedelta(seconds=rng.choice([0, 5, 9, 30, 59, 400, 5000, 90000]))
        rows.append((alert, moment, rng.choice(["Credit", "Debit"]), rng.choice(["Wire", "Card"]), rng.choice([-1, 1]) * round(rng.random() * 100, 2), i))
    return rows


def longest_run(values):
    best = run = 0
    before = object()
    for v in values:
        run = run + 1 if v == before else 1
        best, before = max(best, run), v
    return best


def expected(rows):
    df = pd.DataFrame(rows, columns=["AlertID", "Timestamp", "Entry", "Type", "Size", "tie"]).sort_values(["AlertID", "Timestamp", "tie"])
    p05, p95, p99 = (float(np.quantile(df["Size"].abs(), p)) for p in (0.05, 0.95, 0.99))
    out = {}
    for alert, g in df.groupby("AlertID"):
        size, absolute = g["Size"].to_numpy(), g["Size"].abs().to_numpy()
        gap = g["Timestamp"].diff().dt.total_seconds().fillna(0).to_numpy()
        ahead = (-g["Timestamp"].diff(-1).dt.total_seconds()).fillna(0).to_numpy()
        start = (g["Timestamp"] - g["Timestamp"].min()).dt.total_seconds().to_numpy()
        wire, debit, credit = (g["Type"] == "Wire").to_numpy(), (g["Entry"] == "Debit").to_numpy(), (g["Entry"] == "Credit").to_numpy()
        std = absolute.std(ddof=1) if len(g) > 1 else 0.0
        z = (absolute - absolute.mean()) / (std + 1e-6)
        out[alert] = {
            "n_transactions": len(g),
            "n_entry_switches": int((g["Entry"] != g["Entry"].shift()).sum() - 1),
            "n_sign_switches": int(((size > 0)[1:] != (size > 0)[:-1]).sum()),
            "n_delta_lt_10s": int((gap < 10).sum()),
            "n_delta_gt_1h": int((gap > 3600).sum()),
            "n_within_300s": int((start <= 300).sum()),
            "n_large_abs": int((absolute > p95).sum()),
            "n_very_large_abs": int((absolute > p99).sum()),
            "n_small_abs": int((absolute < p05).sum()),
            "n_alert_outlier_abs": int((abs(z) > 2).sum()),
            "size_sum": size.sum(),
            "size_std": size.std(ddof=1) if len(g) > 1 else None,
            "size_abs_first_3_sum": absolute[:3].sum(),
            "size_abs_last_3_sum": absolute[-3:].sum(),
            "n_wire_first_5": int(wire[:5].sum()),
            "n_debit_first_3": int(debit[:3].sum()),
            "delta_mean": gap.mean(),
            "next_delta_std": ahead.std(ddof=1) if len(g) > 1 else None,
            "first_entry_credit": int(credit[0]),
            "last_type_wire": int(wire[-1]),
            "max_entry_run_len": longest_run(g["Entry"]),
            "max_type_run_len": longest_run(g["Type"]),
            "mean_type_run_len": len(g) / (1 + int((g["Type"] != g["Type"].shift()).sum() - 1)),
            "size_abs_log1p_mean": np.log1p(absolute).mean(),
        }
    return out


@pytest.mark.parametrize("hot_rows,ranges", [(10_000, None), (20, 3), (20, 40), (100, 11)])
def test_aggregates_match_pandas(spark, hot_rows, ranges):
    rows = make()
    tx = seq.usable_transactions(spark.createDataFrame(rows, SCHEMA), ["tie"])
    got = {r["AlertID"]: r for r in seq.sequence_aggregates(tx, ["tie"], hot_rows=hot_rows, ranges=ranges).collect()}
    want = expected(rows)
    assert set(got) == set(want)
    for alert, values in want.items():
        for name, value in values.items():
            have = got[alert][name]
            assert (have is None) if value is None else math.isclose(have, value, rel_tol=1e-9, abs_tol=1e-9), (alert, name, have, value)


def test_one_endless_run_over_many_ranges(spark):
    rows = [(1, datetime(2024, 1, 1) + timedelta(seconds=i), "Credit", "Wire" if i != 150 else "Card", 1.0, i) for i in range(300)]
    tx = seq.usable_transactions(spark.createDataFrame(rows, SCHEMA), ["tie"])
    row = seq.sequence_aggregates(tx, ["tie"], hot_rows=10, ranges=25).first()
    assert row["max_entry_run_len"] == 300 and row["max_type_run_len"] == 150 and row["n_type_switches"] == 2


def alerts(spark, rows):
    return spark.createDataFrame(rows, "AlertID bigint, Date timestamp_ntz, Outcome string")


def test_alerts_without_transactions_and_copies(spark):
    held = alerts(spark, [(1, datetime(2024, 3, 2), "Report"), (99, datetime(2024, 3, 4), "Dismiss"), (99, datetime(2024, 3, 5), "Dismiss")])
    out = {r["AlertID"]: r for r in seq.alert_features(held, spark.createDataFrame(make(), SCHEMA), ["tie"], keep=["AlertID"]).collect()}
    assert set(out) == {1, 99}
    assert out[99]["n_transactions"] == 0 and out[99]["size_std_is_missing"] == 1 and out[99]["alert_day"] == 4
    assert out[1]["fraud_bool"] == 1 and out[1]["size_std_is_missing"] == 0 and out[1]["alert_is_weekend"] == 1


def test_bad_rows_are_dropped_and_bad_labels_raise(spark):
    rows = [(1, datetime(2024, 1, 1), "Credit", "Wire", None, 0), (None, datetime(2024, 1, 1), "Credit", "Wire", 1.0, 1), (1, None, "Credit", "Wire", 1.0, 2), (1, datetime(2024, 1, 1), None, "Wire", 1.0, 3)]
    assert seq.usable_transactions(spark.createDataFrame(rows, SCHEMA), ["tie"]).count() == 1
    with pytest.raises(ValidationError, match="Open"):
        seq.labelled_alerts(alerts(spark, [(1, None, "Open")]))
    with pytest.raises(ValidationError, match="Size"):
        seq.usable_transactions(spark.createDataFrame(rows, SCHEMA).drop("Size"), [])
