import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate as ev
from riskloom.operators import results as res


def brute(rows, threshold=0.5, ks=(3, 50)):
    tp = sum(1 for _, y, s in rows if s >= threshold and y)
    fp = sum(1 for _, y, s in rows if s >= threshold and not y)
    pos = sum(y for _, y, _ in rows)
    neg = len(rows) - pos
    pairs = [(a, b) for _, y, a in rows if y for _, z, b in rows if not z]
    auc = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs) if pairs else None
    ap = 0.0
    for s in {s for _, _, s in rows}:
        k = sum(1 for *_, x in rows if x >= s)
        hit = sum(y for _, y, x in rows if x >= s)
        ap += sum(y for _, y, x in rows if x == s) / pos * hit / k if pos else 0.0
    best = sorted(rows, key=lambda r: (-r[2], r[0]))
    out = {"tp": tp, "fp": fp, "fn": pos - tp, "tn": neg - fp, "roc_auc": auc, "pr_auc": ap, "positive_share": pos / len(rows)}
    for k in ks:
        hits = sum(r[1] for r in best[:k])
        out[f"precision_at_{k}"] = hits / min(k, len(rows))
        out[f"recall_at_{k}"] = hits / pos if pos else 0.0
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, y int, score double")


def make(seed, n=40, levels=12):
    rng = random.Random(seed)
    return [(i, int(rng.random() < 0.3), rng.randrange(levels) / levels) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_match_brute_force(spark, seed):
    rows = make(seed)
    got = ev.evaluate_scores(frame(spark, rows), ks=(3, 50)).first().asDict()
    for name, value in brute(rows).items():
        assert got[name] == pytest.approx(value, abs=1e-12), name


@pytest.mark.parametrize("rows", [[(i, 1, 0.5) for i in range(5)], [(i, 0, 0.2) for i in range(5)], [(i, i % 2, 0.7) for i in range(6)], [(0, 1, 0.9)]])
def test_one_class_all_ties_single_row(spark, rows):
    got = ev.evaluate_scores(frame(spark, rows), ks=(3, 50)).first().asDict()
    for name, value in brute(rows).items():
        assert got[name] == (None if value is None else pytest.approx(value)), name


def test_groups_are_independent(spark):
    both = {"a": make(4), "b": make(5, 70)}
    df = frame(spark, both["a"]).withColumn("g", F.lit("a")).unionByName(frame(spark, both["b"]).withColumn("g", F.lit("b")))
    for row in ev.evaluate_scores(df, ks=(3, 50), by=["g"]).collect():
        for name, value in brute(both[row["g"]]).items():
            assert row[name] == pytest.approx(value, abs=1e-12), name


def test_sweep_counts_equal_the_counts_at_each_threshold(spark):
    exact = [i / 100 for i in range(101)]
    rows = [(i, i % 3 == 0, s) for i, s in enumerate([*exact, 0.29, 0.57, 0.58, 0.2899999, 0.5800001])]
    rows = [(i, int(y), s) for i, y, s in rows]
    sweep = {r["step"]: r for r in ev.threshold_sweep(frame(spark, rows)).collect()}
    assert sorted(sweep) == list(range(1, 100))
    for step, row in sweep.items():
        want = brute(rows, step / 100)
        assert [row[c] for c in ev.COUNTS] == [want[c] for c in ev.COUNTS], step


def test_operating_points(spark):
    rows = make(7, 200, 40)
    table = [brute(rows, i / 100) | {"t": i} for i in range(1, 100)]
    for r in table:
        r["precision"] = r["tp"] / (r["tp"] + r["fp"]) if r["tp"] + r["fp"] else 0.0
        r["recall"] = r["tp"] / (r["tp"] + r["fn"])
        r["f1"] = 2 * r["tp"] / (2 * r["tp"] + r["fp"] + r["fn"])
        r["alert"], r["fpr"] = (r["tp"] + r["fp"]) / len(rows), r["fp"] / (r["fp"] + r["tn"])
    by_recall = lambda r: (r["recall"], r["precision"], r["f1"], -r["t"])
    want = {
        ev.MODE_DEFAULT: 0.5,
        ev.MODE_BEST_F1: max(table, key=lambda r: (r["f1"], r["recall"], r["precision"], -r["t"]))["t"] / 100,
        ev.MODE_ALERT_20: max((r for r in table if r["alert"] <= 0.2), key=by_recall)["t"] / 100,
        ev.MODE_ALERT_30: max((r for r in table if r["alert"] <= 0.3), key=by_recall)["t"] / 100,
        ev.MODE_FPR_05: max((r for r in table if r["fpr"] <= 0.05), key=by_recall)["t"] / 100,
    }
    got = {r["threshold_mode"]: r["threshold"] for r in ev.operating_points(ev.threshold_sweep(frame(spark, rows))).collect()}
    assert got == want


def test_top_rows_by_running_counts(spark, monkeypatch):
    df = frame(spark, make(11, 300)).withColumn("g", F.col("row_id") % 3)
    plain = {k: {(r["row_id"], r["rank"]) for r in ev.top_rows(df, 20, by=k).collect()} for k in ((), ("g",))}
    monkeypatch.setattr(ev, "GROUP_LIMIT", 5)
    monkeypatch.setattr(ev, "TOP_ROWS", 5)
    for by, want in plain.items():
        assert {(r["row_id"], r["rank"]) for r in ev.top_rows(df, 20, by=by).collect()} == want


def test_scores_that_are_no_numbers_come_last(spark, monkeypatch):
    df = frame(spark, [(1, 1, float("nan")), (2, 0, 0.4), (3, 1, 0.9), (4, 0, None), (5, 0, 0.1)])
    few = [r["row_id"] for r in ev.top_rows(df, 4).orderBy("rank").collect()]
    monkeypatch.setattr(ev, "TOP_ROWS", 1)
    many = [r["row_id"] for r in ev.top_rows(df, 4).orderBy("rank").collect()]
    assert few == many == [3, 2, 5, 1]


def test_points_keep_the_group_without_a_name(spark):
    df = frame(spark, make(12, 80)).withColumn("g", F.when(F.col("row_id") % 2 == 0, "a"))
    assert {r["g"] for r in ev.apply_operating_points(df, df, by=["g"]).collect()} == {"a", None}


def test_mode_without_candidate_is_absent(spark):
    rows = [(i, int(i < 2), 1.0) for i in range(10)]
    got = {r["threshold_mode"] for r in ev.operating_points(ev.threshold_sweep(frame(spark, rows))).collect()}
    assert got == {ev.MODE_DEFAULT, ev.MODE_BEST_F1}


def test_points_chosen_on_one_part_measured_on_the_other(spark):
    valid, test = make(8, 120, 30), make(9, 90, 30)
    rows = ev.apply_operating_points(frame(spark, valid), frame(spark, test), ks=(3, 50)).collect()
    for r in rows:
        want = brute(test, r["threshold"])
        assert all(r[n] == pytest.approx(v, abs=1e-12) for n, v in want.items())


# Published counts and the rates that belong to them.
PUBLISHED = [
    (1527, 19600, 519, 128354, 0.0722771808586169, 0.7463343108504399, 0.1317913088508177, 0.1324736066615299, 0.1408466666666666, 0.01364),
    (1525, 18812, 521, 129142, 0.0749864778482568, 0.7453567937438905, 0.1362641290264933, 0.1271476269651378, 0.13558, 0.01364),
    (1052, 223916, 645, 1200116, 0.0046762206180434, 0.619917501473188, 0.0092824211942734, 0.1572408485202579, 0.1577915578626793, 0.0011902682767903),
]


def test_published_rates(spark):
    counts = spark.createDataFrame([r[:4] for r in PUBLISHED], "tp bigint, fp bigint, fn bigint, tn bigint")
    got = {r["tp"]: r for r in ev.with_rates(counts).collect()}
    names = ["precision", "recall", "f1_score", "false_positive_rate", "alert_rate", "positive_share"]
    for row in PUBLISHED:
        assert [got[row[0]][n] for n in names] == pytest.approx(row[4:], rel=1e-12)


RESULTS = [
    ("j1", "Base", "0.20", 0.9, 0.5, 0.6),
    ("j2", "Base", "0.20", 0.8, 0.5, 0.7),
    ("j3", "Variant I", "0.10", 0.7, None, 0.1),
    ("j4", "Other", "bad", 0.99, 0.9, 0.9),
]


def table(spark):
    return res.coerce_results(spark.createDataFrame(RESULTS, "job_id string, scenario string, pr_auc string, roc_auc double, f1_score double, precision_at_100 double"))


def test_result_tables(spark):
    df = table(spark)
    assert [r["job_id"] for r in res.sort_by_scenario_rank(df).collect()] == ["j1", "j2", "j3", "j4"]
    assert {r["scenario"]: r["job_id"] for r in res.best_per_scenario(df, ["pr_auc"]).collect()} == {"Base": "j1", "Variant I": "j3"}
    assert {r["job_id"] for r in res.best_per_scenario(df, ["pr_auc", "f1_score", "precision_at_100"]).collect()} == {"j2", "j3"}
    assert {r["best_by"]: r["job_id"] for r in res.overall_best(df).collect()} == {"pr_auc": "j1", "roc_auc": "j4", "precision_at_100": "j4"}
    assert [r["job_id"] for r in res.scenario_like(df, "VARIANT", ["job_id", "none"]).collect()] == ["j3"]


def test_read_results_with_provenance(spark, folder):
    table(spark).write.option("header", True).csv(f"{folder}/a.csv")
    with pytest.raises(FileNotFoundError):
        res.read_results(spark, [f"{folder}/a.csv", f"{folder}/b.csv"])
    rows = res.read_results(spark, [f"{folder}/a.csv", f"{folder}/b.csv"], on_missing="skip").collect()
    assert len(rows) == 4 and {r["source_file"] for r in rows} == {"a.csv"}
