import collections
import glob
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators import explain, models
from riskloom.operators.models import ModelBundle, ModelSettings
from riskloom.operators.presets import REQUEST_SCHEMA
from riskloom.operators.validate import ValidationError
from riskloom.plans import jobs
from riskloom.streaming import scorer

SMALL = ModelSettings(trees=3, depth=3, linear_iterations=20)


@pytest.fixture(scope="module")
def prepared(applications):
    return jobs.build_application_features(applications(120))


@pytest.fixture(scope="module")
def linear(prepared):
    return models.train(prepared.frame, prepared.categorical, prepared.numerical, models.LINEAR, settings=SMALL)


def test_selection_publishes_the_best(spark, prepared, folder):
    summary = jobs.run_training(
        prepared, (models.TREES_BALANCED, models.TREES_POSITIVE), settings=SMALL, publish_to=f"{folder}/best", runs_out=f"{folder}/runs"
    ).collect()
    best = [r for r in summary if r["is_best"]]
    assert len(best) == 1 and best[0]["valid_roc_auc"] >= 0.5
    assert best[0]["valid_pr_auc"] == max(r["valid_pr_auc"] for r in summary)
    assert sum(best[0][f"{s}_rows"] for s in ("train", "valid", "test")) == 120
    loaded = ModelBundle.load(spark, f"{folder}/best")
    scored = loaded.score(prepared.frame)
    assert scored.columns == [*prepared.frame.columns, models.SCORE, models.LABEL]
    row = scored.agg(F.min(models.SCORE), F.max(models.SCORE)).first()
    assert 0 <= row[0] <= row[1] <= 1
    assert spark.read.parquet(f"{folder}/runs").select("run_id").distinct().count() == 2


def test_scoring_needs_every_input(prepared, linear):
    with pytest.raises(ValidationError, match="income"):
        linear.bundle.score(prepared.frame.drop("income"))


def test_contributions_add_up(prepared, linear):
    bundle = linear.bundle
    means = bundle.means(prepared.frame, ["event_id"])
    base = bundle.linear.intercept + sum(c * m for c, m in zip(bundle.linear.coefficients, means))
    for row in bundle.explain(prepared.frame, ["event_id"]).limit(20).collect():
        logit = math.log(row[models.SCORE] / (1 - row[models.SCORE]))
        assert base + sum(f["shap_value"] for f in row["factors"]) == pytest.approx(logit, abs=1e-6)
        sizes = [f["abs_shap_value"] for f in row["factors"]]
        assert sizes == sorted(sizes, reverse=True)
        assert not any(f["feature"].startswith("payment_type_") for f in row["factors"])


def test_arrays_and_long_form_agree(prepared, linear):
    bundle = linear.bundle
    arrays = bundle.contributions(prepared.frame, ["event_id"], "event_id")
    long = explain.long_contributions(arrays, "event_id", "contributions", bundle.feature_names)
    folded = {(r["event_id"], r["feature"]): r["shap_value"] for r in explain.fold_contributions(long, "event_id").collect()}
    for row in bundle.explain(prepared.frame, ["event_id"]).collect():
        for f in row["factors"]:
            assert folded[row["event_id"], f["feature"]] == pytest.approx(f["shap_value"], abs=1e-9)


def test_folding_and_reasons(spark):
    rows = [(1, "payment_type_AB", 0.2), (1, "payment_type_AA", 0.1), (1, "income", -0.3), (1, "event_is_weekend_1", 0.0), (1, "credit_risk_score", 0.25)]
    df = spark.createDataFrame(rows, "row_id bigint, feature string, shap_value double")
    row = explain.with_reasons(explain.explain_rows(explain.fold_contributions(df), top_k=2)).first()
    assert [f["feature"] for f in row["top_positive_factors"]] == ["payment_type", "credit_risk_score"]
    assert [f["feature"] for f in row["top_negative_factors"]] == ["income"]
    ranked = explain.ranked_factors(explain.fold_contributions(df)).where("feature = 'event_is_weekend_1'").first()
    assert ranked["direction"] == "decrease_risk" and ranked["rank"] == 4
    assert row["human_readable_reasons"][0].endswith("(SHAP=0.3000)") and "0.2500" in row["human_readable_reasons"][1]
    other = spark.range(1).select(explain.reason_text(explain.factor(F.lit("zip"), F.lit(0.5)))).first()[0]
    assert "'zip'" in other and "SHAP=0.5000" in other


def requests(spark, applications, n=40):
    rows = applications(n).withColumn("row_id", F.monotonically_increasing_id())
    return rows.select("row_id", *REQUEST_SCHEMA.fieldNames())


def test_batch_scoring(spark, applications, linear, folder):
    held = requests(spark, applications)
    out = jobs.score_batch(held.unionAll(held.withColumn("row_id", F.col("row_id") + 10**12)), linear.bundle, log_to=f"{folder}/log")
    rows = out.collect()
    assert len(rows) == 80 and len({r["row_id"] for r in rows}) == 80
    assert all(r["recommendation"] == ("red" if r[models.SCORE] >= 0.8 else "yellow" if r[models.SCORE] >= 0.5 else "green") for r in rows)
    assert all(len(r["human_readable_reasons"]) == len(r["top_positive_factors"]) for r in rows)
    log = spark.read.parquet(f"{folder}/log").collect()
    assert len(log) == 80 and len({r["request_id"] for r in log}) == 1 and {r["payload"] for r in log} == {'{"batch_size":80}'}


def test_no_requests_no_results(spark, applications, linear):
    assert jobs.score_batch(requests(spark, applications).limit(0), linear.bundle).count() == 0


def test_stream_scores_equal_batch_scores(spark, prepared, linear, folder):
    bundle = linear.bundle
    landed = prepared.frame.select("event_id", *REQUEST_SCHEMA.fieldNames())
    landed.repartition(3).write.json(f"{folder}/in")
    means = bundle.means(prepared.frame, ["event_id"])
    stream = scorer.score_records(scorer.read_requests(spark, f"{folder}/in", files_per_batch=1), bundle, means)
    scorer.start_scoring(stream, f"{folder}/out", f"{folder}/state", available_now=True).awaitTermination()
    got = {r["event_id"]: r[models.SCORE] for r in spark.read.parquet(f"{folder}/out").collect()}
    want = {r["event_id"]: r[models.SCORE] for r in bundle.score(prepared.frame).collect()}
    assert got == pytest.approx(want)


def test_repeated_micro_batch_leaves_no_row_twice(spark, prepared, linear, folder):
    """A stream that stops before a batch is committed writes it again, in place of the first attempt."""
    prepared.frame.select("event_id", *REQUEST_SCHEMA.fieldNames()).repartition(3).write.json(f"{folder}/in")
    means = linear.bundle.means(prepared.frame, ["event_id"])

    def run():
        stream = scorer.score_records(scorer.read_requests(spark, f"{folder}/in", files_per_batch=1), linear.bundle, means)
        scorer.start_ledger(stream, f"{folder}/out", f"{folder}/log", f"{folder}/state", "linear", available_now=True).awaitTermination()
        return sorted(r["event_id"] for r in spark.read.parquet(f"{folder}/out").collect()), spark.read.parquet(f"{folder}/log").collect()

    ids, log = run()
    assert ids == list(range(120)) and len(log) == 120
    os.remove(f"{folder}/state/commits/2")
    for crc in glob.glob(f"{folder}/state/commits/.2*"):
        os.remove(crc)
    again, log_again = run()
    assert again == ids and len(log_again) == 120
    sizes = collections.Counter(r["request_id"] for r in log_again)
    assert len(sizes) == 3 and {r["request_id"] for r in log} == set(sizes)
    assert all(json.loads(r["payload"]) == {"batch_size": sizes[r["request_id"]]} for r in log_again)


def test_benchmark_suite(spark, applications, prepared, folder):
    variant = jobs.build_application_features(applications(90, shift=0.1))
    suite = {("base", "engineered"): prepared, ("variant_1", "engineered"): variant}
    wanted = [
        jobs.BenchmarkJob("Base", "base", "base", models.LINEAR, "engineered"),
        jobs.BenchmarkJob("Variant I", "base", "variant_1", models.LINEAR, "engineered"),
    ]
    tables = jobs.run_benchmark_suite(suite, wanted, settings=SMALL, repeats=2)
    rows = {r["job_id"]: r for r in tables["results_with_inference"].collect()}
    assert rows["base_linear_engineered"]["test_rows"] == 120 - 84 - 18
    assert rows["variant_1_linear_engineered"]["test_rows"] == 90
    # The small held-out part may hold one class only; the external table holds both.
    assert rows["variant_1_linear_engineered"]["roc_auc"] >= 0.5
    assert all(r["inference_repeats"] == 2 for r in rows.values())
    assert tables["best_by_f1"].count() == 2 and tables["threshold_modes"].count() <= 10
    assert len(tables["chapter"].columns) == 25 and len(tables["lift"].columns) == 11 and len(tables["performance"].columns) == 8
    saved = jobs.save_tables({"chapter": tables["chapter"]}, folder)
    assert spark.read.option("header", True).csv(saved["chapter"]).count() == 2


def test_ten_benchmark_jobs():
    assert len(jobs.BENCHMARK_JOBS) == 10
    assert sum(j.evaluation_mode == "external_dataset" for j in jobs.BENCHMARK_JOBS) == 4


def test_explanation_export(spark, prepared, linear, folder):
    out = jobs.export_explanations(prepared, linear.bundle, f"{folder}/x", rows=3, top_k=2)
    rows = out.collect()
    assert [r["row_index"] for r in sorted(rows)] == [0, 1, 2]
    assert all(0 <= r[models.SCORE] <= 1 and r["raw_top_features"] for r in rows)
    assert spark.read.json(f"{folder}/x").count() == 3
