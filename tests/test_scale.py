import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskloom.operators import models, quantiles
from riskloom.operators.prep import encoding_stages
from riskloom.session import COMPILED_BYTES, keep_methods_compiled


@pytest.fixture
def rows(spark):
    data = [(i, i % 2, float(i % 7), None if i % 5 == 0 else i % 11, "abc"[i % 3] if i % 4 else None) for i in range(200)]
    return spark.createDataFrame(data, "event_id bigint, fraud_bool int, x double, n int, c string")


def test_methods_stay_short_enough_to_be_compiled(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        for given, kept in ((65535, COMPILED_BYTES), (500, 500)):
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", given)
            keep_methods_compiled(spark)
            assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == kept
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_candidates_share_what_is_fitted_to_fill(rows, monkeypatch):
    asked = []
    monkeypatch.setattr(models, "medians", lambda df, columns: asked.append(columns) or quantiles.exact_medians(df, columns))
    settings = models.ModelSettings(trees=1, depth=2, linear_iterations=3)
    _, results = models.train_and_select(rows, ["c"], ["x", "n"], (models.TREES_BALANCED, models.TREES_POSITIVE, models.LINEAR), settings=settings)
    assert len(asked) == 1 and [r.kind for r in results] == [models.TREES_BALANCED, models.TREES_POSITIVE, models.LINEAR]
    assert all(r.sizes == {"train": 140, "valid": 30, "test": 30} for r in results)


def test_training_rows_are_what_the_encoder_gives(rows):
    made = models.training_rows(rows, ["c"], ["x", "n"])
    mine = made.encoded(F.lit(1.0))
    theirs = PipelineModel(Pipeline(stages=encoding_stages(["in_x", "in_n"], ["in_c"])).fit(made.filled).stages).transform(made.filled)
    assert mine.schema["features"].metadata == theirs.schema["features"].metadata
    assert [r[0].toArray().tolist() for r in mine.select("features").collect()] == [r[0].toArray().tolist() for r in theirs.select("features").collect()]


@pytest.mark.parametrize("picked", [50_000, 3])
def test_quantiles_of_columns_that_buckets_part_badly(spark, monkeypatch, picked):
    monkeypatch.setattr(quantiles, "PICKED_VALUES", picked)
    data = [(math.exp(i % 97 - 40), math.inf if i % 2 else -math.inf, float(i % 3), 1e308 * (-1) ** i, None if i % 3 else i * 1e-9) for i in range(999)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double").repartition(4)
    probs = [0.0, 0.25, 0.5, 0.93, 1.0]
    got, want = (quantiles.exact_quantiles(df, df.columns, probs, small_values=n) for n in (5, 10_000))
    assert {c: pytest.approx(v, rel=1e-12) for c, v in want.items()} == got


def test_buckets_take_no_sketch(spark, monkeypatch):
    monkeypatch.setattr(F, "percentile_approx", lambda *a: pytest.fail("a sketch is merged by one task"))
    df = spark.range(1001).select((F.col("id") * 1.0).alias("x"))
    assert quantiles.exact_quantiles(df, ["x"], [0.5], small_values=10) == {"x": [500.0]}


def test_only_background_rows_are_encoded(rows, monkeypatch):
    bundle = models.fit(rows, ["c"], ["x", "n"], models.LINEAR, models.ModelSettings(linear_iterations=3))
    seen, means = [], models.background_means
    monkeypatch.setattr(models, "background_means", lambda encoded, width: seen.append(encoded) or means(encoded, width))
    many = rows.union(rows.withColumn("event_id", F.col("event_id") + 200).withColumn("x", F.lit(1e6)))
    assert bundle.means(many, ["event_id"]) == pytest.approx(bundle.means(rows, ["event_id"]))
    assert "Limit" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
