"""Compiled scores against Spark ML's own, and attributions against sums over all subsets of features."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import attribution, compiled, models
from riskloom.operators.compiled import Node
from riskloom.operators.models import ModelBundle, ModelSettings
from riskloom.plans import jobs

SETTINGS = ModelSettings(trees=6, depth=4, linear_iterations=20)


@pytest.fixture(scope="module")
def prepared(applications):
    return jobs.build_application_features(applications(160))


@pytest.fixture(scope="module", params=[models.TREES_BALANCED, models.LINEAR])
def bundle(request, prepared):
    return models.fit(prepared.frame, prepared.categorical, prepared.numerical, request.param, SETTINGS)


def odd_rows(prepared, spark):
    """Known rows, and rows with gaps, unseen categories and numbers that are none."""
    frame = prepared.frame
    gaps = frame.withColumn("payment_type", F.when(F.col("event_id") % 3 == 0, "never seen")).withColumn("income", F.lit(None).cast("double"))
    odd = frame.withColumn("velocity_6h", F.lit(float("nan"))).withColumn("credit_risk_score", F.lit(1e12))
    return frame.unionByName(gaps).unionByName(odd)


def test_scores_equal_the_pipelines(spark, prepared, bundle):
    rows = odd_rows(prepared, spark)
    both = bundle.encode(rows)
    names = rows.columns
    own = sorted(bundle.score(rows).select("event_id", "payment_type", "income", "velocity_6h", models.SCORE, models.LABEL).collect(), key=str)
    want = both.select("event_id", "payment_type", "income", "velocity_6h", vector_to_array("probability")[1].alias("p")).collect()
    key = lambda r: (r["event_id"], str(r["payment_type"]), str(r["income"]), str(r["velocity_6h"]))
    want = {key(r): r["p"] for r in want}
    assert len(own) == 3 * 160 and bundle.score(rows).columns == [*names, models.SCORE, models.LABEL]
    for r in own:
        assert r[models.SCORE] == pytest.approx(want[key(r)], abs=1e-9)
        assert r[models.LABEL] == int(want[key(r)] >= 0.5)


def test_scoring_is_one_scan(prepared, bundle):
    plan = bundle.score(prepared.frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert bundle.kind != models.LINEAR or "UDF" not in plan


def test_a_loaded_model_scores_the_same(spark, prepared, bundle, folder):
    bundle.score(prepared.frame).count()
    loaded = ModelBundle.load(spark, bundle.save(f"{folder}/m"))
    row = lambda b: b.score(prepared.frame).agg(F.sum(models.SCORE)).first()[0]
    assert row(loaded) == pytest.approx(row(bundle), abs=1e-9)


def test_parts_add_up_to_the_log_odds(prepared, bundle):
    means = bundle.means(prepared.frame, ["event_id"])
    base = bundle.attribution.base if bundle.kind != models.LINEAR else bundle.linear.intercept + sum(c * m for c, m in zip(bundle.linear.coefficients, means))
    rows = bundle.explain(prepared.frame, ["event_id"]).collect()
    assert len(rows) == 160
    for r in rows:
        odds = math.log(r[models.SCORE] / (1 - r[models.SCORE]))
        assert base + sum(f["shap_value"] for f in r["factors"]) == pytest.approx(odds, abs=1e-9)
        assert not any(f["feature"].startswith("payment_type_") for f in r["factors"])


def random_tree(rng, depth, features):
    cover = float(rng.randint(1, 40))
    if depth == 0 or rng.random() < 0.15:
        return Node(rng.uniform(-1, 1), cover)
    left, right = (random_tree(rng, depth - 1, features) for _ in range(2))
    return Node(0.0, left.cover + right.cover, rng.randrange(features), rng.uniform(-1, 1), left, right)


def known(node, x, names):
    """Expected output when only the features in `names` are known."""
    if node.left is None:
        return node.value
    if node.feature in names:
        return known(node.left if x[node.feature] <= node.upto else node.right, x, names)
    whole = node.left.cover + node.right.cover
    return (node.left.cover * known(node.left, x, names) + node.right.cover * known(node.right, x, names)) / whole


@pytest.mark.parametrize("seed", range(8))
def test_contributions_equal_sums_over_subsets(seed):
    rng = random.Random(seed)
    width = 5
    trees = [(rng.uniform(0.1, 1), random_tree(rng, 4, width)) for _ in range(3)]
    found = attribution.Attribution(trees, width, 2.0)
    x = np.array([[rng.uniform(-1.2, 1.2) for _ in range(width)] for _ in range(6)])
    x[0, 0] = trees[0][1].upto if trees[0][1].left is not None else x[0, 0]  # a value on a border goes left
    output = lambda row, names: sum(2 * w * known(t, row, names) for w, t in trees)
    got = found.of(x)
    for row, parts in zip(x, got, strict=True):
        for j in range(width):
            others = [i for i in range(width) if i != j]
            want = 0.0
            for size in range(width):
                share = math.factorial(size) * math.factorial(width - size - 1) / math.factorial(width)
                for names in itertools.combinations(others, size):
                    want += share * (output(row, {*names, j}) - output(row, set(names)))
            assert parts[j] == pytest.approx(want, abs=1e-12)
        assert found.base + parts.sum() == pytest.approx(output(row, set(range(width))), abs=1e-12)


def test_a_tree_that_is_one_leaf():
    found = attribution.Attribution([(0.5, Node(3.0, 10.0))], 2)
    assert found.base == 1.5 and not found.of(np.zeros((4, 2))).any()


def test_values_that_are_no_numbers_go_right():
    tree = Node(0.0, 2.0, 0, 1.0, Node(-1.0, 1.0), Node(1.0, 1.0))
    parts = attribution.Attribution([(1.0, tree)], 1).of(np.array([[math.nan], [math.inf], [-math.inf], [1.0]]))
    assert parts[:, 0].tolist() == [1.0, 1.0, -1.0, -1.0]


def test_batches_and_reports_explain_trees(spark, applications, prepared, bundle, folder):
    from riskloom.operators.presets import REQUEST_SCHEMA

    requests = applications(30).withColumn("row_id", F.monotonically_increasing_id()).select("row_id", *REQUEST_SCHEMA.fieldNames())
    rows = jobs.score_batch(requests, bundle).collect()
    assert len(rows) == 30 and all(len(r["human_readable_reasons"]) == len(r["top_positive_factors"]) for r in rows)
    assert any(r["top_positive_factors"] for r in rows)
    report = jobs.export_explanations(prepared, bundle, f"{folder}/x", rows=4).collect()
    assert len(report) == 4 and all(r["raw_top_features"] for r in report)
