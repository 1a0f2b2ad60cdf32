import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import clean, correlate, drift, prep, review
from riskloom.plans import jobs

# Published distributions and the scores that belong to them.
AGE_CURRENT = [0.00160175, 0.0187175, 0.02348575, 0.017964125, 0.0, 0.047825125, 0.01256275, 0.00232825, 0.000481375, 3.3375e-05]
AGE_REFERENCE = [0.002623375, 0.030731875, 0.038929125, 0.029839, 0.0, 0.017544125, 0.00434625, 0.000814625, 0.000162125, 9.5e-06]
AGE_WIDTH = 8
PAYMENT_CURRENT = [251688, 395277, 242178, 110604, 253]
PAYMENT_REFERENCE = [258249, 370554, 252071, 118837, 289]


@pytest.mark.parametrize(
    "reference,current,score",
    [
        (PAYMENT_REFERENCE, PAYMENT_CURRENT, 0.0027576244353384456),
        ([round(x * AGE_WIDTH * 1e6) for x in AGE_REFERENCE if x], [round(x * AGE_WIDTH * 1e6) for x in AGE_CURRENT if x], 0.49076979280926625),
    ],
)
def test_published_scores(spark, reference, current, score):
    counts = spark.createDataFrame([("c", str(i), r, c) for i, (r, c) in enumerate(zip(reference, current))], "column string, label string, reference_rows bigint, current_rows bigint")
    assert drift.psi_from_counts(counts).first()["drift_score"] == pytest.approx(score, abs=1e-9)


def brute(a, b, numeric=True):
    a, b = [x for x in a if x is not None], [x for x in b if x is not None]
    pooled = a + b
    if numeric and len(set(pooled)) > 20:
        bins, low, high = math.ceil(math.log2(len(pooled))) + 1, min(pooled), max(pooled)
        place = lambda x: min(int(bins * (x - low) / (high - low)), bins - 1)
        a, b = [place(x) for x in a], [place(x) for x in b]
    total = 0.0
    for v in set(a) | set(b):
        r, c = a.count(v) / len(a) or 1e-4, b.count(v) / len(b) or 1e-4
        total += (r - c) * math.log(r / c)
    return total


def sides(spark, seed=2):
    rng = random.Random(seed)
    schema = "few int, edge int, over int, many double, word string, flag boolean, gap double, fraud_bool int"

    def rows(n, shift):
        return [
            (
                rng.randrange(5),
                rng.randrange(20),
                rng.randrange(21 + int(shift)),
                rng.gauss(shift, 1),
                rng.choice("abc" if shift else "abcd"),
                rng.random() < 0.5 + shift / 10,
                None if rng.random() < 0.4 else rng.gauss(0, 1),
                0,
            )
            for _ in range(n)
        ]

    a, b = rows(700, 0), rows(500, 2)
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), a, b


def test_scores_match_brute_force(spark):
    left, right, a, b = sides(spark)
    columns = drift.drift_columns(left, right)
    assert columns == ["edge", "few", "flag", "gap", "many", "over", "word"]
    got = {r["column_name"]: r for r in drift.drift_table(left, right).collect()}
    for name in columns:
        i = left.columns.index(name)
        want = brute([r[i] for r in a], [r[i] for r in b], numeric=name != "word")
        assert got[name]["drift_score"] == pytest.approx(want, abs=1e-9), name
    assert {n for n, r in got.items() if r["bins"] > 0} == {"gap", "many", "over"}


def test_table_against_itself_does_not_drift(spark):
    left, _, _, _ = sides(spark)
    assert all(r["drift_score"] == 0 for r in drift.drift_table(left, left).collect())


def test_shifted_applications_drift(applications):
    table, summary = jobs.run_drift_check(applications(100), applications(100, shift=5.0))
    row = summary.first()
    assert row["number_of_drifted_columns"] >= 1 and "income" in row["drifted_columns"]
    assert row["drifted_columns"] == sorted(row["drifted_columns"])
    assert row["retrain"] == (row["share_of_drifted_columns"] >= 0.3)


def test_no_common_column(spark):
    with pytest.raises(ValueError):
        drift.drift_columns(spark.range(1), spark.range(1).withColumnRenamed("id", "other"))


def test_distribution_and_roll_up(spark, folder):
    left, right, a, _ = sides(spark)
    summary = drift.distribution_summary(left, right, ["many", "word"])
    mass = summary.where("column = 'many'").withColumn("m", F.col("density") * (F.col("upper") - F.col("lower")))
    assert [r["s"] for r in mass.groupBy("side").agg(F.sum("m").alias("s")).collect()] == pytest.approx([1.0, 1.0])
    assert drift.nested_distribution(summary).count() == 2
    drift.drift_summary(drift.drift_table(left, right)).write.parquet(f"{folder}/drift_b")
    assert [r["report_file"] for r in drift.report_roll_up(spark, [f"{folder}/drift_z", f"{folder}/drift_b"]).collect()] == ["drift_b"]


def test_bins_without_rows_are_there(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0), (10.0, 5.0)], "x double, one double")
    rows = drift.distribution_summary(df, df, ["x", "one"]).where("side = 'current'").orderBy("column", "label").collect()
    assert [(r["column"], r["rows"]) for r in rows] == [("one", 3), ("x", 1), ("x", 1), *[("x", 0)] * 7, ("x", 1)]
    assert [r["density"] for r in rows if r["column"] == "x" and not r["rows"]] == [0.0] * 7


def test_correlations_use_the_rows_with_both_values(spark):
    values = [[None if (i + j) % 5 == 0 else math.sin(i * (j + 1)) for j in range(18)] for i in range(60)]
    df = spark.createDataFrame([tuple(v) for v in values], ", ".join(f"c{j} double" for j in range(18)))
    got = {(r["x"], r["y"]): r["corr"] for r in correlate.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 18 * 18
    both = [(v[2], v[9]) for v in values if v[2] is not None and v[9] is not None]
    mx, my = (sum(p[k] for p in both) / len(both) for k in (0, 1))
    sxy, sxx, syy = (sum((p[a] - m) * (p[b] - n) for p in both) for a, b, m, n in ((0, 1, mx, my), (0, 0, mx, mx), (1, 1, my, my)))
    assert got["c2", "c9"] == got["c9", "c2"] == pytest.approx(sxy / math.sqrt(sxx * syy))


def test_correlations_small_and_wide(spark):
    df = spark.range(200).select(*[(F.sin(F.col("id") * (i + 1)) + F.col("id") * (i % 3)).alias(f"c{i}") for i in range(20)])
    names = df.columns
    wide = {(r["x"], r["y"]): r["corr"] for r in correlate.correlation_matrix(df, names).collect()}
    small = {(r["x"], r["y"]): r["corr"] for r in correlate.correlation_matrix(df, names[:4]).collect()}
    for pair, value in small.items():
        assert wide[pair] == pytest.approx(value, abs=1e-9)
    assert correlate.select_top_features(df, names[:3], top=5) == names[:3]
    assert len(correlate.select_top_features(df, names, "c0", top=5)) == 5


def test_bands_and_actions(spark):
    df = spark.createDataFrame([(1, 0.8), (2, 0.5), (3, 0.4999)], "row_id int, prediction_score double")
    rows = review.with_band(df).withColumn("a", review.action_label()).orderBy("row_id").collect()
    assert [r["recommendation"] for r in rows] == ["red", "yellow", "green"]
    odd = spark.createDataFrame([("blue",)], "recommendation string").select(review.action_label()).first()[0]
    assert odd == "blue"


def test_stratified_quotas_and_stability(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    first = prep.stratified_split(df, "y", ["id"])
    counts = {(r["y"], r["split"]): r["count"] for r in first.groupBy("y", "split").count().collect()}
    assert counts == {(1, "test"): 50, (1, "train"): 284, (0, "test"): 100, (0, "train"): 566}
    again = prep.stratified_split(df.repartition(7), "y", ["id"])
    assert first.exceptAll(again).isEmpty()


def test_quotas_sum_up():
    assert prep.class_quotas({0: 7, 1: 3}, 0.15) == {0: 1, 1: 1}
    assert sum(prep.class_quotas({0: 333, 1: 333, 2: 334}, 0.15).values()) == 150


def test_encoding_of_unseen_and_missing(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    test = spark.createDataFrame([("a", 1.0), ("z", 2.0), (None, 3.0)], "c string, x double")
    model = prep.encoding(["x"], ["c"]).fit(train)
    assert prep.encoded_names(["x"], ["c"], model.stages) == ["x", "c_a", "c_b"]
    assert [list(r["features"].toArray()) for r in model.transform(test).collect()] == [[1, 1, 0], [2, 0, 0], [3, 0, 0]]


def test_fitted_values(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", None), ("b", 4.0), ("a", 2.0), (None, 9.0)], "c string, x double")
    assert prep.most_frequent(df, ["c"]) == {"c": "a"}
    assert prep.medians(df, ["x"]) == {"x": 3.0}
    weights = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert prep.positive_weight(weights, "y") == 3.0 and prep.positive_weight(weights.where("y = 0"), "y") == 1.0
    assert prep.balanced_weights(weights, "y") == {0: 4 / 6, 1: 2.0}


def test_dummy_matrix(spark):
    rows = [("a", 1.0, True, None, 7), ("b", None, False, None, 7), (None, 3.0, True, None, 7), ("a", float("inf"), True, None, 7)]
    df = spark.createDataFrame(rows, "c string, x double, f boolean, e double, k int")
    matrix = prep.dummy_matrix(df)
    assert matrix.columns == ["x", "f", "c_a", "c_b", "c_nan"]
    assert sorted(tuple(r) for r in matrix.frame.collect()) == sorted([(1.0, 1.0, 1, 0, 0), (2.0, 0.0, 0, 1, 0), (3.0, 1.0, 0, 0, 1), (2.0, 1.0, 1, 0, 0)])
    crowded = spark.range(30).select(F.col("id").cast("string").alias("c"), "id")
    assert prep.dummy_matrix(crowded).columns == ["id"]
    assert clean.numeric_columns(df) == ["x", "e", "k"]
