import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordered
from riskloom.operators.quantiles import exact_quantiles


def sample(spark, n=997, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of the rows share one key value; some keys are missing.
        key = 5 if i % 3 == 0 else rng.choice([None, *range(40)])
        rows.append((i, key, rng.choice([None, round(rng.random(), 2)])))
    return spark.createDataFrame(rows, "id bigint, k int, x double"), rows


def last(v):
    return (v is None, v if v is not None else 0)


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_row_index_equals_a_full_sort(spark, ranges):
    df, rows = sample(spark)
    got = ordered.with_row_index(df, ["k", "x", "id"], "pos", ranges=ranges)
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (last(r[1]), last(r[2]), r[0])))}
    assert got.rows == len(rows)
    assert {r["id"]: r["pos"] for r in got.frame.collect()} == want


def test_descending_and_time_keys(spark):
    df = spark.range(200).select("id", (F.col("id") % 7 / 7.0).alias("s"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 5).cast("int"))).alias("t"))
    got = ordered.with_row_index(df, ["-s", "-t", "id"], "pos", ranges=9).frame.orderBy("pos").collect()
    assert [r["id"] for r in got] == [r["id"] for r in sorted(got, key=lambda r: (-r["s"], -(r["t"].day), r["id"]))]


def test_hot_key_is_cut(spark):
    """Rows that share one key, and even equal rows, are dealt over several ranges."""
    df, _ = sample(spark, 3000)
    for frame in (df.select("k", "id"), df.select(F.lit(1).alias("k"))):
        placed = ordered.in_ranges(frame, ["k"], "hot", ranges=20, spread_ties=True)
        sizes = [r["count"] for r in placed.where("k = 5 OR k = 1").groupBy("_range").count().collect()]
        assert len(sizes) > 2 and max(sizes) < 3000 / 3 / 2


def test_positions_repeat(spark):
    """Without a tie key two runs, differently dealt, give every row the same position."""
    df, _ = sample(spark)
    one = ordered.with_row_index(df, ["k"], "pos").frame.collect()
    other = ordered.with_row_index(df.repartition(7, "x"), ["k"], "pos", ranges=11).frame.collect()
    assert sorted(r["pos"] for r in one) == list(range(997))
    assert {r["id"]: r["pos"] for r in one} == {r["id"]: r["pos"] for r in other}


def test_one_exchange_of_the_rows(spark, folder):
    """Reading positions takes a scan of what was written: no exchange, no window."""
    df, _ = sample(spark)
    df.write.parquet(f"{folder}/t")
    plan = ordered.with_row_index(spark.read.parquet(f"{folder}/t"), ["k"], "pos").frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_empty_and_single_row(spark):
    df = spark.range(0).withColumn("k", F.lit(1))
    assert ordered.with_row_index(df, ["k", "id"]).frame.count() == 0
    one = ordered.with_row_index(spark.range(1), ["id"], "p")
    assert one.rows == 1 and one.frame.first()["p"] == 0


def test_running_sums_by_group(spark):
    df, rows = sample(spark)
    clean = df.where("x IS NOT NULL")
    tied = clean.groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"))
    got = ordered.running_sums(tied, ["x"], {"upto": "n"}, by=["k"], ranges=13).collect()
    for r in got:
        assert r["upto"] == sum(1 for i, k, x in rows if k == r["k"] and x is not None and x <= r["x"])


def test_descending_texts_and_numbers_that_are_none(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, None, float("nan")), (3, "a", None), (4, "b", 1.0)], "id long, t string, x double")
    by = lambda *order: [r["id"] for r in ordered.with_row_index(df, order, "pos").frame.orderBy("pos").collect()]
    assert by("-t", "id") == [1, 4, 3, 2]
    assert by("x") == [4, 1, 2, 3]
    assert by("-x") == [1, 4, 2, 3]


def test_split_parts_follow_position(spark):
    df = spark.range(103)
    parts = {r["split"]: r["count"] for r in ordered.ordered_split(df, ["id"]).groupBy("split").count().collect()}
    assert parts == {"train": int(103 * 0.7), "valid": int(103 * 0.15), "test": 103 - int(103 * 0.7) - int(103 * 0.15)}
    assert ordered.ordered_split(df, ["id"]).where("split = 'train'").agg(F.max("id")).first()[0] == 71


@pytest.mark.parametrize("limit,want", [(0, 50), (None, 50), (7, 7), (80, 50)])
def test_first_rows(spark, limit, want):
    got = [r["id"] for r in ordered.first_rows(spark.range(50), ["-id"], limit).orderBy(F.desc("id")).collect()]
    assert got == list(range(49, -1, -1))[:want]


def test_first_rows_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr(ordered, "TOP_ROWS", 5)
    assert [r["id"] for r in ordered.first_rows(spark.range(50).repartition(3), ["-id"], 20).collect()] == list(range(49, 29, -1))


@pytest.mark.parametrize("small", [10, 100_000])
def test_quantiles_are_exact(spark, small):
    rng = np.random.default_rng(3)
    spread = rng.normal(size=800)
    # Half the values equal: an interval that cannot shrink.
    heavy = np.where(np.arange(800) % 2 == 0, 1.0, rng.integers(0, 4, 800).astype(float))
    rows = [(float(a), float(b), None if i % 5 else float(i), float("nan") if i % 9 == 0 else float(a)) for i, (a, b) in enumerate(zip(spread, heavy))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    probs = [0.0, 0.05, 0.5, 0.95, 0.99, 1.0]
    got = exact_quantiles(df, ["a", "b", "c", "d"], probs, small_values=small)
    columns = {n: [r[i] for r in rows if r[i] is not None and r[i] == r[i]] for i, n in enumerate("abcd")}
    for name, values in columns.items():
        assert got[name] == pytest.approx(list(np.quantile(values, probs)), abs=1e-12), name


def test_quantiles_of_equal_and_missing_values(spark):
    df = spark.range(100).select(F.lit(2.5).alias("a"), F.lit(None).cast("double").alias("b"))
    assert exact_quantiles(df, ["a", "b"], [0.5], small_values=10) == {"a": [2.5], "b": [None]}
