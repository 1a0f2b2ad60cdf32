"""Metrics of scored tables: confusion counts, exact ranking metrics, top-k and threshold sweeps.

Input: a 0/1 label, a score in [0, 1] and, for top-k, a row id that breaks ties.
Every function takes `by`, group columns whose groups may be of any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import ratio_or_zero
from riskloom.operators.ordered import TOP_ROWS, running_sums

# Names and limits of the operating points.
DEFAULT_THRESHOLD = 0.5
MODE_DEFAULT = "default_0.5"
MODE_BEST_F1 = "best_f1_valid"
MODE_ALERT_20 = "best_recall_alert_20_valid"
MODE_ALERT_30 = "best_recall_alert_30_valid"
MODE_FPR_05 = "best_recall_fpr_05_valid"
TOP_K = (100, 500)
SMALL_SWEEP = (0.1, 0.2, 0.3, 0.4, 0.5)
STEPS = 99
GROUP_LIMIT = 1000  # Spark cuts ranked groups before the shuffle up to this rank

COUNTS = ["tp", "fp", "fn", "tn"]


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by)


def confusion_counts(
    df: DataFrame, threshold: float = DEFAULT_THRESHOLD, *, y: str = "y", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    flagged, positive = F.col(score) >= threshold, F.col(y) == 1
    return _grouped(df, by).agg(
        F.count_if(flagged & positive).alias("tp"),
        F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & positive).alias("fn"),
        F.count_if(~flagged & ~positive).alias("tn"),
    )


def rate_expressions() -> dict[str, Column]:
    """Rates from the four counts; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    rows = tp + fp + fn + tn
    return {
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1_score": ratio_or_zero(tp * 2, tp * 2 + fp + fn),
        "false_positive_rate": ratio_or_zero(fp, fp + tn),
        "alert_rate": ratio_or_zero(tp + fp, rows),
        "positive_share": ratio_or_zero(tp + fn, rows),
    }


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(rate_expressions())


def ranking_quality(
    df: DataFrame, *, y: str = "y", score: str = "score", by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Exact ROC-AUC (ties count half; null with one class only) and step-wise average precision.

    Rows are first counted per distinct score; running counts over scores follow without a
    single-task window.
    """
    base = df.select(*by, F.col(score).alias("score"), F.col(y).cast("bigint").alias("pos"), F.lit(1).cast("bigint").alias("n"))
    tied = base.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    cumulative = running_sums(tied, ["-score"], {"tp": "pos", "k": "n"}, by=by, ranges=ranges)
    pos, tp, n = (F.col(c).cast("double") for c in ("pos", "tp", "n"))
    positives, negatives = F.sum(pos), F.sum(n - pos)
    return _grouped(cumulative, by).agg(
        F.try_divide(F.sum((n - pos) * (tp - pos / 2)), positives * negatives).alias("roc_auc"),
        F.coalesce(F.try_divide(F.sum(pos * tp / F.col("k")), positives), F.lit(0.0)).alias("pr_auc"),
    )


def top_rows(
    df: DataFrame, k: int, *, score: str = "score", row_id: str = "row_id", by: Sequence[str] = (), rank: str = "rank"
) -> DataFrame:
    """The k best rows by score (ties by row id) with their rank; each task keeps only its own best k.

    A score that is no number counts as missing, and missing ones come last. Beyond the sizes Spark
    limits per task, ranks come from running counts over ranges instead.
    """
    if isinstance(df.schema[score].dataType, (T.DoubleType, T.FloatType)):
        df = df.withColumn(score, F.when(~F.isnan(score), F.col(score)))
    if k > (GROUP_LIMIT if by else TOP_ROWS):
        counted = running_sums(df.withColumn("_one", F.lit(1)), [f"-{score}", row_id], {rank: "_one"}, by=by)
        return counted.drop("_one").filter(F.col(rank) <= k)
    order = [F.col(score).desc(), F.col(row_id).asc()]
    if by:
        ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked.filter(F.col(rank) <= k)
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def _top_hits(df: DataFrame, ks: Sequence[int], y: str, score: str, row_id: str, by: Sequence[str]) -> DataFrame:
    narrow = df.select(*by, F.col(y).cast("bigint").alias("_y"), F.col(score).alias("_s"), F.col(row_id).alias("_r"))
    best = top_rows(narrow, max(ks), score="_s", row_id="_r", by=by, rank="_rank")
    return _grouped(best, by).agg(
        *[F.coalesce(F.sum(F.when(F.col("_rank") <= k, F.col("_y"))), F.lit(0)).alias(f"_hits_{k}") for k in ks]
    )


def _totals(df: DataFrame, y: str, by: Sequence[str]) -> DataFrame:
    return _grouped(df, by).agg(F.count(F.lit(1)).alias("_rows"), F.coalesce(F.sum(F.col(y).cast("bigint")), F.lit(0)).alias("_positives"))


def _side_by_side(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Put one-row-per-group results next to each other, without a join."""
    names = [c for p in parts for c in p.columns if c not in by]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _grouped(stacked, by).agg(*[F.max(c).alias(c) for c in names])


def _top_k_expressions(ks: Sequence[int]) -> dict[str, Column]:
    share = ratio_or_zero("_positives", "_rows")
    out: dict[str, Column] = {}
    for k in ks:
        precision = ratio_or_zero(F.col(f"_hits_{k}"), F.least(F.lit(k), F.col("_rows")))
        out[f"precision_at_{k}"] = precision
        out[f"recall_at_{k}"] = ratio_or_zero(f"_hits_{k}", "_positives")
        out[f"lift_at_{k}"] = ratio_or_zero(precision, share)
    return out


def top_k_metrics(
    df: DataFrame,
    ks: Sequence[int] = TOP_K,
    *,
    y: str = "y",
    score: str = "score",
    row_id: str = "row_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """Precision, recall and lift among the k best rows; k never exceeds the table."""
    both = _side_by_side([_totals(df, y, by), _top_hits(df, ks, y, score, row_id, by)], by)
    return both.select(*by, *[c.alias(n) for n, c in _top_k_expressions(ks).items()])


def evaluate_scores(
    df: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    ks: Sequence[int] = TOP_K,
    *,
    y: str = "y",
    score: str = "score",
    row_id: str = "row_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per group: quality, business and top-k metrics and the four counts."""
    parts = [
        confusion_counts(df, threshold, y=y, score=score, by=by),
        ranking_quality(df, y=y, score=score, by=by),
        _totals(df, y, by),
        _top_hits(df, ks, y, score, row_id, by),
    ]
    wide = _side_by_side(parts, by).withColumns({**rate_expressions(), **_top_k_expressions(ks)})
    names = ["roc_auc", "pr_auc", *rate_expressions(), *_top_k_expressions(ks), *COUNTS]
    return wide.select(*by, F.lit(float(threshold)).alias("threshold"), *names)


def _step_of(score: Column) -> Column:
    """How many of the thresholds 0.01 .. 0.99 a score reaches; exact at the thresholds themselves."""
    near = F.floor(score * 100)
    exact = F.when(score >= (near + 1) / 100, near + 1).when(score < near / 100, near - 1).otherwise(near)
    return F.greatest(F.least(exact, F.lit(STEPS)), F.lit(0)).cast("int")


def _reached_counts(histogram: DataFrame, steps: int, by: Sequence[str]) -> DataFrame:
    """Confusion counts at every step from a histogram of reached steps."""
    each = histogram.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    flagged = F.col("reached") >= F.col("step")
    neg = F.col("n") - F.col("pos")
    return each.groupBy(*by, "step").agg(
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(flagged, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(flagged, 0).otherwise(neg)).alias("tn"),
    )


def _histogram(df: DataFrame, reached: Column, y: str, by: Sequence[str]) -> DataFrame:
    return (
        df.select(*by, reached.alias("reached"), F.col(y).cast("bigint").alias("_y"))
        .groupBy(*by, "reached")
        .agg(F.sum("_y").alias("pos"), F.count(F.lit(1)).alias("n"))
    )


def threshold_sweep(df: DataFrame, *, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates at the 99 thresholds 0.01 .. 0.99 from one pass over the table."""
    counts = _reached_counts(_histogram(df, _step_of(F.col(score)), y, by), STEPS, by)
    return with_rates(counts.withColumn("threshold", F.col("step") / F.lit(100.0)))


def confusion_at(
    df: DataFrame, thresholds: Sequence[float] = SMALL_SWEEP, *, y: str = "y", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """Counts and rates at a short list of thresholds, again from one pass."""
    levels = sorted(thresholds)
    reached = reduce(lambda a, b: a + b, [(F.col(score) >= t).cast("int") for t in levels])
    counts = _reached_counts(_histogram(df, reached, y, by), len(levels), by)
    names = F.array(*[F.lit(float(t)) for t in levels])
    return with_rates(counts.withColumn("threshold", F.element_at(names, F.col("step"))))


def operating_points(sweep: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Thresholds per mode chosen on a sweep; a mode without candidate is left out, ties take the lowest threshold."""

    def best(first: str, second: str, third: str, allowed: Column | None = None) -> Column:
        rank = F.struct(F.col(first), F.col(second), F.col(third), -F.col("step"))
        return F.max_by(F.col("step"), rank if allowed is None else F.when(allowed, rank))

    modes = {
        MODE_DEFAULT: F.max(F.lit(round(DEFAULT_THRESHOLD * 100))),
        MODE_BEST_F1: best("f1_score", "recall", "precision"),
        MODE_ALERT_20: best("recall", "precision", "f1_score", F.col("alert_rate") <= 0.20),
        MODE_ALERT_30: best("recall", "precision", "f1_score", F.col("alert_rate") <= 0.30),
        MODE_FPR_05: best("recall", "precision", "f1_score", F.col("false_positive_rate") <= 0.05),
    }
    chosen = _grouped(sweep, by).agg(*[c.alias(f"m{i}") for i, c in enumerate(modes.values())])
    entries = F.array(*[F.struct(F.lit(m).alias("threshold_mode"), F.col(f"m{i}").alias("step")) for i, m in enumerate(modes)])
    return (
        chosen.select(*by, F.explode(entries).alias("e"))
        .select(*by, "e.threshold_mode", "e.step")
        .where(F.col("step").isNotNull())
        .withColumn("threshold", F.col("step") / F.lit(100.0))
        .withColumn(
            "threshold_selected_on",
            F.when(F.col("threshold_mode") == MODE_DEFAULT, "fixed").otherwise("validation"),
        )
    )


def apply_operating_points(
    valid: DataFrame,
    test: DataFrame,
    ks: Sequence[int] = TOP_K,
    *,
    y: str = "y",
    score: str = "score",
    row_id: str = "row_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per mode: thresholds chosen on `valid`, all metrics measured on `test`.

    Modes lie on the sweep grid, so their counts come from the sweep of `test`.
    """
    modes = operating_points(threshold_sweep(valid, y=y, score=score, by=by), by=by)
    measured = threshold_sweep(test, y=y, score=score, by=by).drop("threshold")
    common = _side_by_side(
        [ranking_quality(test, y=y, score=score, by=by), _totals(test, y, by), _top_hits(test, ks, y, score, row_id, by)], by
    )
    common = common.select(*by, "roc_auc", "pr_auc", *[c.alias(n) for n, c in _top_k_expressions(ks).items()])
    if not by:
        modes, common = (d.withColumn("_one", F.lit(1)) for d in (modes, common))
    keys = list(by) or ["_one"]
    joined = _join_with_nulls(_join_with_nulls(modes, measured, [*by, "step"]), common, keys)
    return joined.drop("step", "_one")


def _join_with_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys where null equals null, so that the group without a name stays."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(other, same).drop(*[f"_right_{k}" for k in keys])


def small_sweep(
    df: DataFrame, by: Sequence[str], thresholds: Sequence[float] = SMALL_SWEEP, *, y: str = "y", score: str = "score"
) -> DataFrame:
    """The short sweep with a rank per group: F1, then recall, then the lower threshold."""
    w = Window.partitionBy(*by).orderBy(F.col("f1_score").desc(), F.col("recall").desc(), F.col("threshold"))
    return confusion_at(df, thresholds, y=y, score=score, by=by).drop("step").withColumn("rank", F.row_number().over(w))


def result_row(metrics: DataFrame, identity: dict[str, object]) -> DataFrame:
    """Identity and sizes in front of a metric row."""
    return metrics.select(*[F.lit(v).alias(n) for n, v in identity.items() if n not in metrics.columns], *metrics.columns)
