"""Metric, threshold and result-table queries over the scored view."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import evaluate as ev
from riskloom.operators import results as res
from workload.registry import ctes, number, query, whole
from workload.views import MODEL_SCORES, SCORED, duck, model_scores, scored

PARTS = {"scored": duck(SCORED)}


def share(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0)"


RATES = {
    "precision": share("tp", "tp + fp"),
    "recall": share("tp", "tp + fn"),
    "f1_score": share("2 * tp", "2 * tp + fp + fn"),
    "false_positive_rate": share("fp", "fp + tn"),
    "alert_rate": share("tp + fp", "tp + fp + fn + tn"),
    "positive_share": share("tp + fn", "tp + fp + fn + tn"),
}
COUNTS = ["tp", "fp", "fn", "tn"]


def counts_at(flagged: str) -> str:
    return f"""CAST(count(*) FILTER ({flagged} AND y = 1) AS BIGINT) AS tp, CAST(count(*) FILTER ({flagged} AND y = 0) AS BIGINT) AS fp,
    CAST(count(*) FILTER (NOT ({flagged}) AND y = 1) AS BIGINT) AS fn, CAST(count(*) FILTER (NOT ({flagged}) AND y = 0) AS BIGINT) AS tn"""


def rates(names=tuple(RATES)) -> str:
    return ", ".join(number(RATES[n], n) for n in names)


def grouped(keys: str, text: str) -> str:
    return f"GROUP BY {keys}" if keys else text


def group_list(by: str) -> str:
    return f"{by}, " if by else ""


def partition(by: str) -> str:
    return f"PARTITION BY {by} " if by else ""


def ranking(source: str, by: str = "") -> dict[str, str]:
    """CTEs tied, running and ranked: exact AUC and average precision of a scored relation."""
    g = group_list(by)
    return {
        "tied": f"SELECT {g}score, sum(y) AS pos, count(*) AS n FROM {source} GROUP BY {g}score",
        "running": f"""SELECT *, sum(pos) OVER ({partition(by)}ORDER BY score DESC) AS tp, sum(n) OVER ({partition(by)}ORDER BY score DESC) AS k FROM tied""",
        "ranked": f"""SELECT {g}sum(CAST(n - pos AS DOUBLE) * (tp - CAST(pos AS DOUBLE) / 2)) / nullif(sum(CAST(pos AS DOUBLE)) * sum(CAST(n - pos AS DOUBLE)), 0) AS roc_auc,
            coalesce(sum(CAST(pos AS DOUBLE) * tp / k) / nullif(sum(CAST(pos AS DOUBLE)), 0), 0) AS pr_auc FROM running {grouped(by, '')}""",
    }


def top_hits(source: str, by: str = "") -> dict[str, str]:
    g = group_list(by)
    hits = ", ".join(f"sum(CASE WHEN rn <= {k} THEN y ELSE 0 END) AS hits_{k}" for k in (100, 500))
    return {
        "ordered_rows": f"SELECT {g}y, row_number() OVER ({partition(by)}ORDER BY score DESC, row_id) AS rn FROM {source}",
        "hits": f"SELECT {g}count(*) AS rows, sum(y) AS positives, {hits} FROM ordered_rows {grouped(by, '')}",
    }


TOP_K = {
    name: expr
    for k in (100, 500)
    for name, expr in {
        f"precision_at_{k}": share(f"hits_{k}", f"least({k}, rows)"),
        f"recall_at_{k}": share(f"hits_{k}", "positives"),
        f"lift_at_{k}": share(share(f"hits_{k}", f"least({k}, rows)"), share("positives", "rows")),
    }.items()
}
TOP_K_COLUMNS = ", ".join(number(e, n) for n, e in TOP_K.items())


@query("e01_confusion_counts", ctes(PARTS, f"SELECT {counts_at('score >= 0.5')} FROM scored"))
def e01(spark, folder):
    return ev.confusion_counts(scored(spark, folder))


def at_half() -> dict[str, str]:
    return {**PARTS, "counted": f"SELECT {counts_at('score >= 0.5')} FROM scored"}


@query("e02_precision_recall_f1", ctes(at_half(), f"SELECT {rates(['precision', 'recall', 'f1_score'])} FROM counted"))
def e02(spark, folder):
    return ev.with_rates(ev.confusion_counts(scored(spark, folder))).select("precision", "recall", "f1_score")


@query("e03_false_positive_rate", ctes(at_half(), f"SELECT {rates(['false_positive_rate'])} FROM counted"))
def e03(spark, folder):
    return ev.with_rates(ev.confusion_counts(scored(spark, folder))).select("false_positive_rate")


@query("e04_roc_auc", ctes({**PARTS, **ranking("scored")}, f"SELECT {number('roc_auc', digits=9)} FROM ranked"), digits=9)
def e04(spark, folder):
    return ev.ranking_quality(scored(spark, folder)).select("roc_auc")


@query("e05_average_precision", ctes({**PARTS, **ranking("scored")}, f"SELECT {number('pr_auc', digits=9)} FROM ranked"), digits=9)
def e05(spark, folder):
    return ev.ranking_quality(scored(spark, folder)).select("pr_auc")


@query("e06_rates", ctes(at_half(), f"SELECT {rates(['alert_rate', 'positive_share'])} FROM counted"))
def e06(spark, folder):
    return ev.with_rates(ev.confusion_counts(scored(spark, folder))).select("alert_rate", "positive_share")


def full_row(source: str, by: str = "") -> dict[str, str]:
    return {
        "counted": f"SELECT {group_list(by)}{counts_at('score >= 0.5')} FROM {source} {grouped(by, '')}",
        **ranking(source, by),
        **top_hits(source, by),
    }


ROW_COLUMNS = f"{number('0.5', 'threshold')}, {number('roc_auc')}, {number('pr_auc')}, {rates()}, {TOP_K_COLUMNS}, tp, fp, fn, tn"


@query("e07_top_k", ctes({**PARTS, **full_row("scored")}, f"SELECT {ROW_COLUMNS} FROM counted, ranked, hits"))
def e07(spark, folder):
    return ev.evaluate_scores(scored(spark, folder))


THRESHOLDS = "SELECT CAST(i AS BIGINT) AS step, round(i / CAST(100 AS DOUBLE), 2) AS threshold FROM range(1, 100) r(i)"


def sweep(source: str, name: str, by: str = "") -> dict[str, str]:
    g = group_list(by)
    return {
        f"{name}_counts": f"""SELECT {g}step, threshold, {counts_at('score >= threshold')} FROM {source} CROSS JOIN thresholds GROUP BY {g}step, threshold""",
        name: f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in RATES.items())} FROM {name}_counts",
    }


SWEEP_PARTS = {**PARTS, "thresholds": THRESHOLDS, **sweep("scored", "swept")}


@query("e08_threshold_sweep", ctes(SWEEP_PARTS, f"SELECT {whole('step')}, {number('threshold')}, tp, fp, fn, tn, {rates()} FROM swept"))
def e08(spark, folder):
    return ev.threshold_sweep(scored(spark, folder))


def chosen(source: str, name: str, by: str = "") -> dict[str, str]:
    g = group_list(by)

    def best(mode: str, order: str, where: str) -> str:
        return f"""SELECT {g}'{mode}' AS threshold_mode, step, threshold, 'validation' AS threshold_selected_on FROM (
        SELECT *, row_number() OVER ({partition(by)}ORDER BY {order}, step) AS rn FROM {source} WHERE {where}) WHERE rn = 1"""

    by_f1, by_recall = "f1_score DESC, recall DESC, precision DESC", "recall DESC, precision DESC, f1_score DESC"
    fixed = f"SELECT DISTINCT {g}'default_0.5' AS threshold_mode, CAST(50 AS BIGINT) AS step, CAST(0.5 AS DOUBLE) AS threshold, 'fixed' AS threshold_selected_on FROM {source}"
    return {
        name: " UNION ALL ".join(
            [
                fixed,
                best("best_f1_valid", by_f1, "TRUE"),
                best("best_recall_alert_20_valid", by_recall, "alert_rate <= 0.20"),
                best("best_recall_alert_30_valid", by_recall, "alert_rate <= 0.30"),
                best("best_recall_fpr_05_valid", by_recall, "false_positive_rate <= 0.05"),
            ]
        )
    }


@query(
    "e09_operating_points",
    ctes({**SWEEP_PARTS, **chosen("swept", "modes")}, f"SELECT threshold_mode, {number('threshold')}, threshold_selected_on FROM modes"),
)
def e09(spark, folder):
    return ev.operating_points(ev.threshold_sweep(scored(spark, folder))).drop("step")


def applied(source: str, by: str = "") -> dict[str, str]:
    """CTEs up to `measured`: modes chosen on the validation part, metrics on the test part."""
    return {
        "thresholds": THRESHOLDS,
        "valid_rows": f"SELECT * FROM {source} WHERE part = 'valid'",
        "test_rows": f"SELECT * FROM {source} WHERE part = 'test'",
        **sweep("valid_rows", "valid_swept", by),
        **chosen("valid_swept", "modes", by),
        **sweep("test_rows", "test_swept", by),
        **ranking("test_rows", by),
        **top_hits("test_rows", by),
    }


MODE_COLUMNS = f"threshold_mode, {number('m.threshold', 'threshold')}, threshold_selected_on, tp, fp, fn, tn, {rates()}, {number('roc_auc')}, {number('pr_auc')}, {TOP_K_COLUMNS}"


@query(
    "e10_points_on_test",
    ctes({**PARTS, **applied("scored")}, f"SELECT {MODE_COLUMNS} FROM modes m JOIN test_swept t ON m.step = t.step, ranked, hits"),
)
def e10(spark, folder):
    rows = scored(spark, folder)
    return ev.apply_operating_points(rows.where("part = 'valid'"), rows.where("part = 'test'"))


SMALL = "SELECT unnest([1e-1, 2e-1, 3e-1, 4e-1, 5e-1]) AS threshold"
SMALL_PARTS = {
    "scores": MODEL_SCORES,
    "thresholds": SMALL,
    "counted": f"SELECT model_type, threshold, {counts_at('score >= threshold')} FROM scores CROSS JOIN thresholds GROUP BY 1, 2",
    "swept": f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in RATES.items())} FROM counted",
    "placed": "SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY f1_score DESC, recall DESC, threshold) AS rank FROM swept",
}


@query("e11_small_sweep", ctes(SMALL_PARTS, f"SELECT model_type, {number('threshold')}, tp, fp, fn, tn, {rates()}, {whole('rank')} FROM placed"))
def e11(spark, folder):
    return ev.small_sweep(model_scores(spark, folder), ["model_type"])


@query("e11_best_three", ctes(SMALL_PARTS, f"SELECT model_type, {number('threshold')}, {number('f1_score')}, {whole('rank')} FROM placed WHERE rank <= 3"))
def e11_top(spark, folder):
    swept = ev.small_sweep(model_scores(spark, folder), ["model_type"])
    return swept.where("rank <= 3").select("model_type", "threshold", "f1_score", "rank")


IDENTITY = {"job_id": "base_model_a", "model_type": "model_a", "feature_set": "raw", "evaluation_mode": "held_out_test"}


@query(
    "e12_result_row",
    ctes({**PARTS, **full_row("scored")}, f"SELECT {', '.join(f'{chr(39)}{v}{chr(39)} AS {n}' for n, v in IDENTITY.items())}, {ROW_COLUMNS}, {whole('rows', 'test_rows')} FROM counted, ranked, hits"),
)
def e12(spark, folder):
    rows = scored(spark, folder)
    row = ev.result_row(ev.evaluate_scores(rows), IDENTITY)
    return row.withColumn("test_rows", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


@query(
    "e12_rows_by_scenario",
    ctes(
        {"scores": MODEL_SCORES, **full_row("scores", "scenario, model_type")},
        f"SELECT scenario, model_type, {ROW_COLUMNS} FROM counted JOIN ranked USING (scenario, model_type) JOIN hits USING (scenario, model_type)",
    ),
)
def e12_grouped(spark, folder):
    return ev.evaluate_scores(model_scores(spark, folder), by=["scenario", "model_type"])


# Result tables: a job per scenario and model.
BY = "scenario, model_type"
JOB_COLUMNS = {
    "job_id": "scenario || '_' || model_type",
    "scenario": "scenario",
    "model_type": "model_type",
    "feature_set": "'raw'",
    "threshold_mode": "'default_0.5'",
    "threshold_selected_on": "'fixed'",
    "source_file": "model_type || '.csv'",
}
RESULT_PARTS = {
    "scores": MODEL_SCORES,
    **full_row("scores", BY),
    "results": f"""SELECT {', '.join(f'{e} AS {n}' for n, e in JOB_COLUMNS.items())}, CAST(0.5 AS DOUBLE) AS threshold, roc_auc, pr_auc,
    {', '.join(f'{e} AS {n}' for n, e in {**RATES, **TOP_K}.items())}, tp, fp, fn, tn FROM counted JOIN ranked USING ({BY}) JOIN hits USING ({BY})""",
}
NUMBERS = ["threshold", "roc_auc", "pr_auc", *RATES, *TOP_K]
RESULT_COLUMNS = f"{', '.join(JOB_COLUMNS)}, {', '.join(number(n) for n in NUMBERS)}, tp, fp, fn, tn"


def with_job(df, mode: bool = True):
    out = df.withColumn("job_id", F.concat("scenario", F.lit("_"), "model_type"))
    out = out.withColumn("feature_set", F.lit("raw")).withColumn("source_file", F.concat("model_type", F.lit(".csv")))
    if mode:
        out = out.withColumn("threshold_mode", F.lit("default_0.5")).withColumn("threshold_selected_on", F.lit("fixed"))
    return out


def results_table(spark, folder):
    return with_job(ev.evaluate_scores(model_scores(spark, folder), by=["scenario", "model_type"]))


@query("b01_concat_results", ctes(RESULT_PARTS, f"SELECT {RESULT_COLUMNS} FROM results"))
def b01(spark, folder):
    rows = model_scores(spark, folder)
    parts = []
    for model in ("model_a", "model_b"):
        part = ev.evaluate_scores(rows.where(F.col("model_type") == model), by=["scenario", "model_type"])
        parts.append(with_job(part))
    return res.concat_results(parts)


@query("b02_numeric_coercion", ctes(RESULT_PARTS, f"SELECT job_id, {', '.join(number(n) for n in [*NUMBERS, *COUNTS])} FROM results"))
def b02(spark, folder):
    texts = results_table(spark, folder).select("job_id", *[F.col(n).cast("string").alias(n) for n in [*NUMBERS, *COUNTS]])
    return res.coerce_results(texts)


RANK = "CASE scenario WHEN 'Base' THEN 1 WHEN 'SAML-D' THEN 2 WHEN 'Variant I' THEN 3 WHEN 'Variant II' THEN 4 ELSE 99 END"


def positioned(df):
    """The order of a small sorted report as a column."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id())


@query(
    "b03_scenario_rank_order",
    ctes(RESULT_PARTS, f"SELECT job_id, {whole(f'row_number() OVER (ORDER BY {RANK}, pr_auc DESC, roc_auc DESC) - 1', 'place')} FROM results"),
)
def b03(spark, folder):
    return positioned(res.sort_by_scenario_rank(results_table(spark, folder))).select("job_id", "place")


@query(
    "b04_scenario_name_order",
    ctes(RESULT_PARTS, f"SELECT job_id, {whole('row_number() OVER (ORDER BY scenario, pr_auc DESC, f1_score DESC, precision_at_100 DESC) - 1', 'place')} FROM results"),
)
def b04(spark, folder):
    return positioned(res.sort_by_scenario_name(results_table(spark, folder))).select("job_id", "place")


@query(
    "b05_scenario_tables",
    ctes(RESULT_PARTS, f"SELECT scenario, {whole('count(*)', 'rows')}, {number('max(pr_auc)', 'best')} FROM results GROUP BY 1"),
)
def b05(spark, folder):
    from workload.source_queries import scratch

    path = scratch(spark, "scenario-tables")
    res.scenario_tables(results_table(spark, folder), path)
    return spark.read.parquet(path).groupBy("scenario").agg(F.count(F.lit(1)).alias("rows"), F.max("pr_auc").alias("best"))


def best_sql(order: str, columns: str = RESULT_COLUMNS) -> str:
    return ctes(
        RESULT_PARTS,
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY {order}, job_id) AS rn FROM results) WHERE rn = 1",
    )


@query("b06_best_by_pr_auc", best_sql("pr_auc DESC"))
def b06(spark, folder):
    return res.best_per_scenario(results_table(spark, folder), ["pr_auc"])


@query("b07_best_by_three", best_sql("pr_auc DESC, f1_score DESC, precision_at_100 DESC"))
def b07(spark, folder):
    return res.best_per_scenario(results_table(spark, folder), ["pr_auc", "f1_score", "precision_at_100"])


B08_PARTS = {
    "scores": MODEL_SCORES,
    **applied("scores", BY),
    "mode_rows": f"""SELECT scenario || '_' || model_type AS job_id, scenario, model_type, threshold_mode, m.threshold, {', '.join(f'{e} AS {n}' for n, e in RATES.items())}
    FROM modes m JOIN test_swept t USING ({BY}, step)""",
}


@query(
    "b08_best_by_f1_over_modes",
    ctes(
        B08_PARTS,
        f"""SELECT job_id, scenario, model_type, threshold_mode, {number('threshold')}, {number('f1_score')} FROM (
        SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY f1_score DESC, job_id, threshold_mode) AS rn FROM mode_rows) WHERE rn = 1""",
    ),
)
def b08(spark, folder):
    rows = model_scores(spark, folder)
    modes = ev.apply_operating_points(rows.where("part = 'valid'"), rows.where("part = 'test'"), by=["scenario", "model_type"])
    best = res.best_per_scenario(with_job(modes, mode=False), ["f1_score"], tie=["job_id", "threshold_mode"])
    return best.select("job_id", "scenario", "model_type", "threshold_mode", "threshold", "f1_score")


# Stand-in timings: the quantities of a scenario's orders play the repeated seconds.
RUNS = """SELECT CASE o_orderstatus WHEN 'F' THEN 'Base_model_a' WHEN 'O' THEN 'Variant I_model_a' ELSE 'none' END AS job_id,
o_totalprice / 1000 AS seconds FROM orders"""
TIMED = """SELECT job_id, count(*) AS batch_size, count(*) AS inference_repeats, median(seconds) AS inference_time_sec_median, avg(seconds) AS inference_time_sec_mean FROM runs GROUP BY 1"""
TIMING = f"{whole('batch_size')}, {whole('inference_repeats')}, {number('inference_time_sec_median', digits=4)}, {number('inference_time_sec_mean', digits=4)}, {number('inference_time_sec_median / batch_size * 1000', 'inference_time_per_1000_sec', 4)}, {number('batch_size / inference_time_sec_median', 'records_per_second', 4)}"


@query("b09_join_timings", ctes({**RESULT_PARTS, "runs": RUNS, "timed": TIMED}, f"SELECT results.job_id, {TIMING}, {number('pr_auc', digits=4)} FROM results LEFT JOIN timed ON results.job_id = timed.job_id"), digits=4)
def b09(spark, folder):
    from workload.views import view

    runs = view(spark, folder, RUNS)
    sizes = runs.groupBy("job_id").agg(F.count(F.lit(1)).alias("batch_size"))
    timings = res.timing_table(runs.join(sizes, "job_id"))
    joined = res.join_timings(results_table(spark, folder), timings)
    return joined.select("job_id", *res.TIMING_COLUMNS, "pr_auc")


def report_columns(names) -> str:
    return ", ".join(number(n) if n in NUMBERS else n for n in names)


@query("b10_chapter_table", ctes(RESULT_PARTS, f"SELECT {report_columns(res.CHAPTER_COLUMNS)} FROM results"))
def b10(spark, folder):
    return res.project_present(results_table(spark, folder), res.CHAPTER_COLUMNS)


@query("b10_lift_table", ctes(RESULT_PARTS, f"SELECT {report_columns(res.LIFT_COLUMNS)} FROM results"))
def b10_lift(spark, folder):
    return res.project_present(results_table(spark, folder), res.LIFT_COLUMNS)


@query("b10_performance_table", ctes(RESULT_PARTS, "SELECT scenario, model_type, feature_set FROM results"))
def b10_performance(spark, folder):
    return res.project_present(results_table(spark, folder), res.PERFORMANCE_COLUMNS)


@query(
    "b11_overall_best",
    ctes(
        RESULT_PARTS,
        " UNION ALL ".join(
            f"(SELECT '{m}' AS best_by, job_id, {number('pr_auc')}, {number('roc_auc')} FROM results ORDER BY {m} DESC, job_id LIMIT 1)"
            for m in ("pr_auc", "roc_auc", "precision_at_100")
        ),
    ),
)
def b11(spark, folder):
    return res.overall_best(results_table(spark, folder)).select("best_by", "job_id", "pr_auc", "roc_auc")


@query("b12_scenario_like", ctes(RESULT_PARTS, f"SELECT scenario, model_type, {number('pr_auc')} FROM results WHERE scenario ILIKE '%variant%'"))
def b12(spark, folder):
    return res.scenario_like(results_table(spark, folder), "VARIANT", ["scenario", "model_type", "pr_auc", "absent"])
