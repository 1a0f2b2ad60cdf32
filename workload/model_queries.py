"""Preparation, drift, explanation, correlation, review and model queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.functions import band
from riskloom.operators import applications as app
from riskloom.operators import clean, correlate, drift, evaluate, explain, models, ordered, prep, results, review
from riskloom.operators.presets import APPLICATION_COLUMNS, REQUEST_SCHEMA
from riskloom.operators.transfers import transfer_feature_lists
from riskloom.plans import jobs
from riskloom.session import stage_table
from riskloom.sources import files, ledger
from riskloom.streaming import scorer
from workload.features import FEATURE_PARTS, cleaned, indexed
from workload.registry import ctes, number, query, whole
from workload.source_queries import scratch
from workload.tables import APPS, CLEANED_PARTS
from workload.views import (
    ALERTS,
    CONTRIBUTIONS,
    REFERENCE_ROWS,
    SCORED,
    TRANSFER_TIE,
    alert_transactions,
    alerts,
    applications,
    contributions,
    drift_pair,
    duck,
    scored,
    table,
    transfers,
)

# --- splits, imputation, weights, encoding -------------------------------------------------

BORDERS = "SELECT CAST(floor(count(*) * 0.7) AS BIGINT) AS t, CAST(floor(count(*) * 0.7) + floor(count(*) * 0.15) AS BIGINT) AS v FROM indexed"
SPLIT = "SELECT indexed.*, CASE WHEN event_id < t THEN 'train' WHEN event_id < v THEN 'valid' ELSE 'test' END AS split FROM indexed, borders"
SPLIT_PARTS = {**{k: FEATURE_PARTS[k] for k in ("applications", "copied", "cleaned", "indexed")}, "borders": BORDERS, "parted": SPLIT}


def parted(spark, folder):
    return ordered.ordered_split(indexed(spark, folder), ["event_id"], index="event_id")


@query("p01_ordered_split", ctes(SPLIT_PARTS, f"SELECT {whole('app_id')}, split FROM parted"))
def p01(spark, folder):
    frame = cleaned(spark, folder).select("app_id", "month", "days_since_request", "customer_age", "income")
    order = clean.reproducible_order(frame, ["app_id"])
    return ordered.ordered_split(stage_table(frame, "to-split"), order).select("app_id", "split")


@query(
    "p02_stratified_split",
    ctes(
        {"applications": APPS, "sizes": "SELECT fraud_bool, count(*) AS n, sum(count(*)) OVER () AS total FROM applications GROUP BY 1",
         "exact": "SELECT *, CAST(ceil(CAST(total AS DOUBLE) * 0.15) AS DOUBLE) * n / total AS share, sum(floor(CAST(ceil(CAST(total AS DOUBLE) * 0.15) AS DOUBLE) * n / total)) OVER () AS floors FROM sizes",
         "quotas": "SELECT *, floor(share) + CASE WHEN row_number() OVER (ORDER BY floor(share) - share, fraud_bool) <= ceil(CAST(total AS DOUBLE) * 0.15) - floors THEN 1 ELSE 0 END AS quota FROM exact"},
        f"SELECT {whole('fraud_bool')}, 'test' AS split, {whole('quota', 'rows')} FROM quotas UNION ALL SELECT fraud_bool, 'train', CAST(n - quota AS BIGINT) FROM quotas",
    ),
)
def p02(spark, folder):
    split = prep.stratified_split(applications(spark, folder), "fraud_bool", ["app_id"])
    return split.groupBy("fraud_bool", "split").agg(F.count(F.lit(1)).alias("rows"))


P03 = ["bank_months_count", "intended_balcon_amount", "velocity_24h", "session_length_in_minutes", "zip_count_4w"]


@query("p03_medians", ctes(SPLIT_PARTS, f"SELECT {', '.join(number(f'median({c})', c) for c in P03)} FROM parted WHERE split = 'train'"))
def p03(spark, folder):
    found = prep.medians(parted(spark, folder).where("split = 'train'"), P03)
    return spark.createDataFrame([tuple(found[c] for c in P03)], ", ".join(f"{c} double" for c in P03))


@query("p03_medians_by_selection", ctes(SPLIT_PARTS, f"SELECT {', '.join(number(f'median({c})', c) for c in P03)} FROM parted WHERE split = 'train'"))
def p03_selection(spark, folder):
    """As p03, by the way taken for tables beyond one task."""
    train = stage_table(parted(spark, folder).where("split = 'train'").select(*P03), "train-part")
    found = prep.medians(train, P03, small_values=500)
    return spark.createDataFrame([tuple(found[c] for c in P03)], ", ".join(f"{c} double" for c in P03))


P04 = ["payment_type", "employment_status", "housing_status", "source", "device_os"]


def mode_sql(c: str) -> str:
    return f"(SELECT CAST({c} AS VARCHAR) FROM parted WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS {c}"


@query("p04_most_frequent", ctes(SPLIT_PARTS, f"SELECT {', '.join(mode_sql(c) for c in P04)}"))
def p04(spark, folder):
    found = prep.most_frequent(parted(spark, folder).where("split = 'train'"), P04)
    return spark.createDataFrame([tuple(found[c] for c in P04)], ", ".join(f"{c} string" for c in P04))


HOT = [("payment_type", "1-URGENT"), ("payment_type", "5-LOW"), ("housing_status", "F"), ("housing_status", "O"), ("housing_status", "P")]


@query(
    "p05_one_hot",
    ctes({"applications": APPS}, f"SELECT {whole('app_id')}, {', '.join(whole(f'{c} = {chr(39)}{v}{chr(39)}', f'{c}_{v}') for c, v in HOT)} FROM applications"),
)
def p05(spark, folder):
    apps = applications(spark, folder)
    fitted = prep.encoding(["income"], ["payment_type", "housing_status"]).fit(apps)
    names = prep.encoded_names(["income"], ["payment_type", "housing_status"], fitted.stages)
    values = fitted.transform(apps).withColumn("v", vector_to_array("features"))
    return values.select("app_id", *[F.col("v")[names.index(f"{c}_{v}")].cast("int").alias(f"{c}_{v}") for c, v in HOT])


@query(
    "p06_assembly",
    ctes({"applications": APPS}, f"SELECT {whole('app_id')}, {number('income')}, {number('velocity_6h')}, CAST(10 AS BIGINT) AS width FROM applications"),
)
def p06(spark, folder):
    apps = applications(spark, folder)
    fitted = prep.encoding(["income", "velocity_6h"], ["payment_type", "housing_status"]).fit(apps)
    values = fitted.transform(apps).withColumn("v", vector_to_array("features"))
    return values.select("app_id", F.col("v")[0].alias("income"), F.col("v")[1].alias("velocity_6h"), F.size("v").alias("width"))


@query(
    "p07_encoded_names",
    ctes(
        {"applications": APPS, "names": "SELECT DISTINCT 'payment_type_' || payment_type AS name, 1 AS place FROM applications UNION ALL SELECT DISTINCT 'housing_status_' || housing_status, 2 FROM applications"},
        "SELECT 'income,' || string_agg(name, ',' ORDER BY place, name) AS names FROM names",
    ),
)
def p07(spark, folder):
    apps = applications(spark, folder)
    fitted = prep.encoding(["income"], ["payment_type", "housing_status"]).fit(apps)
    names = prep.encoded_names(["income"], ["payment_type", "housing_status"], fitted.stages)
    return spark.createDataFrame([(",".join(names),)], "names string")


@query("p08_positive_weight", ctes(SPLIT_PARTS, f"SELECT {number('CAST(count(*) FILTER (fraud_bool = 0) AS DOUBLE) / count(*) FILTER (fraud_bool = 1)', 'weight')} FROM parted WHERE split = 'train'"))
def p08(spark, folder):
    return spark.createDataFrame([(prep.positive_weight(parted(spark, folder).where("split = 'train'"), "fraud_bool"),)], "weight double")


@query(
    "p09_balanced_weights",
    ctes(SPLIT_PARTS, f"SELECT {whole('fraud_bool', 'class')}, {number('CAST(sum(count(*)) OVER () AS DOUBLE) / (2 * count(*))', 'weight')} FROM parted WHERE split = 'train' GROUP BY 1"),
)
def p09(spark, folder):
    weights = prep.balanced_weights(parted(spark, folder).where("split = 'train'"), "fraud_bool")
    return spark.createDataFrame(sorted(weights.items()), "class int, weight double")


MATRIX_NUMBERS = ["income", "bank_months_count", "session_length_in_minutes"]
MATRIX_DUMMIES = [("housing_status", "F"), ("housing_status", "O"), ("source", "TELEAPP")]


@query(
    "p10_dummy_matrix",
    ctes(
        CLEANED_PARTS,
        f"""SELECT {whole('app_id')}, {', '.join(number(f'coalesce({c}, (SELECT median({c}) FROM cleaned))', c) for c in MATRIX_NUMBERS)},
        {', '.join(whole(f'{c} = {chr(39)}{v}{chr(39)}', f'{c}_{v}') for c, v in MATRIX_DUMMIES)}, CAST(46 AS BIGINT) AS width FROM cleaned""",
    ),
)
def p10(spark, folder):
    frame = clean.sentinel_to_null(clean.drop_duplicate_rows(applications(spark, folder)))
    # A category with more values than allowed, a constant and an empty column: none of them may stay.
    frame = frame.withColumns({"many": F.col("app_id").cast("string"), "same": F.lit(7), "empty": F.lit(None).cast("double")})
    matrix = prep.dummy_matrix(frame, "fraud_bool", keep=["app_id"])
    out = matrix.frame.select("app_id", *MATRIX_NUMBERS, *[f"{c}_{v}" for c, v in MATRIX_DUMMIES])
    return out.withColumn("width", F.lit(len(matrix.columns)))


# --- drift ---------------------------------------------------------------------------------

DRIFT_NUMBERS = [c for c in APPLICATION_COLUMNS if c not in ("fraud_bool", *P04)]
DRIFT_COLUMNS = sorted([*DRIFT_NUMBERS, *P04])


def drift_parts(columns=tuple(DRIFT_COLUMNS)) -> dict[str, str]:
    def entry(c: str) -> str:
        if c in P04:
            return f"SELECT side, '{c}' AS name, 'cat' AS kind, CAST({c} AS VARCHAR) AS text, CAST(NULL AS DOUBLE) AS value FROM pooled"
        return f"SELECT side, '{c}', 'num', NULL, CAST({c} AS DOUBLE) FROM pooled"

    text = [c for c in columns if c in P04]
    rest = [c for c in columns if c not in P04]
    return {
        "applications": APPS,
        "pooled": f"SELECT *, CASE WHEN {REFERENCE_ROWS} THEN 1 ELSE 0 END AS side FROM applications",
        "long": " UNION ALL ".join(entry(c) for c in [*text, *rest]),
        "shapes": """SELECT name, kind, min(value) AS lo, max(value) AS hi, CASE WHEN count(DISTINCT value) > 20
            THEN CAST(ceil(log2(count(value))) AS BIGINT) + 1 ELSE 0 END AS bins FROM long GROUP BY 1, 2""",
        "labelled": """SELECT side, l.name, CASE WHEN l.kind = 'cat' THEN text WHEN bins = 0 THEN CAST(value AS VARCHAR)
            ELSE CAST(CAST(greatest(least(floor(bins * (value - lo) / (hi - lo)), bins - 1), 0) AS BIGINT) AS VARCHAR) END AS label
            FROM long l JOIN shapes s ON l.name = s.name WHERE text IS NOT NULL OR value IS NOT NULL""",
        "paired": "SELECT name, label, sum(side) AS r, sum(1 - side) AS c FROM labelled GROUP BY 1, 2",
        "shares": """SELECT name, CASE WHEN r = 0 THEN 1e-4 ELSE CAST(r AS DOUBLE) / sum(r) OVER (PARTITION BY name) END AS r,
            CASE WHEN c = 0 THEN 1e-4 ELSE CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY name) END AS c FROM paired""",
        "scores": "SELECT name, sum((r - c) * ln(r / c)) AS drift_score FROM shares GROUP BY 1",
        "verdicts": "SELECT scores.*, kind, bins, drift_score >= 1e-1 AS drifted FROM scores JOIN shapes USING (name)",
    }


DRIFT = drift_parts()
SUMMARY = {
    **DRIFT,
    "summary": """SELECT count(*) AS number_of_columns, count(*) FILTER (drifted) AS number_of_drifted_columns,
        coalesce(string_agg(name, ',' ORDER BY name) FILTER (drifted), '') AS drifted_columns FROM verdicts""",
}


def drift_scores(spark, folder):
    return drift.drift_table(*drift_pair(spark, folder), DRIFT_COLUMNS)


@query("d01_common_columns", ctes({"applications": APPS}, f"SELECT '{','.join(DRIFT_COLUMNS)}' AS columns, {whole('count(*)', 'rows')} FROM applications"))
def d01(spark, folder):
    reference, current = drift_pair(spark, folder)
    columns = drift.drift_columns(reference.withColumn("only_here", F.lit(1)), current, drop=("fraud_bool", "event_time", "app_id"))
    return reference.unionAll(current).agg(F.lit(",".join(columns)).alias("columns"), F.count(F.lit(1)).alias("rows"))


@query("d02_psi_by_value", ctes(DRIFT, f"SELECT name AS column_name, {number('drift_score')} FROM verdicts WHERE bins = 0"))
def d02(spark, folder):
    return drift_scores(spark, folder).where("bins = 0").select("column_name", "drift_score")


@query("d03_psi_by_bin", ctes(DRIFT, f"SELECT name AS column_name, {whole('bins')}, {number('drift_score')} FROM verdicts WHERE bins > 0"))
def d03(spark, folder):
    return drift_scores(spark, folder).where("bins > 0").select("column_name", "bins", "drift_score")


@query("d04_column_verdicts", ctes(DRIFT, f"SELECT name AS column_name, kind AS column_type, {number('drift_score')}, drifted AS drift_detected FROM verdicts"))
def d04(spark, folder):
    return drift_scores(spark, folder).select("column_name", "column_type", "drift_score", "drift_detected")


@query(
    "d05_dataset_verdict",
    ctes(SUMMARY, f"SELECT {whole('number_of_columns')}, {whole('number_of_drifted_columns')}, {number('CAST(number_of_drifted_columns AS DOUBLE) / number_of_columns', 'share')}, CAST(number_of_drifted_columns AS DOUBLE) / number_of_columns >= 3e-1 AS dataset_drift FROM summary"),
)
def d05(spark, folder):
    summary = drift.drift_summary(drift_scores(spark, folder))
    return summary.select("number_of_columns", "number_of_drifted_columns", F.col("share_of_drifted_columns").alias("share"), "dataset_drift")


@query("d06_drifted_columns", ctes(SUMMARY, "SELECT drifted_columns FROM summary"))
def d06(spark, folder):
    return drift.drift_summary(drift_scores(spark, folder)).select("drifted_columns")


D07_COLUMNS = ["credit_risk_score", "income", "payment_type", "velocity_6h"]


def side_bins(c: str) -> str:
    return f"""SELECT '{c}' AS name, side, CAST(bin AS VARCHAR) AS bin, lo, hi, count(*) FILTER (WHERE place = bin) AS n
    FROM (SELECT side, lo, hi, CAST(greatest(least(floor(10 * (x - lo) / nullif(hi - lo, 0)), 9), 0) AS INT) AS place
      FROM (SELECT side, CAST({c} AS DOUBLE) AS x, min(CAST({c} AS DOUBLE)) OVER (PARTITION BY side) AS lo, max(CAST({c} AS DOUBLE)) OVER (PARTITION BY side) AS hi FROM pooled)),
      (SELECT CAST(unnest(range(10)) AS INT) AS bin)
    GROUP BY side, bin, lo, hi HAVING lo < hi OR count(*) FILTER (WHERE place = bin) > 0"""


@query(
    "d07_distributions",
    ctes(
        {
            "applications": APPS,
            "pooled": DRIFT["pooled"],
            "binned": " UNION ALL ".join(side_bins(c) for c in D07_COLUMNS if c != "payment_type")
            + " UNION ALL SELECT 'payment_type', side, payment_type, NULL, NULL, count(*) FROM pooled GROUP BY 2, 3",
        },
        f"""SELECT name AS "column", CASE WHEN side = 1 THEN 'reference' ELSE 'current' END AS side, CASE WHEN lo IS NULL THEN bin ELSE lpad(bin, 2, '0') END AS label,
        {number('lo + (hi - lo) / 10 * TRY_CAST(bin AS INT)', 'lower')}, {number('lo + (hi - lo) / 10 * (TRY_CAST(bin AS INT) + 1)', 'upper')}, {whole('n', 'rows')},
        {number('n / (sum(n) OVER (PARTITION BY name, side) * ((hi - lo) / 10))', 'density')} FROM binned""",
    ),
)
def d07(spark, folder):
    return drift.distribution_summary(*drift_pair(spark, folder), D07_COLUMNS)


@query("d08_drift_job")
def d08(spark, folder):
    table_, _ = jobs.run_drift_check(*drift_pair(spark, folder), ["app_id"])
    return table_


@query(
    "d09_report_roll_up",
    ctes(SUMMARY, f"SELECT r.report_file, CAST(number_of_drifted_columns AS DOUBLE) / number_of_columns >= 3e-1 AS dataset_drift, {whole('number_of_drifted_columns')} FROM summary, (SELECT unnest(['drift_a', 'drift_b']) AS report_file) r"),
)
def d09(spark, folder):
    base = scratch(spark, "reports")
    summary = drift.drift_summary(drift_scores(spark, folder))
    for name in ("drift_a", "drift_b"):
        summary.write.parquet(f"{base}/{name}")
    found = drift.report_roll_up(spark, [f"{base}/{n}" for n in ("drift_b", "drift_a", "drift_none")])
    return found.select("report_file", "dataset_drift", "number_of_drifted_columns")


@query("d10_retrain_flag", ctes(SUMMARY, "SELECT CAST(number_of_drifted_columns AS DOUBLE) / number_of_columns >= 3e-1 AS retrain FROM summary"))
def d10(spark, folder):
    return drift.retrain_decision(drift.drift_summary(drift_scores(spark, folder))).select("retrain")


# --- explanations --------------------------------------------------------------------------

FOLDED = {
    "contributions": duck(CONTRIBUTIONS),
    "folded": """SELECT row_id, CASE WHEN feature LIKE 'payment\\_type\\_%' ESCAPE '\\' THEN 'payment_type' WHEN feature LIKE 'device\\_os\\_%' ESCAPE '\\' THEN 'device_os' ELSE feature END AS feature,
        sum(shap_value) AS shap_value FROM contributions GROUP BY 1, 2""",
    # Sizes are compared after rounding, as the order of addition could decide among equals.
    "exact": "SELECT row_id, feature, round(shap_value, 9) + 0.0 AS shap_value FROM folded",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(shap_value) DESC, feature) AS rank FROM exact",
}


def folded(spark, folder):
    summed = explain.fold_contributions(contributions(spark, folder))
    return summed.withColumn("shap_value", F.round("shap_value", 9))


@query("x01_folded_contributions", ctes(FOLDED, f"SELECT {whole('row_id')}, feature, {number('shap_value')} FROM exact"))
def x01(spark, folder):
    return folded(spark, folder)


@query(
    "x02_ranked_factors",
    ctes(FOLDED, f"SELECT {whole('row_id')}, feature, {number('shap_value')}, {number('abs(shap_value)', 'abs_shap_value')}, CASE WHEN shap_value > 0 THEN 'increase_risk' ELSE 'decrease_risk' END AS direction, {whole('rank')} FROM ranked"),
)
def x02(spark, folder):
    return explain.ranked_factors(folded(spark, folder))


def top_names(condition: str, k: int) -> str:
    return f"coalesce(string_agg(feature, ',' ORDER BY rank) FILTER (place <= {k} AND {condition}), '')"


X03_PARTS = {
    **FOLDED,
    "signed": "SELECT *, row_number() OVER (PARTITION BY row_id, sign(shap_value) ORDER BY rank) AS place FROM ranked",
}


@query(
    "x03_top_factors",
    ctes(
        X03_PARTS,
        f"""SELECT {whole('row_id')}, {top_names('shap_value > 0', 2)} AS positive, {top_names('shap_value < 0', 2)} AS negative,
        coalesce(string_agg(feature, ',' ORDER BY rank) FILTER (rank <= 2), '') AS largest FROM signed GROUP BY 1""",
    ),
)
def x03(spark, folder):
    rows = explain.explain_rows(folded(spark, folder), top_k=2)

    def names(c):
        return F.array_join(F.transform(c, lambda f: f["feature"]), ",")

    return rows.select(
        "row_id", names("top_positive_factors").alias("positive"), names("top_negative_factors").alias("negative"), names("raw_top_features").alias("largest")
    )


REASON_SQL = "CASE feature " + " ".join(
    f"WHEN '{k}' THEN replace('{v}', '%s', printf('%.4f', shap_value))" for k, v in explain.REASONS.items()
) + " ELSE 'Признак ''' || feature || ''' повысил риск (SHAP=' || printf('%.4f', shap_value) || ')' END"


@query(
    "x04_reasons",
    ctes(X03_PARTS, f"SELECT {whole('row_id')}, coalesce(string_agg({REASON_SQL}, ',' ORDER BY rank) FILTER (place <= 5 AND shap_value > 0), '') AS reasons FROM signed GROUP BY 1"),
)
def x04(spark, folder):
    rows = explain.with_reasons(explain.explain_rows(folded(spark, folder)))
    return rows.select("row_id", F.array_join("human_readable_reasons", ",").alias("reasons"))


@query("x05_export", ctes(FOLDED, f"SELECT {whole('count(DISTINCT row_id)', 'rows')}, {whole('count(*) FILTER (rank <= 5)', 'factors')} FROM ranked"))
def x05(spark, folder):
    path = explain.write_explanations(explain.with_reasons(explain.explain_rows(folded(spark, folder))), scratch(spark, "explanations"))
    back = spark.read.json(path)
    return back.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("raw_top_features")).alias("factors"))


@query(
    "x06_global_importance",
    ctes(FOLDED, f"SELECT feature, {number('avg(abs(shap_value))', 'mean_abs_shap')} FROM contributions GROUP BY 1 ORDER BY avg(abs(shap_value)) DESC, feature LIMIT 15"),
)
def x06(spark, folder):
    return explain.global_importance(contributions(spark, folder))


@query("x07_explanation_sample", ctes({"scored": duck(SCORED)}, f"SELECT {whole('row_id')}, {number('score', 'prediction_score')} FROM scored WHERE part = 'test' ORDER BY score DESC, row_id LIMIT 500"))
def x07(spark, folder):
    test = scored(spark, folder).where("part = 'test'").withColumnRenamed("score", "prediction_score")
    return explain.explanation_sample(test).select("row_id", "prediction_score")


# --- correlation and review ----------------------------------------------------------------

K_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "k01_correlations",
    " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, {number(f'corr({a}, {b})', 'corr')} FROM lineitem" for a in K_COLUMNS for b in K_COLUMNS),
)
def k01(spark, folder):
    return correlate.correlation_matrix(table(spark, folder, "lineitem"), K_COLUMNS)


@query(
    "k02_top_by_target",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, {number(f'abs(corr({c}, CASE WHEN l_returnflag = {chr(39)}R{chr(39)} THEN 1 ELSE 0 END))', 'abs_corr')} FROM lineitem" for c in K_COLUMNS)
    + " ORDER BY abs_corr DESC LIMIT 2",
)
def k02(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("y", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return correlate.top_by_target_correlation(lines, K_COLUMNS, "y", top=2)


@query(
    "k03_top_by_variance",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, {number(f'var_samp({c})', 'variance', 2)} FROM lineitem" for c in K_COLUMNS) + " ORDER BY variance DESC LIMIT 2",
    digits=2,
)
def k03(spark, folder):
    return correlate.top_by_variance(table(spark, folder, "lineitem"), K_COLUMNS, top=2)


BANDED = {
    "scored": duck(SCORED),
    "banded": "SELECT *, CASE WHEN score >= 0.80 THEN 'red' WHEN score >= 0.50 THEN 'yellow' ELSE 'green' END AS recommendation FROM scored",
    "labelled": "SELECT *, CASE recommendation WHEN 'red' THEN '🔴 block' WHEN 'yellow' THEN '🟡 review' ELSE '🟢 pass' END AS recommendation_label FROM banded",
}


def banded(spark, folder):
    rows = scored(spark, folder).withColumnRenamed("score", "prediction_score")
    labelled = rows.withColumn("prediction_label", (F.col("prediction_score") >= 0.5).cast("int"))
    return review.with_band(labelled)


@query("m05_bands", ctes(BANDED, f"SELECT {whole('row_id')}, recommendation FROM banded"))
def m05(spark, folder):
    return scored(spark, folder).select("row_id", band("score").alias("recommendation"))


@query(
    "q01_review_queue",
    ctes(BANDED, f"SELECT {whole('row_id')}, {number('score', 'prediction_score')}, {whole('score >= 0.5', 'prediction_label')}, recommendation_label FROM labelled WHERE recommendation IN ('red', 'yellow')"),
)
def q01(spark, folder):
    return review.review_queue(banded(spark, folder), ["red", "yellow"])


@query("q02_band_counts", ctes(BANDED, f"SELECT {whole('count(*)', 'total')}, {whole('count(*) FILTER (score >= 0.8)', 'red')}, {whole('count(*) FILTER (score >= 0.5 AND score < 0.8)', 'yellow')} FROM banded"))
def q02(spark, folder):
    return review.band_counts(banded(spark, folder))


@query("q03_action_labels", "SELECT o_orderpriority AS recommendation, CAST(count(*) AS BIGINT) AS rows, o_orderpriority AS label FROM orders GROUP BY 1 UNION ALL SELECT 'red', CAST(count(*) AS BIGINT), '🔴 block' FROM orders")
def q03(spark, folder):
    orders = table(spark, folder, "orders")
    bands = orders.select(F.explode(F.array(F.col("o_orderpriority"), F.lit("red"))).alias("recommendation"))
    counts = bands.groupBy("recommendation").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("label", review.action_label())


@query(
    "q04_record_lookup",
    ctes(BANDED, f"SELECT {whole('row_id')}, recommendation, {number('o_totalprice')}, o_orderpriority FROM banded JOIN orders ON row_id = o_orderkey"),
)
def q04(spark, folder):
    raw = table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"), "o_totalprice", "o_orderpriority")
    return review.record_lookup(banded(spark, folder).select("row_id", "recommendation"), raw)


# --- models and jobs (no SQL form: rows only) ------------------------------------------------

SMALL_MODEL = models.ModelSettings(trees=3, depth=3, linear_iterations=10)


def prepared_applications(spark, folder, feature_set="engineered"):
    return jobs.build_application_features(applications(spark, folder), ["app_id"], feature_set=feature_set)


def prepared_transfers(spark, folder):
    return jobs.build_transfer_features(transfers(spark, folder), TRANSFER_TIE)


def fitted(spark, folder, kind):
    prepared = prepared_applications(spark, folder)
    result = models.train(prepared.frame, prepared.categorical, prepared.numerical, kind, settings=SMALL_MODEL)
    return prepared, result


@query("m01_trees_balanced")
def m01(spark, folder):
    _, result = fitted(spark, folder, models.TREES_BALANCED)
    return models.selection_summary(spark, result, [result])


@query("m02_trees_positive_weight")
def m02(spark, folder):
    _, result = fitted(spark, folder, models.TREES_POSITIVE)
    return models.selection_summary(spark, result, [result])


@query("m03_select_best")
def m03(spark, folder):
    return jobs.run_training(
        prepared_applications(spark, folder), (models.TREES_BALANCED, models.LINEAR), settings=SMALL_MODEL, publish_to=scratch(spark, "production")
    )


@query("m04_scored_table")
def m04(spark, folder):
    prepared, result = fitted(spark, folder, models.LINEAR)
    return result.bundle.score(prepared.frame).select("app_id", "event_id", models.SCORE, models.LABEL)


@query("m06_batch_scoring")
def m06(spark, folder):
    _, result = fitted(spark, folder, models.LINEAR)
    requests = applications(spark, folder).select(F.col("app_id").alias("row_id"), *REQUEST_SCHEMA.fieldNames())
    return jobs.score_batch(requests, result.bundle, log_to=scratch(spark, "log"))


@query("m07_stream_scoring")
def m07(spark, folder):
    prepared, result = fitted(spark, folder, models.LINEAR)
    landed, out = scratch(spark, "requests"), scratch(spark, "scores")
    records_ = indexed(spark, folder).select("event_id", *REQUEST_SCHEMA.fieldNames())
    records_.write.json(landed)
    stream = scorer.score_records(scorer.read_requests(spark, landed), result.bundle)
    running = scorer.start_scoring(stream, out, scratch(spark, "stream-state"), available_now=True)
    running.awaitTermination()
    return spark.read.parquet(out)


@query(
    "j07_batch_and_stream",
    f"""SELECT {whole('count(*)', 'rows')}, {whole('count(*)', 'streamed')}, {whole('count(*)', 'same')}, {whole('count(*)', 'logged')}, {whole('count(*)', 'in_requests')}, {whole('count(*)', 'with_reasons')} FROM orders""",
)
def j07_service(spark, folder):
    """The same requests scored and explained as one batch and as a stream, which logs its micro-batches."""
    prepared, result = fitted(spark, folder, models.LINEAR)
    bundle = result.bundle
    means = bundle.means(prepared.frame, ["event_id"])
    landed, out, log = scratch(spark, "requests"), scratch(spark, "answers"), scratch(spark, "answers-log")
    indexed(spark, folder).select("event_id", *REQUEST_SCHEMA.fieldNames()).repartition(4).write.json(landed)
    stream = scorer.score_records(scorer.read_requests(spark, landed, files_per_batch=2), bundle, means)
    scorer.start_ledger(stream, out, log, scratch(spark, "ledger-state"), bundle.kind, available_now=True).awaitTermination()
    batch = bundle.explained(prepared.frame, means).select("event_id", F.col(models.SCORE).alias("batch_score"))
    rows = batch.join(spark.read.parquet(out), "event_id", "full")
    logged = spark.read.parquet(log).groupBy("request_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.get_json_object("payload", "$.batch_size").cast("bigint")).alias("size"))
    logged = logged.agg(F.sum("n").alias("logged"), F.sum("size").alias("in_requests")).first()
    return rows.agg(
        F.count("batch_score").alias("rows"),
        F.count(models.SCORE).alias("streamed"),
        F.count_if(F.abs(F.col("batch_score") - F.col(models.SCORE)) < 1e-9).alias("same"),
        F.count_if(F.size("human_readable_reasons") == F.size("top_positive_factors")).alias("with_reasons"),
        F.lit(logged["logged"]).alias("logged"),
        F.lit(logged["in_requests"]).alias("in_requests"),
    )


@query("m08_run_ledger")
def m08(spark, folder):
    _, result = fitted(spark, folder, models.LINEAR)
    path = scratch(spark, "runs")
    ledger.append_run(ledger.run_rows(spark, ledger.new_run_id(), models.run_parameters(result), models.run_metrics(result)), path)
    return spark.read.parquet(path).drop("run_id")


@query("m09_scoring_time")
def m09(spark, folder):
    prepared, result = fitted(spark, folder, models.LINEAR)
    runs = models.time_scoring(result.bundle.score, prepared.frame).withColumn("job_id", F.lit("base_linear"))
    return results.timing_table(runs)


@query("x08_linear_contributions")
def x08(spark, folder):
    prepared, result = fitted(spark, folder, models.LINEAR)
    arrays = result.bundle.contributions(prepared.frame, ["event_id"], "app_id")
    return explain.fold_contributions(explain.long_contributions(arrays, "app_id", "contributions", result.bundle.feature_names), "app_id")


@query("x09_explanation_report")
def x09(spark, folder):
    prepared, result = fitted(spark, folder, models.LINEAR)
    sample = scratch(spark, "sample")
    jobs.export_explanations(prepared, result.bundle, sample)
    path = scratch(spark, "report")
    ledger.append_run(ledger.run_rows(spark, ledger.new_run_id(), {"model_type": result.kind, "explanations": "sample"}, {"rows": spark.read.json(sample).count()}), path)
    return spark.read.parquet(path).drop("run_id")


@query("j01_data_check", ctes({"applications": APPS}, f"SELECT {whole('count(*)', 'rows')}, {whole('count(*) FILTER (bank_months_count = -1)', 'missing')} FROM applications"))
def j01(spark, folder):
    path = scratch(spark, "checked") + ".parquet"
    jobs.check_data(applications(spark, folder), path)
    return files.read_table(spark, path).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("bank_months_count").isNull()).alias("missing"))


@query("j02_feature_build", ctes(FEATURE_PARTS, f"SELECT {whole('count(*)', 'rows')}, {whole('max(event_id)', 'last')}, {number('sum(velocity_24h - velocity_6h)', 'delta', 2)} FROM indexed"), digits=2)
def j02(spark, folder):
    path = scratch(spark, "features") + ".parquet"
    built = jobs.build_application_features(applications(spark, folder), ["app_id"], out=path, spec_out=scratch(spark, "spec"))
    return built.frame.agg(F.count(F.lit(1)).alias("rows"), F.max("event_id").alias("last"), F.sum("velocity_delta_24h_6h").alias("delta"))


@query("j03_training_transfers")
def j03(spark, folder):
    return jobs.run_training(
        prepared_transfers(spark, folder), models.CANDIDATES, settings=SMALL_MODEL, runs_out=scratch(spark, "runs")
    )


@query("j04_benchmark_job")
def j04(spark, folder):
    job = jobs.BenchmarkJob("Base", "base", "base", models.TREES_BALANCED, "engineered")
    return jobs.run_benchmark_job(job, prepared_applications(spark, folder), settings=SMALL_MODEL).mode_rows


@query("j05_benchmark_suite")
def j05(spark, folder):
    reference, current = drift_pair(spark, folder)
    prepared = {
        ("base", "engineered"): jobs.build_application_features(reference, ["app_id"]),
        ("variant_1", "engineered"): jobs.build_application_features(current, ["app_id"]),
        ("samld", "engineered"): prepared_transfers(spark, folder),
    }
    wanted = [j for j in jobs.BENCHMARK_JOBS if (j.eval_dataset, j.feature_set) in prepared and j.model_type == models.TREES_BALANCED]
    tables = jobs.run_benchmark_suite(prepared, wanted, settings=SMALL_MODEL, repeats=2)
    return tables["results_with_inference"]


@query("j06_drift_summary")
def j06(spark, folder):
    _, summary = jobs.run_drift_check(*drift_pair(spark, folder), ["app_id"], out=scratch(spark, "drift") + ".parquet")
    return summary


@query("j07_alert_training")
def j07(spark, folder):
    prepared = jobs.build_alert_features(alerts(spark, folder), alert_transactions(spark, folder), ["event_id"])
    return jobs.run_training(prepared, (models.LINEAR,), settings=SMALL_MODEL)


@query("j08_explanations")
def j08(spark, folder):
    prepared, result = fitted(spark, folder, models.LINEAR)
    return jobs.export_explanations(prepared, result.bundle)
