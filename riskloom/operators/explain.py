"""Explanations: per-row contributions folded to source columns, ranked, and put in words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.evaluate import top_rows
from riskloom.operators.ordered import first_rows
from riskloom.operators.presets import APPLICATION_CATEGORIES

TOP_FACTORS = 5
BACKGROUND_ROWS = 200

# Reason texts per feature, and the text for any other feature.
REASONS = {
    "credit_risk_score": "Высокий кредитный риск увеличил итоговый риск операции (SHAP=%s)",
    "velocity_24h_to_6h_ratio": "Нестандартная динамика активности за 24 часа повысила риск (SHAP=%s)",
    "risk_low_similarity_free_email": "Низкая схожесть имени и e-mail при бесплатной почте повысила риск (SHAP=%s)",
    "risk_foreign_and_device_fraud": "Иностранный запрос в сочетании с историей fraud-устройства повысил риск (SHAP=%s)",
    "device_fraud_count": "История мошеннической активности устройства повысила риск (SHAP=%s)",
    "proposed_credit_limit": "Запрошенный кредитный лимит увеличил риск (SHAP=%s)",
    "payment_type": "Тип платежа оказал влияние на повышение риска (SHAP=%s)",
    "device_os": "Характеристика операционной системы устройства повлияла на риск (SHAP=%s)",
}
OTHER_REASON = "Признак '%s' повысил риск (SHAP=%s)"


def source_column(name: str, categories: Sequence[str] = tuple(APPLICATION_CATEGORIES)) -> str:
    return next((c for c in categories if name.startswith(f"{c}_")), name)


def source_column_of(c: Column, categories: Sequence[str] = tuple(APPLICATION_CATEGORIES)) -> Column:
    """Encoded name to source column. Encoded flags outside the categories keep their name."""
    out = None
    for name in categories:
        out = (F if out is None else out).when(c.startswith(f"{name}_"), F.lit(name))
    return c if out is None else out.otherwise(c)


def fold_contributions(
    df: DataFrame,
    row_id: str = "row_id",
    feature: str = "feature",
    value: str = "shap_value",
    categories: Sequence[str] = tuple(APPLICATION_CATEGORIES),
) -> DataFrame:
    """Long contributions summed per row and source column."""
    return df.groupBy(row_id, source_column_of(F.col(feature), categories).alias("feature")).agg(
        F.sum(value).alias("shap_value")
    )


def factor(feature: Column, value: Column) -> Column:
    return F.struct(
        feature.alias("feature"),
        value.alias("shap_value"),
        F.abs(value).alias("abs_shap_value"),
        F.when(value > 0, "increase_risk").otherwise("decrease_risk").alias("direction"),
    )


def ranked_factors(folded: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Factors per row ranked by size, names deciding among equals."""
    return all_factors(folded, row_id).select(row_id, F.posexplode("factors").alias("_pos", "f")).select(
        row_id, "f.*", (F.col("_pos") + 1).alias("rank")
    )


def _by_size(factors: Column) -> Column:
    keyed = F.transform(factors, lambda f: F.struct((-f["abs_shap_value"]).alias("o"), f["feature"].alias("n"), f.alias("f")))
    return F.transform(F.sort_array(keyed), lambda k: k["f"])


def all_factors(folded: DataFrame, row_id: str = "row_id") -> DataFrame:
    """One row per row id with all its factors, largest first; a row has at most one per source column."""
    return folded.groupBy(row_id).agg(
        _by_size(F.collect_list(factor(F.col("feature"), F.col("shap_value")))).alias("factors")
    )


def explanation_columns(factors: Column, top_k: int = TOP_FACTORS) -> dict[str, Column]:
    return {
        "top_positive_factors": F.slice(F.filter(factors, lambda f: f["shap_value"] > 0), 1, top_k),
        "top_negative_factors": F.slice(F.filter(factors, lambda f: f["shap_value"] < 0), 1, top_k),
        "raw_top_features": F.slice(factors, 1, top_k),
    }


def explain_rows(folded: DataFrame, row_id: str = "row_id", top_k: int = TOP_FACTORS) -> DataFrame:
    out = all_factors(folded, row_id)
    return out.select(row_id, *[c.alias(n) for n, c in explanation_columns(F.col("factors"), top_k).items()])


def reason_text(f: Column) -> Column:
    templates = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    shown = F.format_string("%.4f", f["shap_value"])
    known = F.replace(F.try_element_at(templates, f["feature"]), F.lit("%s"), shown)
    head, middle, tail = OTHER_REASON.split("%s")
    return F.coalesce(known, F.concat(F.lit(head), f["feature"], F.lit(middle), shown, F.lit(tail)))


def with_reasons(explained: DataFrame, factors: str = "top_positive_factors") -> DataFrame:
    return explained.withColumn("human_readable_reasons", F.transform(F.col(factors), reason_text))


def write_explanations(explained: DataFrame, path: str) -> str:
    explained.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def global_importance(df: DataFrame, top: int = 15, feature: str = "feature", value: str = "shap_value") -> DataFrame:
    """Mean absolute contribution per encoded feature, the largest first."""
    return (
        df.groupBy(F.col(feature).alias("feature"))
        .agg(F.avg(F.abs(F.col(value))).alias("mean_abs_shap"))
        .orderBy(F.col("mean_abs_shap").desc(), F.col("feature"))
        .limit(top)
    )


def explanation_sample(scored: DataFrame, rows: int = 500, score: str = "prediction_score", row_id: str = "row_id") -> DataFrame:
    """The rows with the highest scores."""
    return top_rows(scored, rows, score=score, row_id=row_id)


def background_means(encoded: DataFrame, width: int, vector: str = "features") -> list[float]:
    """Mean of the encoded background rows, one number per encoded feature; 0 without rows."""
    values = encoded.select(vector_to_array(vector).alias("x"))
    row = values.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(width)]).first()
    return [0.0 if m is None else float(m) for m in row]


def background_rows(df: DataFrame, order: Sequence[str], rows: int = BACKGROUND_ROWS) -> DataFrame:
    return first_rows(df, order, rows)


def folded_factors(
    parts: Sequence[Column], names: Sequence[str], categories: Sequence[str] = tuple(APPLICATION_CATEGORIES)
) -> Column:
    """One contribution per encoded feature to the row's ranked factors: no shuffle, however many rows."""
    groups: dict[str, list[Column]] = {}
    for part, name in zip(parts, names, strict=True):
        groups.setdefault(source_column(name, categories), []).append(part)
    sums = [F.struct(F.lit(g).alias("n"), reduce(add, members).alias("v")) for g, members in groups.items()]
    keyed = F.transform(F.array(*sums), lambda f: F.struct((-F.abs(f["v"])).alias("o"), f["n"].alias("n"), f["v"].alias("v")))
    return F.transform(F.sort_array(keyed), lambda f: factor(f["n"], f["v"]))


def long_contributions(df: DataFrame, row_id: str, contributions: str, names: Sequence[str]) -> DataFrame:
    """Contribution arrays as long rows (row id, encoded feature, value)."""
    labels = F.array(*[F.lit(n) for n in names])
    return df.select(row_id, F.posexplode(contributions).alias("_pos", "shap_value")).select(
        row_id, F.element_at(labels, F.col("_pos") + 1).alias("feature"), "shap_value"
    )
