"""Stratified splits, imputation values, class weights, encoding stages and the dummy matrix."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import to_number
from riskloom.operators.clean import numeric_columns
from riskloom.operators.ordered import with_row_index
from riskloom.operators.quantiles import exact_medians

MAX_CATEGORIES = 20


def class_quotas(counts: dict, share: float) -> dict:
    """Test rows per class: proportional whole parts, the rest to the largest remainders."""
    rows = sum(counts.values())
    wanted = math.ceil(rows * share)
    exact = {c: wanted * n / rows for c, n in counts.items()}
    quota = {c: math.floor(v) for c, v in exact.items()}
    left = wanted - sum(quota.values())
    for c in sorted(counts, key=lambda c: (quota[c] - exact[c], str(c)))[:left]:
        quota[c] += 1
    return quota


def stratified_split(
    df: DataFrame, target: str, row_id: Sequence[str], *, test_share: float = 0.15, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Random split with an exact test quota per class.

    Rows get a position by (class, hash, id); a class may hold nearly all rows, as positions do not
    come from a window over the class.
    """
    counts = {r[0]: r[1] for r in df.groupBy(target).agg(F.count(F.lit(1))).collect()}
    quota = class_quotas(counts, test_share)
    hashed = df.withColumn("_hash", F.xxhash64(*row_id, F.lit(seed)))
    frame = with_row_index(hashed, [target, "_hash", *row_id], "_position").frame
    border, label = 0, F.lit(False)
    for value in sorted(counts, key=lambda v: (v is None, v)):
        label = label | F.col("_position").between(border, border + quota[value] - 1)
        border += counts[value]
    return frame.withColumn(name, F.when(label, "test").otherwise("train")).drop("_position", "_hash")


def medians(train: DataFrame, columns: Sequence[str], **options) -> dict[str, float | None]:
    return exact_medians(train, columns, **options)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and text value, nulls left out; one pass for all columns."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(entries).alias("e"))
        .select("e.*")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(train: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """The commonest value per column, the smallest among equals."""
    if not columns:
        return {}
    best = value_counts(train, columns).groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    )
    found = {r["column"]: r["value"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def impute(df: DataFrame, numbers: dict[str, float | None], texts: dict[str, str | None], prefix: str = "") -> DataFrame:
    """Fill missing values with fitted ones. With a prefix the inputs stay and filled copies are added."""
    filled = {f"{prefix}{c}": F.coalesce(to_number(c), F.lit(v).cast("double")) for c, v in numbers.items()}
    filled |= {f"{prefix}{c}": F.coalesce(F.col(c).cast("string"), F.lit(v).cast("string")) for c, v in texts.items()}
    return df.withColumns(filled)


def positive_weight(df: DataFrame, target: str) -> float:
    """Negatives per positive; 1 when there is no positive."""
    row = df.agg(F.count_if(F.col(target) == 1).alias("p"), F.count_if(F.col(target) == 0).alias("n")).first()
    return row["n"] / row["p"] if row["p"] else 1.0


def balanced_weights(df: DataFrame, target: str) -> dict[int, float]:
    """Rows over twice the rows of the class."""
    counts = {int(r[0]): r[1] for r in df.groupBy(target).agg(F.count(F.lit(1))).collect()}
    rows = sum(counts.values())
    return {c: rows / (len(counts) * n) for c, n in counts.items()}


def encoding_stages(numerical: Sequence[str], categorical: Sequence[str], output: str = "features") -> list:
    """Index and one-hot stages (an unseen category is all zeros) and the assembly: numbers, then categories."""
    stages = []
    if categorical:
        indexed, hot = [f"{c}_index" for c in categorical], [f"{c}_hot" for c in categorical]
        stages += [
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
    else:
        hot = []
    stages.append(VectorAssembler(inputCols=[*numerical, *hot], outputCol=output, handleInvalid="keep"))
    return stages


def encoding(numerical: Sequence[str], categorical: Sequence[str], output: str = "features") -> Pipeline:
    return Pipeline(stages=encoding_stages(numerical, categorical, output))


def encoded_names(numerical: Sequence[str], categorical: Sequence[str], stages: Sequence) -> list[str]:
    """Names of the assembled vector: `column` or `column_category`."""
    names = list(numerical)
    indexer = next((s for s in stages if isinstance(s, StringIndexerModel)), None)
    if indexer is not None:
        for c, labels in zip(categorical, indexer.labelsArray, strict=True):
            names += [f"{c}_{label}" for label in labels]
    return names


@dataclass(frozen=True)
class DummyMatrix:
    frame: DataFrame
    columns: list[str]


def dummy_matrix(
    df: DataFrame,
    target: str | None = None,
    drop: Sequence[str] = (),
    *,
    keep: Sequence[str] = (),
    max_categories: int = MAX_CATEGORIES,
) -> DummyMatrix:
    """A numeric matrix: numbers with medians for gaps, and 0/1 columns for categories of 2..20 values.

    Columns that are empty or constant are left out. `keep` names columns carried along unchanged.
    """
    body = df.drop(*drop, *([target] if target else []), *keep)
    numbers = numeric_columns(body)
    switches = [f.name for f in body.schema.fields if isinstance(f.dataType, T.BooleanType)]
    texts = [f.name for f in body.schema.fields if isinstance(f.dataType, T.StringType)]
    plain = {c: F.col(c).cast("double") for c in [*numbers, *switches]}

    profile = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(plain):
        value = to_number(plain[c])
        profile += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"), F.count(value).alias(f"n{i}")]
    for i, c in enumerate(texts):
        profile.append(F.count(c).alias(f"t{i}"))
    seen = body.agg(*profile).first()
    rows = seen["rows"]

    useful = []
    for i, c in enumerate(plain):
        filled = seen[f"n{i}"]
        if filled and (seen[f"lo{i}"] != seen[f"hi{i}"] or filled < rows):
            useful.append(c)
    finite = {c: F.when(F.abs(to_number(plain[c])) < math.inf, to_number(plain[c])) for c in useful}
    middle = exact_medians(body.select(*[v.alias(c) for c, v in finite.items()]), useful) if useful else {}

    out: dict[str, Column] = {c: F.coalesce(finite[c], F.lit(middle[c])) for c in useful}
    for c, values, filled in _small_categories(body, texts, [seen[f"t{i}"] for i in range(len(texts))], max_categories):
        for value, n in values:
            if n < rows:
                out[f"{c}_{value}"] = F.coalesce(F.col(c) == value, F.lit(False)).cast("int")
        if 0 < filled < rows:
            out[f"{c}_nan"] = F.col(c).isNull().cast("int")
    frame = df.select(*keep, *([target] if target else []), *[v.alias(n) for n, v in out.items()])
    return DummyMatrix(frame, list(out))


def _small_categories(df: DataFrame, texts: Sequence[str], filled: Sequence[int], limit: int):
    """Categories with 2..limit values and their counts; only those values come to the driver."""
    if not texts:
        return []
    counts = value_counts(df, texts)
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct")).where(F.col("distinct").between(2, limit))
    rows = counts.join(F.broadcast(sizes), "column").collect()
    present = {c: n for c, n in zip(texts, filled, strict=True)}
    out = []
    for c in texts:
        values = sorted((r["value"], r["n"]) for r in rows if r["column"] == c)
        if values:
            out.append((c, values, present[c]))
    return out
