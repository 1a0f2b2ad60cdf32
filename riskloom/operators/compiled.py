"""Fitted models over column expressions: no indexer, no encoder, no Python per row.

Encoded features are expressions over the filled inputs: a number is itself, a category is 1 where the text is
its label. The linear model is a sum with one look-up per category. Boosted trees walk a vector of the features;
their nodes, for attributions, come from the tables in which Spark ML keeps them (one row a node).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_folder


@dataclass(frozen=True)
class Feature:
    """One encoded feature: a filled input, and the label it must equal where it is a category."""

    source: str
    label: str | None = None

    def value(self) -> Column:
        if self.label is None:
            return F.col(f"`{self.source}`")
        return F.coalesce(F.col(f"`{self.source}`") == F.lit(self.label), F.lit(False)).cast("double")


def encoded_features(stages: Sequence, numerical: Sequence[str], categorical: Sequence[str]) -> list[Feature]:
    """The places of the assembled vector: numbers, then the labels of each category in the indexer's order."""
    features = [Feature(c) for c in numerical]
    indexer = next((s for s in stages if isinstance(s, StringIndexerModel)), None)
    if indexer is not None:
        for c, labels in zip(categorical, indexer.labelsArray, strict=True):
            features += [Feature(c, label) for label in labels]
    return features


@dataclass(frozen=True)
class Node:
    """A node of a tree; `left` is None at a leaf. Rows with a value up to `upto` go left, the others right.

    A split of a 0/1 feature by categories is one at 0.5, turned round where 1 goes left.
    """

    value: float
    cover: float
    feature: int = -1
    upto: float = 0.0
    left: Node | None = None
    right: Node | None = None


def read_trees(model, spark: SparkSession) -> list[tuple[float, Node]]:
    """(weight, root) of every tree of a boosted model."""
    path = f"{shared_folder(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes: dict[int, dict[int, object]] = {}
    for r in spark.read.parquet(f"{path}/data").collect():  # the model's own nodes, not data
        nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]

    def build(tree: dict, number: int) -> Node:
        n = tree[number]
        cover = float(n["impurityStats"][0])
        if n["leftChild"] < 0:
            return Node(n["prediction"], cover)
        left, right, split = build(tree, n["leftChild"]), build(tree, n["rightChild"]), n["split"]
        upto = split["leftCategoriesOrThreshold"]
        if split["numCategories"] >= 0:
            if sorted(upto) not in ([0.0], [1.0]) or split["numCategories"] != 2:
                raise ValueError("only numbers and 0/1 categories are encoded")
            left, right, upto = (right, left, [0.5]) if upto[0] == 1.0 else (left, right, [0.5])
        return Node(n["prediction"], cover, split["featureIndex"], float(upto[0]), left, right)

    return [(float(w), build(nodes[t], 0)) for t, w in enumerate(model.treeWeights)]


def tree_scores(model, df: DataFrame, columns: Sequence[str], features: Sequence[Feature]) -> DataFrame:
    """`columns` of the filled rows and `_margin`, the log-odds of a boosted model.

    The fitted trees walk a vector built from the features' expressions; of their outputs only the raw one is asked
    for. Nested conditions in place of the walk give the same numbers, but take seconds to plan for 300 trees.
    """
    walker = model.copy().setPredictionCol("").setProbabilityCol("").setRawPredictionCol("_raw").setFeaturesCol("_vector")
    rows = df.select(*columns, array_to_vector(F.array(*[f.value() for f in features])).alias("_vector"))
    return walker.transform(rows).select(*columns, (2 * vector_to_array("_raw")[1]).alias("_margin"))


def linear_margin(features: Sequence[Feature], coefficients: Sequence[float], intercept: float) -> Column:
    """Intercept, coefficient times number, and the coefficient of each category's label."""
    parts, labels = [F.lit(float(intercept))], {}
    for f, c in zip(features, map(float, coefficients), strict=True):
        if f.label is None:
            parts.append(f.value() * F.lit(c))
        else:
            labels.setdefault(f.source, []).append((f.label, c))
    for source, pairs in labels.items():
        table = F.create_map(*[F.lit(v) for pair in pairs for v in pair])
        parts.append(F.coalesce(F.try_element_at(table, F.col(f"`{source}`")), F.lit(0.0)))
    return reduce(add, parts)


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
