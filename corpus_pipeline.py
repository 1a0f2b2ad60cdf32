"""Prepares a training corpus from `documents`: each stage reads what the one before wrote.

Rows the quality classifier rejects go; of equal texts one stays; of texts that are near copies one stays;
the domains are brought to their target shares by keeping or leaving out documents of those that have too
much, while plain documents stay; and what is left is packed into sequences.

Defined results: a null text counts as empty; empty texts are scored by the classifier like others, are one text
to the exact copies and have no near copies. A null doc_id is a row like others: it is kept only where no copy has
an id, is never labelled, and is packed. Of ties the smallest doc_id stays, of rows that are the same in id and text
one. Extra columns are carried along to the last stage. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import exact, jaccard, mixing, packing, quality
from riskloom.llm.common import documents, labels, passing_tables, small_batches, staged
from riskloom.llm.queries import domains, vocabulary_files

#: Wanted shares of the tokens; plain documents keep theirs.
MIX = {"plain": 0.96, "junk": 0.01, "toxic": 0.03}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    small_batches(spark)
    model = quality.train(docs, labels(spark, sf_dir))
    return quality.with_scores(docs, model, score="__score").where(F.col("__score") >= quality.THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    small_batches(spark)
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of similar texts (five words, 0.8)."""
    small_batches(spark)
    return jaccard.drop_similar(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates that bring the domains to their shares; no document is taken twice."""
    names = ("__n", "__p", "__rate")
    classifier = mixing.fit_domains(docs, domains(spark, sf_dir))
    rated = mixing.fit_rates(docs, classifier, MIX, least=0.0, most=1.0, anchor="plain", names=names)
    return mixing.drawn(rated, names=names).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    small_batches(spark)
    return packing.pack(docs, *vocabulary_files())


STAGES = [("quality", keep_good), ("exact_copies", drop_copies), ("near_copies", drop_near_copies), ("mix", mix), ("pack", pack)]

#: The classifier, the mixture and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with passing_tables() as keep:
            docs = keep(staged(stage(spark, docs, sf_dir), f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
