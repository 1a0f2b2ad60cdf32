"""Merkle manifest of a table: a leaf for each row, a subtree for each source, one root, and a proof for each row.

Leaves are hashed by SQL functions and placed by one range exchange on (source, id): a task's first position
follows from the counts of the tasks before it. Places are cut into superblocks of 3^6 consecutive nodes of a
source. Upwards, each superblock is reduced to one node, and the nodes of all superblocks are placed and
reduced in the same way until every source has its subroot; subroots, placed by source, give the root by the
same steps. Downwards, the nodes of a superblock and the outer node that stands for it, with its siblings up
to the root, are cogrouped: the group does the local levels again, joins the outer part to each proof, and
folds each row's proof over the leaf that is to be verified. Only superblocks meet in a task, so a hot source
is as many groups as any rows of that number, and the jobs grow with the logarithm of the rows.

Defined results: a null in a leaf's column counts as `-`; a null source is a source of its own, the first; null
ids come first in their source and are never tampered with; rows of one source and id are ordered by their leaf;
repeated rows are leaves of their own, with proofs that may differ; one row is its own subroot and root with
an empty proof; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import staged

#: Nodes of a run, and levels within a superblock.
ARITY = 3
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: What stands for the key of the tree of subroots.
TOP = "top"


def _h(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(*columns: Column) -> Column:
    """SHA-256 of the values, each with its byte count before it."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def key_of(source: Column) -> Column:
    """A text that is never null and tells the null source from any other."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source))


def placed(rows: DataFrame, group: str | None, order: list[Column], label: str) -> DataFrame:
    """`pos` of each row within its group, from 0, and the group's `total`; groups and their rows by `order`.

    One range exchange; the rows are staged with the task that holds them, so that a lost task is read again
    and not dealt anew.
    """
    dealt = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), f"{label}-dealt")
    dealt = dealt.withColumn("__task", F.shiftright("__at", 33))
    keys = ["__task"] if group is None else [group, "__task"]
    counts = dealt.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__at").alias("__least"))
    over = Window.partitionBy(F.lit(0) if group is None else F.col(group))
    before = F.coalesce(F.sum("__n").over(over.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(k).alias(f"{k}_") for k in keys], (before - F.col("__least")).alias("__shift"), F.sum("__n").over(over).alias("total"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"{k}_"))
    return dealt.join(counts, same).select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("pos"), "total")


def _levels(nodes: list[str], total: int, depth: int) -> list[list[str]]:
    """The levels from a superblock's nodes to the one that stands for them: all `depth` if the key has other superblocks."""
    more = total > ARITY**depth
    levels = [nodes]
    while len(levels) <= depth and (more or len(levels[-1]) > 1):
        last = levels[-1]
        levels.append([_h(last[i : i + ARITY]) for i in range(0, len(last), ARITY)])
    return levels


def _reduce(block: pd.DataFrame, depth: int) -> pd.DataFrame:
    block = block.sort_values("pos")
    first = block.iloc[0]
    return pd.DataFrame({"key": [first.key], "pos": [first.block], "node": [_levels(block.node.tolist(), first.total, depth)[-1][0]], "total": [-(-first.total // ARITY**depth)]})


def fold(node: str, path: str) -> str:
    """The root that a node and its siblings give; a path has one `place:siblings` a level."""
    for level in path.split("/") if path else ():
        place, _, others = level.partition(":")
        at = int(place) * 64
        node = _h([others[:at], node, others[at:]])
    return node


def _local_paths(nodes: list[str], total: int, depth: int) -> list[str]:
    levels = _levels(nodes, total, depth)
    paths = []
    for place in range(len(nodes)):
        steps = []
        for level in levels[:-1]:
            start = place - place % ARITY
            others = level[start:place] + level[place + 1 : start + ARITY]
            steps.append(f"{place - start}:{''.join(others)}")
            place //= ARITY
        paths.append("/".join(steps))
    return paths


def _joined(nodes: pd.DataFrame, outer: pd.DataFrame, depth: int) -> pd.DataFrame:
    """The nodes of one superblock with their paths to the root."""
    nodes = nodes.sort_values("pos")
    above = outer.iloc[0]
    paths = [f"{own}/{above.path}".strip("/") for own in _local_paths(nodes.node.tolist(), nodes.total.iloc[0], depth)]
    return nodes.assign(path=paths, subroot=above.subroot, root=above.root)


def _join_nodes(nodes: pd.DataFrame, outer: pd.DataFrame, depth: int) -> pd.DataFrame:
    return _joined(nodes, outer, depth)[["key", "pos", "path", "subroot", "root"]]


def _join_leaves(leaves: pd.DataFrame, outer: pd.DataFrame, depth: int) -> pd.DataFrame:
    rows = _joined(leaves, outer, depth)
    rows["proof_sha256"] = [_h([step.partition(":")[2] for step in path.split("/")]) for path in rows.path]
    rows["folded_root"] = [fold(leaf, path) for leaf, path in zip(rows.claimed, rows.path, strict=True)]
    rows["verified"] = rows.folded_root == rows.root
    return rows.rename(columns={"node": "leaf"})[["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]]


def _blocks(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / ARITY**depth).cast("long"))


def _up(nodes: DataFrame, depth: int, label: str) -> list[DataFrame]:
    """Tables of nodes (key, pos, node, total), from the given ones to one node for each key."""
    tables = [nodes]
    while tables[-1].where("total > 1").limit(1).count():
        blocks = _blocks(tables[-1], depth).select("key", "pos", "block", "node", "total").groupBy("key", "block")
        tables.append(staged(blocks.applyInPandas(lambda g: _reduce(g, depth), "key string, pos long, node string, total long"), label))
    return tables


def _exchange(nodes: DataFrame, outer: DataFrame, join, schema: str, depth: int) -> DataFrame:
    """Superblocks cogrouped with the outer node that stands for each."""
    return _blocks(nodes, depth).groupBy("key", "block").cogroup(outer.groupBy("key", "pos")).applyInPandas(lambda a, b: join(a, b, depth), schema)


def _down(tables: list[DataFrame], outer: DataFrame, depth: int, label: str) -> DataFrame:
    """Paths of the nodes of the first table, from `outer`, the paths of what the last table reduces to."""
    for nodes in reversed(tables):
        outer = staged(_exchange(nodes, outer, _join_nodes, "key string, pos long, path string, subroot string, root string", depth), label)
    return outer


def read_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, source, node, claimed): the leaf, and the leaf of a row whose line ends were deleted where `tampered`."""
    columns = {c: F.col(f"`{c}`") for c in FIELDS}
    cut = columns | {"text": F.translate(columns["text"].cast("string"), "\n", "")}
    leaf = leaf_of(*columns.values())
    return docs.select(
        columns["doc_id"].alias("doc_id"),
        columns["source"].cast("string").alias("source"),
        leaf.alias("node"),
        F.when(tampered, leaf_of(*cut.values())).alias("claimed"),
    )


def build(docs: DataFrame, tampered: Column, depth: int = LEVELS) -> DataFrame:
    """Leaf, subroot, root and proof digest of every row, and whether the row as it is claimed folds to the root.

    `tampered` marks the rows whose claimed text has lost its line ends; superblocks have 3^depth nodes.
    """
    leaves = read_leaves(docs, tampered).withColumn("claimed", F.coalesce("claimed", "node")).withColumn("key", key_of(F.col("source"))).withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("copy")]
    leaves = placed(staged(leaves, "leaves"), "key", order, "leaves").drop("copy", "source")
    kind = leaves.schema["doc_id"].dataType
    leaves = staged(leaves.withColumn("doc_id", F.col("doc_id").cast("string")), "placed")  # pandas has no null integers
    inner = _up(leaves, depth, "subtrees")

    subroots = inner[-1].select(F.col("key").alias("source_key"), F.col("node"))
    # `-` sorts before `=`, so the null source comes first, and the others by their bytes
    ranked = placed(subroots, None, [F.col("source_key")], "subroots").withColumn("key", F.lit(TOP))
    ranked = staged(ranked, "subroots")
    upper = _up(ranked.select("key", "pos", "node", "total"), depth, "top")
    root = upper[-1].select("key", "pos", F.lit("").alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    paths = _down(upper[:-1], root, depth, "paths").select("pos", "path", "root")
    outer = ranked.join(paths, "pos").select(F.col("source_key").alias("key"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"), "root")
    outer = _down(inner[1:-1], staged(outer, "outer"), depth, "outer")
    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _exchange(leaves, outer, _join_leaves, schema, depth).withColumn("doc_id", F.col("doc_id").cast(kind))
