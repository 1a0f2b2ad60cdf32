"""Fingerprints of documents: Merkle trees over blocks, paragraphs and sections.

A paragraph is a line and is cut into blocks of 64 code points; a section is 16 paragraphs. Each node's hash
is SHA-256 over its children's, and the root's stands for the text. A fingerprint is the root, a colon, and
the leading digits of the block hashes, paragraph by paragraph between slashes: equal roots mean equal texts,
and the first branches that differ tell where an edit lies. The likeness of two fingerprints is the share of
their distinct blocks that they have in common (Dice), 1 for equal roots.

Defined results: a null text counts as empty, and an empty text has one paragraph without blocks; two texts
without blocks are alike only if equal. In the order of documents, by id from the largest, null ids come
last, rows with one id are ordered by text, and after the last comes the first. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_of

BLOCK = 64
SECTION = 16
DIGITS = 8
LOWEST = "(-9223372036854775807L - 1L)"


def with_tree(rows: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with `name`: root, section and paragraph hashes, and block hashes by paragraph.

    Each level is a projection of its own, so that it is worked out once.
    """
    hashed = lambda kind, parts: F.sha2(F.concat(F.lit(kind), F.array_join(parts, "")), 256)
    blocks, paragraphs, sections = (f"__{name}_{x}" for x in ("b", "p", "s"))
    keep = rows.columns
    rows = rows.withColumn(blocks, F.transform(F.split(F.col(text), "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), lambda b: F.sha2(b, 256))))
    rows = rows.withColumn(paragraphs, F.transform(F.col(blocks), lambda b: hashed("p", b)))
    starts = F.sequence(F.lit(1), F.size(paragraphs), F.lit(SECTION))
    rows = rows.withColumn(sections, F.transform(starts, lambda i: hashed("s", F.slice(F.col(paragraphs), i, SECTION))))
    tree = F.struct(hashed("r", F.col(sections)).alias("root"), F.col(sections).alias("sections"), F.col(paragraphs).alias("paragraphs"), F.col(blocks).alias("blocks"))
    return rows.select(*[F.col(f"`{c}`") for c in keep], tree.alias(name))


def printed(tree: Column) -> Column:
    """The tree as text."""
    short = F.transform(tree["blocks"], lambda p: F.array_join(F.transform(p, lambda b: F.substring(b, 1, DIGITS)), ""))
    return F.concat(tree["root"], F.lit(":"), F.array_join(short, "/"))


def likeness(a: Column, b: Column, root_a: Column, root_b: Column) -> Column:
    """Of two arrays of distinct leading digits of blocks."""
    both = F.size(F.array_intersect(a, b)) * F.lit(2.0) / F.greatest(F.size(a) + F.size(b), F.lit(1))
    return F.when(root_a == root_b, F.lit(1.0)).otherwise(both)


def leaves(tree: Column) -> Column:
    return F.array_distinct(F.transform(F.flatten(tree["blocks"]), lambda b: F.substring(b, 1, DIGITS)))


def differing(a: Column, b: Column) -> Column:
    """Numbers, from 0, of the paragraphs of b that differ from a's in that place, sections first compared."""
    places = F.sequence(F.lit(0), F.greatest(F.size(a["paragraphs"]), F.size(b["paragraphs"])) - 1)
    same_section = lambda i: F.get(a["sections"], F.floor(i / SECTION).cast("int")).eqNullSafe(F.get(b["sections"], F.floor(i / SECTION).cast("int")))
    same = lambda i: F.get(a["paragraphs"], i).eqNullSafe(F.get(b["paragraphs"], i))
    return F.filter(places, lambda i: ~(same_section(i) | same(i)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, tree, next_text, next_leaves, next_root) of every row: the next one by descending id.

    Ids are cut into ranges at ids that exist, so the first row of a range is known beforehand and travels
    also to the range before it: texts are exchanged once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.expr(LOWEST)).alias("place"))
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = [i / ranges for i in range(1, ranges)] or [0.5]
    found = rows.agg(F.percentile_approx("place", cuts, 10 * ranges + 1000).alias("cuts"), F.max("place").alias("top")).first()
    bounds, top = sorted(set(found.cuts or [])), found.top if found.top is not None else 0
    literal = lambda v: f"{v}L" if v > -(1 << 63) else LOWEST
    width = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)] or [[top]]
    firsts = F.expr("array(" + ", ".join(literal(g[0]) for g in groups) + ")")
    inner = F.expr("array(" + ", ".join("array(" + ", ".join(map(literal, g)) + ")" for g in groups) + ")")
    place = F.col("place")
    at = F.size(F.filter(firsts, lambda b: b < place))  # groups that begin below
    below = F.when(at == 0, 0).otherwise((at - 1) * width + F.size(F.filter(F.element_at(inner, F.greatest(at, F.lit(1))), lambda b: b < place)))
    rows = rows.withColumn("range", below)
    bound = F.get(F.flatten(inner), F.col("range"))
    # late 1: the first row of the range below; late 2: the first row of all, after the last
    goes = F.array(
        F.struct(F.col("range").alias("to"), F.lit(0).alias("late")),
        F.when((bound == place) & F.lit(bool(bounds)), F.struct((F.col("range") + 1).alias("to"), F.lit(1).alias("late"))),
        F.when(place == F.expr(literal(top)), F.struct(F.lit(0).alias("to"), F.lit(2).alias("late"))),
    )
    sent = rows.select("id", "place", "text", F.explode(F.array_compact(goes)).alias("go")).select("id", "place", "text", "go.to", "go.late")
    sent = with_tree(sent.repartition(ranges, "to"), "text", "tree").withColumn("leaves", leaves(F.col("tree")))
    over = "OVER (PARTITION BY to ORDER BY late, place DESC, text)"
    return sent.select(
        "*", F.expr(f"lead(text) {over}").alias("next_text"), F.expr(f"lead(leaves) {over}").alias("next_leaves"), F.expr(f"lead(tree.root) {over}").alias("next_root")
    ).where("late = 0")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text whose last half is taken from the next document's start."""
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    edited = "concat(substring(text, 1, CAST(n_chars - n_chars DIV 2 AS INT)), substring(next_text, 1, CAST(n_chars DIV 2 AS INT)))"
    rows = with_tree(rows.withColumn("edited", F.expr(edited)), "edited", "edited_tree")
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        printed(F.col("tree")).alias("fingerprint"),
        printed(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("leaves"), leaves(F.col("edited_tree")), F.col("tree.root"), F.col("edited_tree.root")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next_leaves"), F.col("tree.root"), F.col("next_root")).alias("near_next"),
    )
