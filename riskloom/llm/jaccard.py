"""Similarity join of word-shingle sets: a grouped prefix join, and the components of its links.

Two documents link when their sets' Jaccard similarity reaches a percentage. In one order of all shingles
(rarest first, by counts over the whole corpus in hash buckets, more for more text) linked sets share a shingle
in their prefixes. Documents with equal sets are one class; classes with the same prefix and size are one
group, and only groups enter the index of prefix shingles. Lists that name one group alone are dropped;
the others are expanded to the member classes, and so is each group of several classes.

A list is then settled without forming all its pairs: its members are compared with one of them, the leader,
then with the next leader, and members already in one component need no comparison. After a few rounds lists
that are still open give all their remaining pairs between components, so no link between components is
missed. Sizes, positions in the prefix and
small bitmaps of the sets rule pairs out, within the join where pairs are formed, before the full sets of
the rest are compared. A class's full set is read from its text when a pair first asks for it.

Defined results: a null text, or one without words, has an empty set, links with nothing and is its own
component; a null id has no say in a component's smallest id; repeated rows have equal sets; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import MASK64, byte_slices, nothing, passing_tables, signed, staged, text_of, tidied
from riskloom.llm.components import components
from riskloom.llm.registers import BROADCAST_ROWS, shingle_sets

#: Text bytes for each bucket of shingle counts, and the least and most buckets; only the order hangs on them.
BYTES_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1536, 1 << 14, 1 << 20
#: Buckets of one row of counts.
PIECE = 1 << 12
#: Text bytes that are shingled at once.
SLICE = 1 << 20
#: Longs of a set's bitmap, in which every shingle flips one bit.
BITMAP = 16
#: Rounds of one leader for each open list, before the pairs that remain are formed.
ROUNDS = 2


def _counter(width: int, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.uint32)
        for batch in byte_slices(batches, "text", SLICE):
            np.add.at(counts, shingle_sets(batch.column("text"), width)[1] % np.uint64(buckets), np.uint32(1))
        pieces = counts.reshape(-1, PIECE)
        met = np.flatnonzero(pieces.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array([pieces[i].tobytes() for i in met], pa.binary())], ["piece", "counts"])

    return count


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            sums[piece] = sums.get(piece, 0) + np.frombuffer(counts, np.uint32).astype(np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["piece", "counts"])


def _shingle_counts(texts: DataFrame, width: int) -> np.ndarray:
    """In how many rows the shingles of each bucket are met; more buckets for more text, 8 MB at most."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = min(max(1 << (size // BYTES_PER_BUCKET).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)
    schema = "piece int, counts binary"
    rows = texts.select("text").mapInArrow(tidied(_counter(width, buckets)), schema).repartition("piece").mapInArrow(tidied(_summed), schema)
    counts = np.zeros((buckets // PIECE, PIECE), np.uint64)
    for r in rows.collect():  # at most MOST_BUCKETS / PIECE rows
        counts[r.piece] = np.frombuffer(r.counts, np.uint64)
    return counts.ravel()


SETS = "id long, text_hash long, n long, h1 long, h2 long, prefix_hash long, prefix array<long>, bits array<long>"


def _bitmap(own: np.ndarray) -> np.ndarray:
    """Bits set where an odd number of shingles falls: two sets differ in at least as many shingles as bits."""
    odd = np.bincount((own >> np.uint64(40)).astype(np.int64) % (64 * BITMAP), minlength=64 * BITMAP) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.view(np.int64)))


def _describer(width: int, percent: int, counts: np.ndarray):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rarest first; of equal counts, the smaller hash
        order = np.minimum(counts, (1 << 32) - 1).astype(np.uint32)
        for batch in byte_slices(batches, "text", SLICE):
            bounds, hashes = shingle_sets(batch.column("text"), width)
            ranks = order[hashes % np.uint64(len(order))]
            sizes, prefixes, maps = np.diff(bounds), [], []
            for a, b, n in zip(bounds, bounds[1:], sizes, strict=False):
                own = hashes[a:b]
                prefixes.append(own[np.argsort(ranks[a:b], kind="stable")[: n - -(-n * percent // 100) + 1]])
                maps.append(_bitmap(own))
            whole = [xxhash.xxh3_128_intdigest(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            numbers = [[signed(w >> 64) for w in whole], [signed(w & MASK64) for w in whole], [signed(xxhash.xxh3_64_intdigest(p)) for p in prefixes]]
            columns = [pa.array(sizes), *[pa.array(v, pa.int64()) for v in numbers], _lists(prefixes), _lists(maps)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), *columns], ["id", "text_hash", "n", "h1", "h2", "prefix_hash", "prefix", "bits"])

    return describe


def _reader(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", SLICE):
            bounds, hashes = shingle_sets(batch.column("text"), width)
            own = pa.array([hashes[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("class"), own], ["class", "own"])

    return read


def _in_both(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in batches:
        yield pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True)) for x, y in zip(a, b, strict=True)], dtype="int64")


_common = F.pandas_udf(tidied(_in_both), T.LongType())


def _open_lists(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(list, class, n, place) of the lists with several classes: prefix shingles, and groups as lists of their own."""
    groups = classes.groupBy("n", "prefix_hash").agg(F.min("class").alias("gid"), F.count("*").alias("classes"))
    members = staged(classes.join(groups, ["n", "prefix_hash"]).select("class", "gid", "n", "classes"), "members")
    index = (
        sets.join(groups.select("gid"), sets["row"] == F.col("gid"))  # a group's prefix is that of its first class
        .select("gid", F.posexplode("prefix").alias("place", "list"))
    )
    index = staged(index, "prefixes")
    shared = index.groupBy("list").agg(F.count("*").alias("groups")).where("groups > 1").select("list")
    across = index.join(shared, "list").join(members, "gid").select("list", "class", "n", "place")
    within = members.where("classes > 1").select(F.xxhash64("gid", F.lit("group")).alias("list"), "class", "n", F.lit(0).alias("place"))
    return staged(across.unionAll(within), "lists")


def _may_link(percent: int) -> str:
    """Whether sizes and places in the prefixes leave room for a link."""
    overlap = "least(place, lead_place) + 1 + least(n - place, lead_n - lead_place) - 1"
    return f"100 * least(n, lead_n) >= {percent} * greatest(n, lead_n) AND {100 + percent} * ({overlap}) >= {percent} * (n + lead_n)"


def _bits_allow(percent: int, a: str, b: str) -> Column:
    """Whether the bitmaps leave room for a link: sets share at most half of their sizes less the bits that differ."""
    apart = reduce(add, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITMAP)])
    sizes = F.col("n") + F.col("lead_n")
    return (100 + percent) * (sizes - apart) >= 2 * percent * sizes


def _sets_of(pairs: DataFrame, bodies: DataFrame, wanted: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The full sets of the classes in `pairs`, and of those asked for before."""
    new = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(bodies, "class", "left_anti")
    first = staged(new.join(wanted, "class").select("class", F.col("id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash")), "first")
    rows = first.count()
    if not rows:
        return bodies
    if rows <= BROADCAST_ROWS:  # else the texts are exchanged by their ids
        first = F.broadcast(first)
    found = texts.join(first, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash"))).select("class", "text")
    # rows that are the same in id and text give a class the same set more than once
    found = found.mapInArrow(tidied(_reader(width)), "class long, own binary").groupBy("class").agg(F.first("own").alias("own"))
    return bodies.unionAll(staged(found, "bodies"))


def _near_roots(links: DataFrame) -> DataFrame:
    """(node, root) of linked nodes by two steps along the links: one root means one component, not the reverse."""
    up = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    above = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return up.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def _similar(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, label, least_id) of every row: one label for each component, null for empty sets."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    counts = _shingle_counts(texts, width)
    sets = staged(texts.mapInArrow(tidied(_describer(width, percent, counts)), SETS).withColumn("row", F.monotonically_increasing_id()), "sets")
    classes = sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("row").alias("class"), F.min("id").alias("least_id"), F.min("prefix_hash").alias("prefix_hash"))
    classes = staged(classes, "classes")
    lists = _open_lists(sets, classes)

    wanted = sets.join(lists.select(F.col("class").alias("row")).distinct(), "row", "left_semi")
    wanted = staged(wanted.select(F.col("row").alias("class"), "id", "text_hash", "bits"), "wanted")
    bitmaps = wanted.select("class", "bits")
    bodies = nothing(spark, "class long, own binary")

    links = tested = nothing(spark, "a long, b long")
    roots = nothing(spark, "node long, root long")
    for turn in range(ROUNDS + 1):
        marked = lists.join(roots, lists["class"] == roots["node"], "left").select(*lists.columns, F.coalesce("root", "class").alias("label"))
        marked = staged(marked, "marked")
        spans = marked.groupBy("list").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct("class", "n", "place", "label")).alias("lead")).where("lo < hi")
        open_ = marked.join(spans.select("list", "lead"), "list")
        if turn < ROUNDS:
            led = open_.select("list", "class", "n", "place", "label", F.col("lead.class").alias("lead"), F.col("lead.n").alias("lead_n"), F.col("lead.place").alias("lead_place"), F.col("lead.label").alias("lead_label"))
        else:
            member = open_.drop("lead").join(bitmaps.select("class", F.col("bits").alias("own_bits")), "class")
            other = member.select("list", F.col("class").alias("lead"), F.col("n").alias("lead_n"), F.col("place").alias("lead_place"), F.col("label").alias("lead_label"), F.col("own_bits").alias("lead_bits"))
            # all tests on a pair are part of the join, which yields only pairs that may link
            led = member.join(other, "list").where("class > lead AND label <> lead_label").where(_may_link(percent)).where(_bits_allow(percent, "own_bits", "lead_bits"))
        pairs = led.where("class <> lead AND label <> lead_label").where(_may_link(percent)).select(F.col("class").alias("a"), F.col("lead").alias("b"), "n", "lead_n").distinct()
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = pairs.join(bitmaps.select(F.col("class").alias("a"), F.col("bits").alias("bits_a")), "a").join(bitmaps.select(F.col("class").alias("b"), F.col("bits").alias("bits_b")), "b")
        pairs = staged(pairs.where(_bits_allow(percent, "bits_a", "bits_b")).select("a", "b", "n", "lead_n"), "pairs")
        bodies = _sets_of(pairs, bodies, wanted, texts, width)
        left = bodies.select(F.col("class").alias("a"), F.col("own").alias("own_a"))
        right = bodies.select(F.col("class").alias("b"), F.col("own").alias("own_b"))
        compared = pairs.join(left, "a").join(right, "b").withColumn("common", _common("own_a", "own_b"))
        found = compared.where(f"{100 + percent} * common >= {percent} * (n + lead_n)").select("a", "b")
        links = staged(links.unionAll(found), "linked")
        if turn == ROUNDS:
            break
        tested = tested.unionAll(pairs.select("a", "b"))
        lists = staged(open_.where(F.col("class") != F.col("lead.class")).select("list", "class", "n", "place"), "lists")
        if lists.isEmpty():
            break
        # labels only spare comparisons until all pairs are formed, which takes true components
        roots = staged(_near_roots(links) if turn + 1 < ROUNDS else components(links), "roots")
    roots = components(links)

    named = classes.join(roots, classes["class"] == roots["node"], "left").select("h1", "h2", "n", "least_id", F.coalesce("root", "class").alias("label"))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_set = named.join(least, "label").select("h1", "h2", "n", "label", F.col("component_id").alias("least_id"))
    return sets.select("id", "text_hash", "n", "h1", "h2").join(by_set, ["h1", "h2", "n"], "left").drop("h1", "h2")


def join_similar(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its set's size and `component_id`, the smallest id reachable by links."""
    found = _similar(docs, width, percent, id_col, text_col)
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least_id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_similar(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one of each component, and all rows with an empty set.

    The row with the smallest id stays, a null id only where there is no other; of several texts under that id,
    the one with the smallest hash; of rows that are the same in id and text, any one.
    """
    with passing_tables() as keep:
        found = staged(_similar(docs, width, percent, id_col, text_col).where("n > 0"), "similar")
        best = found.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("best"))
        rows = found.groupBy("label", "id", "text_hash").agg(F.count("*").alias("rows")).join(best, "label")
        stays = F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.text_hash") == F.col("text_hash"))
        marks = rows.select(F.col("id").alias("mark_id"), F.col("text_hash").alias("mark_hash"), stays.alias("stays"), "rows")
        marks = keep(staged(marks.where("NOT stays OR rows > 1"), "marks"))
    carried = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried")
    inner = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"), carried)
    match = F.col("id").eqNullSafe(F.col("mark_id")) & (F.col("text_hash") == F.col("mark_hash"))
    kept = inner.join(marks, match, "left_anti").select("carried")
    repeated = marks.where("stays")
    if not repeated.isEmpty():
        kept = kept.unionAll(inner.join(repeated, match, "left_semi").groupBy("id", "text_hash").agg(F.first("carried").alias("carried")).select("carried"))
    return kept.select(*[F.col(f"carried.`{c}`").alias(c) for c in docs.columns])
