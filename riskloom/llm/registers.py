"""Near copies by HyperMinHash: compressed registers in bands, estimates, then the sets themselves.

A document's set holds its distinct word shingles as 64-bit hashes. The first bits of a hash choose one of
`REGISTERS` buckets; a bucket keeps its smallest hash, as its number of leading zeros and the `MANTISSA` bits
that follow. An empty bucket takes the register of the first filled one in an order of its own, so small sets
have as many comparable registers as large ones. Sets that agree in a band of neighbouring registers meet;
pairs are dropped by size, then by the share of equal registers, corrected for registers that agree by chance,
and what is left is confirmed on the full sets. Band width follows from the wanted similarity: a pair at it
shares no band with a probability of `MISS` at most. Documents with equal sets are one class from the start.

A bucket of many classes is not turned into all its pairs. In the first turn, over some of the bands, its members
are compared with the one that meets most others. Then components are known, and only buckets that still hold
several of them are opened. In `CENTRES` turns, members outside a bucket's largest component are compared with
one member of it. Those still outside are compared with the members they share one of their rarest shingles
with, where its places leave room for a link; this loses no pair.

Defined results: a null text, or one without words, has an empty set, links with nothing and is its own
component; a text of fewer words than a shingle is one shingle; a null id has no say in a component's smallest
id, and is kept where its component has no other id; repeated rows have equal sets; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import MASK64, SPACES, byte_slices, mixed, signed, staged, text_of
from riskloom.llm.components import components

#: Registers of a signature and the bits that choose one; bits kept after the leading zeros.
PLACE_BITS, MANTISSA = 7, 10
REGISTERS = 1 << PLACE_BITS
#: Probability that a pair at the wanted similarity shares no band.
MISS = 1e-6
#: An estimate may be so much below the wanted similarity: more than five standard deviations.
MARGIN = 0.2
#: Bands of the first turn, and further turns against single members of the largest component.
FIRST_BANDS, CENTRES = 8, 1
#: Classes whose texts are fetched by a broadcast of their ids, some 40 bytes each.
BROADCAST_ROWS = 200_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_RANDOM = np.random.default_rng(20)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_DONORS = np.array([_RANDOM.permutation(REGISTERS) for _ in range(REGISTERS)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True

#: Two different minima have the same register with this probability: equal zeros, then equal mantissas.
CHANCE = 1 / 3 / (1 << MANTISSA)


def band_rows(percent: int) -> int:
    """The most registers a band may have."""
    p = percent / 100
    return max([r for r in range(1, 33) if (1 - p**r) ** (REGISTERS // r) <= MISS], default=1)


def _word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in `data`, and where each text's words begin and the last end."""
    filled = np.flatnonzero(~_SPACE[data])
    first = np.ones(len(filled), bool)
    first[1:] = filled[1:] != filled[:-1] + 1
    edges = np.searchsorted(filled, offsets)
    first[edges[:-1][edges[:-1] < len(filled)]] = True
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    sizes = np.diff(starts, append=len(filled))
    place = np.arange(len(filled)) - np.repeat(starts, sizes)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(sizes.max()) - 1, _BASE)]), dtype=np.uint64)
    hashes = np.add.reduceat(_BYTES[_LOWER[data[filled]]] * powers[place], starts)
    return mixed(hashes ^ mixed(sizes.astype(np.uint64) * _STEP)), np.searchsorted(starts, edges)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the distinct shingles of text i, in order, are hashes[bounds[i]:bounds[i + 1]]."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    words, edges = _word_numbers(data, offsets - offsets[0])
    counts = np.diff(edges)
    number = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(number)])
    size = np.repeat(np.minimum(counts, width), number)  # words of each shingle
    begin = np.repeat(edges[:-1] - bounds[:-1], number) + np.arange(bounds[-1])
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    h = padded[begin]
    for i in range(1, width):
        h = np.where(i < size, h * _STEP + padded[begin + i], h)
    h = mixed(mixed(h + size.astype(np.uint64)))
    for a, b in zip(bounds, bounds[1:], strict=False):
        h[a:b].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    fresh[bounds[:-1][number > 0]] = True
    return np.concatenate([[0], np.cumsum(fresh)])[bounds], h[fresh]


def signatures(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The registers of each set, a row each; zeros for an empty set."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = (hashes >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
    least = np.ones(len(hashes), bool)  # sets are in order, so a bucket's first hash is its smallest
    least[1:] = (places[1:] != places[:-1]) | (rows[1:] != rows[:-1])
    rest = (hashes[least] << np.uint64(PLACE_BITS)) | np.uint64(1)
    mantissa, exponent = np.frexp(rest.astype(np.float64))
    out = np.zeros((len(bounds) - 1, REGISTERS), np.uint16)
    out[rows[least], places[least]] = (64 - exponent) * (1 << MANTISSA) + ((mantissa * 2 - 1) * (1 << MANTISSA)).astype(np.int64) + 1
    some = np.flatnonzero((np.diff(bounds) > 0) & (out == 0).any(1))
    for i in range(0, len(some), 256):
        own = out[some[i : i + 256]]
        donor = _DONORS[np.arange(REGISTERS), (own != 0)[:, _DONORS].argmax(2)]
        out[some[i : i + 256]] = np.where(own == 0, np.take_along_axis(own, donor, 1), own)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of sets by the share of equal registers, without those that agree by chance."""
    return ((a == b).mean(1) - CHANCE) / (1 - CHANCE)


def _pieces(rows: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind)


def _binary(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    size = matrix.shape[1] * matrix.itemsize
    return pa.Array.from_buffers(pa.binary(size), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix))]).cast(pa.binary())


SETS = "id long, text_hash long, n long, h1 long, h2 long, signature binary"


def _describer(width: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            bounds, hashes = shingle_sets(batch.column("text"), width)
            whole = [xxhash.xxh3_128_intdigest(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            columns = [pa.array(np.diff(bounds)), pa.array([signed(w >> 64) for w in whole], pa.int64()), pa.array([signed(w & MASK64) for w in whole], pa.int64()), _binary(signatures(bounds, hashes))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), *columns], ["id", "text_hash", "n", "h1", "h2", "signature"])

    return describe


def _reader(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            bounds, hashes = shingle_sets(batch.column("text"), width)
            sets = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer((bounds * 8).astype(np.int64)), pa.py_buffer(hashes)])
            yield pa.RecordBatch.from_arrays([batch.column("class"), sets.cast(pa.binary())], ["class", "own"])

    return read


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "own"):
        sets = batch.column("own").cast(pa.large_binary())
        bounds = np.frombuffer(sets.buffers()[1], np.int64)[sets.offset : sets.offset + len(sets) + 1]
        flat = np.frombuffer(sets.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]].view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(((bounds - bounds[0]) // 8).astype(np.int32)), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("class"), lists], ["class", "shingles"])


@F.pandas_udf(T.DoubleType())
def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(estimate(_pieces(a.tolist(), np.uint16).reshape(-1, REGISTERS), _pieces(b.tolist(), np.uint16).reshape(-1, REGISTERS)))


@F.pandas_udf(T.LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True)) for x, y in zip(a, b, strict=True)], dtype="int64")


def _entries(classes: DataFrame, bands: range, rows: int, *columns: str) -> DataFrame:
    """(bucket, class, n, ...): one row for each class and band."""
    keys = [F.xxhash64(F.lit(i), F.substring("signature", 2 * rows * i + 1, 2 * rows)) for i in bands]
    return classes.select("class", "n", *columns, F.explode(F.array(*keys)).alias("bucket"))


class _Comparer:
    """Confirms pairs of classes: sizes, estimates, then sets; every pair once."""

    def __init__(self, texts: DataFrame, classes: DataFrame, width: int, percent: int):
        self.texts, self.classes, self.width, self.percent = texts, classes, width, percent
        spark = texts.sparkSession
        self.tested = self.links = spark.createDataFrame([], "a long, b long")
        self.bodies = spark.createDataFrame([], "class long, own binary")

    def sets_of(self, classes: DataFrame) -> DataFrame:
        """The sets of these classes, and of those asked for before; a text is read once."""
        wanted = classes.distinct().join(self.bodies, "class", "left_anti")
        first = staged(wanted.join(self.classes, "class").select("class", F.col("id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash")), "wanted")
        if first.count() <= BROADCAST_ROWS:  # else the texts are exchanged by their ids
            first = F.broadcast(first)
        rows = self.texts.join(first, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash"))).select("class", "text")
        found = rows.mapInArrow(_reader(self.width), "class long, own binary").groupBy("class").agg(F.first("own").alias("own"))
        self.bodies = self.bodies.unionAll(staged(found, "sets"))
        return self.bodies

    def compare(self, led: DataFrame) -> None:
        """`led` has pairs of classes (class, lead) and their sizes n and m; adds those that link to `links`."""
        swap = F.col("class") < F.col("lead")
        sizes = [F.when(swap, F.col("m")).otherwise(F.col("n")).alias("n"), F.when(swap, F.col("n")).otherwise(F.col("m")).alias("m")]
        pairs = led.where(f"100 * least(n, m) >= {self.percent} * greatest(n, m)").select(F.greatest("class", "lead").alias("a"), F.least("class", "lead").alias("b"), *sizes)
        pairs = pairs.distinct().join(self.tested, ["a", "b"], "left_anti")
        sides = [self.classes.select(F.col("class").alias(s), F.col("signature").alias(f"signature_{s}")) for s in "ab"]
        pairs = pairs.join(sides[0], "a").join(sides[1], "b").withColumn("similar", _similar("signature_a", "signature_b"))
        pairs = staged(pairs.where(F.col("similar") >= self.percent / 100 - MARGIN).select("a", "b", "n", "m"), "candidates")
        if not pairs.isEmpty():
            bodies = self.sets_of(pairs.select(F.explode(F.array("a", "b")).alias("class")))
            full = pairs.join(bodies.select(F.col("class").alias("b"), F.col("own").alias("own_b")), "b").join(bodies.select(F.col("class").alias("a"), F.col("own").alias("own_a")), "a")
            found = full.withColumn("common", _common("own_a", "own_b")).where(100 * F.col("common") >= self.percent * (F.col("n") + F.col("m") - F.col("common")))
            self.links = self.links.unionAll(staged(found.select("a", "b"), "links"))
        self.tested = self.tested.unionAll(pairs.select("a", "b"))


def _open_buckets(entries: DataFrame) -> DataFrame:
    """The entries of buckets with several labels."""
    several = entries.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("bucket")
    return staged(entries.join(several, "bucket"), "open")


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.drop("label").join(roots, rows["class"] == roots["node"], "left").withColumn("label", F.coalesce("root", "class")).drop("node", "root")


def _by_prefix(comparer: _Comparer, marked: DataFrame) -> DataFrame:
    """Pairs of different labels in open buckets that may link by their rarest shingles.

    Similar sets share one of the first shingles of both in any common order, and from its places follows how
    much they can share at most. Copies that keep apart have enough shingles of their own to meet nobody there.
    """
    percent = comparer.percent
    members = staged(marked.groupBy("class", "n", "label").agg(F.max(F.col("label") != F.col("main")).alias("outside")), "outside")
    sets = comparer.sets_of(members.select("class")).mapInArrow(_unpack, "class long, shingles array<long>")
    rows = staged(sets.join(members.select("class"), "class", "left_semi").select("class", F.explode("shingles").alias("shingle")), "shingles")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("c"))
    place = F.row_number().over(Window.partitionBy("class").orderBy("c", "shingle")) - 1
    placed = rows.join(counts, "shingle").withColumn("place", place).where("c > 1").join(members, "class")
    prefixes = staged(placed.where(f"100 * place <= (100 - {percent}) * n").drop("c"), "prefixes")
    left = prefixes.where("outside").drop("outside")
    right = prefixes.select("shingle", F.col("class").alias("lead"), F.col("n").alias("m"), F.col("label").alias("lead_label"), F.col("place").alias("lead_place"))
    most = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("lead_place"))
    return left.join(right, "shingle").where(F.col("label") != F.col("lead_label")).where((100 + percent) * most >= percent * (F.col("n") + F.col("m"))).select("class", "lead", "n", "m")


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its set's size, `component_id`, the smallest id reachable by links, and whether it is `kept`."""
    rows = band_rows(percent)
    bands = REGISTERS // rows
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    sets = staged(texts.mapInArrow(_describer(width), SETS).withColumn("row", F.monotonically_increasing_id()), "signatures")
    classes = staged(sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("row").alias("class"), F.min("id").alias("least_id")), "classes")
    # sets too small to be similar without being equal have no links beyond their class
    indexed = classes.where(f"100 * n >= {percent} * (n + 1)").select("class")
    indexed = staged(indexed.join(sets, F.col("class") == F.col("row")).select("class", "n", "id", "text_hash", "signature"), "indexed")
    comparer = _Comparer(texts, indexed, width, percent)

    members = _entries(indexed, range(min(FIRST_BANDS, bands)), rows)
    shared = members.groupBy("bucket").agg(F.count("*").alias("met")).where("met > 1")
    members = staged(members.join(shared, "bucket"), "members")
    central = staged(members.groupBy("class").agg(F.sum("met").alias("score")), "scores")
    members = members.join(central, "class")
    leads = members.groupBy("bucket").agg(F.max(F.struct("score", "class", "n")).alias("lead"))
    led = members.join(leads, "bucket").select("class", "n", F.col("lead.class").alias("lead"), F.col("lead.n").alias("m"))
    comparer.compare(led.where(F.col("class") != F.col("lead")))

    scored = indexed.select("class", "n", "signature").join(central, "class", "left")
    open_ = _open_buckets(_entries(_labelled(scored, components(comparer.links)), range(bands), rows, "label", "score"))
    for turn in range(CENTRES + 1):
        if open_.isEmpty():
            break
        sizes = open_.groupBy("bucket", "label").agg(F.count("*").alias("c")).groupBy("bucket").agg(F.max(F.struct("c", "label")).alias("top"))
        marked = staged(open_.join(sizes.select("bucket", F.col("top.label").alias("main")), "bucket"), "marked")
        if turn == CENTRES:
            comparer.compare(_by_prefix(comparer, marked))
            break
        order = F.struct(F.xxhash64("class", F.lit(turn)) if turn else F.col("score"), "class", "n")
        chosen = marked.where("label = main").groupBy("bucket").agg(F.max(order).alias("lead")).select("bucket", F.col("lead.class").alias("lead"), F.col("lead.n").alias("m"))
        comparer.compare(marked.where("label <> main").join(chosen, "bucket"))
        open_ = _open_buckets(_labelled(marked.select("bucket", "class", "n", "score"), components(comparer.links)))

    roots = components(comparer.links)
    named = classes.join(roots, classes["class"] == roots["node"], "left").select("h1", "h2", "n", "least_id", F.coalesce("root", "class").alias("label"))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_set = named.join(least, "label").select("h1", "h2", "n", "component_id")
    whole = sets.select("id", "n", "h1", "h2").join(by_set, ["h1", "h2", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return whole.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
