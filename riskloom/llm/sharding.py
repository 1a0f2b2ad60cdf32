"""Shards of nearly equal bytes by histogram sort.

Rows have a place in a total order: a hash of the text, then the id, then a number given when the rows are
first written. Splitters cut that order at equal shares of the bytes. They are found by counting: each round
sums the exact bytes between candidate boundaries across all partitions, keeps for each splitter the one
interval that holds it, and sets finer candidates there, until the splitter meets the tolerance (0: it stands
between two rows). Only the histograms, bounded by splitters and candidates, reach the driver. Then every row
knows its range, and one exchange brings the rows of a range together in order.

Equal texts are neighbours in the order, so they share a shard unless a boundary falls among them; a group
of any size is cut by id, and repeated rows by their number, so no shard or task depends on group sizes.
Each shard consists of as many ranges as the exchange needs, so no task holds a whole shard.

Defined results: a null text has no bytes and is ordered as empty text, a null id comes first, an empty table
gives an empty result. Added columns replace input columns of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import staged, text_of

ROW_BYTES = 16
#: Candidate boundaries for each open splitter and round.
PROBES = 1024
LOWEST = -(1 << 63)
PLACE = ("__hash", "__id", "__row")


@dataclass(frozen=True)
class Interval:
    """Places with the given leading parts whose next part lies in lo..hi; `below`: bytes before them."""

    prefix: tuple[int, ...]
    lo: int
    hi: int
    below: int

    @property
    def step(self) -> int:
        return (self.hi - self.lo) // PROBES + 1

    def holds(self) -> str:
        part = PLACE[len(self.prefix)]
        same = [f"{p} = {v}L" if v > LOWEST else f"{p} <= {v + 1}L - 1L" for p, v in zip(PLACE, self.prefix, strict=False)]
        low = f"{part} >= {self.lo}L" if self.lo > LOWEST else "true"
        return " AND ".join([*same, low, f"{part} <= {self.hi}L"])

    def bin(self) -> str:
        return f"CAST(floor((CAST({PLACE[len(self.prefix)]} AS DECIMAL(20,0)) - {self.lo}) / {self.step}) AS INT)"


def _histograms(rows: DataFrame, intervals: list[Interval]) -> dict[int, list]:
    """Exact bytes and rows of each bin of each interval, and the extent of the part it cuts and the next."""
    cell = "CASE " + " ".join(f"WHEN {c.holds()} THEN {i}" for i, c in enumerate(intervals)) + " END"
    by = "CASE __cell " + " ".join(f"WHEN {i} THEN {c.bin()}" for i, c in enumerate(intervals)) + " END"
    part = "CASE __cell " + " ".join(f"WHEN {i} THEN {PLACE[len(c.prefix)]}" for i, c in enumerate(intervals)) + " END"
    after = "CASE __cell " + " ".join(f"WHEN {i} THEN {PLACE[min(2, len(c.prefix) + 1)]}" for i, c in enumerate(intervals)) + " END"
    found = (
        rows.withColumn("__cell", F.expr(cell)).where("__cell IS NOT NULL")
        .select("__cell", F.expr(by).alias("bin"), F.expr(part).alias("v"), F.expr(after).alias("w"), "__size")
        .groupBy("__cell", "bin")
        .agg(F.sum("__size").alias("size"), F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("w").alias("next_lo"), F.max("w").alias("next_hi"))
    )
    out: dict[int, list] = {}
    for r in sorted(found.collect(), key=lambda r: (r["__cell"], r["bin"])):  # at most PROBES bins for each open splitter
        out.setdefault(r["__cell"], []).append(r)
    return out


def find_splitters(rows: DataFrame, ranges: int, tolerance: float = 0.0) -> list[tuple[int, ...]]:
    """The first places of ranges 1, 2, ...: a row is in as many ranges' reach as there are splitters not above it.

    Range j starts at the first row with at least j / ranges of all bytes before it, or within `tolerance`
    (a share of one range's bytes) of that.
    """
    whole = rows.agg(F.min(PLACE[0]).alias("lo"), F.max(PLACE[0]).alias("hi"), F.sum("__size").alias("size")).first()
    if whole.lo is None:
        return []
    total = int(whole.size)
    slack = Fraction(total, ranges) * Fraction(tolerance)
    found: dict[int, tuple[int, ...]] = {}
    open_in = {Interval((), whole.lo, whole.hi, 0): list(range(1, ranges))}
    while open_in:
        intervals = list(open_in)
        finer: dict[Interval, list[int]] = {}
        for i, bins in _histograms(rows, intervals).items():
            cell, below = intervals[i], intervals[i].below
            wanted = list(open_in[cell])
            for b in bins:
                end = below + int(b.size)
                while wanted and Fraction(wanted[0] * total, ranges) <= end:
                    j = wanted.pop(0)
                    target = Fraction(j * total, ranges)
                    if target - below <= slack and target > below and slack:
                        found[j] = (*cell.prefix, b.lo)
                    elif b.n == 1 or end - target <= slack:
                        found[j] = (*cell.prefix, b.hi + 1)
                    elif b.lo < b.hi:
                        finer.setdefault(Interval(cell.prefix, b.lo, b.hi, below), []).append(j)
                    else:
                        finer.setdefault(Interval((*cell.prefix, b.lo), b.next_lo, b.next_hi, below), []).append(j)
                below = end
        open_in = finer
    return [found[j] for j in range(1, ranges)]


def _range_of(splitters: list[tuple[int, ...]]) -> Column:
    """Number of splitters not above the row, looked up in two levels."""
    if not splitters:
        return F.lit(0)
    place = F.struct(*[F.col(p) for p in PLACE])
    edge = lambda s: "named_struct(" + ", ".join(f"'{p}', " + (f"{v}L" if v > LOWEST else f"{v + 1}L - 1L") for p, v in zip(PLACE, (*s, LOWEST, LOWEST)[:3], strict=True)) + ")"
    width = math.isqrt(len(splitters)) + 1
    groups = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    inner = F.expr("array(" + ", ".join("array(" + ", ".join(map(edge, g)) + ")" for g in groups) + ")")
    first = F.expr("array(" + ", ".join(edge(g[0]) for g in groups) + ")")
    at = F.size(F.filter(first, lambda e: place >= e))
    within = F.size(F.filter(F.element_at(inner, F.greatest(at, F.lit(1))), lambda e: place >= e))
    return F.when(at == 0, 0).otherwise((at - 1) * width + within).cast("int")


def shard_by_bytes(rows: DataFrame, size: Column, text_hash: Column, id_col: str = "doc_id", shards: int = 40, tolerance: float = 0.0) -> DataFrame:
    """The rows with `shard`, and `slot`: their place in the shard, gapless from 0, in the order of the sort."""
    given = [c for c in rows.columns if c not in ("shard", "slot")]
    placed = rows.select(
        *[F.col(f"`{c}`") for c in given],
        F.coalesce(size, F.lit(0)).cast("long").alias("__size"),
        text_hash.alias("__hash"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.expr(f"{LOWEST + 1}L - 1L")).alias("__id"),
        F.monotonically_increasing_id().alias("__row"),
    )
    placed = staged(placed, "shards")  # fixes the row numbers
    each = max(1, -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    splitters = find_splitters(placed, shards * each, tolerance)
    placed = placed.withColumn("__range", _range_of(splitters))
    offsets, before, n = [], 0, dict(map(tuple, placed.groupBy("__range").count().collect()))  # a row for each range
    for r in range(shards * each):
        before = 0 if r % each == 0 else before
        offsets.append(before)
        before += n.get(r, 0)
    order = "row_number() OVER (PARTITION BY __range ORDER BY __hash, __id, __row) - 1"
    return placed.select(
        *[F.col(f"`{c}`") for c in given],
        F.expr(f"CAST(__range DIV {each} AS INT)").alias("shard"),
        (F.expr(order) + F.element_at(F.expr("array(" + ", ".join(f"{o}L" for o in offsets) + ")"), F.col("__range") + 1)).cast("long").alias("slot"),
    )


def text_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, size, checksum and hash of each text: what the shards are planned from."""
    text = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return text.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text_of("text"), "UTF-8")).alias("text_crc32"),
        F.conv(F.substring(F.md5(F.encode(text_of("text"), "UTF-8")), 1, 15), 16, 10).cast("long").alias("hash"),
    )
