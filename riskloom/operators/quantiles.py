"""Exact quantiles (linear interpolation) for columns of any size.

Small inputs use the built-in exact percentile. Beyond that its value map would
outgrow one task, so values are counted in buckets of equal width, a few columns a plan; running counts over the
buckets name the one that holds a wanted rank, and that one is cut again. The values left are listed, or ranked by
distributed running sums. All rows are counted in every step, and nothing is approximated in the result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import to_number
from riskloom.operators.ordered import running_sums

SMALL_VALUES = 300_000  # values of one column that the built-in percentile may hold
BATCH_VALUES = 4_000_000  # values of all columns of one such job
PICKED_VALUES = 50_000
PICKED_BATCH = 64
BUCKETS = 1024
PLAN_COLUMNS = 10  # columns of one generated method, so that it stays short enough to be compiled


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *, small_values: int = SMALL_VALUES
) -> dict[str, list[float | None]]:
    """Quantiles of the non-null values of each column, as the given probabilities ask for."""
    columns = list(columns)
    numbers = df.select(*[to_number(c).alias(f"v{i}") for i, c in enumerate(columns)])
    finite = F.when(F.abs("value") < math.inf, F.col("value"))
    summary = [F.count("value").alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi")]
    every = [(i, -math.inf, math.inf) for i in range(len(columns))]
    seen = {r["slot"]: r for r in _of_values(numbers, every, lambda x: x.groupBy("slot").agg(*summary)).collect()} if columns else {}
    counts = [seen[i]["n"] if i in seen else 0 for i in range(len(columns))]
    spans = {i: (r["lo"], r["hi"]) if r["lo"] is not None else (0.0, 0.0) for i, r in seen.items()}
    result: dict[str, list[float | None]] = {}
    small = [i for i in range(len(columns)) if counts[i] <= small_values]
    batch = max(1, BATCH_VALUES // max([counts[i] for i in small] + [1]))
    for start in range(0, len(small), batch):
        part = small[start : start + batch]
        row = numbers.agg(
            *[F.percentile(f"v{i}", F.lit(list(probabilities)).cast("array<double>")).alias(f"v{i}") for i in part]
        ).first()
        for i in part:
            result[columns[i]] = list(row[f"v{i}"]) if row[f"v{i}"] is not None else [None] * len(probabilities)
    large = [i for i in range(len(columns)) if counts[i] > small_values]
    if large:
        found = _select_ranks(numbers, {i: counts[i] for i in large}, spans, probabilities, small_values)
        for i in large:
            values = []
            for p in probabilities:
                low, high, share = _ranks(counts[i], p)
                first, last = found[i, low], found[i, high]
                values.append(first if first == last else first + (last - first) * share)
            result[columns[i]] = values
    return {c: result[c] for c in columns}


def exact_medians(df: DataFrame, columns: Sequence[str], **options) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5], **options).items()}


def _ranks(rows: int, probability: float) -> tuple[int, int, float]:
    position = (rows - 1) * probability
    return math.floor(position), math.ceil(position), position - math.floor(position)


def _select_ranks(
    numbers: DataFrame, counts: dict[int, int], spans: dict[int, tuple], probabilities: Sequence[float], small_values: int
) -> dict[tuple[int, int], float]:
    # One interval per column and probability: (low, high, rows below low, rows inside).
    intervals = {(i, p): (-math.inf, math.inf, 0, n) for i, n in counts.items() for p in probabilities}
    few = min(small_values, PICKED_VALUES)
    for _ in range(3):
        wide = [k for k, (lo, hi, _, inside) in intervals.items() if inside > few and lo < hi]
        if not wide:
            break
        intervals.update(_narrow(numbers, {k: intervals[k] for k in wide}, counts, spans))
    wanted = {(i, p): _ranks(counts[i], p)[:2] for i, p in intervals}
    found: dict[tuple[int, int], float] = {}
    picked, open_keys = [], []
    for k, (lo, hi, _, inside) in intervals.items():
        if lo == hi:
            found.update({(k[0], r): lo for r in wanted[k]})
        elif inside <= few:
            picked.append(k)
        else:
            open_keys.append(k)
    for start in range(0, len(picked), PICKED_BATCH):
        found.update(_pick(numbers, {k: intervals[k] for k in picked[start : start + PICKED_BATCH]}, wanted))
    if not open_keys:
        return found
    # Many equal values keep an interval wide: rank the distinct values by running counts.
    slots = [(k[0], *intervals[k][:2]) for k in open_keys]
    values = _of_values(numbers, slots, lambda x: x.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = running_sums(values, ["value"], {"upto": "n"}, by=["slot"])
    picks = {
        f"s{slot}_{side}": F.min(
            F.when((F.col("slot") == slot) & (F.col("upto") > wanted[k][side] - intervals[k][2]), F.col("value"))
        )
        for slot, k in enumerate(open_keys)
        for side in (0, 1)
    }
    row = ranked.agg(*[c.alias(n) for n, c in picks.items()]).first()
    for slot, k in enumerate(open_keys):
        found.update({(k[0], wanted[k][side]): row[f"s{slot}_{side}"] for side in (0, 1)})
    return found


def _of_values(numbers: DataFrame, slots: Sequence[tuple[int, float, float]], then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`then` of the values (slot, value) of each slot's column that lie in its interval, a few columns at a time, in one frame."""
    parts = []
    for start in range(0, len(slots), PLAN_COLUMNS):
        some = slots[start : start + PLAN_COLUMNS]
        place = F.col("_place")
        values = numbers.select(F.posexplode(F.array(*[F.col(f"v{i}") for i, _, _ in some])).alias("_place", "value"))
        low, high = (_of_slot([float(s[side]) for s in some], place) for side in (1, 2))
        parts.append(then(values.where(F.col("value").between(low, high)).select((place + start).alias("slot"), "value")))
    return reduce(DataFrame.unionAll, parts)


def _of_slot(listed: Sequence, slot: Column) -> Column:
    """What a list of constants holds for a slot."""
    return F.element_at(F.lit(listed) if isinstance(listed[0], float) else F.array(*[F.lit(x) for x in listed]), slot + 1)


def _pick(numbers: DataFrame, intervals: dict, wanted: dict) -> dict[tuple[int, int], float]:
    """Values at the wanted ranks from short sorted lists; the counts have shown how short they are."""
    names = list(intervals)
    places = [[int(r - intervals[k][2] + 1) for r in wanted[k]] for k in names]
    listed = F.sort_array(F.collect_list("value"))
    at = [F.element_at("values", _of_slot([p[side] for p in places], F.col("slot"))).alias(f"p{side}") for side in (0, 1)]
    lists = _of_values(numbers, [(k[0], *intervals[k][:2]) for k in names], lambda x: x.groupBy("slot").agg(listed.alias("values")))
    rows = {r["slot"]: r for r in lists.select("slot", *at).collect()}
    return {(k[0], r): rows[s][f"p{side}"] for s, k in enumerate(names) for side, r in enumerate(wanted[k])}


def _narrow(numbers: DataFrame, intervals: dict, counts: dict[int, int], spans: dict[int, tuple]) -> dict:
    """Tighter intervals: the bucket that holds the wanted ranks, or the two that do, from its least to its largest value."""
    # Ranks that share an interval share its buckets.
    shared: dict[tuple, list] = {}
    for (i, p), (lo, hi, below, _) in intervals.items():
        shared.setdefault((i, lo, hi, below), []).append((i, p))
    starts, scales, asked = [], [], []
    for (i, lo, hi, below), keys in shared.items():
        # Infinite values go to the outer buckets; what falls out of step with the width is still in order.
        first, last = max(lo, spans[i][0]), min(hi, spans[i][1])
        starts.append(float(first))
        scales.append(BUCKETS / (last - first) if last > first else 0.0)
        asked.append(sorted({r - below for _, p in keys for r in _ranks(counts[i], p)[:2]}))
    slot = F.col("slot")
    place = (F.col("value") - _of_slot(starts, slot)) * _of_slot(scales, slot)
    bucket = F.least(F.greatest(place, F.lit(0.0)), F.lit(BUCKETS - 1.0)).cast("int")
    counted = _of_values(
        numbers,
        [s[:3] for s in shared],
        lambda x: x.groupBy("slot", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")),
    )
    upto = F.sum("n").over(Window.partitionBy("slot").orderBy("bucket"))
    ranks = F.element_at(F.array(*[F.lit(a).cast("array<bigint>") for a in asked]), slot + 1)
    held = F.exists(ranks, lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    rows = counted.withColumn("upto", upto).where(held).collect()
    better = {}
    for s, ((i, _, _, below), keys) in enumerate(shared.items()):
        for _, p in keys:
            low, high = (next(r for r in rows if r["slot"] == s and r["upto"] - r["n"] <= rank - below < r["upto"]) for rank in _ranks(counts[i], p)[:2])
            before = low["upto"] - low["n"]
            better[i, p] = (low["lo"], high["hi"], below + before, high["upto"] - before)
    return better
