"""Best-fit packing of token pieces by minimum bin slack.

A document's tokens, with the end token, are cut into pieces of at most the sequence length. Only the
lengths decide which pieces share a sequence, so the plan is made from the histogram of lengths, which has
as many entries as a sequence has tokens, whatever the corpus. Each step of the plan takes the longest
length left, finds by subset sums over the lengths available (a bitset with one bit for each fill) the
combination that leaves the least slack beside it, and removes it as often as the histogram allows. At
least one length runs out, or nearly so, in each step, so the plan stays short.

Pieces then take their places by rank among those of their length. Ranks come from counts by (group of
documents, length) and running sums over them: no task sees all pieces of a length, and no text is
shuffled.

Defined results: a null text counts as empty and becomes one piece with the end token alone, null and
repeated ids are carried as they are, an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import byte_slices, staged, text_of, tidied

SEQUENCE = 1024
END_ID = 2
#: Fixed value: the only added token of the vocabulary; texts that contain it go through the slower library.
SPECIAL = "<|endoftext|>"

PIECES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("rank", T.LongType()),
    ]
)


@lru_cache(maxsize=1)
def _fast(ranks: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=1)
def _exact(vocabulary: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def _encoders(vocabulary: str, ranks: str):
    """The faster library's encoder and that of `tokenizers`, each kept until the task ends."""
    return _fast(ranks), _exact(vocabulary)


def _forget_encoders() -> None:
    _fast.cache_clear()
    _exact.cache_clear()


def encode(text: str, vocabulary: str, ranks: str) -> np.ndarray:
    """The ids of `tokenizers` for the vocabulary, without added tokens.

    Both files hold one vocabulary and give the same ids; the ranks file is read by the faster library.
    """
    if SPECIAL in text:
        return np.array(_exact(vocabulary).encode(text, add_special_tokens=False).ids, "<u4")
    return np.asarray(_fast(ranks).encode_to_numpy(text, disallowed_special=()), "<u4")


def cut(n: int, limit: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first takes what full pieces leave over."""
    first = n % limit or limit
    return [(0, min(n, first))] + [(s, limit) for s in range(first, n, limit)]


def _cutter(vocabulary: str, ranks: str, limit: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        met = [0] * (limit + 1)
        for batch in byte_slices(batches, "text"):
            out: list[list] = [[] for _ in PIECES]
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text, vocabulary, ranks), np.array([END_ID], "<u4"))
                for k, (start, length) in enumerate(cut(len(ids), limit)):
                    row = (doc, k, start, length, zlib.crc32(ids[start : start + length].tobytes()), part, met[length])
                    met[length] += 1
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], PIECES.names)

    return pieces


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths whose sum is as near to `room` as can be, longer ones first; counts limit their use."""
    mask = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left = min(counts[length], room // length)
        before, times = reach, 1
        while left:  # copies in powers of two
            take = min(times, left)
            reach |= (reach << (length * take)) & mask
            left -= take
            times *= 2
        trail.append((length, before))
        if reach >> room & 1:
            break
    fill, chosen = reach.bit_length() - 1, []
    for length, before in reversed(trail):
        while not before >> fill & 1:
            fill -= length
            chosen.append(length)
    return sorted(chosen, reverse=True)


def plan(histogram: dict[int, int], limit: int = SEQUENCE) -> list[tuple[list[int], int]]:
    """(lengths, number of sequences filled so), by minimum bin slack beside the longest length left."""
    counts = {x: n for x, n in histogram.items() if n}
    steps = []
    while counts:
        longest = max(counts)
        rest = counts | {longest: counts[longest] - 1}
        chosen = [longest, *fullest(rest, limit - longest)]
        uses = {x: chosen.count(x) for x in set(chosen)}
        times = min(counts[x] // u for x, u in uses.items())
        steps.append((chosen, times))
        for x, u in uses.items():
            counts[x] -= u * times
            if not counts[x]:
                del counts[x]
    return steps


def _places(steps: list[tuple[list[int], int]], limit: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length, for runs of ranks: first rank, uses in a sequence, first sequence, offset of the first use."""
    runs: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for chosen, times in steps:
        offset = 0
        for x in sorted(set(chosen), reverse=True):
            uses = chosen.count(x)
            runs.setdefault(x, []).append((ranks.get(x, 0), uses, sequence, offset))
            ranks[x] = ranks.get(x, 0) + uses * times
            offset += x * uses
        sequence += times
    return {x: tuple(np.array(v, np.int64) for v in zip(*rows, strict=True)) for x, rows in runs.items()}


def _placer(places: dict[int, tuple[np.ndarray, ...]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, uses, start, shift = places[int(x)]
                run = np.searchsorted(first, rank[at], "right") - 1
                k = rank[at] - first[run]
                sequence[at] = start[run] + k // uses[run]
                offset[at] = shift[run] + k % uses[run] * x
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, vocabulary: str, ranks: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SEQUENCE) -> DataFrame:
    """One row for each piece: where it starts in its document, its checksum, and its place in a sequence."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    pieces = staged(texts.mapInArrow(tidied(_cutter(vocabulary, ranks, limit), _forget_encoders), PIECES), "pieces")
    counts = staged(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `limit` rows
    steps = plan(histogram, limit)
    earlier = counts.select("length", "part", F.expr("sum(n) OVER (PARTITION BY length ORDER BY part) - n AS earlier"))
    ranked = pieces.join(earlier, ["length", "part"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("earlier")).alias("rank"))
    schema = T.StructType([f for f in PIECES if f.name not in ("part", "rank")]).add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(tidied(_placer(_places(steps, limit))), schema).withColumnRenamed("id", id_col)
