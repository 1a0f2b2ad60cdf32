"""Small helpers of the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import drop_table, stage_table

#: The white space of the corpus contracts, and the letters that are lower-cased.
SPACES = b" \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MASK64 = (1 << 64) - 1


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")


def text_of(name: str = "text") -> Column:
    """A text column with empty text in place of null."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


#: Removes what a query shuffled as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_passing: ContextVar[list[DataFrame] | None] = ContextVar("passing", default=None)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, so that later jobs start from files and not from what was shuffled."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        table = stage_table(df, f"llm-{label}")
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    if _passing.get() is not None:
        _passing.get().append(table)
    return table


@contextmanager
def passing_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged in the block are deleted at its end, but for those given to the function it yields.

    What leaves the block must not read any of the others.
    """
    outer, tables, kept = _passing.get(), [], []
    mark = _passing.set(tables)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        _passing.reset(mark)
        for table in tables:
            if not any(table is k for k in kept):
                drop_table(table)
        if outer is not None:
            outer += kept


def nothing(spark: SparkSession, schema: str) -> DataFrame:
    """A frame without rows; one made from a list would start further Python workers on every executor."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)]).limit(0)


def small_batches(spark: SparkSession, size: str = "2m") -> None:
    """Batches of long texts to Python hold so many bytes at most, unless the session sets a size itself."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "1b") == "1b":  # the stand-in comes back where nothing is set
        spark.conf.set(key, size)


def free_memory() -> None:
    """What this process no longer uses goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # not in every C library
        trim(0)


def tidied(work: Callable[..., Iterator], forget: Callable[[], None] | None = None) -> Callable[..., Iterator]:
    """`work` on a task's batches, after which the Python worker gives its memory back.

    Workers stay, idle, beside later stages of their executor. `forget` empties what a module keeps between batches.
    """

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            if forget:
                forget()
            free_memory()

    return run


def signed(value: int) -> int:
    """An unsigned 64-bit number as the bigint with the same bits."""
    return value - (1 << 64) if value >> 63 else value


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of the batches whose texts hold about `limit` bytes; one longer text is a part of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist() if batch.num_rows else []
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + (size or 0) > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size or 0
        if sizes:
            yield batch.slice(start)


def raw(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, so that any part of them serves as a hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


class WordTable:
    """Numbers of words, worked out once for each word and kept for the most recent ones."""

    def __init__(self, width: int, numbers: Callable[[bytes], tuple], room: int = 1 << 18):
        self.numbers, self.room = numbers, room
        self.places: dict[bytes, int] = {}
        self.table = np.zeros((room, width), np.uint64)

    def clear(self) -> None:
        self.places.clear()
        self.table = np.zeros_like(self.table)

    def of(self, words: list[bytes]) -> np.ndarray:
        """A row of numbers for each word."""
        if len(words) > self.room:
            return np.concatenate([self.of(words[i : i + self.room]) for i in range(0, len(words), self.room)])
        new = set(words).difference(self.places)
        if len(self.places) + len(new) > self.room:
            self.places.clear()
            new = set(words)
        for w in new:
            at = self.places[w] = len(self.places)
            self.table[at] = self.numbers(w)
        return self.table[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))]
