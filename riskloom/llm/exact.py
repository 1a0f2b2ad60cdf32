"""Exact deduplication by an extendible-hash index whose buckets are owned by tasks.

Texts are equal when they are identical after deleting white space. The key of a row is a 64-bit hash of
that normalised text. A directory over the leading key bits starts with a few buckets; an overfull bucket is
split by doubling, one more bit at a time, until it fits or the directory has its full width. What is still
overfull then is one key (or a few) with very many copies, and its rows are dealt over several pages.

Rows travel once, to the task that owns their bucket or page, in key order. The owner streams through them
and keeps, for the current key only, a chain of the different texts met so far: each row is compared byte by
byte with the chain, so two texts whose hashes collide stay apart. Its output, the index, is a table of
files in the shared folder; pages of one bucket are united there by key and SHA-256 of the text.

Defined results: a null text counts as empty, and empty texts equal each other; a null doc_id is ordered
after all others; of repeated rows exactly one stays; an empty table gives an empty result. Other columns
take no part in the comparison, and their names may be anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import SPACES, raw, signed, staged, text_of, tidied

#: Entries of the directory at its full width. The directory and its counts are held by the driver.
DIRECTORY_BITS = 16
FIRST_BITS = 4
#: Text bytes in a bucket before it is split; grows with the data, so that buckets stay fewer than entries.
BUCKET_BYTES = 8 << 20


def normalised(text: bytes) -> bytes:
    return text.translate(None, SPACES)


@F.pandas_udf(T.LongType())
def text_key(texts: pd.Series) -> pd.Series:
    return pd.Series([signed(xxhash.xxh3_64_intdigest(normalised(t.encode()))) for t in texts], dtype="int64")


def _entry(key: Column) -> Column:
    """The leading bits of the key: the place in the directory."""
    return F.shiftrightunsigned(key, 64 - DIRECTORY_BITS).cast("int")


def split_buckets(sizes: dict[int, int], capacity: int) -> list[tuple[int, int, int]]:
    """(entry, bucket, pages) for each directory entry in use, from the text bytes of each entry.

    Buckets are split breadth first: an overfull one gives way to two that own one more bit.
    """
    out, level = [], {}
    for entry in sizes:
        level.setdefault(entry >> (DIRECTORY_BITS - FIRST_BITS), []).append(entry)
    bits = FIRST_BITS
    while level:
        deeper: dict[int, list[int]] = {}
        for prefix, entries in level.items():
            size = sum(sizes[e] for e in entries)
            if size <= capacity or bits == DIRECTORY_BITS:
                bucket = prefix << (DIRECTORY_BITS - bits)
                out += [(e, bucket, max(1, -(-size // capacity))) for e in entries]
            else:
                for e in entries:
                    deeper.setdefault(e >> (DIRECTORY_BITS - bits - 1), []).append(e)
        level, bits = deeper, bits + 1
    return out


def directory(docs: DataFrame, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> list[tuple[int, int, int]]:
    counts = (
        docs.select(text_of(text_col).alias("t"))
        .select(_entry(text_key("t")).alias("entry"), F.octet_length("t").cast("long").alias("bytes"))
        .groupBy("entry").agg(F.sum("bytes").alias("bytes"))
    )
    sizes = {r.entry: r.bytes for r in counts.collect()}  # at most one row for each directory entry
    return split_buckets(sizes, max(bucket_bytes, sum(sizes.values()) >> (DIRECTORY_BITS - 2)))


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in key order: the digest of each row's text, and whether it is the first with that text."""
    key, page, chain = None, None, {}
    for batch in batches:
        firsts, digests = [], []
        for k, p, text in zip(batch.column("key").to_pylist(), batch.column("page").to_pylist(), raw(batch.column("text")), strict=True):
            if (k, p) != (key, page):
                key, page, chain = k, p, []
            body = normalised(text)
            met = next((digest for other, digest in chain if other == body), None)
            firsts.append(met is None)
            if met is None:
                met = hashlib.sha256(body).hexdigest()
                chain.append((body, met))
            digests.append(met)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(firsts, pa.bool_()), pa.array(digests, pa.string())], [*names, "first", "sha"])


def build_index(docs: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: its bucket and page, key, digest, code points, and the columns in `carry`.

    `first` marks the row that stays among those of one text in its page.
    """
    spark = docs.sparkSession
    found = directory(docs, text_col, bucket_bytes)
    # from an Arrow table, as rows of a list would start further Python workers on every executor
    kinds = {"entry": pa.int32(), "bucket": pa.int32(), "pages": pa.int64()}
    entries = spark.createDataFrame(pa.table({name: pa.array([r[i] for r in found], kind) for i, (name, kind) in enumerate(kinds.items())}))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("__none")).alias("carried")
    ).select("*", text_key("text").alias("key"), F.length("text").cast("long").alias("cp"))
    rows = (
        rows.withColumn("entry", _entry(F.col("key")))
        # at most 2 ** DIRECTORY_BITS rows, with every entry: an inner join would also work out the keys before it, to test them for null
        .join(F.broadcast(entries), "entry", "left")
        .withColumn("page", F.pmod(F.xxhash64("id", "cp", F.crc32("text")), F.col("pages")).cast("int"))
        .drop("entry")
    )
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"]).add("first", "boolean").add("sha", "string")
    owned = rows.repartition("bucket", "page").sortWithinPartitions("bucket", "page", "key", F.desc("cp"), F.asc_nulls_last("id"))
    return owned.mapInArrow(tidied(_own), schema)


def _winners(index: DataFrame) -> DataFrame:
    """For each text, the row that stays and the number of rows; pages are united here."""
    order = F.struct((-F.col("cp")).alias("cp"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("page").alias("page"))
    return index.groupBy("bucket", "key", "sha").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """For every row: the row kept in its stead, the size of its group, and the digest of its normalised text."""
    index = staged(build_index(docs, [], id_col, text_col, bucket_bytes).drop("carried"), "copies")
    keys = ["bucket", "key", "sha"]
    return index.join(_winners(index), keys).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("first") & (F.col("page") == F.col("best.page"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows that stay, with all their columns."""
    index = build_index(docs, docs.columns, id_col, text_col, bucket_bytes).where("first")
    index = staged(index, "firsts")
    paged = index.where("pages > 1")
    best = _winners(paged.select("bucket", "key", "sha", "cp", "id", "page")).select("bucket", "key", "sha", F.col("best.page").alias("page"))
    whole = index.where("pages = 1").select("carried").unionAll(paged.join(best, ["bucket", "key", "sha", "page"], "left_semi").select("carried"))
    return whole.select(*[F.col(f"carried.`{c}`").alias(c) for c in docs.columns])
