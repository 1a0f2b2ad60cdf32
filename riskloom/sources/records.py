"""JSON records landed as files: a list, or an object holding the list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_KEYS = ("data", "items", "records")


def read_records(
    spark: SparkSession, path: str, *, schema: T.StructType | None = None, one_per_file: bool = True
) -> DataFrame:
    """Rows of a landed payload.

    A payload is a list of records, or an object whose data / items / records holds the list;
    the first non-empty one counts. Anything else is an error, as is a payload that is cut off or does
    not fit the schema, and, under a schema, one that has neither a list nor a value of any of its fields.
    A file is one payload, or holds one per line; a file with a payload per line can be cut for reading,
    so large sources land that way.
    """
    payload = spark.read.option("multiLine", one_per_file).option("mode", "FAILFAST")
    if schema is not None:
        wrapped = T.StructType([T.StructField(k, T.ArrayType(schema)) for k in RECORD_KEYS])
        rows = payload.schema(T.StructType(list(wrapped.fields) + list(schema.fields))).json(path)
        present = list(RECORD_KEYS)
    else:
        rows = payload.json(path)
        present = [k for k in RECORD_KEYS if k in rows.columns and _is_record_list(rows.schema[k].dataType)]
    plain = [c for c in rows.columns if c not in RECORD_KEYS]
    if not present:
        if not plain or set(rows.columns) & set(RECORD_KEYS):
            raise ValueError("the payload must be a list or an object with data, items or records")
        return rows
    held = F.coalesce(*[F.when(F.size(k) > 0, F.col(k)) for k in present], *[F.col(k) for k in present])
    nested = rows.where(reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in present]))
    return nested.select(F.explode(held).alias("r")).select("r.*") if schema is None or not plain else _either(rows, nested, held, schema, present)


def _is_record_list(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def _either(rows: DataFrame, nested: DataFrame, held, schema: T.StructType, present: list[str]) -> DataFrame:
    absent = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in present])
    filled = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in schema.fieldNames()])
    told = F.raise_error("the payload must be a list or an object with data, items or records").cast("boolean")
    listed = rows.where(absent).where(F.when(filled, True).otherwise(told)).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    return nested.select(F.explode(held).alias("r")).select("r.*").unionByName(listed)


def write_records(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """One JSON object per line; missing values are written as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path
