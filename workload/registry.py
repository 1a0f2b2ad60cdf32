"""Collects queries and their SQL, and brings results into one comparable form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a query under its key; without SQL only its rows are checked."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(build(spark, folder), digits)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as bigint, numbers rounded, times and lists as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.round(c, digits)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def whole(expr: str, name: str | None = None) -> str:
    """SQL: a bigint column."""
    return f'CAST({expr} AS BIGINT) AS "{name or expr}"'


def number(expr: str, name: str | None = None, digits: int = 6) -> str:
    """SQL: a rounded double column; adding zero clears a negative zero."""
    return f'round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS "{name or expr}"'


def moment(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS \"{name or expr}\""


def ctes(parts: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in parts.items()) + "\n" + select.strip()
