"""Database tables and queries over JDBC: option building, parallel reads, batched writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 100_000
WRITE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


@dataclass(frozen=True)
class DatabaseSettings:
    host: str = "localhost"
    port: int = 5432
    database: str = ""
    user: str = ""
    password: str = ""
    driver: str = "org.postgresql.Driver"
    kind: str = "postgresql"

    def options(self) -> dict[str, str]:
        return {
            "url": f"jdbc:{self.kind}://{self.host}:{self.port}/{self.database}",
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


@dataclass(frozen=True)
class ParallelRead:
    """How to cut a table for reading: a column, its bounds and the number of parts."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def split_table_name(table: str) -> tuple[str | None, str]:
    schema, dot, name = table.partition(".")
    return (schema, name) if dot else (None, table)


def read_options(config: dict, settings: DatabaseSettings, parallel: ParallelRead | None = None) -> dict[str, str]:
    """Reader options for a `query` or a `table`; a query wins. A parallel read needs a table or a subselect."""
    options = settings.options()
    query, table = config.get("query"), config.get("table")
    if query and parallel:
        options["dbtable"] = f"({query}) AS source_query"
    elif query:
        options["query"] = str(query)
    elif table:
        options["dbtable"] = str(table)
    else:
        raise ValueError("a database source needs a table or a query")
    if parallel:
        options.update(parallel.options())
    return options


def read_database(
    spark: SparkSession,
    config: dict,
    settings: DatabaseSettings,
    *,
    limit: int | None = None,
    parallel: ParallelRead | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A lazy table; a limit is pushed into the database by Spark."""
    reader = spark.read.format("jdbc").options(**read_options(config, settings, parallel))
    df = reader.option("fetchsize", fetch_rows).option("pushDownLimit", "true").load()
    return df.limit(int(limit)) if limit else df


def write_options(config: dict, settings: DatabaseSettings, batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    table = config.get("table")
    if not table:
        raise ValueError("saving to a database needs a table")
    split_table_name(table)
    return {**settings.options(), "dbtable": table, "batchsize": str(batch_rows)}


def write_mode(if_exists: str = "replace") -> str:
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(WRITE_MODES)}, not {if_exists}")
    return WRITE_MODES[if_exists]


def write_database(
    df: DataFrame,
    config: dict,
    settings: DatabaseSettings,
    *,
    if_exists: str = "replace",
    batch_rows: int = BATCH_ROWS,
    connections: int | None = None,
) -> None:
    options = write_options(config, settings, batch_rows)
    if connections:
        options["numPartitions"] = str(connections)
    df.write.format("jdbc").mode(write_mode(if_exists)).options(**options).save()
