"""CSV and Parquet files on any file system Spark can reach, chosen by suffix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.ordered import first_rows

FORMATS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}

# Texts read as missing in a CSV file.
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def format_of(path: str) -> str:
    lowered = path.rstrip("/").lower()
    for suffix, name in FORMATS.items():
        if lowered.endswith(suffix):
            return name
    raise ValueError(f"unsupported file format: {path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def normalise_missing(df: DataFrame, texts: bool = True) -> DataFrame:
    """NaN to null in numbers and, for CSV input, missing markers to null in texts."""
    changed = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            changed[f.name] = F.when(~F.isnan(c), c)
        elif texts and isinstance(f.dataType, T.StringType):
            changed[f.name] = F.when(~c.isin(*MISSING_TEXTS), c)
    return df.withColumns(changed) if changed else df


def _typed_csv(reader: DataFrameReader, path: str, schema: T.StructType | str) -> DataFrame:
    wanted = {f.name: f for f in (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)}
    header = reader.csv(path).columns
    typed = T.StructType([wanted.get(name, T.StructField(name, T.StringType())) for name in header])
    order = [name for name in wanted if name in header] + [name for name in header if name not in wanted]
    return reader.option("enforceSchema", False).schema(typed).csv(path).select(*[F.col(f"`{name}`") for name in order])


def read_table(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    nrows: int | None = None,
    order: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """Read a file or folder. Without a schema the types of a CSV are inferred.

    A schema gives types to the columns of a CSV by the names in its header: columns the file lacks are left
    out, so that validation can see it, and those it has besides come last, as text. All files of a folder
    must have one header. Quotes in quoted texts are doubled; lines broken within quotes need `multiLine`.

    `nrows` keeps the first rows; give `order` to say what first means, else any rows in file order count.
    """
    kind = format_of(path)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"file not found: {path}")
    reader = spark.read.options(**options)
    if kind == "csv":
        reader = spark.read.options(**{"header": True, "quote": '"', "escape": '"'} | options)
        df = normalise_missing(_typed_csv(reader, path, schema) if schema is not None else reader.option("inferSchema", True).csv(path))
    else:
        df = normalise_missing((reader.schema(schema) if schema is not None else reader).parquet(path), texts=False)
    if nrows and int(nrows) > 0:
        df = first_rows(df, order, nrows) if order else df.limit(int(nrows))
    return df


def write_table(
    df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: Sequence[str] = (), **options: str
) -> str:
    """Write to the path, replacing what is there. Folders on the way are made by the writer."""
    kind = format_of(path)
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "csv":
        writer.options(**{"header": True, "quote": '"', "escape": '"'} | options).csv(path)
    else:
        writer.parquet(path)
    return path
