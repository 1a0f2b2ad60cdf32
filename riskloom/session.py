"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

COMPILED_BYTES = 8000  # HotSpot compiles no longer method


def local_session(app_name: str = "riskloom", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column expression costs more than building wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a scratch folder only where none is set."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(scratch)
    return scratch


def stage_table(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back, so later jobs start from files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


def keep_methods_compiled(spark: SparkSession) -> None:
    """Let the session run a wide plan operator by operator where its generated method would be too long to be compiled.

    The JVM interprets any method beyond COMPILED_BYTES for ever; Spark by itself lets methods grow to eight times that.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > COMPILED_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))


def drop_table(table: DataFrame) -> None:
    """Delete a table that `stage_table` returned; no later job may read it."""
    spark = table.sparkSession
    if not hasattr(table, "_staged_at"):
        raise ValueError("only staged tables can be dropped")
    path = spark._jvm.org.apache.hadoop.fs.Path(table._staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a small table that came in fewer partitions; large tables pass as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
