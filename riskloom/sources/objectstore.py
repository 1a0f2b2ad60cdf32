"""CSV and Parquet objects in an S3-compatible store, through the Hadoop connector."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.sources import files


@dataclass(frozen=True)
class StoreSettings:
    endpoint: str = ""
    access_key: str = ""
    secret_key: str = ""

    def hadoop_options(self) -> dict[str, str]:
        out = {"fs.s3a.path.style.access": "true"}
        if self.endpoint:
            out["fs.s3a.endpoint"] = with_scheme(self.endpoint)
            out["fs.s3a.connection.ssl.enabled"] = str(with_scheme(self.endpoint).startswith("https://")).lower()
        if self.access_key:
            out["fs.s3a.access.key"] = self.access_key
            out["fs.s3a.secret.key"] = self.secret_key
        return out


def with_scheme(endpoint: str) -> str:
    return endpoint if endpoint.startswith(("http://", "https://")) else f"http://{endpoint}"


def store_uri(uri: str) -> str:
    """The connector's scheme in place of the plain one."""
    return "s3a://" + uri[len("s3://") :] if uri.startswith("s3://") else uri


def read_object(spark: SparkSession, uri: str, settings: StoreSettings, **options) -> DataFrame:
    files.format_of(uri)
    _apply(spark, settings)
    return files.read_table(spark, store_uri(uri), **options)


def write_object(df: DataFrame, uri: str, settings: StoreSettings, **options) -> str:
    files.format_of(uri)
    _apply(df.sparkSession, settings)
    return files.write_table(df, store_uri(uri), **options)


def _apply(spark: SparkSession, settings: StoreSettings) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, value in settings.hadoop_options().items():
        conf.set(name, value)
