import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.presets import APPLICATION_SCHEMA
from riskloom.sources import files, jdbc, ledger, objectstore, records
from riskloom.sources.catalog import Catalog, preview

CONFIG = {
    "default_source": "s3",
    "datasets": {
        "base": {
            "target_column": "fraud_bool",
            "csv": {"path": "base.csv"},
            "s3": {"uri": "s3://bucket/base.csv"},
            "postgres": {"table": "datasets.base"},
            "api": {"path": "landed"},
        },
        "alerts": {"csv": {"path": "alerts.parquet"}},
    },
}


def test_csv_round_trip_and_missing_texts(spark, folder, applications):
    df = applications(20)
    path = files.write_table(df, f"{folder}/deep/apps.csv")
    assert files.read_table(spark, path, schema=APPLICATION_SCHEMA).exceptAll(df).isEmpty()
    (spark.createDataFrame([("a,b,c",), ("2,3.5,x",)], "value string").coalesce(1).write.text(f"{folder}/raw.csv"))
    raw = files.read_table(spark, f"{folder}/raw.csv", schema="a int, b double, c string")
    # The first line is the header.
    assert [tuple(r) for r in raw.collect()] == [(2, 3.5, "x")]
    spark.createDataFrame([("a,b,c",), ("1,NaN,NA",), ("2,,null",)], "value string").coalesce(1).write.text(f"{folder}/gaps.csv")
    gaps = files.read_table(spark, f"{folder}/gaps.csv", schema="a int, b double, c string")
    assert [tuple(r) for r in gaps.orderBy("a").collect()] == [(1, None, None), (2, None, None)]


def test_suffix_and_missing_file(spark, folder):
    with pytest.raises(ValueError, match="unsupported"):
        files.write_table(spark.range(1), f"{folder}/x.txt")
    with pytest.raises(ValueError):
        files.read_table(spark, f"{folder}/x.json")
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, f"{folder}/none.csv")


def test_row_limits(spark, folder):
    path = files.write_table(spark.range(100), f"{folder}/n.parquet")
    assert files.read_table(spark, path, nrows=0).count() == 100
    assert sorted(r["id"] for r in files.read_table(spark, path, nrows=3, order=["-id"]).collect()) == [97, 98, 99]
    assert files.read_table(spark, path, nrows=5).count() == 5


def test_catalog_names_and_errors():
    names = Catalog(CONFIG)
    assert names.dataset_names() == ["alerts", "base"]
    # The setting wins over the file's own default.
    assert names.resolve("base").source == "csv"
    assert Catalog(CONFIG, default_setting=None).resolve("base").source == "s3"
    assert names.resolve("base", "POSTGRES").config == {"table": "datasets.base"}
    assert names.resolve("base").target_column == "fraud_bool"
    for args, text in ((("nobody",), "unknown dataset"), (("base", "ftp"), "unsupported source"), (("alerts", "s3"), "no source 's3'")):
        with pytest.raises(ValueError, match=text):
            names.resolve(*args)


def test_catalog_copy(spark, folder, applications):
    names = Catalog(CONFIG, root=folder)
    names.save(applications(30), "base")
    assert names.copy(spark, "base", "csv", "api") == 30
    assert names.load(spark, "base", "api").exceptAll(applications(30)).isEmpty()
    assert names.load(spark, "base", nrows=4).count() == 4
    assert preview(names.load(spark, "base"), 7).first()["rows"] == 7


@pytest.mark.parametrize("key", ["data", "items", "records", None])
def test_record_payloads(spark, folder, key):
    rows = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    payload = rows if key is None else {key: rows, "total": 2}
    (spark.createDataFrame([(json.dumps(payload),)], "value string").coalesce(1).write.text(f"{folder}/p"))
    for schema in (None, APPLICATION_SCHEMA.__class__.fromJson({"type": "struct", "fields": [{"name": "a", "type": "long", "nullable": True, "metadata": {}}, {"name": "b", "type": "string", "nullable": True, "metadata": {}}]})):
        got = records.read_records(spark, f"{folder}/p", schema=schema).select("a", "b").orderBy("a").collect()
        assert [tuple(r) for r in got] == [(1, "x"), (2, None)]


def test_first_filled_list_wins_and_bad_payload_raises(spark, folder):
    def land(name, payload):
        spark.createDataFrame([(json.dumps(payload),)], "value string").coalesce(1).write.text(f"{folder}/{name}")
        return f"{folder}/{name}"

    assert records.read_records(spark, land("p", {"data": [], "items": [{"a": 1}]})).collect()[0]["a"] == 1
    with pytest.raises(ValueError):
        records.read_records(spark, land("q", {"data": 5}))


@pytest.mark.parametrize("payload", ['{"error": "denied"}', '{"data": [{"a": 1}, {"a"'])
def test_other_and_cut_payloads_raise(spark, folder, payload):
    spark.createDataFrame([(payload,)], "value string").coalesce(1).write.text(f"{folder}/p")
    with pytest.raises(Exception, match="must be a list|MALFORMED|[Mm]alformed"):
        records.read_records(spark, f"{folder}/p", schema=T.StructType().add("a", "long")).collect()


def test_catalog_refuses_a_source_without_names():
    with pytest.raises(ValueError, match="must hold names"):
        Catalog({"datasets": {"base": {"csv": "base.csv"}}})


def test_records_keep_nulls(spark, folder):
    records.write_records(spark.createDataFrame([(1, None)], "a int, b string"), f"{folder}/out")
    assert spark.read.text(f"{folder}/out").first()["value"] == '{"a":1,"b":null}'


def test_store_options():
    assert objectstore.store_uri("s3://b/k.csv") == "s3a://b/k.csv"
    assert objectstore.store_uri("s3a://b/k.csv") == "s3a://b/k.csv"
    options = objectstore.StoreSettings("store:9000", "k", "s").hadoop_options()
    assert options["fs.s3a.endpoint"] == "http://store:9000" and options["fs.s3a.access.key"] == "k"
    assert objectstore.with_scheme("https://x") == "https://x"


def test_object_suffix_is_checked_first(spark):
    with pytest.raises(ValueError):
        objectstore.read_object(spark, "s3://bucket/file.txt", objectstore.StoreSettings())


def test_database_options():
    settings = jdbc.DatabaseSettings("h", 1, "d", "u", "p")
    assert jdbc.read_options({"table": "s.t"}, settings)["dbtable"] == "s.t"
    both = jdbc.read_options({"table": "s.t", "query": "SELECT 1"}, settings)
    assert both["query"] == "SELECT 1" and "dbtable" not in both
    cut = jdbc.read_options({"query": "SELECT 1"}, settings, jdbc.ParallelRead("id", 0, 100, 4))
    assert cut["dbtable"] == "(SELECT 1) AS source_query" and cut["numPartitions"] == "4"
    assert settings.options()["url"] == "jdbc:postgresql://h:1/d"
    with pytest.raises(ValueError):
        jdbc.read_options({}, settings)
    with pytest.raises(ValueError):
        jdbc.write_options({"query": "x"}, settings)
    assert jdbc.write_options({"table": "t"}, settings)["batchsize"] == "100000"
    assert [jdbc.write_mode(m) for m in ("replace", "append", "fail")] == ["overwrite", "append", "errorifexists"]
    with pytest.raises(ValueError):
        jdbc.write_mode("drop")
    assert jdbc.split_table_name("a.b.c") == ("a", "b.c") and jdbc.split_table_name("t") == (None, "t")


def test_ledgers(spark, folder):
    rows = ledger.run_rows(spark, "r1", {"depth": 3, "none": None}, {"auc": 0.5})
    ledger.append_run(rows, f"{folder}/runs")
    ledger.append_run(rows, f"{folder}/runs")
    assert spark.read.parquet(f"{folder}/runs").count() == 4
    with pytest.raises(ValueError):
        ledger.append_metrics(spark.range(1), f"{folder}/m")
    log = ledger.prediction_log(spark.range(3), "single", "linear", 1.0, F.struct("id"), request_id="q")
    ledger.append_predictions(log, f"{folder}/log")
    assert spark.read.parquet(f"{folder}/log").where("mode = 'single' AND request_id = 'q'").count() == 3


def test_csv_columns_are_bound_by_name(spark, folder):
    path = f"{folder}/moved.csv"
    with open(path, "w") as f:
        f.write('b,extra,a\n2,"say ""hi"", ok",1\n')
    got = files.read_table(spark, path, schema="a int, b int, c int")
    assert got.columns == ["a", "b", "extra"]
    assert [tuple(r) for r in got.collect()] == [(1, 2, 'say "hi", ok')]
    files.write_table(got, f"{folder}/back.csv")
    assert files.read_table(spark, f"{folder}/back.csv", schema=got.schema).exceptAll(got).isEmpty()
