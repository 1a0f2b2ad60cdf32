"""Source and sink queries: tables written to a fresh folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.operators import applications as app
from riskloom.operators import clean, ordered
from riskloom.session import shared_folder
from riskloom.sources import files, ledger, records
from riskloom.sources.catalog import Catalog, preview
from workload.registry import ctes, moment, number, query, whole
from workload.tables import APPS
from workload.views import applications, table


def scratch(spark, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


ORDER_COLUMNS = f"{whole('o_orderkey')}, {whole('o_custkey')}, o_orderstatus, {number('o_totalprice')}, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"
ORDERS_SQL = f"SELECT {ORDER_COLUMNS} FROM orders"


@query("s01_s03_csv_round_trip", ORDERS_SQL)
def s01(spark, folder):
    orders = table(spark, folder, "orders")
    path = files.write_table(orders, scratch(spark, "orders") + ".csv")
    return files.read_table(spark, path, schema=orders.schema)


@query("s02_s04_parquet_round_trip", f"SELECT {whole('event_id')}, {moment('ts')}, {whole('user_id')}, event_type, {number('value')}, props FROM events")
def s02(spark, folder):
    path = files.write_table(table(spark, folder, "events"), scratch(spark, "events") + ".parquet")
    return files.read_table(spark, path)


@query(
    "s05_format_by_suffix",
    " UNION ALL ".join(f"SELECT '{k}' AS kind, {whole('count(*)', 'rows')}, {number('sum(c_acctbal)', 'balance', 2)} FROM customer" for k in ("csv", "parquet")),
    digits=2,
)
def s05(spark, folder):
    customers, out = table(spark, folder, "customer"), None
    for suffix in (".csv", ".parquet"):
        path = files.write_table(customers, scratch(spark, "customer") + suffix)
        back = files.read_table(spark, path, schema=customers.schema if suffix == ".csv" else None)
        part = back.agg(F.lit(files.format_of(path)).alias("kind"), F.count(F.lit(1)).alias("rows"), F.sum("c_acctbal").alias("balance"))
        out = part if out is None else out.unionByName(part)
    return out


@query("s11_json_payloads", f"SELECT {whole('o_orderkey')}, {whole('o_custkey')}, o_orderstatus, {number('o_totalprice')} FROM orders")
def s11(spark, folder):
    """Payload objects of up to a thousand neighbouring orders each, landed one per line."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    number_of = F.floor(F.col("o_orderkey") / 1000)
    held = orders.groupBy(number_of.alias("payload")).agg(F.collect_list(F.struct(*orders.columns)).alias("rows"))
    keyed = held.select(
        *[F.when(F.col("payload") % 3 == i, F.col("rows")).alias(k) for i, k in enumerate(records.RECORD_KEYS)]
    )
    path = scratch(spark, "payloads")
    keyed.write.json(path)
    return records.read_records(spark, path, schema=orders.schema, one_per_file=False)


@query(
    "s12_json_nulls",
    ctes({"applications": APPS}, f"""SELECT {whole('count(*)', 'rows')}, {whole('count(*) FILTER (bank_months_count = -1)', 'written_nulls')} FROM applications"""),
)
def s12(spark, folder):
    cleaned = clean.sentinel_to_null(applications(spark, folder))
    path = records.write_records(cleaned, scratch(spark, "records"))
    lines = spark.read.text(path)
    return lines.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.contains(F.col("value"), F.lit('"bank_months_count":null'))).alias("written_nulls")
    )


def catalog(spark, label: str) -> Catalog:
    root = scratch(spark, label)
    places = {"csv": {"path": "data.csv"}, "api": {"path": "landed"}}
    return Catalog({"datasets": {"orders": {"target_column": "o_orderstatus", **places}, "archive": {"csv": {"path": "old.parquet"}}}}, root=root)


@query("s13_s14_catalog_round_trip", ORDERS_SQL)
def s14(spark, folder):
    orders, names = table(spark, folder, "orders"), catalog(spark, "catalog")
    names.save(orders, "orders")
    return names.load(spark, "orders", schema=orders.schema)


@query("s16_copy_between_sources", f"SELECT {ORDER_COLUMNS}, {whole('count(*) OVER ()', 'copied')} FROM orders")
def s16(spark, folder):
    orders, names = table(spark, folder, "orders"), catalog(spark, "copy")
    names.save(orders, "orders", "csv")
    names.schemas["orders"] = orders.schema
    copied = names.copy(spark, "orders", "csv", "api")
    back = records.read_records(spark, names._path("landed"), schema=orders.schema, one_per_file=False)
    return back.withColumn("copied", F.lit(copied))


@query("s15_first_rows", f"SELECT {whole('o_orderkey')}, {number('o_totalprice')} FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500")
def s15(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return ordered.first_rows(orders, ["o_orderdate", "o_orderkey"], 500).drop("o_orderdate")


@query("s17_preview", "SELECT CAST(least(count(*), 100) AS BIGINT) AS rows, CAST(6 AS BIGINT) AS columns, 'event_id,ts,user_id,event_type,value,props' AS names FROM events")
def s17(spark, folder):
    return preview(table(spark, folder, "events"), 100)


@query(
    "s18_feature_spec",
    ctes({"applications": APPS}, f"SELECT 'fraud_bool' AS target_column, CAST(65 AS BIGINT) AS features, CAST(10 AS BIGINT) AS categorical, CAST(53 AS BIGINT) AS numerical, {whole('count(*)', 'rows')} FROM applications"),
)
def s18(spark, folder):
    build = app.build_features(clean.clean_applications(applications(spark, folder)), ["app_id"])
    path = scratch(spark, "feature-spec")
    ledger.write_feature_spec(app.feature_spec(build), path)
    sizes = [F.size(f"{k}_columns").alias(n) for k, n in (("feature", "features"), ("categorical", "categorical"), ("numerical", "numerical"))]
    return spark.read.json(path).select("target_column", *sizes, F.lit(build.rows).alias("rows"))


@query("s19_prediction_log", f"SELECT 'batch' AS mode, 'linear' AS model_type, {whole('count(*)', 'rows')}, {whole('1', 'requests')}, {whole('count(*)', 'batch_size')}, {number('sum(o_totalprice)', 'total', 2)} FROM orders", digits=2)
def s19(spark, folder):
    results = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    path = scratch(spark, "predictions")
    ledger.append_predictions(ledger.prediction_log(results, "batch", "linear", 12.5, batch_size=results.count()), path)
    logged = spark.read.parquet(path)
    total = F.get_json_object("result", "$.o_totalprice").cast("double")
    return logged.groupBy("mode", "model_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("request_id").alias("requests"),
        F.max(F.get_json_object("payload", "$.batch_size").cast("bigint")).alias("batch_size"),
        F.sum(total).alias("total"),
    )


@query(
    "s20_metric_rows",
    f"SELECT o_orderpriority AS job_id, {whole('2 * count(*)', 'rows')} FROM orders GROUP BY 1",
)
def s20(spark, folder):
    rows = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("job_id")).agg(F.count(F.lit(1)).alias("rows"))
    path = scratch(spark, "metrics")
    ledger.append_metrics(rows, path)
    ledger.append_metrics(rows, path)
    return spark.read.parquet(path).groupBy("job_id").agg(F.sum("rows").alias("rows"))


@query("s21_landed_table", ctes({"applications": APPS}, f"SELECT {whole('month')}, {whole('count(*)', 'rows')}, {number('sum(income)', 'income', 3)} FROM applications GROUP BY 1"), digits=3)
def s21(spark, folder):
    path = files.write_table(applications(spark, folder), scratch(spark, "landed") + ".parquet", partition_by=["month"])
    return files.read_table(spark, path).groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum("income").alias("income"))
