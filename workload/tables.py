"""Validation and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import to_number, to_time
from riskloom.operators import clean, ordered, validate
from riskloom.operators.presets import (
    ALERT_COLUMNS,
    APPLICATION_CATEGORIES,
    APPLICATION_COLUMNS,
    APPLICATION_FLAGS,
    APPLICATION_TYPES,
    SENTINEL_COLUMNS,
    TRANSFER_COLUMNS,
    TRANSFER_LEAKAGE,
    TRANSFER_TECHNICAL,
)
from workload.registry import ctes, moment, number, query, whole
from workload.views import (
    ALERTS,
    APPLICATIONS,
    TRANSFERS,
    alerts,
    applications,
    duck,
    table,
    transfers,
)

APPS = duck(APPLICATIONS)
# Rows from the phone channel occur twice, so that there are copies to find.
COPIED = "SELECT * FROM applications UNION ALL SELECT * FROM applications WHERE source = 'TELEAPP'"

CLEAN_COLUMNS = ["app_id", *APPLICATION_COLUMNS]


def clean_column(name: str) -> str:
    if name in SENTINEL_COLUMNS:
        return f"nullif({name}, -1) AS {name}"
    if name in APPLICATION_CATEGORIES:
        return f"coalesce({name}, 'nan') AS {name}"
    return name


CLEANED = "SELECT DISTINCT " + ", ".join(clean_column(c) for c in CLEAN_COLUMNS) + " FROM copied"
CLEANED_PARTS = {"applications": APPS, "copied": COPIED, "cleaned": CLEANED}


def shown(names, types=APPLICATION_TYPES) -> str:
    out = []
    for n in names:
        kind = types.get(n, "bigint")
        out.append(n if kind == "string" else number(n) if kind == "double" else whole(n))
    return ", ".join(out)


def copied(spark, folder):
    apps = applications(spark, folder)
    return apps.unionAll(apps.where("source = 'TELEAPP'"))


NULL_COUNTS = ", ".join(f"count(*) - count({c}) AS {c}" for c in CLEAN_COLUMNS)
NULL_NAMES = " || ".join(f"CASE WHEN count({c}) < count(*) THEN '{c},' ELSE '' END" for c in CLEAN_COLUMNS)


@query(
    "v01_column_lists",
    ctes(
        {"applications": APPS},
        """SELECT TRUE AS is_valid, '' AS missing_columns, 'app_id' AS unexpected_columns, 'schema is valid' AS message,
        CAST(count(*) AS BIGINT) AS row_count FROM applications""",
    ),
)
def v01(spark, folder):
    return validate.schema_report(applications(spark, folder)).select(
        "is_valid", "missing_columns", "unexpected_columns", "message", "row_count"
    )


@query(
    "v02_counts",
    ctes({"applications": APPS, "copied": COPIED}, f"SELECT {whole('count(*)', 'row_count')}, CAST(33 AS BIGINT) AS column_count FROM copied"),
)
def v02(spark, folder):
    return validate.schema_report(copied(spark, folder)).select("row_count", "column_count")


@query(
    "v03_null_columns",
    ctes(CLEANED_PARTS, f"SELECT rtrim({NULL_NAMES}, ',') AS columns_with_nulls FROM cleaned"),
)
def v03(spark, folder):
    return validate.schema_report(clean.sentinel_to_null(applications(spark, folder))).select("columns_with_nulls")


@query(
    "v04_duplicate_rows",
    ctes(
        {"applications": APPS, "copied": COPIED},
        "SELECT (SELECT CAST(count(*) AS BIGINT) FROM copied) - (SELECT count(*) FROM (SELECT DISTINCT * FROM copied)) AS duplicate_rows",
    ),
)
def v04(spark, folder):
    return validate.schema_report(copied(spark, folder)).select("duplicate_rows")


@query(
    "v05_target_values",
    ctes({"applications": APPS}, f"SELECT {whole('fraud_bool', 'value')}, {whole('count(*)', 'rows')} FROM applications GROUP BY 1"),
)
def v05(spark, folder):
    checked = validate.require_binary_target(applications(spark, folder))
    return checked.groupBy(F.col("fraud_bool").alias("value")).agg(F.count(F.lit(1)).alias("rows"))


@query("v06_not_empty", "SELECT count(*) > 0 AS has_rows, count(*) AS rows FROM orders")
def v06(spark, folder):
    orders = validate.require_not_empty(table(spark, folder, "orders"))
    return orders.agg((F.count(F.lit(1)) > 0).alias("has_rows"), F.count(F.lit(1)).alias("rows"))


@query(
    "v07_full_validation",
    ctes(
        {"applications": APPS, "copied": COPIED},
        """SELECT TRUE AS is_valid, CAST(count(*) AS BIGINT) AS row_count, CAST(33 AS BIGINT) AS column_count, '' AS missing_columns,
        'app_id' AS unexpected_columns, '' AS columns_with_nulls,
        CAST(count(*) AS BIGINT) - (SELECT count(*) FROM (SELECT DISTINCT * FROM copied)) AS duplicate_rows, 'schema is valid' AS message FROM copied""",
    ),
)
def v07(spark, folder):
    report = validate.full_validation(copied(spark, folder))
    return spark.createDataFrame(
        [tuple(report.__dict__.values())],
        "is_valid boolean, row_count bigint, column_count bigint, missing_columns array<string>, "
        "unexpected_columns array<string>, columns_with_nulls array<string>, duplicate_rows bigint, message string",
    )


@query(
    "v08_required_columns",
    ctes(
        {"transfers": duck(TRANSFERS), "alerts": duck(ALERTS)},
        """SELECT 'transfers' AS name, '' AS missing_columns, CAST(count(*) AS BIGINT) AS rows FROM transfers
        UNION ALL SELECT 'alerts', 'Timestamp,Entry', count(*) FROM alerts""",
    ),
)
def v08(spark, folder):
    def row(df, name, expected):
        return df.agg(
            F.lit(name).alias("name"),
            F.lit(validate.missing_columns(df, expected)).cast("array<string>").alias("missing_columns"),
            F.count(F.lit(1)).alias("rows"),
        )

    paid = validate.require_columns(transfers(spark, folder), TRANSFER_COLUMNS, "transfers")
    held = validate.require_columns(alerts(spark, folder), ALERT_COLUMNS, "alerts")
    return row(paid, "transfers", TRANSFER_COLUMNS).unionByName(row(held, "alerts", [*ALERT_COLUMNS, "Timestamp", "Entry"]))


@query(
    "v09_unknown_labels",
    "SELECT o_orderstatus AS label, CAST(count(*) AS BIGINT) AS rows FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
)
def v09(spark, folder):
    return validate.unknown_labels(table(spark, folder, "orders"), "o_orderstatus", ["F", "O"])


@query(
    "v10_model_columns",
    ctes({"applications": APPS}, f"SELECT {shown(['month', 'income', 'source', 'app_id'])} FROM applications"),
)
def v10(spark, folder):
    return validate.select_model_columns(applications(spark, folder), ["month", "income", "source", "app_id"])


REQUEST_FIELDS = [c for c in APPLICATION_COLUMNS if c != "fraud_bool"]


@query(
    "v11_typed_requests",
    ctes({"applications": APPS}, f"SELECT {whole('app_id')}, {shown(REQUEST_FIELDS)} FROM applications"),
)
def v11(spark, folder):
    apps = applications(spark, folder)
    text = apps.select("app_id", F.to_json(F.struct(*REQUEST_FIELDS)).alias("body"))
    return validate.parse_requests(text, "body")


@query("c01_distinct_rows", ctes({"applications": APPS, "copied": COPIED}, f"SELECT DISTINCT {shown(CLEAN_COLUMNS)} FROM copied"))
def c01(spark, folder):
    return clean.drop_duplicate_rows(copied(spark, folder))


@query(
    "c02_first_by_key",
    f"""SELECT {whole('l_orderkey')}, {whole('l_linenumber')}, {whole('l_partkey')}, {whole('l_suppkey')}, {number('l_extendedprice')}
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def c02(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return clean.first_by_key(lines, ["l_orderkey"], order).drop("l_shipdate")


@query(
    "c03_sentinel_to_null",
    ctes(CLEANED_PARTS, f"SELECT {shown(['app_id', *SENTINEL_COLUMNS])} FROM cleaned"),
)
def c03(spark, folder):
    return clean.sentinel_to_null(applications(spark, folder)).select("app_id", *SENTINEL_COLUMNS)


@query(
    "c04_categories_to_text",
    f"SELECT {whole('o_orderkey', 'app_id')}, coalesce(nullif(o_orderpriority, '5-LOW'), 'nan') AS payment_type, CAST(o_custkey AS VARCHAR) AS source FROM orders",
)
def c04(spark, folder):
    orders = table(spark, folder, "orders")
    raw = orders.select(
        F.col("o_orderkey").alias("app_id"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("payment_type"),
        F.col("o_custkey").alias("source"),
    )
    return clean.categories_to_text(raw)


@query(
    "c05_flags_to_integer",
    ctes({"applications": APPS}, f"SELECT {whole('app_id')}, {', '.join(whole(c) for c in APPLICATION_FLAGS)} FROM applications"),
)
def c05(spark, folder):
    apps = applications(spark, folder)
    loose = apps.withColumns({c: F.col(c).cast("double") for c in APPLICATION_FLAGS})
    return clean.flags_to_integer(loose).select("app_id", *APPLICATION_FLAGS)


ORDER_SQL = "month NULLS LAST, days_since_request NULLS LAST, customer_age NULLS LAST, income NULLS LAST, app_id"


@query(
    "c06_reproducible_order",
    ctes({"applications": APPS}, f"SELECT {whole('app_id')}, {whole(f'row_number() OVER (ORDER BY {ORDER_SQL}) - 1', 'position')} FROM applications"),
)
def c06(spark, folder):
    apps = applications(spark, folder)
    order = clean.reproducible_order(apps, ["app_id"])
    return ordered.with_row_index(apps.select("app_id", *order[:-1]), order, "position").frame.select("app_id", "position")


@query("c07_clean_chain", ctes(CLEANED_PARTS, f"SELECT {shown(CLEAN_COLUMNS)} FROM cleaned"))
def c07(spark, folder):
    return clean.clean_applications(copied(spark, folder))


@query(
    "c08_features_and_target",
    ctes(
        {"applications": APPS},
        f"SELECT {whole('count(*)', 'rows')}, {number('sum(income)', 'income')}, {whole('sum(fraud_bool)', 'positives')}, CAST(32 AS BIGINT) AS feature_columns FROM applications",
    ),
)
def c08(spark, folder):
    features, target = clean.split_features_target(applications(spark, folder))
    x = features.agg(F.count(F.lit(1)).alias("rows"), F.sum("income").alias("income"), F.lit(len(features.columns)).alias("feature_columns"))
    return x.withColumn("k", F.lit(1)).join(target.agg(F.sum("fraud_bool").alias("positives")).withColumn("k", F.lit(1)), "k").drop("k")


@query(
    "c09_to_number",
    f"""SELECT {whole('event_id')}, {number("TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE)", 'amount')} FROM events""",
)
def c09(spark, folder):
    events = table(spark, folder, "events")
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    return events.select("event_id", to_number(text).alias("amount"))


JOINED_TIME = """TRY_CAST("Date" || ' ' || "Time" AS TIMESTAMP)"""


@query(
    "c10_to_time",
    ctes({"transfers": duck(TRANSFERS)}, f"SELECT tx_order, tx_line, tx_part, tx_supplier, {moment(JOINED_TIME, 'event_time')} FROM transfers"),
)
def c10(spark, folder):
    return transfers(spark, folder).select("tx_order", "tx_line", "tx_part", "tx_supplier", to_time("Date", "Time").alias("event_time"))


@query(
    "c11_drop_incomplete",
    ctes(CLEANED_PARTS, f"SELECT {shown(['app_id', *SENTINEL_COLUMNS])} FROM cleaned WHERE bank_months_count IS NOT NULL AND intended_balcon_amount IS NOT NULL"),
)
def c11(spark, folder):
    cleaned = clean.sentinel_to_null(applications(spark, folder)).select("app_id", *SENTINEL_COLUMNS)
    return clean.drop_incomplete(cleaned, ["bank_months_count", "intended_balcon_amount"])


@query(
    "c12_unknown_category",
    ctes(
        {"transfers": duck(TRANSFERS)},
        "SELECT tx_order, tx_line, tx_part, tx_supplier, coalesce(Payment_currency, 'unknown') AS Payment_currency, coalesce(Received_currency, 'unknown') AS Received_currency FROM transfers",
    ),
)
def c12(spark, folder):
    return transfers(spark, folder).select(
        "tx_order",
        "tx_line",
        "tx_part",
        "tx_supplier",
        *[clean.unknown_category(c).alias(c) for c in ("Payment_currency", "Received_currency")],
    )


@query(
    "c13_fill_numeric",
    ctes(CLEANED_PARTS, "SELECT " + whole("app_id") + ", " + ", ".join(
        number(f"coalesce({c}, 0)", c) if APPLICATION_TYPES[c] == "double" else whole(f"coalesce({c}, 0)", c) for c in SENTINEL_COLUMNS
    ) + ", CAST(CASE WHEN email_is_free = 1 THEN fraud_bool END AS BIGINT) AS fraud_bool FROM cleaned"),
)
def c13(spark, folder):
    cleaned = clean.sentinel_to_null(applications(spark, folder))
    sparse = cleaned.withColumn("fraud_bool", F.when(F.col("email_is_free") == 1, F.col("fraud_bool")))
    return clean.fill_numeric(sparse.select("app_id", *SENTINEL_COLUMNS, "fraud_bool"))


@query(
    "c14_map_labels",
    ctes({"alerts": duck(ALERTS)}, f"""SELECT {whole('AlertID')}, {whole("CASE Outcome WHEN 'Report' THEN 1 WHEN 'Dismiss' THEN 0 END", 'label')} FROM alerts"""),
)
def c14(spark, folder):
    return alerts(spark, folder).select("AlertID", clean.map_labels("Outcome", {"Report": 1, "Dismiss": 0}).alias("label"))


@query(
    "c15_binary_target",
    f"""SELECT {whole('l_orderkey')}, {whole('l_linenumber')}, {whole('l_partkey')}, {whole('l_suppkey')},
    {whole("CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END", 'target')} FROM lineitem""",
)
def c15(spark, folder):
    raw = F.when(F.col("l_returnflag") == "R", F.lit("1")).when(F.col("l_returnflag") == "A", F.lit("none"))
    lines = table(spark, folder, "lineitem").withColumn("raw", raw)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", clean.binary_target("raw").alias("target"))


KEPT_TRANSFER = ["Amount", "Payment_type", "Sender_bank_location", "Receiver_bank_location"]


@query(
    "c16_drop_technical",
    ctes({"transfers": duck(TRANSFERS)}, f"SELECT tx_order, tx_line, tx_part, tx_supplier, {number('Amount')}, Payment_type, Payment_currency, Received_currency, Sender_bank_location, Receiver_bank_location FROM transfers"),
)
def c16(spark, folder):
    return transfers(spark, folder).drop(*TRANSFER_TECHNICAL, *TRANSFER_LEAKAGE, "Time", "Date", "Is_laundering")


@query(
    "c17_column_order",
    ctes({"applications": APPS}, f"SELECT 'fraud_bool,month,app_id' AS first_columns, {whole('count(*)', 'rows')} FROM applications"),
)
def c17(spark, folder):
    moved = clean.put_first(applications(spark, folder), ["fraud_bool", "month"])
    return moved.agg(F.lit(",".join(moved.columns[:3])).alias("first_columns"), F.count(F.lit(1)).alias("rows"))


def _half_even(c: str) -> str:
    return f"CASE WHEN abs({c} - trunc({c})) = 0.5 THEN 2 * round({c} / 2) ELSE round({c}) END"


@query(
    "c18_serving_payload",
    f"""SELECT {whole('o_orderkey', 'app_id')}, {whole(_half_even('(o_custkey / CAST(2 AS DOUBLE))'), 'customer_age')},
    {number('o_totalprice', 'income')}, coalesce(nullif(o_orderpriority, '5-LOW'), 'nan') AS source FROM orders""",
)
def c18(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("app_id"),
        (F.col("o_custkey") / F.lit(2.0)).cast("string").alias("customer_age"),
        F.col("o_totalprice").cast("string").alias("income"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("source"),
        F.lit(0).alias("fraud_bool"),
    )
    return clean.serving_payload(raw)
