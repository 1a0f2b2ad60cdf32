"""The input tables of the operators, derived from the test tables by the same SQL in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

APPLICATIONS = """
SELECT o.o_orderkey AS app_id,
  CAST(CASE WHEN (o.o_orderkey * 7 + o.o_custkey) % 20 = 0 THEN 1 ELSE 0 END AS INT) AS fraud_bool,
  (o.o_custkey % 9 + 1) / CAST(10 AS DOUBLE) AS income,
  (o.o_orderkey * 37 % 1000) / CAST(1000 AS DOUBLE) AS name_email_similarity,
  CASE WHEN o.o_orderkey % 3 = 0 THEN -1 ELSE o.o_orderkey % 120 END AS prev_address_months_count,
  CASE WHEN o.o_orderkey % 41 = 0 THEN -1 ELSE o.o_custkey % 200 END AS current_address_months_count,
  10 * (1 + o.o_custkey % 9) AS customer_age,
  o.o_orderkey % 30 AS days_since_request,
  CASE WHEN o.o_orderkey % 4 = 0 THEN CAST(-1 AS DOUBLE) ELSE c.c_acctbal / 100 END AS intended_balcon_amount,
  o.o_orderpriority AS payment_type,
  CAST(c.c_nationkey * 50 + o.o_orderkey % 50 AS BIGINT) AS zip_count_4w,
  o.o_totalprice / 10 AS velocity_6h,
  o.o_totalprice / 20 + c.c_acctbal / 10 AS velocity_24h,
  o.o_totalprice / 50 AS velocity_4w,
  o.o_custkey % 12 AS bank_branch_count_8w,
  o.o_custkey % 15 AS date_of_birth_distinct_emails_4w,
  c.c_mktsegment AS employment_status,
  c.c_acctbal / 25 AS credit_risk_score,
  o.o_orderkey % 2 AS email_is_free,
  o.o_orderstatus AS housing_status,
  CAST(CASE WHEN o.o_custkey % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS phone_home_valid,
  CAST(CASE WHEN o.o_custkey % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS phone_mobile_valid,
  CASE WHEN o.o_orderkey % 6 = 0 THEN -1 ELSE o.o_custkey % 32 END AS bank_months_count,
  CAST(CASE WHEN o.o_orderkey % 4 = 1 THEN 1 ELSE 0 END AS BIGINT) AS has_other_cards,
  CAST(200 * (1 + o.o_orderkey % 10) AS DOUBLE) AS proposed_credit_limit,
  CAST(CASE WHEN o.o_orderkey % 40 = 0 THEN 1 ELSE 0 END AS BIGINT) AS foreign_request,
  CASE WHEN o.o_orderkey % 100 = 0 THEN 'TELEAPP' ELSE 'INTERNET' END AS source,
  CASE WHEN o.o_orderkey % 50 = 0 THEN CAST(-1 AS DOUBLE) ELSE (o.o_orderkey % 600) / CAST(10 AS DOUBLE) END AS session_length_in_minutes,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'linux' WHEN 1 THEN 'macintosh' WHEN 2 THEN 'windows' WHEN 3 THEN 'x11' ELSE 'other' END AS device_os,
  o.o_custkey % 2 AS keep_alive_session,
  o.o_orderkey % 3 AS device_distinct_emails_8w,
  CAST(CASE WHEN o.o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS BIGINT) AS device_fraud_count,
  o.o_orderkey % 8 AS month
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

# The tie columns name a line; position numbers are worked out by the operators.
TRANSFER_TIE = ["tx_order", "tx_line", "tx_part", "tx_supplier"]
TRANSFERS = """
SELECT l.l_orderkey AS tx_order, CAST(l.l_linenumber AS BIGINT) AS tx_line, l.l_partkey AS tx_part, l.l_suppkey AS tx_supplier,
  CASE WHEN l.l_partkey % 97 = 0 THEN 'bad'
       ELSE lpad(CAST(l.l_partkey % 24 AS VARCHAR(9)), 2, '0') || ':' || lpad(CAST(l.l_suppkey % 60 AS VARCHAR(9)), 2, '0') || ':00' END AS "Time",
  CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR(19)) AS "Date",
  o.o_custkey AS Sender_account, l.l_suppkey AS Receiver_account,
  l.l_extendedprice AS Amount,
  CASE WHEN l.l_partkey % 31 = 0 THEN NULL ELSE rc.r_name END AS Payment_currency,
  CASE WHEN l.l_partkey % 62 = 0 THEN NULL ELSE rs.r_name END AS Received_currency,
  nc.n_name AS Sender_bank_location, ns.n_name AS Receiver_bank_location,
  o.o_orderpriority AS Payment_type,
  CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_quantity >= 48 THEN 1 ELSE 0 END AS INT) AS Is_laundering,
  l.l_linestatus AS Laundering_type
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation nc ON c.c_nationkey = nc.n_nationkey JOIN region rc ON nc.n_regionkey = rc.r_regionkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation ns ON s.s_nationkey = ns.n_nationkey JOIN region rs ON ns.n_regionkey = rs.r_regionkey
"""

ALERTS = """
SELECT c_custkey AS AlertID,
  CAST('2024-01-01' AS {ntz}) + CAST(c_custkey % 28 AS INT) * INTERVAL '1' DAY AS "Date",
  CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Report' ELSE 'Dismiss' END AS Outcome
FROM customer
"""

ALERT_TRANSACTIONS = """
SELECT user_id AS AlertID, ts AS "Timestamp", event_id,
  CASE WHEN event_type IN ('purchase', 'click') THEN 'Debit' ELSE 'Credit' END AS Entry,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'Wire' ELSE 'Card' END AS Type,
  CASE WHEN event_type IN ('purchase', 'click') THEN -value ELSE value END AS Size
FROM events
"""

# Short groups: orders as alerts, their lines as transactions.
ORDER_ALERTS = """
SELECT o_orderkey AS AlertID, o_orderdate AS "Date",
  CASE WHEN o_orderstatus = 'F' THEN 'Report' ELSE 'Dismiss' END AS Outcome
FROM orders
"""
ORDER_TIE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
ORDER_TRANSACTIONS = """
SELECT l_orderkey AS AlertID, l_shipdate AS "Timestamp", l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CASE WHEN l_returnflag = 'A' THEN 'Credit' ELSE 'Debit' END AS Entry,
  CASE WHEN l_linestatus = 'O' THEN 'Wire' ELSE 'Card' END AS Type,
  CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE -l_extendedprice END AS Size
FROM lineitem
"""

# Two models' scores; thresholds are chosen on the earlier orders and measured on the later ones.
SCORED = """
SELECT o_orderkey AS row_id,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INT) AS y,
  ((o_orderkey * 7919 + CASE WHEN o_orderpriority = '1-URGENT' THEN 250 ELSE 0 END) % 1001) / CAST(1000 AS DOUBLE) AS score,
  ((o_orderkey * 104729 + CASE WHEN o_orderpriority = '1-URGENT' THEN 400 ELSE 0 END) % 1301) / CAST(1300 AS DOUBLE) AS score_b,
  CASE WHEN o_orderdate < CAST('1996-01-01' AS {ntz}) THEN 'valid' ELSE 'test' END AS part,
  CASE o_orderstatus WHEN 'F' THEN 'Base' WHEN 'O' THEN 'Variant I' ELSE 'Other' END AS scenario
FROM orders
"""

CONTRIBUTIONS = """
SELECT l_orderkey AS row_id,
  CASE l_linenumber % 7 WHEN 0 THEN 'payment_type_' || l_returnflag WHEN 1 THEN 'device_os_' || l_linestatus
    WHEN 2 THEN 'credit_risk_score' WHEN 3 THEN 'velocity_24h_to_6h_ratio' WHEN 4 THEN 'proposed_credit_limit'
    WHEN 5 THEN 'device_fraud_count' ELSE 'income' END AS feature,
  (l_discount - CAST(5 AS DOUBLE) / 100) * l_quantity AS shap_value
FROM lineitem
"""

# The drift pair: two parts of the applications that together hold every row.
REFERENCE_ROWS = "velocity_6h <= 20000"


def duck(view: str) -> str:
    return view.replace("{ntz}", "TIMESTAMP").strip()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """A view over the parquet tables of a folder, without registering anything."""
    import re

    text = sql.replace("{ntz}", "TIMESTAMP_NTZ").replace('"', "`")
    for name in TABLES:
        path = f"{folder.rstrip('/')}/{name}.parquet"
        text = re.sub(rf"\b(FROM|JOIN)\s+{name}\b", rf"\1 parquet.`{path}`", text)
    return spark.sql(text)


def applications(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, APPLICATIONS)


def transfers(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, TRANSFERS)


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, ALERTS)


def alert_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, ALERT_TRANSACTIONS)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, SCORED)


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Both models' scores below each other."""
    wide = scored(spark, folder)
    both = F.array(
        F.struct(F.lit("model_a").alias("model_type"), F.col("score").alias("s")),
        F.struct(F.lit("model_b").alias("model_type"), F.col("score_b").alias("s")),
    )
    return wide.select("row_id", "y", "part", "scenario", F.explode(both).alias("m")).select(
        "row_id", "y", "part", "scenario", "m.model_type", F.col("m.s").alias("score")
    )


MODEL_SCORES = f"""
SELECT row_id, y, part, scenario, 'model_a' AS model_type, score FROM ({duck(SCORED)})
UNION ALL SELECT row_id, y, part, scenario, 'model_b', score_b FROM ({duck(SCORED)})
"""


def contributions(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, CONTRIBUTIONS)


def drift_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    apps = applications(spark, folder)
    return apps.where(REFERENCE_ROWS), apps.where(f"NOT ({REFERENCE_ROWS})")
