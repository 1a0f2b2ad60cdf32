"""Application and transfer feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import cyclic, safe_ratio
from riskloom.operators import applications as app
from riskloom.operators import clean, ordered
from riskloom.operators import transfers as tr
from workload.registry import ctes, moment, number, query, whole
from workload.tables import CLEANED_PARTS, ORDER_SQL, copied
from workload.views import TRANSFER_TIE, TRANSFERS, duck, table, transfers

MONTH = "greatest(greatest(CAST(coalesce(month, 1) AS INT), 1) - 1, 1)"
DAYS = "greatest(CAST(coalesce(days_since_request, 0) AS INT), 0)"
INDEXED = f"SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS event_id FROM cleaned"
TIMED = f"""SELECT *, make_timestamp(2024, {MONTH}, 1, 0, 0, 0) + to_days({DAYS}) + to_minutes(event_id * 5) AS event_time FROM indexed"""
CALENDAR = """SELECT *, hour(event_time) AS event_hour, day(event_time) AS event_day, isodow(event_time) - 1 AS event_day_of_week FROM timed"""

PI2 = "2 * pi()"


def ratio(a: str, b: str) -> str:
    return f"({a}) / nullif({b} + 1e-6, 0)"


def sine(f: str, c: str, p: int) -> str:
    return f"{f}({PI2} * {c} / {p})"


DERIVED: dict[str, tuple[str, str]] = {
    "event_hour": ("w", "event_hour"),
    "event_day": ("w", "event_day"),
    "event_day_of_week": ("w", "event_day_of_week"),
    "event_is_weekend": ("w", "CASE WHEN event_day_of_week >= 5 THEN 1 ELSE 0 END"),
    "event_hour_sin": ("n", sine("sin", "event_hour", 24)),
    "event_hour_cos": ("n", sine("cos", "event_hour", 24)),
    "event_day_of_week_sin": ("n", sine("sin", "event_day_of_week", 7)),
    "event_day_of_week_cos": ("n", sine("cos", "event_day_of_week", 7)),
    "prev_address_months_count_is_missing": ("w", "prev_address_months_count IS NULL"),
    "current_address_months_count_is_missing": ("w", "current_address_months_count IS NULL"),
    "intended_balcon_amount_is_missing": ("w", "intended_balcon_amount IS NULL"),
    "bank_months_count_is_missing": ("w", "bank_months_count IS NULL"),
    "session_length_in_minutes_is_missing": ("w", "session_length_in_minutes IS NULL"),
    "credit_limit_to_income_ratio": ("n", ratio("proposed_credit_limit", "income")),
    "velocity_24h_to_6h_ratio": ("n", ratio("velocity_24h", "velocity_6h")),
    "velocity_4w_to_24h_ratio": ("n", ratio("velocity_4w", "velocity_24h")),
    "bank_tenure_to_age_ratio": ("n", ratio("bank_months_count", "customer_age")),
    "email_name_similarity_weighted": ("n", "name_email_similarity * (1 + coalesce(email_is_free, 0))"),
    "income_x_credit_risk": ("n", "income * credit_risk_score"),
    "credit_limit_x_risk": ("n", "proposed_credit_limit * credit_risk_score"),
    "session_length_x_keep_alive": ("n", "coalesce(session_length_in_minutes, 0) * coalesce(keep_alive_session, 0)"),
    "device_fraud_to_distinct_email_ratio": ("n", ratio("device_fraud_count", "device_distinct_emails_8w")),
    "zip_to_branch_activity_ratio": ("n", ratio("zip_count_4w", "bank_branch_count_8w")),
    "velocity_mean": ("n", "list_avg([velocity_6h, velocity_24h, velocity_4w])"),
    "velocity_std": ("n", "list_stddev_samp([velocity_6h, velocity_24h, velocity_4w])"),
    "velocity_max": ("n", "greatest(velocity_6h, velocity_24h, velocity_4w)"),
    "velocity_delta_24h_6h": ("n", "velocity_24h - velocity_6h"),
    "velocity_delta_4w_24h": ("n", "velocity_4w - velocity_24h"),
    "risk_foreign_and_device_fraud": ("w", "coalesce(foreign_request, 0) = 1 AND coalesce(device_fraud_count, 0) > 0"),
    "risk_both_phones_invalid": ("w", "coalesce(phone_home_valid, 0) = 0 AND coalesce(phone_mobile_valid, 0) = 0"),
    "risk_low_similarity_free_email": ("w", "coalesce(name_email_similarity, 0) < 0.35 AND coalesce(email_is_free, 0) = 1"),
    "risk_new_bank_and_new_address": ("w", "coalesce(bank_months_count, 999) < 6 AND coalesce(current_address_months_count, 999) < 6"),
}

FEATURE_PARTS = {**CLEANED_PARTS, "indexed": INDEXED, "timed": TIMED, "calendar": CALENDAR}


def derived(*names: str, digits: int = 6) -> str:
    return ", ".join(
        whole(DERIVED[n][1], n) if DERIVED[n][0] == "w" else number(DERIVED[n][1], n, digits) for n in names
    )


def feature_sql(*names: str, source: str = "calendar", digits: int = 6) -> str:
    return ctes(FEATURE_PARTS, f"SELECT {whole('app_id')}, {derived(*names, digits=digits)} FROM {source}")


def cleaned(spark, folder):
    return clean.clean_applications(copied(spark, folder))


def indexed(spark, folder):
    return ordered.with_row_index(cleaned(spark, folder), clean.reproducible_order(copied(spark, folder), ["app_id"]), stage=True).frame


@query("f01_row_index", ctes(FEATURE_PARTS, f"SELECT {whole('app_id')}, {whole('event_id')} FROM indexed"))
def f01(spark, folder):
    return indexed(spark, folder).select("app_id", "event_id")


@query("f02_event_time", ctes(FEATURE_PARTS, f"SELECT {whole('app_id')}, {moment('event_time')} FROM timed"))
def f02(spark, folder):
    return app.add_event_time(indexed(spark, folder)).select("app_id", "event_time")


ON_ORDERS = """SELECT o_orderkey AS app_id, hour(o_orderdate) AS event_hour, day(o_orderdate) AS event_day,
isodow(o_orderdate) - 1 AS event_day_of_week FROM orders"""
F03_COLUMNS = ["event_hour", "event_day", "event_day_of_week"]
F04_F05 = ["event_is_weekend", "event_hour_sin", "event_hour_cos", "event_day_of_week_sin", "event_day_of_week_cos"]


@query("f03_calendar_parts", ctes({"calendar": ON_ORDERS}, f"SELECT {whole('app_id')}, {derived(*F03_COLUMNS)} FROM calendar"))
def f03(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "app_id")
    return app.add_calendar(orders, "o_orderdate").select("app_id", *F03_COLUMNS)


FAR = """SELECT o_orderkey AS app_id, 31 + 19723 + o_orderkey % 40 + (o_orderkey * 20000000 * 5) // 1440 AS days, (o_orderkey * 20000000 * 5) % 1440 AS minutes FROM orders"""
FAR_PARTS = """SELECT app_id, minutes // 60 AS event_hour, day(DATE '1970-01-01' + CAST(days % 146097 AS INTEGER)) AS event_day,
(days + 3) % 7 AS event_day_of_week, CASE WHEN (days + 3) % 7 >= 5 THEN 1 ELSE 0 END AS event_is_weekend FROM far"""


@query("f03_calendar_of_far_positions", ctes({"far": FAR, "calendar": FAR_PARTS}, f"SELECT {whole('app_id')}, {derived(*F03_COLUMNS, 'event_is_weekend')} FROM calendar"))
def f03_far(spark, folder):
    """Positions up to 1.2e12 and more: the clock has run for millions of years, beyond any timestamp."""
    key = F.col("o_orderkey")
    far = table(spark, folder, "orders").select(key.alias("app_id"), F.lit(3).alias("month"), (key % 40).alias("days_since_request"), (key * 20_000_000).alias("event_id"))
    return app.add_calendar(far, app.time_of_cycle()).select("app_id", *F03_COLUMNS, "event_is_weekend")


@query("f04_weekend_flag", ctes({"calendar": ON_ORDERS}, f"SELECT {whole('app_id')}, {derived('event_is_weekend')} FROM calendar"))
def f04(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "app_id")
    return app.add_calendar(orders, "o_orderdate").select("app_id", "event_is_weekend")


@query(
    "f05_cyclic_encoding",
    f"""SELECT {whole('event_id')}, {number(sine('sin', 'hour(ts)', 24), 'hour_sin')}, {number(sine('cos', 'hour(ts)', 24), 'hour_cos')},
    {number(sine('sin', '(isodow(ts) - 1)', 7), 'day_sin')}, {number(sine('cos', '(isodow(ts) - 1)', 7), 'day_cos')} FROM events""",
)
def f05(spark, folder):
    hour, day = cyclic(F.hour("ts"), 24), cyclic(F.weekday("ts"), 7)
    return table(spark, folder, "events").select(
        "event_id", hour[0].alias("hour_sin"), hour[1].alias("hour_cos"), day[0].alias("day_sin"), day[1].alias("day_cos")
    )


F06 = [n for n in DERIVED if n.endswith("_is_missing")]


@query("f06_missing_flags", feature_sql(*F06, source="cleaned"))
def f06(spark, folder):
    return app.add_missing_flags(cleaned(spark, folder)).select("app_id", *F06)


@query(
    "f07_safe_ratio",
    f"SELECT {whole('o_orderkey')}, {number('o_totalprice / nullif(CAST(o_custkey % 10 AS DOUBLE), 0)', 'ratio')} FROM orders",
)
def f07(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", safe_ratio("o_totalprice", F.col("o_custkey") % 10).alias("ratio"))


F08 = ["credit_limit_to_income_ratio", "velocity_24h_to_6h_ratio", "velocity_4w_to_24h_ratio", "bank_tenure_to_age_ratio", "email_name_similarity_weighted"]
F09 = ["income_x_credit_risk", "credit_limit_x_risk", "session_length_x_keep_alive", "device_fraud_to_distinct_email_ratio", "zip_to_branch_activity_ratio"]
F10 = ["velocity_mean", "velocity_std", "velocity_max"]
F11 = ["velocity_delta_24h_6h", "velocity_delta_4w_24h"]
F12 = [n for n in DERIVED if n.startswith("risk_")]


@query("f08_ratios", feature_sql(*F08, source="cleaned", digits=4), digits=4)
def f08(spark, folder):
    return app.add_ratios(cleaned(spark, folder)).select("app_id", *F08)


@query("f09_interactions", feature_sql(*F09, source="cleaned", digits=4), digits=4)
def f09(spark, folder):
    return app.add_interactions(cleaned(spark, folder)).select("app_id", *F09)


@query("f10_row_statistics", feature_sql(*F10, source="cleaned"))
def f10(spark, folder):
    return app.add_velocity(cleaned(spark, folder)).select("app_id", *F10)


@query("f11_velocity_deltas", feature_sql(*F11, source="cleaned"))
def f11(spark, folder):
    return app.add_velocity(cleaned(spark, folder)).select("app_id", *F11)


@query("f12_risk_rules", feature_sql(*F12, source="cleaned"))
def f12(spark, folder):
    return app.add_risk_rules(cleaned(spark, folder)).select("app_id", *F12)


CATEGORICAL = [
    "device_os", "employment_status", "event_is_weekend", "housing_status", "payment_type", "risk_both_phones_invalid",
    "risk_foreign_and_device_fraud", "risk_low_similarity_free_email", "risk_new_bank_and_new_address", "source",
]


@query(
    "f13_feature_lists",
    ctes(
        CLEANED_PARTS,
        f"SELECT '{','.join(CATEGORICAL)}' AS categorical, CAST(54 AS BIGINT) AS numerical, CAST(65 AS BIGINT) AS features, {whole('count(*)', 'rows')} FROM cleaned",
    ),
)
def f13(spark, folder):
    build = app.build_features(cleaned(spark, folder), ["app_id"], index_as_feature=True)
    return build.frame.agg(
        F.lit(",".join(build.categorical_columns)).alias("categorical"),
        F.lit(len(build.numerical_columns)).alias("numerical"),
        F.lit(len(build.feature_columns)).alias("features"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    "f14_feature_chain",
    ctes(FEATURE_PARTS, f"SELECT {whole('app_id')}, {whole('event_id')}, {moment('event_time')}, {derived(*DERIVED, digits=4)} FROM calendar"),
    digits=4,
)
def f14(spark, folder):
    build = app.build_features(cleaned(spark, folder), ["app_id"])
    return build.frame.select("app_id", "event_id", "event_time", *DERIVED)


@query(
    "f15_raw_feature_lists",
    ctes(
        CLEANED_PARTS,
        f"SELECT 'payment_type,employment_status,housing_status,source,device_os' AS categorical, CAST(26 AS BIGINT) AS numerical, {number('sum(income)', 'income')} FROM cleaned",
    ),
)
def f15(spark, folder):
    frame = cleaned(spark, folder)
    categorical, numerical = app.raw_feature_lists(frame.columns, not_features=["app_id"])
    return frame.select(*categorical, *numerical).agg(
        F.lit(",".join(categorical)).alias("categorical"), F.lit(len(numerical)).alias("numerical"), F.sum("income").alias("income")
    )


T_KEY = ", ".join(TRANSFER_TIE)
T_TIMED = """SELECT *, TRY_CAST("Date" || ' ' || "Time" AS TIMESTAMP) AS event_time FROM transfers"""
T_INDEXED = f"SELECT *, row_number() OVER (ORDER BY event_time NULLS LAST, {T_KEY}) - 1 AS event_id FROM timed_transfers"
T_PARTS = {"transfers": duck(TRANSFERS), "timed_transfers": T_TIMED, "indexed_transfers": T_INDEXED}
T01 = f"{number('abs(Amount)', 'amount_abs')}, {number('ln(1 + abs(coalesce(Amount, 0)))', 'amount_log1p')}"
T02 = ", ".join(
    whole(f"coalesce({e}, -1)", n)
    for n, e in {"hour": "hour(event_time)", "day_of_week": "isodow(event_time) - 1", "month": "month(event_time)", "day": "day(event_time)"}.items()
)
T03 = whole("Payment_currency IS DISTINCT FROM Received_currency", "is_cross_currency")
T04 = whole("Sender_bank_location IS DISTINCT FROM Receiver_bank_location", "is_cross_border")


@query("t01_amounts", ctes(T_PARTS, f"SELECT {T_KEY}, {T01} FROM transfers"))
def t01(spark, folder):
    return tr.add_amounts(transfers(spark, folder)).select(*TRANSFER_TIE, "amount_abs", "amount_log1p")


@query("t02_calendar", ctes(T_PARTS, f"SELECT {T_KEY}, {T02} FROM timed_transfers"))
def t02(spark, folder):
    timed = tr.add_transfer_time(transfers(spark, folder))
    return tr.add_transfer_calendar(timed).select(*TRANSFER_TIE, "hour", "day_of_week", "month", "day")


@query("t03_cross_currency", ctes(T_PARTS, f"SELECT {T_KEY}, {T03} FROM transfers"))
def t03(spark, folder):
    return tr.add_cross_flags(transfers(spark, folder)).select(*TRANSFER_TIE, "is_cross_currency")


@query("t04_cross_border", ctes(T_PARTS, f"SELECT {T_KEY}, {T04} FROM transfers"))
def t04(spark, folder):
    return tr.add_cross_flags(transfers(spark, folder)).select(*TRANSFER_TIE, "is_cross_border")


@query("t05_time_order", ctes(T_PARTS, f"SELECT {T_KEY}, {whole('event_id')} FROM indexed_transfers"))
def t05(spark, folder):
    timed = tr.add_transfer_time(transfers(spark, folder))
    return ordered.with_row_index(timed.select(*TRANSFER_TIE, "event_time"), ["event_time", *TRANSFER_TIE], stage=True).frame.select(
        *TRANSFER_TIE, "event_id"
    )


@query(
    "t06_feature_lists",
    ctes(
        T_PARTS,
        f"""SELECT 'Payment_currency,Received_currency,Sender_bank_location,Receiver_bank_location,Payment_type' AS categorical,
        'Amount,amount_abs,amount_log1p,hour,day_of_week,month,day,is_cross_currency,is_cross_border' AS numerical, {whole('count(*)', 'rows')} FROM transfers""",
    ),
)
def t06(spark, folder):
    prepared = tr.prepare_transfers(transfers(spark, folder), TRANSFER_TIE)
    categorical, numerical = tr.transfer_feature_lists(prepared.columns)
    return prepared.agg(
        F.lit(",".join(categorical)).alias("categorical"), F.lit(",".join(numerical)).alias("numerical"), F.count(F.lit(1)).alias("rows")
    )


T07_CATEGORIES = ", ".join(
    f"coalesce({c}, 'unknown') AS {c}" for c in ("Payment_currency", "Received_currency", "Sender_bank_location", "Receiver_bank_location", "Payment_type")
)


@query(
    "t07_prepared_transfers",
    ctes(
        T_PARTS,
        f"""SELECT {T_KEY}, {whole('event_id')}, {moment('event_time')}, {whole('Is_laundering', 'fraud_bool')}, {number('Amount')},
        {T01}, {T02}, {T03}, {T04}, {T07_CATEGORIES} FROM indexed_transfers""",
    ),
)
def t07(spark, folder):
    return tr.prepare_transfers(transfers(spark, folder), TRANSFER_TIE, index="event_id", keep=TRANSFER_TIE, stage=True)


@query(
    "t07_preparation_summary",
    ctes(T_PARTS, f"SELECT {whole('count(*)', 'rows')}, CAST(16 AS BIGINT) AS columns, {number('avg(Is_laundering)', 'positive_share')} FROM transfers"),
)
def t07_summary(spark, folder):
    return tr.preparation_summary(tr.prepare_transfers(transfers(spark, folder), TRANSFER_TIE))
