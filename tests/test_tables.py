import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskloom.functions import binary_entropy, row_max, row_mean, row_std, safe_ratio, to_number, to_time
from riskloom.operators import applications as app
from riskloom.operators import clean, transfers, validate
from riskloom.operators.presets import TRANSFER_SCHEMA


def test_valid_table_passes(applications):
    report = validate.full_validation(applications(2))
    assert report.is_valid and report.row_count == 2 and report.duplicate_rows == 0


def test_target_outside_zero_and_one(applications):
    df = applications(3).withColumn("fraud_bool", F.lit(2))
    with pytest.raises(validate.ValidationError, match=r"\[2\]"):
        validate.full_validation(df)
    with pytest.raises(validate.ValidationError):
        validate.require_binary_target(df)


def test_empty_missing_and_unexpected(applications):
    with pytest.raises(validate.ValidationError, match="empty"):
        validate.full_validation(applications(2).limit(0))
    with pytest.raises(validate.ValidationError, match="income"):
        validate.full_validation(applications(2).drop("income"))
    with pytest.raises(validate.ValidationError, match="target"):
        validate.full_validation(applications(2).drop("fraud_bool"))
    extra = validate.full_validation(applications(2).withColumn("other", F.lit(None).cast("int")))
    assert extra.unexpected_columns == ["other"] and extra.columns_with_nulls == ["other"]


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "a int, b string")
    assert validate.profile(df).first()["duplicate_rows"] == 2


def test_labels(spark):
    df = spark.createDataFrame([("Report",), (None,)], "Outcome string")
    with pytest.raises(validate.ValidationError, match=r"\[\]"):
        validate.require_labels(df, "Outcome", ["Report", "Dismiss"])
    with pytest.raises(validate.ValidationError, match="Maybe"):
        validate.require_labels(df.fillna("Maybe"), "Outcome", ["Report", "Dismiss"])


def test_scoring_input_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert validate.select_model_columns(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(validate.ValidationError, match="z"):
        validate.select_model_columns(df, ["a", "z"])


def test_malformed_request_fails(spark):
    df = spark.createDataFrame([('{"income": "much"}',)], "body string")
    with pytest.raises(PySparkException):
        validate.parse_requests(df, "body").collect()


def test_sentinels_categories_and_flags(spark):
    df = spark.createDataFrame([(-1, None, 1.0), (5, "AA", None)], "bank_months_count bigint, payment_type string, email_is_free double")
    rows = clean.clean_applications(df).orderBy(F.col("bank_months_count").asc_nulls_first()).collect()
    assert [tuple(r) for r in rows] == [(None, "nan", 1), (5, "AA", None)]


def test_fractional_flag_is_an_error(spark):
    df = spark.createDataFrame([(0.5,)], "email_is_free double")
    with pytest.raises(PySparkException):
        clean.flags_to_integer(df).collect()


def test_first_by_key_with_a_hot_key(spark):
    rows = [(7 if i % 3 == 0 else i, 100 - i, i) for i in range(99)]
    df = spark.createDataFrame(rows, "k int, o int, v int")
    got = {r["k"]: r["v"] for r in clean.first_by_key(df, ["k"], ["o", "v"]).collect()}
    want = {}
    for k, o, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want.setdefault(k, v)
    assert got == want


def test_scalar_functions(spark):
    df = spark.createDataFrame([("1.5", "2024-02-30", 4.0, 0.0), ("nan", "2024-02-29 10:00:00", 4.0, 2.0), ("x", None, None, 2.0)], "n string, t string, a double, b double")
    rows = df.select(to_number("n").alias("n"), to_time("t").alias("t"), safe_ratio("a", "b").alias("r")).collect()
    assert [r["n"] for r in rows] == [1.5, None, None]
    assert [r["t"] is None for r in rows] == [True, False, True]
    assert [r["r"] for r in rows] == [None, 2.0, None]


def test_row_statistics_skip_missing_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0), (None, 2.0, 4.0), (None, None, 3.0), (None, None, None)], "a double, b double, c double")
    names = ["a", "b", "c"]
    rows = [tuple(r) for r in df.select(row_mean(names), row_std(names), row_max(names)).collect()]
    assert rows[0] == pytest.approx((3.0, 2.6457513110645907, 6.0))
    assert rows[1] == pytest.approx((3.0, 1.4142135623730951, 4.0))
    assert rows[2] == (3.0, None, 3.0) and rows[3] == (None, None, None)


def test_entropy_of_missing_share(spark):
    got = spark.range(1).select(binary_entropy(F.lit(None).cast("double"))).first()[0]
    assert got == pytest.approx(0.6931471805599453)


EXPECTED = [
    "event_id", "event_time", "event_hour", "credit_limit_to_income_ratio", "velocity_24h_to_6h_ratio", "income_x_credit_risk",
    "velocity_mean", "risk_both_phones_invalid", "prev_address_months_count_is_missing",
]


def test_feature_build(applications):
    build = app.build_features(clean.clean_applications(applications(3)))
    assert set(EXPECTED) <= set(build.frame.columns)
    assert build.categorical_columns and build.numerical_columns
    assert "fraud_bool" not in build.feature_columns and len(build.feature_columns) == 65
    assert "event_id" not in build.numerical_columns


def test_event_time_rule(spark):
    months = [None, 0, 1, 2, 3, 7, 13]
    df = spark.createDataFrame([(i, m, None if i else -4) for i, m in enumerate(months)], "event_id bigint, month bigint, days_since_request bigint")
    got = [r["event_time"] for r in app.add_event_time(df).orderBy("event_id").collect()]
    assert [t.month for t in got] == [1, 1, 1, 1, 2, 6, 12]
    assert [t.minute for t in got] == [5 * i for i in range(len(months))]
    with pytest.raises(PySparkException):
        app.add_event_time(df.withColumn("month", F.lit(14))).collect()


def test_calendar_of_far_positions(spark):
    """The clock's calendar holds beyond any timestamp; near positions agree with their time."""
    places = [0, 7, 288 * 59, 288 * 60, 28_700_000_000, 28_900_000_000, 10**12]
    df = spark.createDataFrame([(i, 1, 3) for i in places], "event_id bigint, month int, days_since_request int")
    rows = app.add_calendar(df, app.time_of_cycle()).collect()
    for r in rows:
        minutes = r["event_id"] * 5
        years, day = divmod((datetime.date(2024, 1, 4) - datetime.date(1970, 1, 1)).days + minutes // 1440, 146_097)
        date = datetime.date(1970, 1, 1) + datetime.timedelta(days=day)
        assert (r["event_hour"], r["event_day"], r["event_day_of_week"]) == (minutes % 1440 // 60, date.day, date.weekday())
        assert r["event_is_weekend"] == (date.weekday() >= 5) and r["event_hour_sin"] is not None
    near = app.add_calendar(app.add_event_time(df.where("event_id < 100000"))).drop("event_time").collect()
    assert near == rows[:4]
    built = app.row_features(df.withColumns({"income": F.lit(1.0), "velocity_6h": F.lit(2.0)})).drop("event_time").collect()
    assert [r["event_is_weekend"] for r in built] == [r["event_is_weekend"] for r in rows]


def test_rules_treat_missing_as_stated(spark):
    df = spark.createDataFrame([(None, None, None, 1, None, None)], "phone_home_valid int, phone_mobile_valid int, name_email_similarity double, email_is_free int, bank_months_count int, current_address_months_count int")
    row = app.add_risk_rules(df).first()
    assert row["risk_both_phones_invalid"] == 1 and row["risk_low_similarity_free_email"] == 1
    assert row["risk_new_bank_and_new_address"] == 0


def test_columns_appear_only_with_their_inputs(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "income double, velocity_6h double")
    assert set(app.add_ratios(app.add_velocity(df)).columns) == {"income", "velocity_6h"}


def test_transfers(spark):
    rows = [
        ("10:00:00", "2024-03-04", 1, 2, -50.0, None, None, "UK", "UK", "Card", 1, "x"),
        ("bad", "2024-03-03", 1, 2, None, "EUR", None, "UK", None, None, None, "y"),
    ]
    df = spark.createDataFrame(rows, TRANSFER_SCHEMA)
    out = {r["event_id"]: r for r in transfers.prepare_transfers(df, ["Sender_account"], index="event_id").collect()}
    assert out[0]["is_cross_currency"] == 0 and out[0]["Payment_currency"] == "unknown" and out[0]["fraud_bool"] == 1
    assert out[0]["amount_abs"] == 50.0 and out[0]["day_of_week"] == 0
    late = out[1]
    assert (late["hour"], late["day_of_week"], late["fraud_bool"]) == (-1, -1, 0)
    assert late["is_cross_currency"] == 1 and late["is_cross_border"] == 1 and late["amount_log1p"] == 0.0
    with pytest.raises(validate.ValidationError, match="Amount"):
        transfers.prepare_transfers(df.drop("Amount"))


def test_payload_rounding(spark):
    df = spark.createDataFrame([("2.5", None), ("3.5", "a"), ("bad", "b")], "customer_age string, source string")
    rows = [tuple(r) for r in clean.serving_payload(df).collect()]
    assert rows == [(2, "nan"), (4, "a"), (None, "b")]
