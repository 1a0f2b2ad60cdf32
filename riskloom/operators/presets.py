"""Column lists of the three table shapes the operators are bound to by default."""

from __future__ import annotations

from pyspark.sql import types as T

TARGET = "fraud_bool"
EVENT_TIME = "event_time"

# Application columns in their expected order, with types.
APPLICATION_TYPES = {
    "fraud_bool": "int",
    "income": "double",
    "name_email_similarity": "double",
    "prev_address_months_count": "bigint",
    "current_address_months_count": "bigint",
    "customer_age": "bigint",
    "days_since_request": "bigint",
    "intended_balcon_amount": "double",
    "payment_type": "string",
    "zip_count_4w": "bigint",
    "velocity_6h": "double",
    "velocity_24h": "double",
    "velocity_4w": "double",
    "bank_branch_count_8w": "bigint",
    "date_of_birth_distinct_emails_4w": "bigint",
    "employment_status": "string",
    "credit_risk_score": "double",
    "email_is_free": "bigint",
    "housing_status": "string",
    "phone_home_valid": "bigint",
    "phone_mobile_valid": "bigint",
    "bank_months_count": "bigint",
    "has_other_cards": "bigint",
    "proposed_credit_limit": "double",
    "foreign_request": "bigint",
    "source": "string",
    "session_length_in_minutes": "double",
    "device_os": "string",
    "keep_alive_session": "bigint",
    "device_distinct_emails_8w": "bigint",
    "device_fraud_count": "bigint",
    "month": "bigint",
}
APPLICATION_COLUMNS = list(APPLICATION_TYPES)

SENTINEL_COLUMNS = [
    "prev_address_months_count",
    "current_address_months_count",
    "intended_balcon_amount",
    "bank_months_count",
    "session_length_in_minutes",
]

APPLICATION_CATEGORIES = ["payment_type", "employment_status", "housing_status", "source", "device_os"]

APPLICATION_FLAGS = [
    "email_is_free",
    "phone_home_valid",
    "phone_mobile_valid",
    "has_other_cards",
    "foreign_request",
    "keep_alive_session",
]

# Derived flags that are encoded as categories.
DERIVED_CATEGORIES = [
    "event_is_weekend",
    "risk_foreign_and_device_fraud",
    "risk_both_phones_invalid",
    "risk_low_similarity_free_email",
    "risk_new_bank_and_new_address",
]

APPLICATION_ORDER = ["month", "days_since_request", "customer_age", "income"]

# Transfer columns and their roles.
TRANSFER_TYPES = {
    "Time": "string",
    "Date": "string",
    "Sender_account": "bigint",
    "Receiver_account": "bigint",
    "Amount": "double",
    "Payment_currency": "string",
    "Received_currency": "string",
    "Sender_bank_location": "string",
    "Receiver_bank_location": "string",
    "Payment_type": "string",
    "Is_laundering": "int",
    "Laundering_type": "string",
}
TRANSFER_COLUMNS = list(TRANSFER_TYPES)
TRANSFER_CATEGORIES = [
    "Payment_currency",
    "Received_currency",
    "Sender_bank_location",
    "Receiver_bank_location",
    "Payment_type",
]
TRANSFER_TECHNICAL = ["Sender_account", "Receiver_account"]
TRANSFER_LEAKAGE = ["Laundering_type"]

ALERT_COLUMNS = ["AlertID", "Date", "Outcome"]
ALERT_TRANSACTION_COLUMNS = ["AlertID", "Timestamp", "Entry", "Type", "Size"]


_KINDS = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType()}


def struct(types: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in types.items()])


APPLICATION_SCHEMA = struct(APPLICATION_TYPES)
TRANSFER_SCHEMA = struct(TRANSFER_TYPES)
# A scoring request holds the 31 inputs; the label is not part of it.
REQUEST_SCHEMA = struct({n: t for n, t in APPLICATION_TYPES.items() if n != TARGET})
