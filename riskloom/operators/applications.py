"""Row-wise features of the application table, on top of one global position."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import (
    cyclic,
    flag,
    guarded_ratio,
    missing_flag,
    row_max,
    row_mean,
    row_std,
)
from riskloom.operators.clean import reproducible_order
from riskloom.operators.ordered import with_row_index
from riskloom.operators.presets import (
    APPLICATION_CATEGORIES,
    DERIVED_CATEGORIES,
    EVENT_TIME,
    SENTINEL_COLUMNS,
    TARGET,
)

STEP_MINUTES = 5
LAST_CLOCK_DAY = 100_000_000  # days a timestamp can hold from 1970 on, rounded down
CALENDAR_CYCLE = 146_097  # days of 400 years


@dataclass
class FeatureBuild:
    """A lazy feature frame and the column lists a model needs."""

    frame: DataFrame
    feature_columns: list[str]
    categorical_columns: list[str]
    numerical_columns: list[str]
    rows: int | None = None


def _clock(index: str) -> tuple[Column, Column]:
    """Days since 1970 and minutes of the day: first of the month in 2024, days since request, five minutes per position.

    The month number is used as month-1 but never below January, and is set, not added.
    """
    month = F.greatest(F.greatest(F.coalesce(F.col("month"), F.lit(1)).cast("int"), F.lit(1)) - 1, F.lit(1))
    days = F.greatest(F.coalesce(F.col("days_since_request"), F.lit(0)).cast("int"), F.lit(0))
    minutes = F.col(index).cast("bigint") * STEP_MINUTES
    start = F.unix_date(F.make_date(F.lit(2024), month, F.lit(1)))
    return start.cast("bigint") + days + F.floor(minutes / 1440), F.pmod(minutes, F.lit(1440))


def _moment(days: Column, minutes: Column) -> Column:
    origin = F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return origin + F.make_dt_interval(days.cast("int"), F.lit(0), minutes.cast("int"))


def add_event_time(df: DataFrame, index: str = "event_id") -> DataFrame:
    """A synthetic clock, five minutes a position. Positions beyond what a timestamp can hold get a null time."""
    days, minutes = _clock(index)
    return df.withColumn(EVENT_TIME, F.when(days < LAST_CLOCK_DAY, _moment(F.least(days, F.lit(LAST_CLOCK_DAY)), minutes)))


def time_of_cycle(index: str = "event_id") -> Column:
    """A time of the clock's hour, day of month and weekday, within the first 400 years after 1970.

    The calendar repeats after 146,097 days, which are whole weeks, so this holds however far the clock has run.
    """
    days, minutes = _clock(index)
    return _moment(F.pmod(days, F.lit(CALENDAR_CYCLE)), minutes)


def add_calendar(df: DataFrame, time: str | Column = EVENT_TIME, prefix: str = "event_") -> DataFrame:
    hour, weekday = F.col(f"{prefix}hour"), F.col(f"{prefix}day_of_week")
    out = df.withColumns(
        {
            f"{prefix}hour": F.hour(time),
            f"{prefix}day": F.dayofmonth(time),
            f"{prefix}day_of_week": F.weekday(time),
        }
    )
    hour_sin, hour_cos = cyclic(hour, 24)
    day_sin, day_cos = cyclic(weekday, 7)
    return out.withColumns(
        {
            f"{prefix}is_weekend": flag(weekday >= 5),
            f"{prefix}hour_sin": hour_sin,
            f"{prefix}hour_cos": hour_cos,
            f"{prefix}day_of_week_sin": day_sin,
            f"{prefix}day_of_week_cos": day_cos,
        }
    )


def add_missing_flags(df: DataFrame, columns: Sequence[str] = tuple(SENTINEL_COLUMNS)) -> DataFrame:
    return df.withColumns({f"{c}_is_missing": missing_flag(c) for c in columns if c in df.columns})


def _present(df: DataFrame, definitions: dict) -> DataFrame:
    """Add the columns whose inputs exist; a definition is (inputs, expression builder)."""
    have = set(df.columns)
    return df.withColumns({name: build() for name, (needs, build) in definitions.items() if set(needs) <= have})


def _zero(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def add_ratios(df: DataFrame) -> DataFrame:
    return _present(
        df,
        {
            "credit_limit_to_income_ratio": (
                ["proposed_credit_limit", "income"],
                lambda: guarded_ratio("proposed_credit_limit", "income"),
            ),
            "velocity_24h_to_6h_ratio": (
                ["velocity_24h", "velocity_6h"],
                lambda: guarded_ratio("velocity_24h", "velocity_6h"),
            ),
            "velocity_4w_to_24h_ratio": (
                ["velocity_4w", "velocity_24h"],
                lambda: guarded_ratio("velocity_4w", "velocity_24h"),
            ),
            "bank_tenure_to_age_ratio": (
                ["bank_months_count", "customer_age"],
                lambda: guarded_ratio("bank_months_count", "customer_age"),
            ),
            "email_name_similarity_weighted": (
                ["name_email_similarity", "email_is_free"],
                lambda: F.col("name_email_similarity") * (F.lit(1) + _zero("email_is_free")),
            ),
        },
    )


def add_interactions(df: DataFrame) -> DataFrame:
    return _present(
        df,
        {
            "income_x_credit_risk": (
                ["income", "credit_risk_score"],
                lambda: F.col("income") * F.col("credit_risk_score"),
            ),
            "credit_limit_x_risk": (
                ["proposed_credit_limit", "credit_risk_score"],
                lambda: F.col("proposed_credit_limit") * F.col("credit_risk_score"),
            ),
            "session_length_x_keep_alive": (
                ["session_length_in_minutes", "keep_alive_session"],
                lambda: _zero("session_length_in_minutes") * _zero("keep_alive_session"),
            ),
            "device_fraud_to_distinct_email_ratio": (
                ["device_fraud_count", "device_distinct_emails_8w"],
                lambda: guarded_ratio("device_fraud_count", "device_distinct_emails_8w"),
            ),
            "zip_to_branch_activity_ratio": (
                ["zip_count_4w", "bank_branch_count_8w"],
                lambda: guarded_ratio("zip_count_4w", "bank_branch_count_8w"),
            ),
        },
    )


def add_velocity(df: DataFrame) -> DataFrame:
    speeds = ["velocity_6h", "velocity_24h", "velocity_4w"]
    return _present(
        df,
        {
            "velocity_mean": (speeds, lambda: row_mean(speeds)),
            "velocity_std": (speeds, lambda: row_std(speeds)),
            "velocity_max": (speeds, lambda: row_max(speeds)),
            "velocity_delta_24h_6h": (speeds[:2], lambda: F.col("velocity_24h") - F.col("velocity_6h")),
            "velocity_delta_4w_24h": (speeds[1:], lambda: F.col("velocity_4w") - F.col("velocity_24h")),
        },
    )


def add_risk_rules(df: DataFrame) -> DataFrame:
    """Rule flags. A missing phone counts as invalid and a missing similarity as low."""

    def months(c: str):
        return F.coalesce(F.col(c), F.lit(999))

    return _present(
        df,
        {
            "risk_foreign_and_device_fraud": (
                ["foreign_request", "device_fraud_count"],
                lambda: flag((_zero("foreign_request") == 1) & (_zero("device_fraud_count") > 0)),
            ),
            "risk_both_phones_invalid": (
                ["phone_home_valid", "phone_mobile_valid"],
                lambda: flag((_zero("phone_home_valid") == 0) & (_zero("phone_mobile_valid") == 0)),
            ),
            "risk_low_similarity_free_email": (
                ["name_email_similarity", "email_is_free"],
                lambda: flag((_zero("name_email_similarity") < 0.35) & (_zero("email_is_free") == 1)),
            ),
            "risk_new_bank_and_new_address": (
                ["bank_months_count", "current_address_months_count"],
                lambda: flag((months("bank_months_count") < 6) & (months("current_address_months_count") < 6)),
            ),
        },
    )


def row_features(df: DataFrame, index: str = "event_id") -> DataFrame:
    """Everything that follows from one row once its position is known."""
    return (
        add_event_time(df, index)
        .transform(lambda d: add_calendar(d, time_of_cycle(index)))
        .transform(add_missing_flags)
        .transform(add_ratios)
        .transform(add_interactions)
        .transform(add_velocity)
        .transform(add_risk_rules)
    )


def feature_lists(
    columns: Sequence[str],
    target: str = TARGET,
    *,
    categories: Sequence[str] = tuple(APPLICATION_CATEGORIES),
    index_as_feature: bool = False,
    index: str = "event_id",
    not_features: Sequence[str] = (),
) -> tuple[list[str], list[str]]:
    """Categorical names (sorted) and numerical names (frame order).

    The position column is left out unless asked for: it restarts with every scoring request.
    """
    categorical = sorted({c for c in [*categories, *DERIVED_CATEGORIES] if c in columns})
    excluded = {*categorical, target, EVENT_TIME, *not_features}
    if not index_as_feature:
        excluded.add(index)
    return categorical, [c for c in columns if c not in excluded]


def raw_feature_lists(
    columns: Sequence[str], target: str = TARGET, not_features: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """Lists for the raw feature set: the base categories, and everything else as numbers."""
    categorical = [c for c in APPLICATION_CATEGORIES if c in columns]
    excluded = {*categorical, target, EVENT_TIME, *not_features}
    return categorical, [c for c in columns if c not in excluded]


def build_features(
    df: DataFrame,
    tie: Sequence[str] = (),
    target: str = TARGET,
    *,
    index_as_feature: bool = False,
    ranges: int | None = None,
    stage: bool = True,
) -> FeatureBuild:
    """Position, clock, calendar, missing flags, ratios, interactions, velocity and rules.

    `tie` names columns that make the order unique; they stay in the frame but are no features.
    The cleaned input is staged, as positions need several passes and cleaning has a shuffle.
    """
    order = reproducible_order(df, tie)
    indexed = with_row_index(df, order, "event_id", ranges=ranges, stage=stage)
    frame = row_features(indexed.frame)
    categorical, numerical = feature_lists(
        frame.columns, target, index_as_feature=index_as_feature, not_features=tie
    )
    features = [c for c in frame.columns if c != target and c not in tie]
    return FeatureBuild(frame, features, categorical, numerical, indexed.rows)


def feature_spec(build: FeatureBuild, target: str = TARGET) -> DataFrame:
    """The feature specification as one row, ready for a JSON sink."""
    spark = build.frame.sparkSession
    return spark.range(1).select(
        F.lit(target).alias("target_column"),
        F.lit(build.feature_columns).alias("feature_columns"),
        F.lit(build.categorical_columns).alias("categorical_columns"),
        F.lit(build.numerical_columns).alias("numerical_columns"),
        F.current_timestamp().alias("generated_at"),
    )
