"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-6


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text or number to double; anything unreadable, and NaN, becomes null."""
    number = col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_time(*parts: Column | str) -> Column:
    """One or several text parts, joined by blanks, to a zone-free timestamp; bad text becomes null."""
    text = col(parts[0])
    for part in parts[1:]:
        text = F.concat(text, F.lit(" "), col(part))
    return text.try_cast("timestamp_ntz")


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; null where the denominator is zero or the result is not finite."""
    ratio = F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))
    return F.when(F.abs(ratio) < float("inf"), ratio)


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient over the denominator plus a small constant."""
    return safe_ratio(numerator, col(denominator) + F.lit(EPS))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    return F.coalesce(F.try_divide(col(numerator).cast("double"), col(denominator).cast("double")), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def missing_flag(c: Column | str) -> Column:
    return flag(col(c).isNull())


def cyclic(c: Column | str, period: int) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * col(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def seconds_between(earlier: Column | str, later: Column | str) -> Column:
    """Elapsed seconds, microsecond precision, for zone-free timestamps."""
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later)).cast("double") / F.lit(1e6)


def row_mean(columns: Sequence[str]) -> Column:
    present, total = _present_and_total(columns)
    return F.try_divide(total, present)


def row_std(columns: Sequence[str]) -> Column:
    """Sample standard deviation over the non-null values of a row; null below two values."""
    present, total = _present_and_total(columns)
    mean = F.try_divide(total, present)
    squares = sum((F.coalesce(F.pow(F.col(c) - mean, 2), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.when(present >= 2, F.sqrt(squares / (present - 1)))


def row_max(columns: Sequence[str]) -> Column:
    return F.greatest(*[F.col(c) for c in columns])


def _present_and_total(columns: Sequence[str]) -> tuple[Column, Column]:
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return present, total


def binary_entropy(share: Column | str) -> Column:
    """Natural-log entropy of a share; a missing share counts as one half."""
    p = F.least(F.greatest(F.coalesce(col(share), F.lit(0.5)), F.lit(EPS)), F.lit(1 - EPS))
    return -(p * F.ln(p) + (F.lit(1.0) - p) * F.ln(F.lit(1.0) - p))


def band(score: Column | str, red: float = 0.80, yellow: float = 0.50) -> Column:
    """Score to review band."""
    s = col(score)
    return F.when(s >= red, "red").when(s >= yellow, "yellow").otherwise("green")
