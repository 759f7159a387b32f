"""Row-local column expressions used by the feature, decision and report jobs.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen.  Division always goes through ``try_divide`` because
ANSI mode (the Spark 4 default) raises on a zero divisor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "floor_div", "transaction_hour", "transaction_day", "transaction_week",
    "amount_log", "safe_ratio", "any_not_null", "null_flag", "null_count",
    "values_match", "combo_key", "finite_or_null", "nan_to_null", "without_nan", "decide",
    "recommend", "format_value", "zero_div",
]

# Missing-part markers of the combination keys and the separator.
MISSING_CARD = "missing_card"
MISSING_EMAIL = "missing_email"
MISSING_DEVICE_TYPE = "missing_device_type"
MISSING_DEVICE_INFO = "missing_device_info"
COMBO_SEPARATOR = "|"

# Decision bands.
DECLINE_MARGIN = 0.20
ACTION_DECLINE, ACTION_REVIEW, ACTION_APPROVE = "decline", "review", "approve"

# Fixed value: text shown for an absent KPI.
NOT_AVAILABLE = "Not available — run Module X."


def floor_div(c: Column, n: int) -> Column:
    """Floor division of a whole number by a positive constant (not ``div``,
    which truncates toward zero)."""
    return F.floor(c / F.lit(float(n)))


def transaction_hour(dt: Column) -> Column:
    return F.pmod(floor_div(dt, 3600), F.lit(24))


def transaction_day(dt: Column) -> Column:
    return floor_div(dt, 86400)


def transaction_week(dt: Column) -> Column:
    return floor_div(floor_div(dt, 86400), 7)


def amount_log(amount: Column) -> Column:
    return F.log1p(amount)


def safe_ratio(num: Column, den: Column, default=0.0) -> Column:
    """num / den; a zero or missing divisor and an infinite result give
    ``default``."""
    q = F.try_divide(num, F.when(den != 0, den))
    return F.coalesce(finite_or_null(q), F.lit(default))


def zero_div(num: Column, den: Column) -> Column:
    """num / den with 0 where the divisor is 0 (zero_division=0 rule)."""
    return F.coalesce(F.try_divide(num.cast("double"), F.when(den != 0, den).cast("double")),
                      F.lit(0.0))


def any_not_null(cols: list[Column]) -> Column:
    if not cols:
        return F.lit(0)
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in cols]).cast("int")


def null_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def null_count(cols: list[Column]) -> Column:
    if not cols:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [c.isNull().cast("int") for c in cols])


def values_match(a: Column, b: Column) -> Column:
    """1 when both are present and equal, else 0 (never null)."""
    return F.coalesce(a.isNotNull() & b.isNotNull() & (a == b), F.lit(False)).cast("int")


def combo_key(*parts: tuple[Column, str]) -> Column:
    """Join the parts with a bar; a missing part becomes its marker."""
    return F.concat_ws(COMBO_SEPARATOR,
                       *[F.coalesce(c.cast("string"), F.lit(m)) for c, m in parts])


def finite_or_null(c: Column) -> Column:
    """NaN and ±infinity become NULL (the single 'missing' of the job)."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN of every float column as NULL, the one form of missing that the jobs know."""
    return df.select(*[nan_to_null(F.col(f"`{n}`")).alias(n) if t in ("float", "double") else F.col(f"`{n}`") for n, t in df.dtypes])


def decide(p: Column, threshold) -> Column:
    return (p >= F.lit(threshold) if not isinstance(threshold, Column) else p >= threshold).cast("int")


def recommend(p: Column, threshold) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (F.when(p >= t + F.lit(DECLINE_MARGIN), F.lit(ACTION_DECLINE))
             .when(p >= t, F.lit(ACTION_REVIEW))
             .otherwise(F.lit(ACTION_APPROVE)))


def format_value(v: Column, kind: str = "text") -> Column:
    """KPI text: currency ``$1,234``, percent ``12.34%``, decimal ``0.1234``."""
    if kind == "currency":
        s = F.concat(F.lit("$"), F.format_number(v, 0))
    elif kind == "percent":
        s = F.format_string("%.2f%%", v)
    elif kind == "decimal":
        s = F.format_string("%.4f", v)
    else:
        s = v.cast("string")
    return F.coalesce(F.when(v.isNotNull() & ~F.isnan(v.cast("double")), s), F.lit(NOT_AVAILABLE))
