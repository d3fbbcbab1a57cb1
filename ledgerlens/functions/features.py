"""Row-wise expressions: engineered features, entity key, event time.

Batch, streaming and scoring all use these same Columns, so a feature has one
definition and both paths give the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.schema import BASE_DATE, TRANSACTION_TYPES


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or cannot be told."""
    return F.coalesce(condition, F.lit(False)).cast("long")


def finite(column: Column) -> Column:
    """NaN and infinities become null, so that comparisons with them are unknown."""
    return F.when(F.abs(column) < F.lit(float("inf")), column)


def orig_balance_error() -> Column:
    return F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig")


def dest_balance_error() -> Column:
    return F.col("oldbalanceDest") + F.col("amount") - F.col("newbalanceDest")


def orig_balance_delta() -> Column:
    return F.col("newbalanceOrig") - F.col("oldbalanceOrg")


def dest_balance_delta() -> Column:
    return F.col("newbalanceDest") - F.col("oldbalanceDest")


def is_orig_balance_depleted() -> Column:
    return flag((F.col("oldbalanceOrg") > 0) & (F.col("newbalanceOrig") == 0))


def is_dest_balance_untouched() -> Column:
    return flag(
        (F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") == 0) & (F.col("amount") > 0)
    )


def amount_to_orig_balance_ratio() -> Column:
    # A balance of exactly -1 has no ratio; ANSI division would end the job there.
    return F.try_divide(F.col("amount"), F.col("oldbalanceOrg") + F.lit(1.0))


def hour_of_day() -> Column:
    return F.pmod(F.col("step"), F.lit(24).cast("long"))


def is_dest_merchant() -> Column:
    return flag(F.col("nameDest").startswith("M"))


# Name to expression, in registry order.
FEATURE_EXPRESSIONS = {
    "orig_balance_error": orig_balance_error,
    "dest_balance_error": dest_balance_error,
    "orig_balance_delta": orig_balance_delta,
    "dest_balance_delta": dest_balance_delta,
    "is_orig_balance_depleted": is_orig_balance_depleted,
    "is_dest_balance_untouched": is_dest_balance_untouched,
    "amount_to_orig_balance_ratio": amount_to_orig_balance_ratio,
    "hour_of_day": hour_of_day,
    "is_dest_merchant": is_dest_merchant,
}


def type_indicators() -> dict[str, Column]:
    """One 0/1 column per known transaction type."""
    return {f"type_{name}": flag(F.col("type") == name) for name in TRANSACTION_TYPES}


def double_text(column: Column) -> Column:
    """The shortest decimal text of a double, written as Python and JSON writers do.

    Spark's own text agrees from 0.001 up to 1e7, then it switches to exponents, where
    the entity key needs 10000000.0. The other sizes go through a lambda, which keeps
    their long expression out of the generated code of every row.
    """
    size = F.abs(column)
    agrees = (size == 0) | ((size >= 1e-3) & (size < 1e7))
    other = F.get(F.transform(F.array(column), _unusual_double_text), 0)
    return F.when(agrees, column.cast("string")).otherwise(other)


def _unusual_double_text(column: Column) -> Column:
    decimal = column.try_cast("decimal(38,17)").cast("string")
    plain = F.regexp_replace(decimal, r"(\.\d+?)0+$", "$1")

    text = column.cast("string")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.abs(power).cast("string")
    digits = F.when(F.abs(power) < 10, F.concat(F.lit("0"), digits)).otherwise(digits)
    sign = F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+"))

    size = F.abs(column)
    return (
        F.when(F.isnan(column), F.lit("nan"))
        .when(size == float("inf"), F.when(column > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size >= 1e16) | (size < 1e-4), F.concat(mantissa, sign, digits))
        .otherwise(plain)
    )


def entity_id() -> Column:
    """Sixteen hex digits that name a transaction.

    A gap counts as the text "nan", so the key is never null and joins on it need no
    extra null test of the whole expression.
    """
    parts = (
        F.col("step").cast("string"),
        F.col("type"),
        F.col("nameOrig"),
        F.col("nameDest"),
        double_text(F.col("amount")),
        double_text(F.col("oldbalanceOrg")),
    )
    payload = F.concat_ws(":", *[F.coalesce(p, F.lit("nan")) for p in parts])
    return F.coalesce(F.substring(F.sha2(payload, 256), 1, 16), F.lit(""))


def event_timestamp(base: str = BASE_DATE) -> Column:
    """Base date plus `step` hours, as UTC wall-clock time."""
    days = F.floor(F.col("step") / F.lit(24)).cast("int")
    hours = F.pmod(F.col("step"), F.lit(24).cast("long")).cast("int")
    return F.to_timestamp_ntz(F.lit(base)) + F.make_dt_interval(days, hours)
