"""Record layouts, vocabularies and the feature registry."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import types as T

# The closed vocabulary of transaction types.
TRANSACTION_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")

LABEL = "isFraud"
FLAG = "isFlaggedFraud"
IDENTIFIERS = ("nameOrig", "nameDest")
BALANCES = ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
NUMERIC_COLUMNS = ("amount", *BALANCES)
DRIFT_NUMBERS = ("amount", "oldbalanceOrg", "newbalanceOrig")
DRIFT_CATEGORIES = ("type",)
DRIFT_COLUMNS = ("amount", "type", "oldbalanceOrg", "newbalanceOrig")

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField(LABEL, T.LongType()),
        T.StructField(FLAG, T.LongType()),
    ]
)

# The wire record: no label, the flag is optional and defaults to 0.
REQUIRED_WIRE_FIELDS = tuple(n for n in TRANSACTION_SCHEMA.names if n not in (LABEL, FLAG))
WIRE_SCHEMA = T.StructType([f for f in TRANSACTION_SCHEMA.fields if f.name != LABEL])

PREDICTION_LOG_SCHEMA = T.StructType(
    [
        *WIRE_SCHEMA.fields,
        T.StructField("prediction", T.LongType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("logged_at", T.StringType()),
    ]
)


class Feature(NamedTuple):
    name: str
    dtype: str
    sources: tuple[str, ...]
    description: str


# Names, dtypes and source columns enter the feature version hash.
FEATURES = (
    Feature(
        "orig_balance_error",
        "float64",
        ("oldbalanceOrg", "amount", "newbalanceOrig"),
        "what the sender's balances leave unexplained",
    ),
    Feature(
        "dest_balance_error",
        "float64",
        ("oldbalanceDest", "amount", "newbalanceDest"),
        "what the receiver's balances leave unexplained",
    ),
    Feature(
        "orig_balance_delta",
        "float64",
        ("newbalanceOrig", "oldbalanceOrg"),
        "change of the sender's balance",
    ),
    Feature(
        "dest_balance_delta",
        "float64",
        ("newbalanceDest", "oldbalanceDest"),
        "change of the receiver's balance",
    ),
    Feature(
        "is_orig_balance_depleted",
        "int64",
        ("oldbalanceOrg", "newbalanceOrig"),
        "1 when a positive sender balance went to zero",
    ),
    Feature(
        "is_dest_balance_untouched",
        "int64",
        ("oldbalanceDest", "newbalanceDest", "amount"),
        "1 when money moved but the receiver shows zero before and after",
    ),
    Feature(
        "amount_to_orig_balance_ratio",
        "float64",
        ("amount", "oldbalanceOrg"),
        "amount relative to the sender's balance",
    ),
    Feature("hour_of_day", "int64", ("step",), "hour within the day, 0 to 23"),
    Feature("is_dest_merchant", "int64", ("nameDest",), "1 when the receiver is a merchant"),
)
FEATURE_NAMES = tuple(f.name for f in FEATURES)

ENTITY_KEY = "transaction_id"
EVENT_TIME = "event_timestamp"
WRITTEN_AT = "written_at"
SOURCE_OFFSET = "source_offset"
FEATURE_TTL_DAYS = 3650
BASE_DATE = "2024-01-01 00:00:00"

_SPARK_TYPES = {"float64": T.DoubleType(), "int64": T.LongType()}
FEATURE_VIEW_SCHEMA = T.StructType(
    [
        T.StructField(ENTITY_KEY, T.StringType()),
        T.StructField(EVENT_TIME, T.TimestampNTZType()),
        *(
            T.StructField(f.name, _SPARK_TYPES[f.dtype], metadata={"description": f.description})
            for f in FEATURES
        ),
    ]
)

TYPE_COLUMNS = tuple(f"type_{name}" for name in TRANSACTION_TYPES)
RAW_MODEL_INPUTS = ("step", *NUMERIC_COLUMNS, FLAG)
# Model input order: raw numbers, engineered features, one column per type.
MODEL_INPUTS = (*RAW_MODEL_INPUTS, *FEATURE_NAMES, *TYPE_COLUMNS)
SPLITS = ("train", "validation", "test")


def feature_version() -> str:
    """Twelve hex digits that change when a feature's name, dtype or sources change."""
    text = "|".join(f"{f.name}:{f.dtype}:{','.join(f.sources)}" for f in FEATURES)
    return hashlib.sha256(text.encode()).hexdigest()[:12]
