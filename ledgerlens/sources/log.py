"""The CSV transaction log and its guards."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.errors import LogReadError
from ledgerlens.functions.features import finite
from ledgerlens.operators.prepare import head_sample
from ledgerlens.operators.validation import EXPECTED_TYPES, dtype_counts, unexpected_types, unknown_type
from ledgerlens.schema import TRANSACTION_SCHEMA

log = logging.getLogger(__name__)

_BROKEN = "_broken_line"


def require_columns(df: DataFrame, names: list[str] = TRANSACTION_SCHEMA.names) -> None:
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise LogReadError(f"missing required columns: {absent}")


def read_text_rows(spark: SparkSession, path: str) -> DataFrame:
    """The file's columns as text, plus the broken line where a row does not fit."""
    try:
        header = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        raise LogReadError(f"cannot read a transaction log at {path}: {error}") from error
    if not header.columns:
        raise LogReadError(f"{path} has no header")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header.columns, _BROKEN)])
    return (
        spark.read.schema(schema)
        .option("header", True)
        # Every part file's own header is held against the first one's.
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        .csv(path)
    )


def typed(text_rows: DataFrame) -> DataFrame:
    """Casts checked text to the log's types; NaN and infinities become null."""
    columns = []
    for field in TRANSACTION_SCHEMA.fields:
        value = F.col(field.name).try_cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            value = finite(value)
        columns.append(value.alias(field.name))
    return text_rows.select(*columns)


def _names(types: DataFrame, most: int = 200) -> str:
    """The distinct types as a bounded text, which says how many it leaves out."""
    first = types.select(F.substring("type", 1, 80).alias("type")).distinct().orderBy("type")
    shown = [r.type for r in first.limit(most).collect()]
    more = types.distinct().count() - len(shown)
    return f"{shown}" + (f" and {more} more" if more > 0 else "")


def read_log(
    spark: SparkSession, path: str, nrows: int | None = None, order: tuple[str, ...] | None = None
) -> DataFrame:
    """Reads and checks a CSV log; refuses one that breaks the schema.

    `nrows` keeps the first rows by `order` after the checks.
    """
    rows = read_text_rows(spark, path)
    require_columns(rows)
    try:
        # One pass: row count, broken lines, unknown types and misfits of every column.
        extra = [
            F.count("*").alias("_rows"),
            F.count(_BROKEN).alias("_bad"),
            F.count_if(unknown_type()).alias("_unknown"),
        ]
        counted = dtype_counts(rows, extra).first().asDict()
    except (PySparkException, Py4JJavaError) as error:
        raise LogReadError(f"failed to parse {path}: {error}") from error
    total, bad, unknown = (counted.pop(c) for c in ("_rows", "_bad", "_unknown"))
    if not total:
        raise LogReadError(f"{path} has no rows")
    if bad:
        raise LogReadError(f"{path} has {bad} broken lines")
    misfits = {c: f"expected {EXPECTED_TYPES[c]}, {n} values differ" for c, n in counted.items() if n}
    if misfits:
        raise LogReadError(f"column types do not match: {misfits}")
    if unknown:
        raise LogReadError(f"{unknown} rows have unexpected transaction types: {_names(unexpected_types(rows))}")
    table = typed(rows)
    log.info("read %s rows from %s", total, path)
    return table if nrows is None else head_sample(table, nrows, order)
