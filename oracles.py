"""The expected result of each registered query as DuckDB SQL over the events table."""

from __future__ import annotations

# The transaction log as a view of the events; all other steps build on it.
LOG = """
e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events),
t AS (
  SELECT event_id, ts, k,
    CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS BIGINT) AS step,
    CASE event_type WHEN 'view' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_IN'
      WHEN 'purchase' THEN 'CASH_OUT' WHEN 'signup' THEN 'DEBIT' WHEN 'error' THEN 'TRANSFER' END AS type,
    value AS amount,
    'C' || CAST(user_id AS VARCHAR) AS nameOrig,
    CAST(k * 5 AS DOUBLE) AS oldbalanceOrg,
    greatest(CAST(k * 5 AS DOUBLE) - value, CAST(0 AS DOUBLE)) AS newbalanceOrig,
    CASE WHEN event_id % 3 = 0 THEN 'M' ELSE 'C' END || CAST(event_id % 997 AS VARCHAR) AS nameDest,
    CAST(CASE WHEN k % 4 = 0 THEN 0 ELSE k * 10 END AS DOUBLE) AS oldbalanceDest,
    CASE WHEN k % 8 = 0 THEN CAST(0 AS DOUBLE) WHEN k % 4 = 0 THEN value
      ELSE CAST(k * 10 AS DOUBLE) + value END AS newbalanceDest,
    CAST(event_type IN ('purchase', 'error') AND k > 0 AND CAST(k * 5 AS DOUBLE) <= value AS BIGINT) AS isFraud,
    CAST(event_type = 'error' AND value > 200 AS BIGINT) AS isFlaggedFraud
  FROM e)"""

FEATURES = """
f AS (
  SELECT *,
    oldbalanceOrg - amount - newbalanceOrig AS orig_balance_error,
    oldbalanceDest + amount - newbalanceDest AS dest_balance_error,
    newbalanceOrig - oldbalanceOrg AS orig_balance_delta,
    newbalanceDest - oldbalanceDest AS dest_balance_delta,
    CAST(oldbalanceOrg > 0 AND newbalanceOrig = 0 AS BIGINT) AS is_orig_balance_depleted,
    CAST(oldbalanceDest = 0 AND newbalanceDest = 0 AND amount > 0 AS BIGINT) AS is_dest_balance_untouched,
    amount / (oldbalanceOrg + CAST(1 AS DOUBLE)) AS amount_to_orig_balance_ratio,
    step % 24 AS hour_of_day,
    CAST(nameDest LIKE 'M%' AS BIGINT) AS is_dest_merchant,
    substr(sha256(CAST(step AS VARCHAR) || ':' || type || ':' || nameOrig || ':' || nameDest || ':'
      || CAST(amount AS VARCHAR) || ':' || CAST(oldbalanceOrg AS VARCHAR)), 1, 16) AS transaction_id,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(step) AS event_timestamp
  FROM t)"""

SPLIT = """
steps AS (SELECT step, count(*) AS rows FROM t GROUP BY step),
cum AS (
  SELECT step, rows,
    CAST(sum(rows) OVER (ORDER BY step) AS DOUBLE) / CAST(sum(rows) OVER () AS DOUBLE) AS share
  FROM steps),
cut AS (
  SELECT min(step) FILTER (WHERE share >= CAST(0.7 AS DOUBLE)) AS train_end,
    min(step) FILTER (WHERE share >= CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE)) AS validation_end
  FROM cum),
s AS (
  SELECT f.*, CASE WHEN step <= train_end THEN 'train' WHEN step <= validation_end THEN 'validation'
    ELSE 'test' END AS split
  FROM f, cut)"""

SCORED = """
sc AS (
  SELECT *, event_id AS seq, isFraud AS truth, k + CAST(0.5 AS DOUBLE) AS latency_ms,
    least(amount / CAST(500 AS DOUBLE), CAST(1 AS DOUBLE)) AS fraud_probability,
    CAST(least(amount / CAST(500 AS DOUBLE), CAST(1 AS DOUBLE)) >= 0.5 AS BIGINT) AS prediction
  FROM t)"""

# Requests with k = 0 or 99 are damaged, and no model is loaded for those with k = 98.
OUTCOMES = """
ol AS (
  SELECT event_id, ts AS logged_at,
    CASE WHEN k = 0 THEN 'unknown:type' WHEN k = 99 AND amount > 0 THEN 'negative:amount' END AS reason,
    CASE WHEN k = 98 THEN 'not_ready' WHEN k = 0 OR (k = 99 AND amount > 0) THEN 'malformed'
      WHEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(step) >= TIMESTAMP '2024-01-28 00:00:00'
        THEN 'features_unavailable' ELSE 'success' END AS outcome,
    latency_ms, prediction, fraud_probability, truth
  FROM sc)"""

FEATURE_LIST = (
    "orig_balance_error, dest_balance_error, orig_balance_delta, dest_balance_delta, "
    "is_orig_balance_depleted, is_dest_balance_untouched, amount_to_orig_balance_ratio, "
    "hour_of_day, is_dest_merchant"
)
RAW = (
    "step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, "
    "newbalanceDest, isFraud, isFlaggedFraud"
)
WIRE = RAW.replace("isFraud, ", "")
NUMBERS = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
ONE_HOT = ", ".join(f"CAST(type = '{x}' AS BIGINT) AS type_{x}" for x in TYPES)
MODEL_INPUTS = [
    "step", *NUMBERS, "isFlaggedFraud", *FEATURE_LIST.split(", "), *[f"type_{x}" for x in TYPES]
]
PROCESSED = f"x AS (SELECT step, {', '.join(NUMBERS)}, isFlaggedFraud, {FEATURE_LIST}, {ONE_HOT}, isFraud, split FROM s)"
VIEW = f"transaction_id, event_timestamp, {FEATURE_LIST}"

PARSE_ERROR = """CASE WHEN k = 0 THEN 'invalid:type' WHEN k IN (1, 2) THEN 'not_an_object'
  WHEN k = 3 THEN 'missing:amount' WHEN k = 7 THEN 'missing:nameDest' END"""

# The messages of k = 9 carry a negative amount, which changes key and features.
SENT = LOG.replace("\nt AS (", "\nt0 AS (") + """,
t AS (SELECT * REPLACE (CASE WHEN k = 9 THEN -amount ELSE amount END AS amount) FROM t0)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _log(select: str) -> str:
    return f"{_with(LOG)} {select}"


def _features(select: str) -> str:
    return f"{_with(LOG, FEATURES)} {select}"


def _split(select: str) -> str:
    return f"{_with(LOG, FEATURES, SPLIT)} {select}"


def _scored(select: str) -> str:
    return f"{_with(LOG, SCORED)} {select}"


# Refused at the boundary or before a model is loaded: in no service counter.
COUNTED = "co AS (SELECT * FROM ol WHERE outcome NOT IN ('malformed', 'not_ready'))"


def _outcomes(select: str) -> str:
    return f"{_with(LOG, SCORED, OUTCOMES, COUNTED)} {select}"


# Every third k is sent again, with one more unit in a balance that the key leaves out.
CORRECTED = LOG.replace("\nt AS (", "\nt0 AS (") + """,
t AS (SELECT t0.* REPLACE (newbalanceDest + again AS newbalanceDest), event_id * 2 + again AS source_offset
  FROM t0, (SELECT unnest([0, 1]) AS again) WHERE again = 0 OR k % 3 = 0)"""


def _corrected(select: str) -> str:
    return f"{_with(CORRECTED, FEATURES)} {select}"


CELLS = """
  count(*) FILTER (WHERE truth = 0 AND prediction = 0) AS true_negatives,
  count(*) FILTER (WHERE truth = 0 AND prediction = 1) AS false_positives,
  count(*) FILTER (WHERE truth = 1 AND prediction = 0) AS false_negatives,
  count(*) FILTER (WHERE truth = 1 AND prediction = 1) AS true_positives"""
RATES = """
  round(coalesce((tn + tp) / nullif(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0), 6) AS accuracy,
  round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1"""


def _cells_of(table: str, by: str = "") -> str:
    """Subquery with tn, fp, fn, tp of a scored table."""
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""(SELECT {keys}
      count(*) FILTER (WHERE truth = 0 AND prediction = 0) AS tn,
      count(*) FILTER (WHERE truth = 0 AND prediction = 1) AS fp,
      count(*) FILTER (WHERE truth = 1 AND prediction = 0) AS fn,
      count(*) FILTER (WHERE truth = 1 AND prediction = 1) AS tp FROM {table}{group})"""


def _ranking(table: str, by: str = "") -> str:
    """Subquery with roc_auc and average_precision by plain window functions."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""(SELECT {keys}
      sum(CAST(neg AS DOUBLE) * (pos_above + CAST(pos AS DOUBLE) / 2)) / (max(p) * CAST(max(n) AS DOUBLE)) AS roc_auc,
      coalesce(sum(CAST(pos AS DOUBLE) * (pos_above + pos) / (pos_above + pos + neg_above + neg))
        / nullif(CAST(max(p) AS DOUBLE), 0), 0) AS average_precision
    FROM (SELECT *,
        coalesce(sum(pos) OVER ({part} ORDER BY fraud_probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_above,
        coalesce(sum(neg) OVER ({part} ORDER BY fraud_probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_above,
        sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n
      FROM (SELECT {keys} fraud_probability, count(*) FILTER (WHERE truth = 1) AS pos,
          count(*) FILTER (WHERE truth = 0) AS neg FROM {table} GROUP BY {keys} fraud_probability)){group})"""


RULES = """
r AS (
  SELECT split, truth, model, spec_order, p AS fraud_probability, CAST(p >= 0.5 AS BIGINT) AS prediction FROM (
    SELECT split, isFraud AS truth, 'by_amount' AS model, 0 AS spec_order,
      least(amount / CAST(500 AS DOUBLE), CAST(1 AS DOUBLE)) AS p FROM s
    UNION ALL SELECT split, isFraud, 'by_ratio', 1,
      amount_to_orig_balance_ratio / (amount_to_orig_balance_ratio + CAST(1 AS DOUBLE)) FROM s
    UNION ALL SELECT split, isFraud, 'by_drain', 2,
      is_orig_balance_depleted * CAST(0.5 AS DOUBLE) + least(amount / CAST(1000 AS DOUBLE), CAST(0.5 AS DOUBLE)) FROM s
    UNION ALL SELECT split, isFraud, 'by_hour', 3, hour_of_day / CAST(23 AS DOUBLE) FROM s)
  WHERE split = 'validation')"""
BEST = f"""
runs AS (SELECT * FROM {_ranking('r', 'model, spec_order')}),
best AS (SELECT * FROM runs ORDER BY average_precision DESC, spec_order LIMIT 1)"""

LATENCY_BOUNDS = "[0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]"


def _quantile(q: int) -> str:
    rank = f"(CAST({q} AS DOUBLE) / 100 * total)"
    return (
        f"round(max(CASE WHEN upto >= {rank} AND below < {rank} THEN lower + (le - lower) "
        f"* ({rank} - below) / (upto - below) END), 9) AS p{q}"
    )


def _described(column: str) -> str:
    stats = {
        "count": f"CAST(count({column}) AS DOUBLE)",
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"min({column})",
        "25%": f"quantile_cont({column}, 0.25)",
        "50%": f"quantile_cont({column}, 0.5)",
        "75%": f"quantile_cont({column}, 0.75)",
        "max": f"max({column})",
    }
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{stat}' AS stat, round({value}, 8) AS value FROM t"
        for stat, value in stats.items()
    )


def _correlations() -> str:
    columns = (*NUMBERS, "isFraud")
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM t"
        for a in columns
        for b in columns
    )


def _drift_values(columns: tuple[str, ...]) -> str:
    """v: one row per (column, value) with reference and current counts."""
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, split FROM s WHERE split <> 'validation'" for c in columns
    )
    return f"""
v AS (SELECT "column", value, count(*) FILTER (WHERE split = 'train') AS a,
    count(*) FILTER (WHERE split = 'test') AS b FROM ({union}) GROUP BY "column", value),
n AS (SELECT "column", CAST(sum(a) AS DOUBLE) AS na, CAST(sum(b) AS DOUBLE) AS nb FROM v GROUP BY "column"),
c AS (SELECT v."column", value, a, b, na, nb,
    sum(a) OVER w / na AS fa, sum(b) OVER w / nb AS fb,
    lead(value) OVER (PARTITION BY v."column" ORDER BY value) AS following
  FROM v JOIN n ON v."column" = n."column"
  WINDOW w AS (PARTITION BY v."column" ORDER BY value ROWS UNBOUNDED PRECEDING))"""


DRIFT_NUMBERS = ("amount", "oldbalanceOrg", "newbalanceOrig")
JS = """sqrt(greatest(0, sum(
    CASE WHEN a > 0 THEN a / na * ln((a / na) / ((a / na + b / nb) / 2)) ELSE 0 END
    + CASE WHEN b > 0 THEN b / nb * ln((b / nb) / ((a / na + b / nb) / 2)) ELSE 0 END) / 2))"""


def _drift(columns: tuple[str, ...], select: str) -> str:
    return f"{_with(LOG, FEATURES, SPLIT, _drift_values(columns))} {select}"


def _drift_summary(reference: str, current: str) -> str:
    """Counts columns over the distance limit; `current` rows have amounts times five."""
    parts = []
    for c in DRIFT_NUMBERS:
        parts.append(
            f"""SELECT '{c}' AS "column", sum(abs(fa - fb) * (following - value)) / greatest(
              (SELECT stddev_pop({c}) FROM {reference}), 0.001) AS d FROM (
              SELECT value, lead(value) OVER (ORDER BY value) AS following,
                sum(a) OVER w / (SELECT CAST(count(*) AS DOUBLE) FROM {reference}) AS fa,
                sum(b) OVER w / (SELECT CAST(count(*) AS DOUBLE) FROM {current}) AS fb
              FROM (SELECT value, sum(a) AS a, sum(b) AS b FROM (
                  SELECT {c} AS value, 1 AS a, 0 AS b FROM {reference}
                  UNION ALL SELECT {c}, 0, 1 FROM {current}) GROUP BY value)
              WINDOW w AS (ORDER BY value ROWS UNBOUNDED PRECEDING))"""
        )
    parts.append(
        f"""SELECT 'type', {JS} FROM (SELECT type, sum(a) AS a, sum(b) AS b,
              sum(sum(a)) OVER () AS na, sum(sum(b)) OVER () AS nb FROM (
                SELECT type, CAST(1 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM {reference}
                UNION ALL SELECT type, 0, 1 FROM {current}) GROUP BY type)"""
    )
    return f"""SELECT count(*) FILTER (WHERE d >= 0.1) AS drifted_columns, count(*) AS total_columns,
      count(*) FILTER (WHERE d >= 0.1) / CAST(count(*) AS DOUBLE) AS drift_share
      FROM ({' UNION ALL '.join(parts)})"""


#: What holds of every fitted model: its confusion counts add up to the classes.
CLASS_FACTS = """count(*) FILTER (WHERE isFraud = 0) AS negatives, count(*) FILTER (WHERE isFraud = 1) AS positives,
  true AS precision_in_range, true AS better_than_chance"""
SERVED = """k <> 0 AND NOT (k = 99 AND amount > 0)
  AND TIMESTAMP '2024-01-01 00:00:00' + to_hours(step) < TIMESTAMP '2024-01-28 00:00:00'"""
SUMMARY = """SELECT split, count(*) AS rows, min(step) AS first_step, max(step) AS last_step,
  round(avg(CAST(isFraud AS DOUBLE)), 6) AS positive_rate FROM s GROUP BY split"""

VERSIONS = """
ver AS (
  SELECT DISTINCT 'risk_' || lower(type) AS name, CAST(day(ts) AS VARCHAR) AS version, day(ts) AS d FROM t),
vt AS (
  SELECT name, version, d, substr(sha256(name || ':' || version), 1, 32) AS run_id,
    CASE WHEN d IN (7, 9, 10) THEN 'Production' WHEN d = 30 THEN 'Staging' ELSE 'None' END AS stage FROM ver)"""


def _parity() -> str:
    return _corrected(
        "SELECT count(DISTINCT transaction_id) AS equal_rows, CAST(0 AS BIGINT) AS only_left, "
        "CAST(0 AS BIGINT) AS only_right FROM f"
    )


def _latest(where: str = "true") -> str:
    """Newest row per key; of equal times the last one sent."""
    return _corrected(
        f"SELECT {VIEW} FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id "
        f"ORDER BY event_timestamp DESC, source_offset DESC) AS place FROM f WHERE {where}) WHERE place = 1"
    )


def _drift_p_values() -> str:
    """KS by the limiting series; chi-square with the four degrees of freedom of five types."""
    x = "d * sqrt(na * nb / (na + nb))"
    series = f"2 * list_sum(list_transform(range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * i * i * ({x}) * ({x}))))"
    return f"""{_with(LOG, FEATURES, SPLIT, _drift_values(DRIFT_NUMBERS))},
        ks AS (SELECT "column", 'ks' AS test, d AS statistic,
            CASE WHEN {x} < 0.2 THEN CAST(1 AS DOUBLE) ELSE least(1, greatest(0, {series})) END AS p
          FROM (SELECT "column", max(abs(fa - fb)) AS d, max(na) AS na, max(nb) AS nb FROM c GROUP BY "column")),
        ty AS (SELECT type, CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE) AS a,
            CAST(count(*) FILTER (WHERE split = 'test') AS DOUBLE) AS b FROM s WHERE split <> 'validation' GROUP BY type),
        chi AS (SELECT sum((b - a / na * nb) * (b - a / na * nb) / (a / na * nb)) AS x
          FROM ty, (SELECT sum(a) AS na, sum(b) AS nb FROM ty)),
        tested AS (SELECT * FROM ks UNION ALL SELECT 'type', 'chi2', x, exp(-x / 2) * (1 + x / 2) FROM chi)
        SELECT "column", test, round(statistic, 6) AS statistic, round(p, 6) AS p_value, p < 0.05 AS drifted FROM tested"""


def _report() -> str:
    """All sections of the quality report over the log with gaps."""
    numbers = " UNION ALL ".join(_described(c) for c in NUMBERS).replace(" FROM t", " FROM g")
    overview = {
        "rows": "count(*)",
        "columns": "max(11)",
        "fraud_count": "sum(isFraud)",
        "fraud_percentage": "round(CAST(100 AS DOUBLE) * sum(isFraud) / count(*), 4)",
        "negative_amounts": "count(*) FILTER (WHERE amount < 0)",
    }
    parts = [f"SELECT 'overview' AS section, '{k}' AS item, 'value' AS stat, CAST({v} AS DOUBLE) AS value FROM g" for k, v in overview.items()]
    parts.append(
        "SELECT 'overview', 'duplicate_rows', 'count', CAST((SELECT count(*) FROM g) - "
        f"(SELECT count(*) FROM (SELECT DISTINCT {RAW} FROM g)) AS DOUBLE)"
    )
    parts += [
        f"SELECT * FROM (SELECT 'missing', '{c}', 'count', CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS n FROM g) WHERE n > 0"
        for c in ("amount", "nameDest")
    ]
    parts.append("SELECT 'types', type, 'count', CAST(count(*) AS DOUBLE) FROM g GROUP BY type")
    parts.append(f"SELECT 'numbers', \"column\", stat, value FROM ({numbers})")
    return f"""{_with(LOG)}, g AS (SELECT * REPLACE (CASE WHEN k <> 0 THEN amount END AS amount,
        CASE WHEN k <> 1 THEN nameDest END AS nameDest) FROM t)
        SELECT section, item, stat, round(value, 6) AS value FROM ({' UNION ALL '.join(parts)})"""


def statements() -> dict[str, str]:
    sql = {
        "src_csv": _log(f"SELECT {RAW} FROM t"),
        "src_head_sample": _log(f"SELECT event_id, {RAW} FROM t ORDER BY step, event_id LIMIT 2000"),
        "sink_split_parquet": _split(SUMMARY),
        "src_split_parquet": f"{_with(LOG, FEATURES, SPLIT, PROCESSED)} SELECT * FROM x",
        "sink_offline_features": _features("SELECT count(*) AS rows, count(DISTINCT transaction_id) AS keys FROM f"),
        "src_offline_features": _features(f"SELECT {VIEW} FROM f"),
        "src_stream": "SELECT event_id FROM events",
        "src_stream_bounded": "SELECT count(*) AS messages, count(DISTINCT event_id) AS distinct_messages FROM events",
        "src_stream_first_n": f"{_with(SENT)} SELECT event_id, step, type, amount FROM t "
        "WHERE k NOT IN (0, 1, 2, 3, 7) ORDER BY event_id LIMIT 1000",
        "sink_wire_json": _log(f"SELECT {WIRE} FROM t"),
        "sink_prediction_log": "SELECT 2 * count(*) AS rows, count(DISTINCT ts) AS times FROM events",
        "src_prediction_log": _scored(
            f"SELECT {WIRE}, prediction, fraud_probability, '1' AS model_version, "
            "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS logged_at FROM sc"
        ),
        "sink_status": f"""{_with(SENT, FEATURES)} SELECT event_id,
            CASE WHEN reason IS NULL THEN 'OK' ELSE 'SKIPPED' END AS status,
            CASE WHEN reason IS NOT NULL THEN 'invalid' END AS kind, reason,
            CASE WHEN reason IS NULL THEN transaction_id END AS transaction_id
            FROM (SELECT *, {PARSE_ERROR} AS reason FROM f)""",
        "v2_dtypes": """WITH e AS (SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
            SELECT * FROM (
              SELECT 'amount' AS "column", 'double' AS expected, count(*) FILTER (WHERE k = 0) AS failures FROM e
              UNION ALL SELECT 'step', 'bigint', count(*) FILTER (WHERE k = 1) FROM e
              UNION ALL SELECT 'isFraud', 'bigint', count(*) FILTER (WHERE k = 2) FROM e
              UNION ALL SELECT 'nameOrig', 'string', count(*) FROM e) WHERE failures > 0""",
        "v3_enum_domain": _log("SELECT DISTINCT '' AS type FROM t WHERE k = 0"),
        "v5_parse_transaction": f"""{_with(SENT)} SELECT event_id,
            CASE WHEN k NOT IN (1, 2) THEN step END AS step,
            CASE WHEN k = 0 THEN 'NOT_A_TYPE' WHEN k NOT IN (1, 2) THEN type END AS type,
            CASE WHEN k NOT IN (1, 2, 3) THEN amount END AS amount,
            CASE WHEN k NOT IN (1, 2, 3) THEN nameOrig END AS nameOrig,
            CASE WHEN k NOT IN (1, 2, 3) THEN oldbalanceOrg END AS oldbalanceOrg,
            CASE WHEN k NOT IN (1, 2, 3) THEN newbalanceOrig END AS newbalanceOrig,
            CASE WHEN k NOT IN (1, 2, 3, 7) THEN nameDest END AS nameDest,
            CASE WHEN k NOT IN (1, 2, 3) THEN oldbalanceDest END AS oldbalanceDest,
            CASE WHEN k NOT IN (1, 2, 3) THEN newbalanceDest END AS newbalanceDest,
            CASE WHEN k NOT IN (1, 2, 3) THEN isFlaggedFraud ELSE 0 END AS isFlaggedFraud,
            {PARSE_ERROR} AS error FROM t""",
        "v6_contract": _log(
            """SELECT event_id, CASE WHEN k = 0 THEN 'enum:type' WHEN k IN (1, 2) THEN 'type:object'
              WHEN k = 3 THEN 'required:amount,required:nameDest,required:nameOrig,required:newbalanceDest,'
                || 'required:newbalanceOrig,required:oldbalanceDest,required:oldbalanceOrg'
              WHEN k IN (4, 6) THEN 'type:step' WHEN k = 5 THEN 'type:amount' WHEN k = 7 THEN 'required:nameDest'
              WHEN k = 8 THEN 'extra:note' WHEN k = 9 AND amount > 0 THEN 'minimum:amount' ELSE '' END AS violations FROM t"""
        ),
        "v7_request_bounds": _log(
            "SELECT event_id, CASE WHEN k = 0 THEN 'unknown:type' WHEN k = 99 AND amount > 0 THEN 'negative:amount' END AS problem FROM t"
        ),
        "v9_trainable": _log("SELECT count(*) > 0 AS has_rows, sum(isFraud) > 0 AS has_positives FROM t"),
        "v11_split_classes": _split(
            "SELECT split, count(*) AS rows, count(DISTINCT isFraud) AS classes, "
            "count(DISTINCT isFraud) >= 2 AS usable FROM s GROUP BY split"
        ),
        "v13_quarantine": f"{_with(SENT)} SELECT coalesce({PARSE_ERROR}, 'accepted') AS reason, count(*) AS rows FROM t GROUP BY 1",
        "feature_pipeline": _features(f"SELECT event_id, {RAW}, {FEATURE_LIST} FROM f"),
        "feature_one": _features(f"SELECT event_id, {FEATURE_LIST} FROM f"),
        "drop_identifiers": _log(
            "SELECT event_id, step, type, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud FROM t"
        ),
        "one_hot_type": _log(
            f"SELECT event_id, step, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud, {ONE_HOT} FROM t"
        ),
        "bool_to_int": _log(
            "SELECT event_id, CAST(amount > 100 AS BIGINT) AS large, CAST(nameDest LIKE 'M%' AS BIGINT) AS merchant FROM t"
        ),
        "reindex_features": f"{_with(LOG, FEATURES)}, y AS (SELECT *, {ONE_HOT} FROM f) SELECT event_id, "
        + ", ".join(
            f"CAST(0 AS BIGINT) AS {c}" if c in ("type_DEBIT", "hour_of_day") else c for c in MODEL_INPUTS
        )
        + " FROM y",
        "entity_id": _features("SELECT event_id, transaction_id FROM f"),
        "event_timestamp": _features("SELECT event_id, event_timestamp FROM f"),
        "feature_view_rows": _features(f"SELECT event_id, {VIEW} FROM f"),
        "to_wire": _log(f"SELECT event_id, {WIRE} FROM t"),
        "drop_label": _log(f"SELECT event_id, {WIRE} FROM t"),
        "clip_upper_quantile": _log(
            "SELECT event_id, round(least(amount, (SELECT quantile_cont(amount, 0.99) FROM t)), 6) AS amount_clipped FROM t"
        ),
        "result_row": _scored(
            "SELECT event_id, nameOrig, nameDest, type, amount, truth, prediction, round(fraud_probability, 6) AS fraud_probability, "
            "round(latency_ms, 2) AS latency_ms, prediction = truth AS correct FROM sc"
        ),
        "dq_overview": "SELECT count(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM events",
        "dq_missing": _log(
            """SELECT * FROM (SELECT 'amount' AS "column", count(*) FILTER (WHERE k = 0) AS missing FROM t
               UNION ALL SELECT 'nameDest', count(*) FILTER (WHERE k = 1) FROM t) WHERE missing > 0"""
        ),
        "dq_duplicates": _log("SELECT count(*) FILTER (WHERE k = 0) AS duplicate_rows FROM t"),
        "dq_fraud_balance": _log(
            "SELECT CAST(sum(isFraud) AS BIGINT) AS fraud_count, round(CAST(100 AS DOUBLE) * sum(isFraud) / count(*), 4) AS fraud_percentage FROM t"
        ),
        "dq_type_counts": _log("SELECT type, count(*) AS rows FROM t GROUP BY type"),
        "dq_describe": _log(" UNION ALL ".join(_described(c) for c in NUMBERS)),
        "dq_negative_amount": _log("SELECT count(*) FILTER (WHERE k = 99 AND amount > 0) AS negative_amounts FROM t"),
        "dq_label_counts": _log(
            "SELECT CASE WHEN isFraud = 1 THEN 'fraud' ELSE 'legitimate' END AS label, count(*) AS rows FROM t GROUP BY 1"
        ),
        "dq_amount_histogram": _log(
            """, lim AS (SELECT min(amount) AS low, quantile_cont(amount, 0.99) AS high FROM t),
            lw AS (SELECT low, high, (high - low) / CAST(50 AS DOUBLE) AS width FROM lim),
            g AS (SELECT least(amount, high) AS v, low, width,
                least(CAST(floor((least(amount, high) - low) / width) AS BIGINT), 49) AS b FROM t, lw),
            h AS (SELECT CASE WHEN b > 0 AND v < low + b * width THEN b - 1
                WHEN b < 49 AND v >= low + (b + 1) * width THEN b + 1 ELSE b END AS bin FROM g)
            SELECT CAST(i AS BIGINT) AS bin, round(low + i * width, 6) AS bin_start,
              (SELECT count(*) FROM h WHERE h.bin = i) AS rows
            FROM range(0, 50) AS x(i), lw"""
        ),
        "dq_correlation": _log(_correlations()),
        "split_cumulative": _split("SELECT step, rows, share FROM cum"),
        "split_cutoffs": _split("SELECT train_end, validation_end FROM cut"),
        "temporal_split": _split("SELECT event_id, step, split FROM s"),
        "split_summary": _split(SUMMARY),
        "dataset_xy": f"{_with(LOG, FEATURES, SPLIT, PROCESSED)} SELECT split, isFraud AS label, count(*) AS rows, "
        "CAST(21 AS BIGINT) AS inputs, "
        + ", ".join(f"round(sum(CAST({c} AS DOUBLE)), 4) AS x{i}" for i, c in enumerate(MODEL_INPUTS))
        + " FROM x GROUP BY split, isFraud",
        "class_counts_weight": _split(
            """SELECT count(*) FILTER (WHERE isFraud = 0) AS negatives, count(*) FILTER (WHERE isFraud = 1) AS positives,
               CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE) / count(*) FILTER (WHERE isFraud = 1) AS positive_weight
               FROM s WHERE split = 'train'"""
        ),
        "balanced_weights": _split(
            """SELECT event_id, isFraud, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY isFraud)) AS weight
               FROM s WHERE split = 'train'"""
        ),
        "standardize": _split(
            "SELECT event_id, split, "
            + ", ".join(
                f"round(({c} - (SELECT avg({c}) FROM s WHERE split = 'train')) / "
                f"(SELECT stddev_pop({c}) FROM s WHERE split = 'train'), 6) AS {c}"
                for c in NUMBERS
            )
            + " FROM s"
        ),
        "m_confusion": _scored(f"SELECT {CELLS} FROM sc"),
        "m_scores": _scored(f"SELECT {RATES} FROM {_cells_of('sc')}"),
        "m_roc_auc": _scored(f"SELECT round(roc_auc, 6) AS roc_auc FROM {_ranking('sc')}"),
        "m_average_precision": _scored(f"SELECT round(average_precision, 6) AS average_precision FROM {_ranking('sc')}"),
        "m_as_rows": _scored(
            f"""SELECT 'val_' || metric AS metric, CAST(value AS DOUBLE) AS value FROM (
              UNPIVOT (SELECT accuracy, precision, recall, f1, round(roc_auc, 6) AS roc_auc,
                  round(average_precision, 6) AS average_precision, CAST(tn AS DOUBLE) AS true_negatives,
                  CAST(fp AS DOUBLE) AS false_positives, CAST(fn AS DOUBLE) AS false_negatives, CAST(tp AS DOUBLE) AS true_positives
                FROM (SELECT *, {RATES} FROM {_cells_of('sc')}), {_ranking('sc')})
              ON COLUMNS(*) INTO NAME metric VALUE value)"""
        ),
        "m_best_run": f"{_with(LOG, FEATURES, SPLIT, RULES, BEST)} SELECT model, round(average_precision, 6) AS average_precision, round(roc_auc, 6) AS roc_auc FROM best",
        "m_comparison": f"""{_with(LOG, FEATURES, SPLIT, RULES, BEST)},
            cells AS (SELECT model, {RATES} FROM {_cells_of('r', 'model')}),
            wide AS (SELECT runs.model, round(average_precision, 6) AS average_precision, round(roc_auc, 6) AS roc_auc,
              recall, precision, f1 FROM runs JOIN cells ON runs.model = cells.model)
            SELECT model, metric, value, model = (SELECT model FROM best) AS best FROM (
              UNPIVOT wide ON average_precision, roc_auc, recall, precision, f1 INTO NAME metric VALUE value)""",
        "reg_latest": f"""{_with(LOG, VERSIONS)} SELECT name, version, run_id, stage FROM vt
            QUALIFY row_number() OVER (PARTITION BY name ORDER BY d DESC) = 1""",
        "reg_production": f"""{_with(LOG, VERSIONS)} SELECT name, version, run_id, stage FROM vt WHERE stage = 'Production'
            QUALIFY row_number() OVER (PARTITION BY name ORDER BY d DESC) = 1""",
        "score_lookup_join": _features(
            "SELECT event_id, transaction_id, "
            + ", ".join(
                f"CASE WHEN event_timestamp < TIMESTAMP '2024-01-28 00:00:00' THEN {c} END AS {c}"
                for c in FEATURE_LIST.split(", ")
            )
            + " FROM f"
        ),
        "score_lookup_buckets": _features(
            "SELECT event_id, transaction_id, "
            + ", ".join(
                f"CASE WHEN event_timestamp < TIMESTAMP '2024-01-28 00:00:00' THEN {c} END AS {c}"
                for c in FEATURE_LIST.split(", ")
            )
            + " FROM f"
        ),
        "score_missing": _features(
            "SELECT event_id, transaction_id FROM f WHERE event_timestamp >= TIMESTAMP '2024-01-28 00:00:00'"
        ),
        "score_outcomes": _outcomes("SELECT event_id, outcome, reason FROM ol"),
        "score_log": _log(f"SELECT type, '1' AS model_version, count(*) AS rows FROM t WHERE {SERVED} GROUP BY type"),
        "score_row": _log(f"SELECT event_id, true AS score_sound, '1' AS model_version FROM t WHERE {SERVED}"),
        "score_batch": _split(
            "SELECT event_id, isFraud AS truth, true AS score_sound, '1' AS model_version FROM s WHERE split = 'test'"
        ),
        "train_compare": _split(
            f"SELECT model, split, {CLASS_FACTS}, true AS best_is_chosen FROM s, (SELECT unnest(['logistic_regression', "
            "'random_forest', 'boosted_level', 'boosted_leaf']) AS model) WHERE split <> 'train' GROUP BY model, split"
        ),
        "evaluate_latest": _split(f"SELECT {CLASS_FACTS} FROM s WHERE split = 'test'"),
        "job_weekly": _split(f"SELECT {CLASS_FACTS} FROM s WHERE split = 'test'"),
        **{
            key: _split(f"SELECT split, {CLASS_FACTS}, true AS scores_sound FROM s WHERE split <> 'train' GROUP BY split")
            for key in ("model_lr", "model_rf", "model_gbt_level", "model_gbt_leaf")
        },
        "mon_request_rate": _outcomes(
            "SELECT time_bucket(INTERVAL '1 minute', logged_at) AS window_start, "
            "time_bucket(INTERVAL '1 minute', logged_at) + INTERVAL '1 minute' AS window_end, "
            "round(count(*) / CAST(60 AS DOUBLE), 6) AS requests_per_second FROM co GROUP BY 1, 2"
        ),
        "mon_latency_quantiles": f"""{_with(LOG, SCORED, OUTCOMES)},
            b AS (SELECT CAST(unnest({LATENCY_BOUNDS}) AS DOUBLE) AS le),
            w AS (SELECT time_bucket(INTERVAL '5 minutes', logged_at) AS ws, latency_ms / CAST(1000 AS DOUBLE) AS sec
              FROM ol WHERE outcome = 'success'),
            c AS (SELECT ws, le, count(*) FILTER (WHERE sec <= le) AS upto, count(*) AS total FROM w, b GROUP BY ws, le),
            o AS (SELECT *, lag(upto, 1, 0) OVER (PARTITION BY ws ORDER BY le) AS below,
              lag(le, 1, CAST(0 AS DOUBLE)) OVER (PARTITION BY ws ORDER BY le) AS lower FROM c)
            SELECT ws AS window_start, ws + INTERVAL '5 minutes' AS window_end,
              {_quantile(50)}, {_quantile(95)}, {_quantile(99)} FROM o GROUP BY ws""",
        "mon_error_ratio": _outcomes(
            "SELECT time_bucket(INTERVAL '5 minutes', logged_at) AS window_start, "
            "time_bucket(INTERVAL '5 minutes', logged_at) + INTERVAL '5 minutes' AS window_end, "
            "round(count(*) FILTER (WHERE outcome <> 'success') / CAST(count(*) AS DOUBLE), 6) AS error_ratio FROM co GROUP BY 1, 2"
        ),
        "mon_fraud_per_hour": _outcomes(
            "SELECT time_bucket(INTERVAL '1 hour', logged_at) AS window_start, "
            "time_bucket(INTERVAL '1 hour', logged_at) + INTERVAL '1 hour' AS window_end, "
            "count(*) FILTER (WHERE prediction = 1) AS fraud_predictions FROM ol WHERE outcome = 'success' GROUP BY 1, 2"
        ),
        "mon_mean_probability": _outcomes(
            "SELECT time_bucket(INTERVAL '5 minutes', logged_at) AS window_start, "
            "time_bucket(INTERVAL '5 minutes', logged_at) + INTERVAL '5 minutes' AS window_end, "
            "round(avg(fraud_probability), 12) AS mean_probability FROM ol WHERE outcome = 'success' GROUP BY 1, 2"
        ),
        "mon_class_distribution": _outcomes(
            "SELECT time_bucket(INTERVAL '1 hour', logged_at) AS window_start, "
            "time_bucket(INTERVAL '1 hour', logged_at) + INTERVAL '1 hour' AS window_end, "
            "prediction, count(*) AS predictions FROM ol WHERE outcome = 'success' GROUP BY 1, 2, prediction"
        ),
        "mon_probability_histogram": _outcomes(
            " UNION ALL ".join(
                f"SELECT '{b}' AS le, count(*) FILTER (WHERE fraud_probability <= CAST({b} AS DOUBLE)) AS requests FROM ol WHERE outcome = 'success'"
                for b in ("0.0", "0.001", "0.01", "0.05", "0.1", "0.25", "0.5", "0.75", "0.9", "0.99", "1.0")
            )
            + " UNION ALL SELECT '+Inf', count(*) FROM ol WHERE outcome = 'success'"
        ),
        "mon_outcome_counters": _outcomes(
            "SELECT 'requests' AS counter, outcome AS label, count(*) AS value FROM co GROUP BY outcome "
            "UNION ALL SELECT 'errors', outcome, count(*) FROM co WHERE outcome <> 'success' GROUP BY outcome"
        ),
        "mon_live_performance": f"""{_with(LOG, SCORED, OUTCOMES)},
            served AS (SELECT * FROM ol WHERE outcome = 'success')
            SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
              tn + fp + fn + tp AS scored, {RATES} FROM {_cells_of('served')}""",
        "mon_rolling_accuracy": _scored(
            "SELECT seq, prediction = truth AS correct, round(avg(CAST(prediction = truth AS INTEGER)) OVER "
            "(ORDER BY seq ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 6) AS rolling_accuracy FROM sc"
        ),
        "mon_history_cap": _scored("SELECT seq, truth, prediction, prediction = truth AS correct FROM sc ORDER BY seq DESC LIMIT 500"),
        "mon_recent": _scored("SELECT seq, truth, prediction, prediction = truth AS correct FROM sc ORDER BY seq DESC LIMIT 25"),
        "st_live_performance": f"""{_with(LOG, SCORED, OUTCOMES)},
            judged AS (SELECT * FROM ol WHERE outcome = 'success' AND event_id % 10 <= 7)
            SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
              tn + fp + fn + tp AS scored, {RATES} FROM {_cells_of('judged')}""",
        "st_features": f"{_with(SENT, FEATURES)} SELECT event_id, {VIEW} FROM f WHERE k NOT IN (0, 1, 2, 3, 7)",
        "st_fault_isolation": f"""{_with(SENT)} SELECT CASE WHEN reason IS NULL THEN 'OK' ELSE 'SKIPPED' END AS status,
            CASE WHEN reason IS NOT NULL THEN 'invalid' END AS kind, reason, count(*) AS rows,
              (SELECT count(DISTINCT event_id) FROM t WHERE k NOT IN (0, 1, 2, 3, 7)) AS keys_served
            FROM (SELECT {PARSE_ERROR} AS reason FROM t) GROUP BY ALL""",
        "st_upsert_online": _latest(),
        "st_latest_per_key": _latest(),
        "st_state_newest": _latest(),
        "st_replay": _parity(),
        "st_ttl": _features(
            "SELECT transaction_id, event_timestamp FROM f "
            "WHERE event_timestamp >= TIMESTAMP '2034-01-12 00:00:00' - INTERVAL '3650 days'"
        ),
        "st_windowed_monitoring": _outcomes(
            """SELECT time_bucket(INTERVAL '1 minute', logged_at) AS window_start,
                time_bucket(INTERVAL '1 minute', logged_at) + INTERVAL '1 minute' AS window_end,
                round(count(*) / CAST(60 AS DOUBLE), 6) AS requests_per_second FROM co GROUP BY 1, 2"""
        ),
        "fs_build_offline": _features(f"SELECT {VIEW} FROM f"),
        "fs_materialize_window": _log(
            "SELECT TIMESTAMP '2024-01-01 00:00:00' AS window_start, TIMESTAMP '2024-01-01 00:00:00' + to_hours(max(step) + 1) AS window_end FROM t"
        ),
        "fs_materialize": _latest("k % 5 <> 4"),
        "fs_parity": _parity(),
        "drift_reference": _log("SELECT amount, type, oldbalanceOrg, newbalanceOrig FROM t ORDER BY step, event_id LIMIT 5000"),
        "drift_ks": _drift(
            DRIFT_NUMBERS,
            'SELECT "column", CAST(max(na) AS BIGINT) AS reference_rows, CAST(max(nb) AS BIGINT) AS current_rows, '
            'round(max(abs(fa - fb)), 6) AS statistic FROM c GROUP BY "column"',
        ),
        "drift_chi2": _drift(
            ("type",),
            'SELECT "column", round(sum((b - a / na * nb) * (b - a / na * nb) / (a / na * nb)), 6) AS statistic, '
            'count(*) - 1 AS freedom FROM c GROUP BY "column"',
        ),
        "drift_wasserstein": _drift(
            DRIFT_NUMBERS,
            'SELECT "column", round(sum(abs(fa - fb) * (following - value)) / greatest(max(spread), 0.001), 6) AS statistic FROM c JOIN ('
            + " UNION ALL ".join(
                f"SELECT '{c}' AS name, stddev_pop({c}) AS spread FROM s WHERE split = 'train'" for c in DRIFT_NUMBERS
            )
            + ') ON name = "column" GROUP BY "column"',
        ),
        "drift_js": _drift(("type",), f'SELECT "column", round({JS}, 6) AS statistic FROM c GROUP BY "column"'),
        "drift_summary": f"""{_with(LOG, FEATURES, SPLIT)},
            ref AS (SELECT * FROM s WHERE split = 'train'),
            cur AS (SELECT * REPLACE (amount * 5 AS amount) FROM s WHERE split = 'test')
            {_drift_summary('ref', 'cur')}""",
        "drift_p_values": _drift_p_values(),
        "job_monthly": f"""{_with(LOG)}, cur AS (SELECT * REPLACE (amount * 5 AS amount) FROM t)
            {_drift_summary('t', 'cur')}""",
        "dq_report_tables": _report(),
        "job_preprocess": _split(SUMMARY),
        "job_daily": _features("SELECT transaction_id, max(event_timestamp) AS event_timestamp FROM f GROUP BY transaction_id"),
        "job_sample": _log(
            """SELECT event_id, isFraud FROM t WHERE isFraud = 1 UNION ALL SELECT * FROM (
                SELECT event_id, isFraud FROM t WHERE isFraud <> 1
                ORDER BY sha256(CAST(event_id AS VARCHAR)), event_id LIMIT 2000)"""
        ),
    }
    for key, feature in zip(
        (
            "f_orig_balance_error",
            "f_dest_balance_error",
            "f_orig_balance_delta",
            "f_dest_balance_delta",
            "f_orig_depleted",
            "f_dest_untouched",
            "f_amount_ratio",
            "f_hour_of_day",
            "f_dest_merchant",
        ),
        FEATURE_LIST.split(", "),
    ):
        sql[key] = _features(f"SELECT event_id, {feature} FROM f")
    return sql
