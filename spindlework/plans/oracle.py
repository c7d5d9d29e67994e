"""The same results in plain SQL, written independently of the DataFrame code."""

from __future__ import annotations

import json

from spindlework.functions.text import FALLBACK_REPLY, PROMPT_PREFIX
from spindlework.operators.scoring import FRENCH_NAMES, NO_ADVICE, NO_NAME
from spindlework.operators.tuning import FOREST_SPACE, draw_settings
from spindlework.schemas import NUMERIC_FEATURES, RAW_COLUMNS, READING_COLUMNS, READING_SCHEMA
from spindlework.sources import fixtures

_ARRIVED = fixtures.READINGS_SQL.replace("__DOW__", "dayname(l_shipdate)").format(
    lineitem="lineitem", part="part"
)
_COLS = ", ".join(READING_COLUMNS)
_CANON = "CAST(TRY_CAST(timestamp AS TIMESTAMP) AS VARCHAR)"

_MR = f"WITH arrived AS ({_ARRIVED}), machine_readings AS (SELECT {_COLS} FROM arrived)"
_PRED = f"{_MR}, predictions AS ({fixtures.PREDICTIONS_SQL.format(machine_readings='machine_readings')})"
_TELE = f"WITH machine_telemetry AS ({fixtures.TELEMETRY_SQL.format(events='events')})"
_TALK = f"WITH dialogue AS ({fixtures.DIALOGUE_SQL.format(conversations='conversations')})"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_KPI = f"""{_MR},
kp AS (
  SELECT product_id,
    count(*) FILTER (WHERE failure_type = 'Overstrain Failure') / count(*) * 100 AS defect_rate,
    (100 - max(tool_wear)) / 100 * 100 AS tool_lifetime_efficiency
  FROM machine_readings GROUP BY product_id
),
kt AS (
  SELECT type, round(sum(tool_wear) / nullif(count(DISTINCT product_id), 0), 2) AS tool_wear_per_unit
  FROM machine_readings GROUP BY type
),
kpi AS (
  SELECT m.*,
    abs(process_temperature - air_temperature) AS deviation_from_target_process_temperature,
    1 - tool_wear / 100 AS tool_efficiency,
    defect_rate, tool_wear_per_unit, tool_lifetime_efficiency
  FROM machine_readings m
  LEFT JOIN kp ON m.product_id = kp.product_id LEFT JOIN kt ON m.type = kt.type
),
calendar AS (
  SELECT DISTINCT date, day_of_week, quarter, {_CANON} AS timestamp FROM machine_readings
),
date_dim AS (
  SELECT *, CAST(month(CAST(timestamp AS TIMESTAMP)) AS INT) AS month,
    CAST(year(CAST(timestamp AS TIMESTAMP)) AS INT) AS year,
    CAST(row_number() OVER (ORDER BY date NULLS FIRST, day_of_week NULLS FIRST,
      quarter NULLS FIRST, timestamp NULLS FIRST) AS INT) AS date_id
  FROM calendar
)"""

_FACT_COLS = """udi, failure_type_id AS failure_id, product_id, type_id, date_id, process_temperature,
  tool_wear, air_temperature, rotational_speed, torque, target,
  deviation_from_target_process_temperature, tool_efficiency, defect_rate, tool_wear_per_unit,
  tool_lifetime_efficiency"""


def _fact(match: str) -> str:
    return f"""{_KPI},
fact AS (
  SELECT {_FACT_COLS} FROM kpi LEFT JOIN
    (SELECT timestamp AS dim_timestamp, date_id FROM date_dim) d ON {match} = d.dim_timestamp
)"""


_FACT = _fact(_CANON)


def _digest(columns: list[str], seed: str = "") -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"md5(concat_ws('|', {parts}, '{seed}'))"


def _record_digest(columns: list[str]) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    return "md5(concat(" + ", ".join(f"coalesce(length({t}) || ':' || {t}, '~')" for t in texts) + "))"


def _number(digest: str, start: int = 1) -> str:
    return f"CAST('0x' || substr({digest}, {start}, 8) AS BIGINT)"


_KEYS = ["udi", *fixtures.ARRIVAL]
_KEY_LIST = ", ".join(_KEYS)
_SPLIT = f"""{_MR},
split AS (
  SELECT *, CASE WHEN substr({_digest(_KEYS, "42")}, 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split
  FROM arrived
)"""
_Z = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC_FEATURES)
_ZFIT = f"""{_SPLIT},
fit AS (SELECT {_Z} FROM split WHERE split = 'train'),
slot AS (
  SELECT type AS slot_type, 1 / sqrt(p * (1 - p)) AS size FROM (
    SELECT type, count(*) / sum(count(*)) OVER () AS p FROM split WHERE split = 'train' GROUP BY type)
)"""
# a decision tree finds thresholds of few-valued measures exactly, so it answers with the class
_GRADED = f"""{_MR}, graded AS ({fixtures.GRADED_SQL.format(arrived="arrived")}),
parts AS (
  SELECT *, CASE WHEN substr({_digest(_KEYS, "42")}, 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split
  FROM graded
)"""
_FLAG = f"""{_GRADED}
SELECT udi, CAST(target AS DOUBLE) AS label, CAST(target AS DOUBLE) AS prediction FROM parts WHERE split = 'test'"""


def _classes(order: str) -> str:
    """Every test row answered with its class, numbered as in the train rows."""
    return f"""{_GRADED}, numbered AS (
  SELECT failure_type, CAST(row_number() OVER (ORDER BY {order}) - 1 AS DOUBLE) AS label
  FROM parts WHERE split = 'train' GROUP BY 1
) SELECT udi, failure_type, label, label AS prediction, failure_type AS predicted_class
FROM parts JOIN numbered USING (failure_type) WHERE split = 'test'"""


_LEVELS = ["H", "L", "M"]
_GRID_COLS = ",\n  ".join(
    [
        f"CAST(round(({c} - m_{c}) / s_{c} * 10000) AS BIGINT) AS c{i}"
        for i, c in enumerate(NUMERIC_FEATURES)
    ]
    + [
        f"CASE WHEN type = '{level}' THEN (SELECT CAST(round(size * 10000) AS BIGINT) FROM slot"
        f" WHERE slot_type = '{level}') ELSE 0 END AS c{5 + i}"
        for i, level in enumerate(_LEVELS)
    ]
)
_GRID = f"""{_ZFIT},
grid AS (
  SELECT udi, split, CAST(failure_type_id AS INT) AS label,
  {_GRID_COLS}
  FROM split, fit
)"""
_C = [f"c{i}" for i in range(8)]
_C_LIST = ", ".join(_C)
_DIST = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _C)

_RAW_LIST = ", ".join(RAW_COLUMNS)
_LINE = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in RAW_COLUMNS if c != "udi")
_READING_NULLS_FIRST = ", ".join(f"{c} NULLS FIRST" for c in READING_COLUMNS)

_CELLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM machine_readings" for c in NUMERIC_FEATURES
)
_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS correlation FROM machine_readings"
    for a in NUMERIC_FEATURES
    for b in NUMERIC_FEATURES
)
_PROFILE = " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type,"
    " (SELECT count(*) FROM machine_readings) AS records"
    for i, f in enumerate(READING_SCHEMA.fields)
)


def _sample(n: int, seed: int) -> str:
    return f"{_MR} SELECT * FROM machine_readings ORDER BY {_digest(['udi'], str(seed))}, {_READING_NULLS_FIRST} LIMIT {n}"


# what the damaged messages parse to: unreadable ones leave nothing
_LOST = "(udi % 20 IN (0, 4, 5))"
_PARSED = ", ".join(
    f"CASE WHEN {_LOST} THEN NULL"
    + {
        "rotational_speed": " WHEN udi % 20 = 1 THEN NULL",
        "torque": " WHEN udi % 20 = 2 THEN NULL",
        "product_id": " WHEN udi % 20 = 3 THEN substr(product_id, 2)",
    }.get(c, "")
    + f" ELSE {c} END AS {c}"
    for c in READING_COLUMNS
)

_NAMES = ", ".join(f"({i}, {_text(c)}, {_text(n)})" for i, (c, n) in enumerate(FRENCH_NAMES.items()))

_CLASS = """
counts AS (SELECT label, prediction, count(*) AS n FROM predictions GROUP BY 1, 2),
classes AS (SELECT label AS class FROM counts UNION SELECT prediction FROM counts),
per_class AS (
  SELECT class,
    (SELECT coalesce(sum(n), 0) FROM counts WHERE label = class AND prediction = class) AS tp,
    (SELECT coalesce(sum(n), 0) FROM counts WHERE label = class) AS support,
    (SELECT coalesce(sum(n), 0) FROM counts WHERE prediction = class) AS predicted
  FROM classes
),
scores AS (
  SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
    coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1
  FROM per_class
)"""


def _binary(prediction: str) -> str:
    tp = f"sum(CASE WHEN label_bin = 1 AND {prediction} = 1 THEN 1 ELSE 0 END)"
    pos = "sum(CASE WHEN label_bin = 1 THEN 1 ELSE 0 END)"
    said = f"sum(CASE WHEN {prediction} = 1 THEN 1 ELSE 0 END)"
    return f"""sum(CASE WHEN label_bin = {prediction} THEN 1 ELSE 0 END) / count(*) AS accuracy,
      coalesce({tp} / nullif({pos}, 0), 0) AS recall, coalesce({tp} / nullif({said}, 0), 0) AS precision,
      coalesce(2 * {tp} / nullif({pos} + {said}, 0), 0) AS f1"""


_MODELS = {
    "rule": "prediction_bin",
    "overstrain_only": "(CASE WHEN prediction = 3 THEN 1 ELSE 0 END)",
    "never": "0",
}
_STACK = " UNION ALL ".join(
    f"SELECT {_binary(p)}, '{name}' AS model FROM predictions" for name, p in _MODELS.items()
)
_GAP = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(tr.{m}, 9) AS train, round(te.{m}, 9) AS test,"
    f" round(tr.{m} - te.{m}, 9) AS gap FROM (SELECT * FROM s WHERE split = 'train') tr,"
    " (SELECT * FROM s WHERE split = 'test') te"
    for m in ("accuracy", "recall", "precision", "f1")
)
_SCATTER = " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, CAST(floor({x} / {dx}) * {dx} AS BIGINT) AS x_from,"
    f" CAST(floor({y} / {dy}) * {dy} AS BIGINT) AS y_from, failure_type, count(*) AS n"
    " FROM machine_readings GROUP BY ALL"
    for x, y, dx, dy in (
        ("rotational_speed", "tool_wear", 100, 20),
        ("rotational_speed", "torque", 100, 5),
        ("rotational_speed", "process_temperature", 100, 1),
    )
)
_INT = r"'^\s*[+-]?[0-9]+(_[0-9]+)*\s*$'"
_FLOAT = r"'^\s*[+-]?(([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$'"
_WEAR_TEXT = "CASE WHEN udi % 3 = 0 THEN '1_' || tool_wear || 'e1' ELSE ' +' || tool_wear END"
_TEXT_CELLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", "
    + (_WEAR_TEXT if c == "tool_wear" else f"coalesce(CAST({c} AS VARCHAR), '')")
    + " AS v FROM machine_readings"
    for c in RAW_COLUMNS
)
_RANKED = """(
  SELECT failure_type, row_number() OVER (ORDER BY count(*) DESC, failure_type) - 1 AS idx
  FROM machine_readings GROUP BY 1
)"""
_TYPE_RANK = """(
  SELECT type, row_number() OVER (ORDER BY count(*) DESC, type) - 1 AS idx FROM machine_readings GROUP BY 1
)"""
_BINS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(i AS INT) AS bin, round(lo + i * ((hi - lo) / 15), 9) AS bin_start,
  (SELECT count(*) FROM machine_readings WHERE least(floor(({c} - lo) / ((hi - lo) / 15)), 14) = i) AS n
FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM machine_readings), range(15) r(i)"""
    for c in NUMERIC_FEATURES
)


def _ten(extra: str = "") -> str:
    return f"{_MR} SELECT {_RAW_LIST}{extra} FROM machine_readings"


ORACLE: dict[str, str] = {
    "defect_rate": f"{_KPI} SELECT product_id, defect_rate FROM kp",
    "tool_wear_per_unit": f"{_KPI} SELECT * FROM kt",
    "tool_lifetime_efficiency": f"{_KPI} SELECT product_id, tool_lifetime_efficiency FROM kp",
    "derived_metrics": f"{_KPI} SELECT udi, deviation_from_target_process_temperature, tool_efficiency FROM kpi",
    "kpi_joined": f"{_KPI} SELECT * FROM kpi",
    "failure_dim": f"{_MR} SELECT DISTINCT failure_type, failure_type_id FROM machine_readings",
    "type_dim": f"{_MR} SELECT DISTINCT type, type_id FROM machine_readings",
    "product_dim": f"{_MR} SELECT DISTINCT product_id, product_name, product_category, manufacturer FROM machine_readings",
    "date_dim": f"{_KPI} SELECT * FROM date_dim",
    "fact_table": f"{_FACT} SELECT * FROM fact",
    "fact_table_strict": f"{_fact('timestamp')} SELECT * FROM fact",
    "date_id_distributed": f"""{_MR} SELECT date, timestamp, udi, row_number() OVER (
  ORDER BY date, timestamp, udi, ingest_ts, ingest_seq1, ingest_seq2, ingest_seq3) AS row_id FROM arrived""",
    "star_report": f"""{_FACT}
SELECT year, month, type, failure_type, product_category, count(*) AS readings, CAST(sum(target) AS BIGINT) AS failures,
  CAST(sum(tool_wear) AS BIGINT) AS total_tool_wear, max(torque) AS max_torque
FROM fact
LEFT JOIN (SELECT DISTINCT failure_type, failure_type_id FROM machine_readings) f ON failure_id = failure_type_id
LEFT JOIN (SELECT DISTINCT type, type_id FROM machine_readings) t ON fact.type_id = t.type_id
LEFT JOIN (SELECT DISTINCT product_id, product_name, product_category, manufacturer FROM machine_readings) p
  ON fact.product_id = p.product_id
LEFT JOIN date_dim d ON fact.date_id = d.date_id
GROUP BY 1, 2, 3, 4, 5""",
    "star_load": f"""{_FACT}
SELECT 'failure_dim' AS table_name, * FROM (SELECT DISTINCT failure_type, failure_type_id FROM machine_readings)
UNION ALL BY NAME SELECT 'type_dim' AS table_name, * FROM (SELECT DISTINCT type, type_id FROM machine_readings)
UNION ALL BY NAME SELECT 'product_dim' AS table_name, * FROM (
  SELECT DISTINCT product_id, product_name, product_category, manufacturer FROM machine_readings)
UNION ALL BY NAME SELECT 'date_dim' AS table_name, * FROM date_dim
UNION ALL BY NAME SELECT 'fact_table' AS table_name, * FROM fact""",
    "parse_timestamp": f"""{_MR} SELECT udi, timestamp, {_CANON} AS canonical,
  CAST(month(TRY_CAST(timestamp AS TIMESTAMP)) AS INT) AS month,
  CAST(year(TRY_CAST(timestamp AS TIMESTAMP)) AS INT) AS year FROM machine_readings""",
    "csv_scan": _ten(),
    "csv_dir_load": f"""{_MR}
SELECT {_RAW_LIST}, false AS rejected, NULL AS line FROM machine_readings WHERE udi % 50 <> 0
UNION ALL SELECT {", ".join("NULL" for _ in RAW_COLUMNS)}, true,
  'broken ' || concat_ws(',', udi, {_LINE}) FROM machine_readings WHERE udi % 50 = 0""",
    **{
        name: f"{_MR} SELECT * FROM machine_readings"
        for name in ("keyed_scan", "warehouse_write", "ensure_table", "stream_ingest", "stream_available_now")
    },
    "json_encode_sink": _ten(f", {_record_digest(RAW_COLUMNS)} AS id"),
    "json_parse": f"{_MR} SELECT {_PARSED} FROM machine_readings",
    "reject_split": f"""{_MR}, parsed AS (SELECT {_PARSED} FROM machine_readings)
SELECT udi IS NULL AS rejected, failure_type, count(*) AS n, min(udi) AS min_udi, max(udi) AS max_udi
FROM parsed GROUP BY 1, 2""",
    "format_record": _ten(),
    "format_defaults": f"""{_MR} SELECT udi, coalesce(product_id, 'Unknown') AS product_id, 'Unknown' AS type,
  air_temperature, process_temperature, rotational_speed, CAST(NULL AS DOUBLE) AS torque, tool_wear, target,
  'Unknown' AS failure_type FROM machine_readings""",
    "record_id": _ten(f", {_record_digest(RAW_COLUMNS)} AS id"),
    "drop_nulls": f"{_MR} SELECT * FROM machine_readings WHERE product_id IS NOT NULL",
    "model_columns": f"{_MR} SELECT type, {', '.join(NUMERIC_FEATURES)}, failure_type FROM machine_readings",
    "table_profile": f"{_MR} {_PROFILE}",
    "random_record": _sample(1, 7),
    "sample_n": _sample(10, 42),
    "peek": f"{_MR} SELECT * FROM machine_readings ORDER BY {_READING_NULLS_FIRST} LIMIT 100",
    "enrich_readings": f"""{_MR}
SELECT m.udi, failure_type, target, process_temperature, m.product_id, rotational_speed, air_temperature, tool_wear,
  torque, type, substr({_CANON}, 1, 10) AS date, dayname(TRY_CAST(timestamp AS TIMESTAMP)) AS day_of_week,
  failure_type_id,
  CASE WHEN m.product_id IS NULL THEN NULL ELSE manufacturer END AS manufacturer,
  CASE WHEN m.product_id IS NULL THEN NULL ELSE product_category END AS product_category,
  CASE WHEN m.product_id IS NULL THEN NULL ELSE product_name END AS product_name,
  CAST(quarter(TRY_CAST(timestamp AS TIMESTAMP)) AS INT) AS quarter, timestamp, type_id
FROM machine_readings m""",
    "telemetry_parse": f"""{_TELE} SELECT machine_id, temperature, vibration, runtime_hours, status,
  make_timestamp(timestamp * 1000000) AS timestamp, location, operator_id, power_consumption_kw,
  make_timestamp(last_maintenance_date * 1000000) AS last_maintenance_date FROM machine_telemetry""",
    "infer_types": f"""{_MR}, cells AS ({_TEXT_CELLS}), typed AS (
  SELECT "column", regexp_matches(v, {_INT}) AS i, regexp_matches(v, {_FLOAT}) AS f FROM cells
), c AS (
  SELECT "column", count(*) FILTER (WHERE i) AS int_cells, count(*) FILTER (WHERE f AND NOT i) AS float_cells,
    count(*) FILTER (WHERE NOT f AND NOT i) AS string_cells FROM typed GROUP BY 1
) SELECT *, CASE WHEN string_cells > 0 THEN 'string' WHEN float_cells > 0 THEN 'float' ELSE 'int' END AS inferred FROM c""",
    "advice_lookup": f"""{_MR}, names(nr, name_class, french_name) AS (VALUES {_NAMES}),
advice AS (SELECT name_class AS class, n_name FROM names JOIN nation ON n_nationkey = nr AND nr < 5
  UNION ALL SELECT 'Unlisted Failure', n_name FROM nation WHERE n_nationkey = 6),
named AS (SELECT udi, CASE WHEN udi % 13 = 0 THEN 'Unlisted Failure' ELSE failure_type END AS failure_class FROM machine_readings)
SELECT udi, failure_class, coalesce(french_name, {_text(NO_NAME)}) AS french_name, coalesce(n_name, {_text(NO_ADVICE)}) AS advice
FROM named LEFT JOIN names ON failure_class = name_class LEFT JOIN advice ON failure_class = class""",
    "prompt_build": f"SELECT conv_id, turn, {_text(PROMPT_PREFIX)} || text AS prompt FROM conversations WHERE role = 'user'",
    "reply_guard": f"""{_TALK}, before AS (
  SELECT *, lag(role) OVER w AS role0, lag(text) OVER w AS text0 FROM dialogue WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), asked AS (
  SELECT conv_id, turn, CASE WHEN role0 = 'user' THEN text0 END AS question, text FROM before WHERE role = 'assistant'
) SELECT conv_id, turn, question,
  CASE WHEN text IS NOT DISTINCT FROM question OR length(text) < 10 THEN {_text(FALLBACK_REPLY)} ELSE text END AS reply
FROM asked""",
    "chat_history": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, role, text
FROM conversations""",
    "value_counts_failure": f"{_MR} SELECT failure_type, count(*) AS n FROM machine_readings GROUP BY 1",
    "value_counts_type": f"{_MR} SELECT type, count(*) AS n FROM machine_readings GROUP BY 1",
    "crosstab_type_failure": f"{_MR} SELECT type, failure_type, count(*) AS n FROM machine_readings GROUP BY 1, 2",
    "histograms": f"{_MR} {_BINS}",
    "null_counts": f"{_MR} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM machine_readings" for c in READING_COLUMNS
    ),
    "correlation_matrix": f"{_MR} {_PAIRS}",
    "describe_numeric": f"""{_MR}, cells AS ({_CELLS})
SELECT "column", count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min,
  round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
  round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max FROM cells GROUP BY 1""",
    "profile_from_sketches": f"""{_MR}, cells AS ({_CELLS})
SELECT "column", count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min, max(x) AS max,
  true AS p25_within, true AS p50_within, true AS p75_within, true AS distinct_within FROM cells GROUP BY 1""",
    "nunique": f"{_MR} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM machine_readings" for c in READING_COLUMNS
    ),
    "scatter_grid": f"{_MR} {_SCATTER}",
    "confusion_matrix": f"{_PRED} SELECT label, prediction, count(*) AS n FROM predictions GROUP BY 1, 2",
    "confusion_dense": f"""{_PRED}, {_CLASS}
SELECT a.class AS label, b.class AS prediction, coalesce(n, 0) AS n FROM classes a CROSS JOIN classes b
LEFT JOIN counts ON label = a.class AND prediction = b.class""",
    "confusion_share": f"""{_PRED}, {_CLASS}, dense AS (
  SELECT a.class AS label, b.class AS prediction, coalesce(n, 0) AS n FROM classes a CROSS JOIN classes b
  LEFT JOIN counts ON label = a.class AND prediction = b.class
) SELECT label, prediction, n, round(n / sum(n) OVER (), 9) AS share,
  n || chr(10) || printf('%.2f%%', CAST(n / sum(n) OVER () * 100 AS DOUBLE)) AS text FROM dense""",
    "weighted_metrics": f"""{_PRED}, {_CLASS}
SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(sum(precision * support) / sum(support), 9) AS precision,
  round(sum(recall * support) / sum(support), 9) AS recall, round(sum(f1 * support) / sum(support), 9) AS f1 FROM scores""",
    "binary_metrics": f"""{_PRED}, s AS (SELECT {_binary('prediction_bin')} FROM predictions)
SELECT round(accuracy, 9) AS accuracy, round(recall, 9) AS recall, round(precision, 9) AS precision, round(f1, 9) AS f1 FROM s""",
    "classification_report": f"""{_PRED}, {_CLASS}, report AS (
  SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM scores
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM scores
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM scores
) SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
  CAST(support AS BIGINT) AS support FROM report""",
    "train_test_gap": f"{_PRED}, s AS (SELECT split, {_binary('prediction_bin')} FROM predictions GROUP BY split) {_GAP}",
    "model_comparison": f"""{_PRED}, s AS ({_STACK})
SELECT round(accuracy, 9) AS accuracy, round(recall, 9) AS recall, round(precision, 9) AS precision, round(f1, 9) AS f1,
  model, model = (SELECT model FROM s ORDER BY f1 DESC, model DESC LIMIT 1) AS best FROM s""",
    **{
        name: f"""{_MR} SELECT {_COLS} FROM arrived QUALIFY row_number() OVER (PARTITION BY udi
  ORDER BY ingest_ts DESC, ingest_seq1 DESC, ingest_seq2 DESC, ingest_seq3 DESC) = 1"""
        for name in ("stream_upsert_latest", "stream_upsert_folded")
    },
    "stream_batch_stats": f"""{_MR}, parsed AS (
  SELECT CAST(floor(udi / 10) % 4 AS BIGINT) AS batch_id, CASE WHEN {_LOST} THEN NULL ELSE udi END AS udi FROM machine_readings)
SELECT batch_id, count(*) AS rows, count(*) FILTER (WHERE udi IS NULL) AS rejects, min(udi) AS min_udi, max(udi) AS max_udi
FROM parsed GROUP BY 1""",
    "stream_rejects": f"""{_MR}
SELECT CASE WHEN udi % 20 = 0 THEN 'unreadable' END AS fault, CASE WHEN udi % 20 = 0 THEN CAST(udi AS VARCHAR) ELSE '' END AS named,
  udi % 20 = 4 AS is_empty_object, CAST(NULL AS INTEGER) AS udi FROM machine_readings WHERE udi % 20 IN (0, 4)""",
    "relay_stream": "SELECT 'plant/' || event_type AS topic, props AS value FROM events",
    "label_index_freq": f"{_MR} SELECT udi, m.failure_type, CAST(idx AS DOUBLE) AS label FROM machine_readings m JOIN {_RANKED} r ON m.failure_type = r.failure_type",
    "label_index_alpha": f"""{_MR} SELECT udi, m.failure_type, CAST(idx AS DOUBLE) AS label, m.failure_type AS decoded
FROM machine_readings m JOIN (SELECT failure_type, row_number() OVER (ORDER BY failure_type) - 1 AS idx
  FROM machine_readings GROUP BY 1) r ON m.failure_type = r.failure_type""",
    "class_counts": f"{_MR} SELECT failure_type, count(*) AS n FROM machine_readings GROUP BY 1",
    "one_hot_type": f"""{_MR} SELECT udi, m.type, CAST(idx AS DOUBLE) AS type_index,
  CASE WHEN idx = 0 THEN 1.0::DOUBLE ELSE 0 END AS type_0,
  CASE WHEN idx = 1 THEN 1.0::DOUBLE ELSE 0 END AS type_1 FROM machine_readings m JOIN {_TYPE_RANK} r ON m.type = r.type""",
    "features_indexed": f"""{_MR} SELECT udi, CAST(l.idx AS DOUBLE) AS label,
  {", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(NUMERIC_FEATURES))}, CAST(r.idx AS DOUBLE) AS f5
FROM machine_readings m JOIN {_TYPE_RANK} r ON m.type = r.type JOIN {_RANKED} l ON m.failure_type = l.failure_type""",
    "features_assembled": f"""{_MR} SELECT udi, CAST(l.idx AS DOUBLE) AS label,
  {", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(NUMERIC_FEATURES))},
  CASE WHEN r.idx = 0 THEN 1.0::DOUBLE ELSE 0 END AS f5, CASE WHEN r.idx = 1 THEN 1.0::DOUBLE ELSE 0 END AS f6
FROM machine_readings m JOIN {_TYPE_RANK} r ON m.type = r.type JOIN {_RANKED} l ON m.failure_type = l.failure_type""",
    "scale_std": f"""{_MR}, s AS (SELECT {", ".join(f"stddev_samp({c}) AS s_{c}" for c in NUMERIC_FEATURES)} FROM machine_readings)
SELECT udi, {", ".join(f"round({c} / s_{c}, 6) AS f{i}" for i, c in enumerate(NUMERIC_FEATURES))} FROM machine_readings, s""",
    "scale_zscore": f"""{_ZFIT} SELECT udi, split,
  {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}_z" for c in NUMERIC_FEATURES)} FROM split, fit""",
    "feature_prepare": f"""{_ZFIT}, lab AS (SELECT failure_type AS ft, row_number() OVER (ORDER BY failure_type) - 1 AS idx
  FROM split WHERE split = 'train' GROUP BY 1)
SELECT udi, CAST(idx AS DOUBLE) AS label,
  {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS f{i}" for i, c in enumerate(NUMERIC_FEATURES))},
  {", ".join(f"CASE WHEN type = '{v}' THEN (SELECT round(size, 6) FROM slot WHERE slot_type = '{v}') ELSE 0 END AS f{5 + i}" for i, v in enumerate(_LEVELS))}
FROM split JOIN lab ON failure_type = ft, fit""",
    "split_hash": f"{_SPLIT} SELECT {_KEY_LIST}, split FROM split",
    "split_exact": f"""{_MR} SELECT {_KEY_LIST}, CASE WHEN row_number() OVER (ORDER BY {_digest(_KEYS, "42")})
  <= ceil(0.2 * (SELECT count(*) FROM arrived)) THEN 'test' ELSE 'train' END AS split FROM arrived""",
    "fold_assign": f"{_MR} SELECT {_KEY_LIST}, CAST({_number(_digest(_KEYS, '42'))} % 5 AS INT) AS fold FROM arrived",
    "smote_oversample": f"""{_GRID}, sized AS (
  SELECT *, count(*) OVER (PARTITION BY label) AS class_rows,
    row_number() OVER (PARTITION BY label ORDER BY {_C_LIST}) - 1 AS base FROM grid WHERE split = 'train'
), small AS (
  SELECT *, (SELECT max(class_rows) FROM sized) - class_rows AS missing FROM sized
  WHERE class_rows < (SELECT max(class_rows) FROM sized)
), near AS (
  SELECT a.label, a.base, {", ".join(f"b.{c} AS n_{c}" for c in _C)},
    row_number() OVER (PARTITION BY a.label, a.base ORDER BY {_DIST}, {", ".join(f"b.{c}" for c in _C)}) - 1 AS rank
  FROM small a JOIN small b ON a.label = b.label AND a.base <> b.base
  QUALIFY rank < 5
), wanted AS (
  SELECT *, unnest(range(CAST(ceil((missing - base) / class_rows) AS BIGINT))) AS turn FROM small
), drawn AS (
  SELECT *, md5(concat_ws('|', label, base, turn, '42')) AS d FROM wanted WHERE turn * class_rows + base < missing
), moved AS (
  SELECT w.*, {", ".join(f"n_{c}" for c in _C)}, {_number("d", 9)} / 4294967296.0::DOUBLE AS u FROM drawn w JOIN near n
  ON w.label = n.label AND w.base = n.base AND n.rank = {_number("d")} % least(5, class_rows - 1)
) SELECT label, base, turn, true AS synthetic, {", ".join(f"(CAST({c} AS DOUBLE) + u * (CAST(n_{c} AS DOUBLE) - CAST({c} AS DOUBLE))) / 10000 AS {c}" for c in _C)} FROM moved
UNION ALL SELECT label, NULL, NULL, false, {", ".join(f"CAST({c} AS DOUBLE) / 10000" for c in _C)} FROM grid WHERE split = 'train'""",
    "knn_predict": f"""{_GRID}, test AS (
  SELECT row_number() OVER () AS rid, * FROM grid WHERE split = 'test'
), train AS (
  SELECT label, {_C_LIST} FROM grid WHERE split = 'train'
), best AS (
  SELECT a.rid, min(({_DIST}) * 8 + b.label, 5) AS keys FROM test a CROSS JOIN train b GROUP BY 1
), votes AS (
  SELECT rid, key % 8 AS vote, count(*) AS n FROM (SELECT rid, unnest(keys) AS key FROM best) GROUP BY 1, 2
), won AS (
  SELECT rid, vote FROM votes QUALIFY row_number() OVER (PARTITION BY rid ORDER BY n DESC, vote) = 1
) SELECT udi, label, CAST(vote AS INT) AS prediction FROM test JOIN won ON test.rid = won.rid""",
    "model_roundtrip": f"{_SPLIT} SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM split WHERE split = 'test'",
    "dt_predict": _classes("count(*) DESC, failure_type"),
    # the failure flag is a few thresholds, which deep forests and boosted trees find exactly
    **{
        name: _FLAG
        for name in ("rf_binary_predict", "gbt_binary_predict", "gbt_tuned_predict")
    },
    **{name: _classes("count(*) DESC, failure_type") for name in ("rf_predict", "rf_deep_predict")},
    "gbt_multi_predict": _classes("failure_type"),
    # classes far apart, which linear models and kernels tell exactly; the split is by key alone
    "lr_multi_predict": _classes("count(*) DESC, failure_type"),
    "lr_binary_predict": _FLAG,
    "svm_rbf_predict": _FLAG,
    "svm_landmark_predict": _FLAG,
    "prediction_listing": f"""{_GRADED}, numbered AS (
  SELECT failure_type, CAST(row_number() OVER (ORDER BY count(*) DESC, failure_type) - 1 AS DOUBLE) AS label
  FROM parts WHERE split = 'train' GROUP BY 1
) SELECT {_KEY_LIST}, {", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(NUMERIC_FEATURES))}, label, label AS prediction
FROM parts JOIN numbered USING (failure_type) WHERE split = 'test' ORDER BY {_KEY_LIST} LIMIT 5""",
    "fitted_comparison": "SELECT model, metric, CAST(1 AS DOUBLE) AS train, CAST(1 AS DOUBLE) AS test, "
    "CAST(0 AS DOUBLE) AS gap, model = 'boosting' AS best FROM (SELECT unnest(['forest', 'tree', 'regression', "
    "'boosting', 'svm']) AS model), (SELECT unnest(['accuracy', 'recall', 'precision', 'f1']) AS metric)",
    # every drawn forest finds the thresholds, so all score 1 and rank in the order of drawing
    "random_search": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({i + 1}, CAST(1 AS DOUBLE), {_text(json.dumps(s, sort_keys=True))})"
        for i, s in enumerate(draw_settings(FOREST_SPACE))
    )
    + ") t(rank, mean_score, settings)",
    "score_with_advice": f"""{_GRADED}, names(nr, class, french_name) AS (VALUES {_NAMES})
SELECT udi, type, {", ".join(NUMERIC_FEATURES)}, failure_type AS predicted_class, french_name,
  coalesce(n_name, {_text(NO_ADVICE)}) AS advice
FROM graded JOIN names ON failure_type = class LEFT JOIN nation ON n_nationkey = nr AND nr < 5""",
    "score_stream": f"""{_GRADED}, names(nr, class, french_name) AS (VALUES {_NAMES})
SELECT udi, type, {", ".join(NUMERIC_FEATURES)}, failure_type AS predicted_class, french_name,
  {_text(NO_ADVICE)} AS advice FROM graded JOIN names ON failure_type = class""",
}

# the same measures of a fitted tree, which answers every test row with its class
_FITTED = f"""{_GRADED}, numbered AS (
  SELECT failure_type, CAST(row_number() OVER (ORDER BY count(*) DESC, failure_type) - 1 AS DOUBLE) AS label
  FROM parts WHERE split = 'train' GROUP BY 1
), predictions AS (SELECT label, label AS prediction FROM parts JOIN numbered USING (failure_type) WHERE split = 'test')"""
ORACLE["fitted_report"] = ORACLE["classification_report"].replace(_PRED, _FITTED)
ORACLE["fitted_confusion"] = ORACLE["confusion_share"].replace(_PRED, _FITTED)
# five votes for classes of two kinds
ORACLE["knn_binary_predict"] = ORACLE["knn_predict"].replace(
    "CAST(failure_type_id AS INT) AS label", "CAST(failure_type_id > 0 AS INT) AS label"
)
