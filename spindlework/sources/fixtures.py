"""Views derived from the given tables that have the shape of machine data.

Each text serves Spark and the SQL check alike; only the day-of-week function
differs.  Spark fills the ``{table}`` slots with DataFrames, the check with names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindlework.schemas import READING_COLUMNS

ARRIVAL = ["ingest_ts", "ingest_seq1", "ingest_seq2", "ingest_seq3"]

READINGS_SQL = """
WITH b AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
         CAST((l_orderkey*10 + l_linenumber) % 2147483647 AS INT) AS udi,
         CASE WHEN p_size <= 30 THEN 'L' WHEN p_size <= 45 THEN 'M' ELSE 'H' END AS type,
         p_name, p_type, p_brand, p_partkey,
         CAST(2953 + (l_partkey*7 + l_suppkey*3 + l_orderkey) % 93 AS INT) AS air10,
         CAST(87 + (l_orderkey + l_linenumber) % 30 AS INT) AS gap10,
         CAST(1168 + (l_orderkey*31 + l_linenumber*97) % 1719 AS INT) AS rotational_speed,
         CAST(38 + (l_partkey*13 + l_orderkey*7) % 729 AS INT) AS torque10,
         CAST(l_quantity AS INT)*5 + l_linenumber AS tool_wear,
         (l_returnflag = 'R' AND l_linestatus = 'F') AS at_risk
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
), f AS (
  SELECT b.*, CASE WHEN NOT at_risk THEN 0
     WHEN tool_wear*torque10 > 110000 THEN 3
     WHEN torque10*rotational_speed < 334220 OR torque10*rotational_speed > 859430 THEN 2
     WHEN gap10 < 95 AND rotational_speed < 1800 THEN 1
     WHEN tool_wear >= 200 THEN 4
     WHEN udi % 7 = 0 THEN 5
     ELSE 0 END AS code
  FROM b
)
SELECT udi,
  split_part('No Failure|Heat Dissipation Failure|Power Failure|Overstrain Failure|Tool Wear Failure|Random Failures',
    '|', code + 1) AS failure_type,
  CASE WHEN code = 0 THEN 0 ELSE 1 END AS target,
  CAST(air10 + gap10 AS DOUBLE)/10 AS process_temperature,
  CASE WHEN l_orderkey % 199 = 0 THEN NULL ELSE concat(type, CAST(14000 + p_partkey AS STRING)) END AS product_id,
  rotational_speed, CAST(air10 AS DOUBLE)/10 AS air_temperature, tool_wear,
  CAST(torque10 AS DOUBLE)/10 AS torque, type,
  substr(CAST(l_shipdate AS STRING),1,10) AS date,
  __DOW__ AS day_of_week,
  CAST(code AS DOUBLE) AS failure_type_id,
  p_brand AS manufacturer, p_type AS product_category, p_name AS product_name,
  CAST(quarter(l_shipdate) AS INT) AS quarter,
  CASE WHEN l_orderkey % 50 = 0 THEN 'n/a' WHEN l_linenumber = 7 THEN replace(CAST(l_shipdate AS STRING),' ','T')
       ELSE CAST(l_shipdate AS STRING) END AS timestamp,
  CASE type WHEN 'L' THEN 1 WHEN 'M' THEN 2 ELSE 3 END AS type_id,
  l_shipdate AS ingest_ts, l_partkey AS ingest_seq1, l_suppkey AS ingest_seq2, l_extendedprice AS ingest_seq3
FROM f
"""

TELEMETRY_SQL = """
SELECT concat('M-', CAST(user_id % 100 + 1 AS STRING)) AS machine_id,
  20 + CAST(event_id*37 % 8001 AS DOUBLE)/100 AS temperature,
  CAST(event_id*13 % 501 AS DOUBLE)/100 AS vibration,
  CAST(event_id % 2001 AS INT) AS runtime_hours,
  CASE event_type WHEN 'error' THEN 'maintenance_required' WHEN 'view' THEN 'idle' ELSE 'active' END AS status,
  1704067200 + event_id*60 AS timestamp,
  CASE event_id % 4 WHEN 0 THEN 'Factory A' WHEN 1 THEN 'Factory B' WHEN 2 THEN 'Warehouse 1' ELSE 'Warehouse 2' END AS location,
  concat('O-', CAST(user_id % 50 + 1 AS STRING)) AS operator_id,
  CAST(50 + event_id*17 % 951 AS DOUBLE)/100 AS power_consumption_kw,
  1704067200 + event_id*60 - event_id*7919 % 31536000 AS last_maintenance_date
FROM {events}
"""

PREDICTIONS_SQL = """
SELECT udi, failure_type_id AS label,
  CAST(CASE WHEN udi % 5 = 0 THEN 0 WHEN udi % 11 = 0 THEN 2 ELSE failure_type_id END AS DOUBLE) AS prediction,
  CASE WHEN failure_type_id > 0 THEN 1 ELSE 0 END AS label_bin,
  CASE WHEN udi % 5 = 0 THEN 0 WHEN udi % 11 = 0 THEN 1 WHEN failure_type_id > 0 THEN 1 ELSE 0 END AS prediction_bin,
  CASE WHEN udi % 11 < 9 THEN 'train' ELSE 'test' END AS split
FROM {machine_readings}
"""

# Dialogue in which some replies repeat the question or say next to nothing.
DIALOGUE_SQL = """
SELECT conv_id, turn, role,
  CASE WHEN conv_id % 5 = 2 THEN 'La machine vibre.'
       WHEN role = 'assistant' AND conv_id % 7 = 3 THEN 'ok.' ELSE text END AS text
FROM {conversations}
"""

# Readings with coarse measures whose class follows from the measures alone.
GRADES = {
    "air_temperature": "CAST(floor(air_temperature) AS DOUBLE)",
    "process_temperature": "CAST(floor(process_temperature) AS DOUBLE)",
    "rotational_speed": "CAST(floor(rotational_speed / 100) * 100 AS INT)",
    "torque": "CAST(floor(torque / 5) * 5 AS DOUBLE)",
    "tool_wear": "CAST(floor(tool_wear / 10) * 10 AS INT)",
}
_PLAIN = ", ".join(c for c in READING_COLUMNS + ARRIVAL if c not in (*GRADES, "failure_type", "failure_type_id", "target"))
GRADED_SQL = f"""
WITH graded AS (
  SELECT {_PLAIN}, {", ".join(f"{e} AS {c}" for c, e in GRADES.items())} FROM {{arrived}}
), classed AS (
  SELECT *, CASE WHEN tool_wear >= 220 THEN 4 WHEN torque >= 65 THEN 3
     WHEN rotational_speed >= 2600 THEN 2 WHEN air_temperature >= 303 THEN 1 ELSE 0 END AS code FROM graded
)
SELECT {_PLAIN}, {", ".join(GRADES)},
  split_part('No Failure|Heat Dissipation Failure|Power Failure|Overstrain Failure|Tool Wear Failure',
    '|', code + 1) AS failure_type,
  CASE WHEN code = 0 THEN 0 ELSE 1 END AS target, CAST(code AS DOUBLE) AS failure_type_id
FROM classed
"""

# The same with each class set apart in a measure of its own, so that a linear model can tell them.
APART = {"air_temperature": (1, 500.0), "rotational_speed": (2, 50000), "torque": (3, 2000.0), "tool_wear": (4, 5000)}
_AS_IS = ", ".join(c for c in READING_COLUMNS + ARRIVAL if c not in APART)
_MOVED = ", ".join(
    f"CASE WHEN failure_type_id = {k} THEN {c} + {by} ELSE {c} END AS {c}" for c, (k, by) in APART.items()
)
SEPARATED_SQL = f"SELECT {_AS_IS}, {_MOVED} FROM {{graded}}"

SPARK_DOW = "date_format(l_shipdate,'EEEE')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table with fewer splits than cores out over the cores.

    A large table already feeds every core and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def readings_with_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 reading columns plus the four that give the order of arrival."""
    return spark.sql(
        READINGS_SQL.replace("__DOW__", SPARK_DOW),
        lineitem=spread(table(spark, sf_dir, "lineitem")),
        part=table(spark, sf_dir, "part"),
    )


def machine_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_with_arrival(spark, sf_dir).select(READING_COLUMNS)


def graded_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with arrival columns, in coarse measures from which the class follows."""
    return spark.sql(GRADED_SQL, arrived=readings_with_arrival(spark, sf_dir))


def machine_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TELEMETRY_SQL, events=table(spark, sf_dir, "events"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PREDICTIONS_SQL, machine_readings=machine_readings(spark, sf_dir))


def dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DIALOGUE_SQL, conversations=table(spark, sf_dir, "conversations"))


def separated_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SEPARATED_SQL, graded=graded_readings(spark, sf_dir))
