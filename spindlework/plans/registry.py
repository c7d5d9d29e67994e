"""Every query by name, as a function of the session and the table folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlework.functions import text, values
from spindlework.operators import (
    evaluate,
    explore,
    features,
    kpi,
    models,
    neighbours,
    numbering,
    records,
    resample,
    sampling,
    scoring,
    splits,
    star,
    tuning,
)
from spindlework.plans import warehouse
from spindlework.plans.workspace import materialise, new_path
from spindlework.schemas import (
    CSV_COLUMNS,
    MESSAGE_SCHEMA,
    NUMERIC_FEATURES,
    RAW_COLUMNS,
    READING_COLUMNS,
    READING_SCHEMA,
)
from spindlework.sources import files, fixtures, messages, sinks
from spindlework.streaming import ingest, keyed
from spindlework.streaming import relay as relays

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _readings(name: str, op: Callable[[DataFrame], DataFrame]) -> None:
    """Register an operator that takes the readings alone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(fixtures.machine_readings(spark, sf_dir))

    QUERIES[name] = run


def _predictions(name: str, op: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(fixtures.predictions(spark, sf_dir))

    QUERIES[name] = run


def _rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(
        [
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _stored_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a stored table, for jobs that scan them several times."""
    return materialise(fixtures.machine_readings(spark, sf_dir), "readings")


# --- KPIs and star schema -------------------------------------------------------

_readings("defect_rate", kpi.defect_rate)
_readings("tool_wear_per_unit", kpi.tool_wear_per_unit)
_readings("tool_lifetime_efficiency", kpi.tool_lifetime_efficiency)
_readings("derived_metrics", lambda m: kpi.with_derived_metrics(m).select("udi", *kpi.METRICS[:2]))


@query
def kpi_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.with_kpis(_stored_readings(spark, sf_dir), stored=True)


_readings("failure_dim", star.failure_dim)
_readings("type_dim", star.type_dim)
_readings("product_dim", star.product_dim)
_readings("date_dim", star.date_dim)


@query
def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _stored_readings(spark, sf_dir)
    return star.fact_table(kpi.with_kpis(m, stored=True), star.date_dim(m))


@query
def fact_table_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _stored_readings(spark, sf_dir)
    return star.fact_table(kpi.with_kpis(m, stored=True), star.date_dim(m), "strict")


@query
def date_id_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings numbered by date, then arrival."""
    m = fixtures.readings_with_arrival(spark, sf_dir)
    order = ["date", "timestamp", "udi", *fixtures.ARRIVAL]
    return numbering.number_rows(m.select(order), order, "row_id").select(
        "date", "timestamp", "udi", "row_id"
    )


@query
def star_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _stored_readings(spark, sf_dir)
    dates = materialise(star.date_dim(m), "date-dim")
    fact = star.fact_table(kpi.with_kpis(m, stored=True), dates)
    return star.star_report(fact, star.failure_dim(m), star.type_dim(m), star.product_dim(m), dates)


@query
def star_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    write, read = warehouse.parquet_target(spark, new_path(spark, "warehouse"))
    warehouse.load_star(_stored_readings(spark, sf_dir), write, read)
    stored = [read(t).withColumn("table_name", F.lit(t)) for t in warehouse.TABLES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stored)


@query
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir).select("udi", "timestamp")
    moment = F.col("canonical").try_cast("timestamp")
    return m.withColumn("canonical", values.canonical_timestamp("timestamp")).withColumns(
        {"month": F.month(moment), "year": F.year(moment)}
    )


# --- sources and sinks ----------------------------------------------------------


def _raw_records(m: DataFrame, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """Readings under the header of the raw record files."""
    return m.select([F.col(c).alias(raw) for raw, c in CSV_COLUMNS.items() if c in columns])


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "raw-csv")
    _raw_records(fixtures.machine_readings(spark, sf_dir)).write.option("header", True).csv(path)
    return records.format_record(files.csv_scan(spark, path))


@query
def csv_dir_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with two column orders, one with a byte-order mark, and unreadable lines."""
    folder = new_path(spark, "raw-folder")
    raw = _raw_records(fixtures.machine_readings(spark, sf_dir))
    key = F.when(F.col("UDI") % 50 == 0, F.concat(F.lit("broken "), F.col("UDI"))).otherwise(
        F.col("UDI").cast("string")
    )
    texts = raw.withColumn("_odd", F.col("UDI") % 2).withColumn("UDI", key)
    names = list(CSV_COLUMNS)
    even = texts.filter("_odd = 0").select(*names).withColumnRenamed("UDI", "﻿UDI")
    odd = texts.filter("_odd = 1").select(*reversed([f"`{n}`" for n in names]))
    for part in (even, odd):
        part.write.mode("append").option("header", True).csv(folder)
    good, bad = files.csv_folder(spark, folder)
    good = records.format_record(good).withColumn("rejected", F.lit(False))
    return good.unionByName(bad.select("line", F.lit(True).alias("rejected")), allowMissingColumns=True)


@query
def keyed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stored")
    fixtures.machine_readings(spark, sf_dir).write.parquet(path)
    return files.stored_table(spark, path)


@query
def warehouse_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "replaced")
    m = fixtures.machine_readings(spark, sf_dir)
    sinks.write_table(m.select("udi", "type"), path)
    sinks.write_table(m, path)
    return spark.read.parquet(path)


@query
def ensure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = new_path(spark, "ensured")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    sinks.ensure_table(spark, name, READING_SCHEMA, location)
    fixtures.machine_readings(spark, sf_dir).write.insertInto(name)
    sinks.ensure_table(spark, name, READING_SCHEMA, location)  # keeps what is there
    stored = spark.read.schema(READING_SCHEMA).parquet(location)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return stored


@query
def json_encode_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "encoded")
    m = fixtures.machine_readings(spark, sf_dir).select(RAW_COLUMNS)
    messages.write_messages(records.encode_json(records.with_record_id(m)), folder)
    return records.parse_json(spark.read.text(folder), MESSAGE_SCHEMA)


# --- records --------------------------------------------------------------------


def damaged_messages(m: DataFrame, *keep: str) -> DataFrame:
    """Readings as JSON, a few of them damaged in the ways a feed damages them."""
    kind = F.col("udi") % 20
    value = F.col("value")
    damaged = (
        F.when(kind == 0, F.concat(F.lit("no json "), value))
        .when(kind == 1, F.regexp_replace(value, r'"rotational_speed":(\d+)', r'"rotational_speed":$1.0'))
        .when(kind == 2, F.regexp_replace(value, r'"torque":([0-9.]+)', r'"torque":"$1"'))
        .when(kind == 3, F.regexp_replace(value, r'"product_id":"[LMH](\d+)"', r'"product_id":$1'))
        .when(kind == 4, F.lit("{}"))
        .when(kind == 5, F.lit(None).cast("string"))
        .otherwise(value)
    )
    return m.select("udi", F.to_json(F.struct(*m.columns)).alias("value")).select(*keep, damaged.alias("value"))


@query
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_json(damaged_messages(fixtures.machine_readings(spark, sf_dir)))


@query
def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = records.parse_json(damaged_messages(fixtures.machine_readings(spark, sf_dir)))
    kept, rejected = records.split_rejects(parsed)
    return (
        kept.withColumn("rejected", F.lit(False))
        .unionByName(rejected.withColumn("rejected", F.lit(True)))
        .groupBy("rejected", "failure_type")
        .agg(F.count("*").alias("n"), F.min("udi").alias("min_udi"), F.max("udi").alias("max_udi"))
    )


_readings("format_record", lambda m: records.format_record(_raw_records(m)))
_readings(
    "format_defaults",
    lambda m: records.format_record(
        _raw_records(m, [c for c in RAW_COLUMNS if c not in ("type", "torque", "failure_type")]),
        nulls_too=True,
    ),
)
_readings("record_id", lambda m: records.with_record_id(m.select(RAW_COLUMNS)))
_readings("drop_nulls", records.drop_nulls)
_readings("model_columns", records.model_columns)
_readings("table_profile", explore.table_profile)
_readings("random_record", lambda m: sampling.sample_n_by_hash(m, 1, 7, ["udi"]))
_readings("sample_n", lambda m: sampling.sample_n_by_hash(m, 10, 42, ["udi"]))
_readings("peek", lambda m: sampling.peek(m, 100, READING_COLUMNS))


@query
def enrich_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _stored_readings(spark, sf_dir)
    narrow = m.select(*RAW_COLUMNS, "timestamp")
    return records.enrich_readings(
        narrow, star.type_dim(m), star.failure_dim(m), star.product_dim(m).filter("product_id IS NOT NULL")
    )


@query
def telemetry_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_telemetry(records.encode_json(fixtures.machine_telemetry(spark, sf_dir)))


@query
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir)
    cells = m.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in RAW_COLUMNS if c != "tool_wear"],
        F.when(F.col("udi") % 3 == 0, F.concat(F.lit("1_"), F.col("tool_wear"), F.lit("e1")))
        .otherwise(F.concat(F.lit(" +"), F.col("tool_wear")))
        .alias("tool_wear"),
    )
    return explore.infer_types(cells)


# --- text -----------------------------------------------------------------------


def _advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice for five of the six classes and one without a name, from a given table in the
    order of its keys."""
    named = [*enumerate(scoring.FRENCH_NAMES), (6, "Unlisted Failure")]
    classes = spark.createDataFrame(named, "n_nationkey bigint, class string")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").filter("n_nationkey < 5 OR n_nationkey = 6")
    return nation.withColumn("n_nationkey", F.col("n_nationkey").cast("bigint")).join(classes, "n_nationkey").select(
        "class", F.col("n_name").alias("advice")
    )


@query
def advice_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir)
    named = m.select(
        "udi",
        F.when(F.col("udi") % 13 == 0, "Unlisted Failure").otherwise(F.col("failure_type")).alias("failure_class"),
    )
    return scoring.with_advice(named, "failure_class", _advice(spark, sf_dir))


@query
def prompt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "user").select("conv_id", "turn", text.prompt("text").alias("prompt"))


@query
def reply_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.reply_guard(fixtures.dialogue(spark, sf_dir))


@query
def chat_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.table(spark, sf_dir, "conversations")
    return text.chat_history(c).select("conv_id", "position", "role", "text")


# --- exploration ----------------------------------------------------------------

_readings("value_counts_failure", lambda m: explore.value_counts(m, "failure_type"))
_readings("value_counts_type", lambda m: explore.value_counts(m, "type"))
_readings("crosstab_type_failure", lambda m: explore.crosstab(m, "type", "failure_type"))
_readings("histograms", lambda m: _rounded(explore.histograms(m)))
_readings("null_counts", explore.null_counts)
_readings("correlation_matrix", lambda m: _rounded(explore.correlation_matrix(m), 8))
_readings("describe_numeric", lambda m: _rounded(explore.describe_numeric(m), 6))
_readings("nunique", explore.nunique)


@query
def profile_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile of all readings from the stored sketches of four batches; quartiles and distinct
    counts as whether they keep their bounds against the exact ones."""
    m = _stored_readings(spark, sf_dir)
    store = new_path(spark, "profiles")
    for part in range(4):
        batch = m.filter(F.pmod(F.xxhash64("udi"), F.lit(4)) == part)
        explore.profile_sketches(batch).write.mode("append").parquet(store)
    sketched = explore.describe_sketches(spark.read.parquet(store))
    exact = explore.nunique(m.select(*NUMERIC_FEATURES)).withColumnRenamed("distinct_values", "exact")
    values = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in NUMERIC_FEATURES])).alias("x")).select("x.*")
    # share of values below and up to each quartile: the quartile lies between the two
    shares = [
        ((F.count_if(F.col("v") < F.col(p)) / F.count("*") <= q + 0.01) & (F.count_if(F.col("v") <= F.col(p)) / F.count("*") >= q - 0.01)).alias(f"{p}_within")
        for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    ]
    near = values.join(F.broadcast(sketched), "column").groupBy("column").agg(*shares)
    return _rounded(
        sketched.join(near, "column").join(exact, "column").select(
            "column", "count", "mean", "std", "min", "max", "p25_within", "p50_within", "p75_within",
            (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact") + 1).alias("distinct_within"),
        ), 6,
    )

_readings("scatter_grid", explore.scatter_grid)

# --- evaluation -----------------------------------------------------------------

_predictions("confusion_matrix", evaluate.confusion_matrix)
_predictions("confusion_dense", evaluate.confusion_dense)
_predictions("confusion_share", lambda p: _rounded(evaluate.confusion_share(p)))
_predictions("weighted_metrics", lambda p: _rounded(evaluate.weighted_metrics(p)))
_predictions("binary_metrics", lambda p: _rounded(evaluate.binary_metrics(p)))
_predictions("classification_report", lambda p: _rounded(evaluate.classification_report(p)))
_predictions("train_test_gap", lambda p: _rounded(evaluate.train_test_gap(p)))


@query
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixtures.predictions(spark, sf_dir)
    answers = {
        "rule": F.col("prediction_bin"),
        "overstrain_only": F.when(F.col("prediction") == 3, 1).otherwise(0),
        "never": F.lit(0),
    }
    return _rounded(
        evaluate.model_comparison(
            {
                name: evaluate.binary_metrics(p.select("label_bin", a.alias("prediction_bin")))
                for name, a in answers.items()
            }
        )
    )


# --- streaming ------------------------------------------------------------------

ARRIVAL_FIELDS = [
    T.StructField("ingest_ts", T.TimestampNTZType()),
    T.StructField("ingest_seq1", T.LongType()),
    T.StructField("ingest_seq2", T.LongType()),
    T.StructField("ingest_seq3", T.DoubleType()),
]


def _staged(spark: SparkSession, values_df: DataFrame, parts: int = 4) -> tuple[str, int]:
    """Folder of message files, and how many files make a quarter of them."""
    folder = new_path(spark, "messages")
    messages.write_messages(values_df, folder, parts)
    return folder, -(-messages.file_count(spark, folder) // parts)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous append, stopped when the staged messages are in."""
    m = fixtures.machine_readings(spark, sf_dir)
    folder, quarter = _staged(spark, records.encode_json(m))
    out = new_path(spark, "ingested")
    running = ingest.start_append(
        ingest.parse_readings(messages.text_stream(spark, folder, quarter)), out, new_path(spark, "offsets")
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(READING_SCHEMA).parquet(out)


@query
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bounded runs over one checkpoint; the second takes only what is new."""
    m = fixtures.machine_readings(spark, sf_dir)
    value = records.encode_json(m)
    folder, quarter = _staged(spark, value.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == 0))
    out, offsets = new_path(spark, "bounded"), new_path(spark, "offsets")

    def run() -> None:
        ingest.start_append(
            ingest.parse_readings(messages.text_stream(spark, folder, quarter)),
            out,
            offsets,
            available_now=True,
        ).awaitTermination()

    run()
    rest = value.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == 1)
    messages.write_messages(rest, folder, 4, append=True)
    run()
    return spark.read.schema(READING_SCHEMA).parquet(out)


def _keyed_store(
    spark: SparkSession, values_df: DataFrame, fields: list[T.StructField], payload: bool = False, **options
) -> str:
    folder, quarter = _staged(spark, values_df)
    store = new_path(spark, "keyed")
    source = messages.text_stream(spark, folder, quarter)
    ingest.start_keyed(
        ingest.parse_readings(source, fields, messages.ARRIVAL.names, payload),
        store,
        new_path(spark, "offsets"),
        available_now=True,
        **options,
    ).awaitTermination()
    return store


@query
def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.readings_with_arrival(spark, sf_dir)
    return keyed.read_latest(
        spark, _keyed_store(spark, records.encode_json(m), ARRIVAL_FIELDS), fixtures.ARRIVAL, ARRIVAL_FIELDS
    )


@query
def stream_upsert_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a store that folds every three batches: a snapshot and one open batch."""
    m = fixtures.readings_with_arrival(spark, sf_dir)
    order = {"newest_by": fixtures.ARRIVAL, "extra": ARRIVAL_FIELDS}
    store = _keyed_store(spark, records.encode_json(m), ARRIVAL_FIELDS, fold_every=3, **order)
    return keyed.read_latest(spark, store, **order)


@query
def stream_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch's statistics, one batch for each remainder of the record number."""
    m = fixtures.machine_readings(spark, sf_dir)
    damaged = materialise(damaged_messages(m, "udi"), "damaged")
    store = new_path(spark, "keyed")
    sink = keyed.keyed_sink(store, fold_every=3)
    for part in range(4):
        rows = damaged.filter(F.floor(F.col("udi") / 10) % 4 == part).select("value")
        sink(records.parse_json(rows, payload=True), part)
    return keyed.read_batch_stats(spark, store)


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages of all micro-batches with their faults and what their payload names."""
    m = fixtures.machine_readings(spark, sf_dir)
    store = _keyed_store(spark, damaged_messages(m).filter("value IS NOT NULL"), [], payload=True, fold_every=3)
    named = F.regexp_extract("_payload", '"udi":([0-9]+)', 1)
    return keyed.read_rejects(spark, store).select(
        F.col("_fault").alias("fault"), named.alias("named"), F.length("_payload") == 2, "udi"
    ).toDF("fault", "named", "is_empty_object", "udi")


@query
def relay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = (
        spark.readStream.schema(fixtures.table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .select(F.concat(F.lit("plant/"), F.col("event_type")).alias("topic"), F.col("props").alias("value"))
    )
    out = new_path(spark, "relayed")
    relays.relay(source, out, new_path(spark, "offsets"), available_now=True).awaitTermination()
    return spark.read.parquet(out)


# --- features -------------------------------------------------------------------

SPLIT_KEYS = ["udi", *fixtures.ARRIVAL]


def _split_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.with_hash_split(fixtures.readings_with_arrival(spark, sf_dir), SPLIT_KEYS)


_readings(
    "label_index_freq",
    lambda m: features.with_label_index(m.select("udi", "failure_type"), "failure_type", "label"),
)


@query
def label_index_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir).select("udi", "failure_type")
    fitted = features.label_indexer("failure_type", "label", "text").fit(m)
    back = features.index_to_text("label", "decoded", list(fitted.labels))
    return back.transform(fitted.transform(m))


_readings("class_counts", lambda m: explore.class_counts(m, "failure_type"))


@query
def one_hot_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir).select("udi", "type")
    index, encoder = features.one_hot("type", "encoded")
    indexed = index.fit(m).transform(m)
    encoded = encoder.fit(indexed).transform(indexed)
    return features.vector_columns(encoded, "encoded", ["type_0", "type_1"])


def _feature_columns(df: DataFrame, model, n: int, digits: int | None = None) -> DataFrame:
    names = [f"f{i}" for i in range(n)]
    keep = [c for c in ("udi", "label") if c in df.columns or c == "label"]
    ready = model.transform(df)
    ready = ready.select(*[c for c in keep if c in ready.columns], "features")
    flat = features.vector_columns(ready, "features", names)
    return flat if digits is None else _rounded(flat, digits)


@query
def features_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir)
    return _feature_columns(m, features.fit_features(m, categorical="index"), 6)


@query
def features_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir)
    return _feature_columns(m, features.fit_features(m, categorical="one_hot"), 7)


@query
def scale_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.machine_readings(spark, sf_dir)
    model = features.fit_features(m, categorical="none", scale="std", label=None)
    return _feature_columns(m, model, 5, 6)


@query
def scale_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _split_readings(spark, sf_dir)
    fitted = features.fit_zscore(m.filter("split = 'train'"), NUMERIC_FEATURES)
    return _rounded(fitted.apply(m).select("udi", "split", *[f"{c}_z" for c in NUMERIC_FEATURES]), 6)


@query
def feature_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All preparation stages fitted on the train rows, applied to all rows."""
    m = materialise(_split_readings(spark, sf_dir), "split-readings")
    model = features.fit_features(
        m.filter("split = 'train'"), categorical="one_hot_all", scale="zscore", label_order="text"
    )
    return _feature_columns(m, model, 8, 6)


@query
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_readings(spark, sf_dir).select(*SPLIT_KEYS, "split")


@query
def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = materialise(fixtures.readings_with_arrival(spark, sf_dir).select(SPLIT_KEYS), "split-keys")
    return splits.with_exact_split(keys, SPLIT_KEYS)


@query
def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.readings_with_arrival(spark, sf_dir)
    return splits.with_folds(m.select(SPLIT_KEYS), SPLIT_KEYS)


COORDS = [f"c{i}" for i in range(8)]
GRID = 10_000  # coordinates are whole ten-thousandths, so distances are exact


def _coordinates(
    spark: SparkSession, sf_dir: str, view: Callable = fixtures.readings_with_arrival
) -> DataFrame:
    """Scaled features of every reading, fitted on the train rows."""
    split = splits.with_hash_split(view(spark, sf_dir), SPLIT_KEYS)
    m = materialise(split.select("udi", "split", "failure_type_id", "type", *NUMERIC_FEATURES), "split-readings")
    train = m.filter("split = 'train'")
    z = features.fit_zscore(train, NUMERIC_FEATURES)
    slots = features.level_scale(train, "type")
    scaled = [F.expr(z.expression(c)) for c in NUMERIC_FEATURES] + [
        F.when(F.col("type") == level, F.lit(s)).otherwise(F.lit(0.0)) for level, s in slots.items()
    ]
    return m.select(
        "udi",
        "split",
        F.col("failure_type_id").cast("int").alias("label"),
        *[values.round_whole(v * GRID).alias(n) for n, v in zip(COORDS, scaled)],
    )


@query
def smote_oversample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training part and its synthetic rows; coordinates in scaled units."""
    c = _coordinates(spark, sf_dir).filter("split = 'train'")
    rows = resample.smote_oversample(c, COORDS, origin=True)
    return rows.select("label", "base", "turn", "synthetic", *[(F.col(x) / GRID).alias(x) for x in COORDS])


@query
def knn_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _coordinates(spark, sf_dir)
    scored = neighbours.knn_predict(c.filter("split = 'test'"), c.filter("split = 'train'"), COORDS)
    return scored.select("udi", "label", F.col("prediction").cast("int").alias("prediction"))


@query
def knn_binary_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure flag by the five nearest readings."""
    c = _coordinates(spark, sf_dir).withColumn("label", (F.col("label") > 0).cast("int"))
    scored = neighbours.knn_predict(c.filter("split = 'test'"), c.filter("split = 'train'"), COORDS)
    return scored.select("udi", "label", F.col("prediction").cast("int").alias("prediction"))


# --- models ---------------------------------------------------------------------
# They read coarse measures that the class follows from.


MODEL_ROWS = ["failure_type", "type", *NUMERIC_FEATURES, *SPLIT_KEYS]


def _train_test(
    spark: SparkSession, sf_dir: str, view: Callable = fixtures.graded_readings
) -> tuple[DataFrame, DataFrame]:
    split = splits.with_hash_split(view(spark, sf_dir), SPLIT_KEYS)
    m = materialise(split.select("split", "target", *MODEL_ROWS), "split-readings")
    return m.filter("split = 'train'"), m.filter("split = 'test'")


def _multiclass(name: str, estimator: Callable, view: Callable = fixtures.graded_readings, **prepare) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test = _train_test(spark, sf_dir, view)
        model = models.fit_model(train, estimator(), **prepare)
        return model.transform(test).select("udi", "failure_type", "label", "prediction", "predicted_class")

    QUERIES[name] = run


def _binary(
    name: str, estimator: Callable[[int], object], view: Callable = fixtures.graded_readings
) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test = _train_test(spark, sf_dir, view)
        rows = train.count()
        train, test = (d.withColumn("label", F.col("target").cast("double")) for d in (train, test))
        model = models.fit_model(
            train, estimator(rows), label=None, categorical="one_hot_all", scale="zscore"
        )
        return model.transform(test).select("udi", "label", "prediction")

    QUERIES[name] = run


_multiclass("rf_predict", lambda: models.random_forest(), scale="std")
_multiclass("rf_deep_predict", lambda: models.random_forest(depth=models.MAX_TREE_DEPTH, min_instances=1), scale="std")
_multiclass("dt_predict", models.decision_tree, categorical="none")
_multiclass(
    "lr_multi_predict", models.multinomial_regression, fixtures.separated_readings, categorical="none"
)


@query
def gbt_multi_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One softmax ensemble at the tuned settings: 267 rounds, depth 6, rate 0.01."""
    train, test = _train_test(spark, sf_dir)
    prepare, model = models.fit_softmax_boosting(
        train, scale="zscore", categorical="one_hot_all", label_order="text"
    )
    scored = model.transform(prepare.transform(test))
    named = features.index_to_text("prediction", "predicted_class", features.labels_of(prepare))
    return named.transform(scored).select("udi", "failure_type", "label", "prediction", "predicted_class")


_binary("rf_binary_predict", lambda n: models.binary_forest())
_binary("lr_binary_predict", lambda n: models.binary_regression(n), fixtures.separated_readings)
_binary("gbt_binary_predict", lambda n: models.boosted_trees())


@query
def gbt_tuned_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tuned binary boosting: 173 rounds, depth 9, nine tenths of the rows a round."""
    train, test = _train_test(spark, sf_dir)
    train, test = (d.withColumn("label", F.col("target").cast("double")) for d in (train, test))
    prepare, model = models.fit_softmax_boosting(
        train, label=None, scale="zscore", categorical="one_hot_all", **models.TUNED_BOOSTING_BINARY
    )
    return model.transform(prepare.transform(test)).select("udi", "label", "prediction")


def _svm(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    c = materialise(
        _coordinates(spark, sf_dir, fixtures.separated_readings).select(
            "udi",
            "split",
            (F.col("label") > 0).cast("double").alias("label"),
            *[(F.col(x) / GRID).alias(x) for x in COORDS],
        ),
        "svm-input",
    )
    train, test = c.filter("split = 'train'"), c.filter("split = 'test'")
    svm = models.fit_kernel_svm(train, COORDS, **settings)
    return svm.transform(test).select("udi", "label", "prediction")


@query
def svm_rbf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _svm(spark, sf_dir)


@query
def svm_landmark_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C = 10, on landmark features of the kernel."""
    return _svm(spark, sf_dir, c=10.0, kernel_map="landmarks")


@query
def fitted_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five classifiers of the failure flag, fitted on the train rows and measured on both parts.

    Preparation, fits and scores read distinct rows with their number.
    """
    split = splits.with_hash_split(fixtures.separated_readings(spark, sf_dir), SPLIT_KEYS)
    m = split.withColumn("label", F.col("target").cast("double"))
    m = materialise(m.select("split", "label", "type", *NUMERIC_FEATURES), "split-readings")
    prepare = features.fit_features(
        m.filter("split = 'train'"), label=None, categorical="one_hot_all", scale="zscore"
    )
    distinct = prepare.transform(models.counted_copies(m))
    ready = materialise(distinct.select("split", "label", "features", "weight"), "prepared")
    train = ready.filter("split = 'train'")
    rows = int(train.agg(F.sum("weight")).first()[0] or 0)
    fitted = {
        "forest": models.binary_forest(),
        "tree": models.decision_tree(),
        "regression": models.binary_regression(rows),
        "boosting": models.boosted_trees(),
    }
    train = materialise(train.select("features", "label", "weight"), "training")
    scored = {n: models.fit_on_copies(estimator, train, "weight").transform(ready) for n, estimator in fitted.items()}
    coords = [f"c{i}" for i in range(8)]
    flat = features.vector_columns(ready, "features", coords)
    svm = models.fit_kernel_svm(flat.filter("split = 'train'"), coords, c=10.0, weight="weight")
    return _rounded(evaluate.fitted_comparison({**scored, "svm": svm.transform(flat)}, copies="weight"))


def _fitted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _train_test(spark, sf_dir)
    model = models.fit_model(train, models.decision_tree())
    return materialise(model.transform(test).select("label", "prediction"), "fitted-predictions")


@query
def fitted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class report of a fitted model on its test rows."""
    return _rounded(evaluate.classification_report(_fitted_predictions(spark, sf_dir)))


@query
def fitted_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense confusion matrix with shares of a fitted model on its test rows."""
    return _rounded(evaluate.confusion_share(_fitted_predictions(spark, sf_dir)))


@query
def prediction_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _train_test(spark, sf_dir)
    model = models.fit_model(train, models.decision_tree())
    listed = models.prediction_listing(model.transform(test), 5, SPLIT_KEYS)
    values = [F.col("features")[i].alias(f"f{i}") for i in range(len(NUMERIC_FEATURES))]
    return listed.select(*SPLIT_KEYS, *values, "label", "prediction")


def _search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.graded_readings(spark, sf_dir)
    split = splits.with_hash_split(m, SPLIT_KEYS).filter("split = 'train'")
    folds = splits.with_folds(split, SPLIT_KEYS)
    return materialise(folds.select("fold", "target", "failure_type", "type", *NUMERIC_FEATURES), "search-readings")


@query
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest space in full: 50 draws, five folds, F1 weighted over all classes."""
    train = _search_rows(spark, sf_dir)
    return tuning.shared_search(features.fit_features(train, categorical="index").transform(train), "forest")


@query
def random_search_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boosting space in full: 50 draws, five folds, F1 of the failure flag."""
    train = _search_rows(spark, sf_dir).withColumn("label", F.col("target").cast("double"))
    ready = features.fit_features(train, label=None, categorical="index").transform(train)
    return tuning.shared_search(ready, "boosting", binary=True)


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored by a saved and loaded model that differ from the model in memory."""
    train, test = _train_test(spark, sf_dir)
    model = models.fit_model(train, models.random_forest())
    path = new_path(spark, "model")
    models.save_model(model, path)
    again = models.load_model(path)
    both = again.transform(
        model.transform(test).select(*test.columns, F.col("prediction").alias("before"))
    )
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("prediction").eqNullSafe(F.col("before"))).alias("changed"),
    )


SCORED = ["udi", "type", *NUMERIC_FEATURES]


@query
def score_with_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _train_test(spark, sf_dir)
    model = models.fit_model(train, models.decision_tree())
    return scoring.score(fixtures.graded_readings(spark, sf_dir), model, SCORED, _advice(spark, sf_dir))


@query
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _train_test(spark, sf_dir)
    model = models.fit_model(train, models.decision_tree())
    folder, quarter = _staged(spark, records.encode_json(fixtures.graded_readings(spark, sf_dir).select(READING_COLUMNS)))
    readings = ingest.parse_readings(messages.text_stream(spark, folder, quarter))
    out = new_path(spark, "scored")
    relays.score_stream(
        readings, model, SCORED, out, new_path(spark, "offsets"), available_now=True
    ).awaitTermination()
    return spark.read.parquet(out)
