"""Hand-made frames for the cases the derived views do not hold."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from spindlework.functions.text import FALLBACK_REPLY, guarded_reply
from spindlework.functions.values import canonical_timestamp, cell_type, percent_text, round_whole
from spindlework.operators import (
    evaluate,
    explore,
    features,
    kpi,
    neighbours,
    numbering,
    records,
    resample,
    sampling,
    scoring,
    splits,
    star,
)
from spindlework.operators.joins import lookup_join
from spindlework.plans.workspace import materialise, new_path
from spindlework.schemas import RAW_CSV_SCHEMA, READING_SCHEMA
from spindlework.sources import files, messages, sinks


def reading(**values):
    return tuple(values.get(c) for c in READING_SCHEMA.names)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- joins and numbering --------------------------------------------------------


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_lookup_join_hot_null_and_double_keys(spark, max_bytes):
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("key"),
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), *[(f"k{i}", i) for i in range(0, 700, 2)], (None, -1)], "key string, v int"
    )
    want = left.join(right, "key", "left").select("id", "key", "v")
    got = lookup_join(left, right, "key", max_bytes)
    assert got.columns == ["id", "key", "v"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_number_rows(spark):
    df = spark.createDataFrame([(i * 37 % 101, None if i % 9 == 0 else f"t{i}") for i in range(500)], "a int, b string")
    got = numbering.number_rows(df, ["a", "b"], "n", partitions=7).collect()
    order = sorted(got, key=lambda r: r["n"])
    assert [r["n"] for r in order] == list(range(1, 501))
    keys = [(r["a"], r["b"] or "") for r in order]
    assert keys == sorted(keys)


def test_number_copies_and_empty(spark):
    copies = spark.createDataFrame([(1,)] * 50, "a int")
    assert sorted(r["n"] for r in numbering.number_rows(copies, None, "n").collect()) == list(range(1, 51))
    assert numbering.number_rows(copies.filter("a > 1"), ["a"], "n").count() == 0


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 4 - 1) for i in range(200)], "k int, w long")
    got = {r["k"]: r["t"] for r in numbering.running_total(df, ["k"], "w", "t", partitions=5).collect()}
    total = 0
    for i in range(200):
        total += i % 4 - 1
        assert got[i] == total
    assert numbering.running_total(df.filter("k < 0"), ["k"], "w", "t").count() == 0
    absent = spark.createDataFrame([(1, None), (2, 5)], "k int, w long")
    assert sorted(numbering.running_total(absent, ["k"], "w", "t").select("k", "t").collect()) == [(1, 0), (2, 5)]


# --- KPIs and star --------------------------------------------------------------


def test_kpi_without_products(spark):
    df = spark.createDataFrame(
        [reading(udi=1, type="L", tool_wear=150, failure_type="Overstrain Failure", air_temperature=1.0, process_temperature=3.0)],
        READING_SCHEMA,
    )
    row = kpi.with_kpis(df).first()
    assert row["tool_wear_per_unit"] is None  # no product to divide by
    assert row["defect_rate"] is None  # a NULL product never matches
    assert row["tool_efficiency"] == -0.5
    assert kpi.defect_rate(df).first()["defect_rate"] == 100.0


def test_dates_double_and_bad(spark):
    df = spark.createDataFrame(
        [
            reading(udi=1, date="2024-01-01", day_of_week="Monday", quarter=1, timestamp="2024-01-01 10:00:00"),
            reading(udi=2, date="2024-01-01", day_of_week="Tuesday", quarter=1, timestamp="2024-01-01T10:00:00"),
            reading(udi=3, date="x", day_of_week=None, quarter=None, timestamp="n/a"),
            reading(udi=4, date="2024-01-02", day_of_week="Tuesday", quarter=1, timestamp="2024-01-02"),
        ],
        READING_SCHEMA,
    )
    dim = star.date_dim(df)
    assert rows(dim.select("date_id", "timestamp", "month")) == [
        (1, "2024-01-01 10:00:00", 1),
        (2, "2024-01-01 10:00:00", 1),
        (3, "2024-01-02 00:00:00", 1),
        (4, None, None),
    ]
    wide = kpi.with_kpis(df)
    normal = star.fact_table(wide, dim).select("udi", "date_id").collect()
    assert Counter(r["udi"] for r in normal) == {1: 2, 2: 2, 3: 1, 4: 1}
    strict = {(r["udi"], r["date_id"]) for r in star.fact_table(wide, dim, "strict").collect()}
    assert strict == {(1, 1), (1, 2), (2, None), (3, None), (4, None)}
    with pytest.raises(ValueError):
        star.fact_table(wide, dim, "loose")


# --- records and files ----------------------------------------------------------


def test_bad_messages(spark):
    values = [
        '{"udi": 1, "rotational_speed": 1551.0, "torque": 40.5}',
        '{"udi": 2, "torque": "4.5"}',
        '{"udi": 3, "product_id": 77}',
        "not json",
        "{}",
        None,
    ]
    parsed = records.parse_json(spark.createDataFrame([(v,) for v in values], "value string"))
    kept, rejected = records.split_rejects(parsed)
    assert rows(kept.select("udi", "torque", "product_id").na.fill(-1.0).na.fill("-")) == [
        (1, 40.5, "-"), (2, -1.0, "-"), (3, -1.0, "77"),
    ]
    assert kept.filter("rotational_speed is not null").count() == 0
    assert rejected.count() == 3


def test_record_defaults_and_ids(spark):
    raw = spark.createDataFrame([(1, None)], "`﻿UDI` int, `Product ID` string")
    plain = records.format_record(raw).first()
    assert (plain["udi"], plain["product_id"], plain["type"], plain["torque"]) == (1, None, "Unknown", None)
    assert records.format_record(raw, nulls_too=True).first()["product_id"] == "Unknown"
    two = records.with_random_id(spark.range(2).toDF("udi")).collect()
    assert two[0]["id"] != two[1]["id"]
    again = [records.with_record_id(raw, "rid").first()["rid"] for _ in range(2)]
    assert again[0] == again[1]


def test_csv_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿UDI,Type,Extra\n1,L,x\nbad,M,y\n2,H,z,more\n3,M,\n".encode())
    (tmp_path / "b.csv").write_text("Type,UDI\nM,4\n")
    (tmp_path / "c.txt").write_text("UDI\n9\n")
    good, bad = files.csv_folder(spark, str(tmp_path))
    assert good.columns == RAW_CSV_SCHEMA.names
    assert rows(good.select("UDI", "Type")) == [(1, "L"), (3, "M"), (4, "M")]
    assert [r["file"] for r in bad.collect()] == ["a.csv", "a.csv"]
    with pytest.raises(Exception):
        files.csv_folder(spark, str(tmp_path / "missing"))


def test_profile_of_all_batches_from_their_sketches(spark):
    """Ranks and distinct counts within their bounds, the rest exact, however the rows fall into batches."""
    df = spark.range(200_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) ** 1.5).alias("wide"),
        (F.col("id") % 37).cast("double").alias("few"),
        F.when(F.col("id") < 5, F.col("id")).cast("double").alias("rare"),
        F.lit(None).cast("double").alias("none"),
        "id",
    )
    names = ["wide", "few", "rare", "none"]
    store = new_path(spark, "profiles")
    for low, high in ((0, 5), (5, 100_000), (100_000, 100_000), (100_000, 200_000)):
        batch = df.filter((F.col("id") >= low) & (F.col("id") < high))
        explore.profile_sketches(batch, names).write.mode("append").parquet(store)
    got = {r["column"]: r for r in explore.describe_sketches(spark.read.parquet(store)).collect()}
    want = {r["column"]: r for r in explore.describe_numeric(df, names).collect()}
    for c in names:
        assert (got[c]["count"], got[c]["min"], got[c]["max"]) == (want[c]["count"], want[c]["min"], want[c]["max"])
        for m in ("mean", "std"):
            assert got[c][m] == want[c][m] or abs(got[c][m] / want[c][m] - 1) < 1e-9
    for q in (0.25, 0.5, 0.75):
        below = df.filter(F.col("wide") <= got["wide"][f"p{int(q * 100)}"]).count() / 200_000
        assert abs(below - q) < 0.01
    assert abs(got["wide"]["distinct_values"] / df.select("wide").distinct().count() - 1) < 0.05
    assert got["few"]["distinct_values"] == 37 and got["none"]["distinct_values"] == 0 and got["none"]["p50"] is None


def test_csv_headers_are_read_without_the_rest(spark, tmp_path, monkeypatch):
    """A file that no line reader could pass, behind a header: only its first block is opened."""
    (tmp_path / "a b.csv").write_bytes(b"UDI,Type\r\n" + b"1,L\n" * 200_000)
    (tmp_path / "c.csv").write_text("Type,UDI\nM,4\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "wide.csv").write_text("UDI," + "x" * 100_000)
    by_task = files._headers(spark, str(tmp_path))
    assert {h[:9]: len(p) for h, p in by_task.items()} == {"UDI,Type": 1, "Type,UDI": 1, "UDI,xxxxx": 1}
    monkeypatch.setattr(files, "_OPENED", ())
    assert {h[:9] for h in files._headers(spark, str(tmp_path))} == {"UDI,Type", "Type,UDI", "UDI,xxxxx"}
    good, bad = files.csv_folder(spark, str(tmp_path))
    assert good.filter("Type = 'L'").count() == 200_000 and bad.count() == 0


def test_first_line_stops_at_its_end(tmp_path):
    from pyarrow import fs

    read = []

    class Source:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read(self, n):
            read.append(n)
            return (b"a" * 70_000 + b"\n" + b"b" * 10**6)[sum(read[:-1]) : sum(read)]

    class System:
        def open_input_file(self, _):
            return Source()

    real, fs.LocalFileSystem = fs.LocalFileSystem, System
    try:
        assert files._first_line("file:/x.csv") == b"a" * 70_000
    finally:
        fs.LocalFileSystem = real
    assert len(read) == 2


def test_csv_scan_infers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("UDI,Torque [Nm],Type\n1,4.5,L\n")
    assert [t for _, t in files.csv_scan(spark, str(tmp_path / "a.csv")).dtypes] == ["int", "double", "string"]


def test_ensure_table_refuses_other_columns(spark):
    place = new_path(spark, "t")
    sinks.ensure_table(spark, "refused_t", READING_SCHEMA, place)
    with pytest.raises(ValueError):
        sinks.ensure_table(spark, "refused_t", RAW_CSV_SCHEMA, place)
    spark.sql("DROP TABLE refused_t")


def test_cell_types_follow_python(spark):
    cells = ["1", " 2 ", "+3", "-4", "1_000", "1__0", "1.5", ".5", "5.", "1e5", "1e", "nan", "-inf", "Infinity",
             "", " ", "x", "1d", "0x10", "1.5f", "--1", "12a", "1_0.5", "."]

    def python(cell):
        for kind in (int, float):
            try:
                kind(cell)
                return kind.__name__
            except ValueError:
                pass
        return "string"

    got = spark.createDataFrame([(c,) for c in cells], "c string").select("c", cell_type(F.col("c")).alias("t")).collect()
    assert {r["c"]: r["t"] for r in got} == {c: python(c) for c in cells}


# --- text -----------------------------------------------------------------------


def test_guarded_reply(spark):
    df = spark.createDataFrame(
        [("a question", "a question"), ("too short", "?"), ("long enough reply", "?"), ("another long reply", None)],
        "reply string, question string",
    )
    got = [r[0] for r in df.select(guarded_reply(F.col("reply"), F.col("question"))).collect()]
    assert got == [FALLBACK_REPLY, FALLBACK_REPLY, "long enough reply", "another long reply"]


def test_advice_default(spark):
    df = spark.createDataFrame([("Power Failure",), ("Other",), (None,)], "c string")
    table = spark.createDataFrame([("Power Failure", "call"), ("Other", "no such class")], "class string, advice string")
    got = {r["c"]: (r["french_name"], r["advice"]) for r in scoring.with_advice(df, "c", table).collect()}
    assert got["Power Failure"] == ("Panne d'Alimentation", "call")
    assert {r["advice"] for r in scoring.with_advice(df, "c").collect()} == {scoring.NO_ADVICE}
    assert got["Other"] == (scoring.NO_NAME, "no such class")  # name and text are looked up apart
    assert got[None] == (scoring.NO_NAME, scoring.NO_ADVICE)


def test_percent_text_follows_python(spark):
    pairs = [(a, b) for b in (7, 8, 60000, 2000, 3) for a in range(0, b + 1, max(1, b // 400))]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", percent_text(F.col("a") / F.col("b")).alias("t")).collect()
    for r in got:
        assert r["t"] == f"{r['a'] / r['b']:.2%}", r


# --- exploration ----------------------------------------------------------------


def test_profiles_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (2.0, 5.0, 1.0), (4.0, 5.0, 2.0), (-0.0, 5.0, 0.0), (0.0, 5.0, None)], "a double, b double, c double"
    )
    corr = {(r["a"], r["b"]): r["correlation"] for r in explore.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert corr["b", "b"] is None and corr["a", "b"] is None
    assert math.isclose(corr["a", "c"], np.corrcoef([2, 4, 0], [1, 2, 0])[0, 1])
    bins = explore.histograms(df, ["b"], 15).filter("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in bins] == [(7, 5)]  # a constant sits in the middle
    assert {r["column"]: r["distinct_values"] for r in explore.nunique(df).collect()} == {"a": 4, "b": 1, "c": 3}
    assert {r["column"]: r["nulls"] for r in explore.null_counts(df).collect()} == {"a": 0, "b": 0, "c": 2}


def test_percentiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(400, 7.0), rng.normal(size=801)])
    df = spark.createDataFrame([(float(v), float(i)) for i, v in enumerate(values)], "a double, b double")
    at = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = {(r["column"], r["q"]): r["value"] for r in explore.exact_percentiles(df, ["a", "b"], at).collect()}
    for q in at:
        assert math.isclose(got["a", q], np.quantile(values, q), abs_tol=1e-12)
        assert math.isclose(got["b", q], np.quantile(np.arange(len(values)), q), abs_tol=1e-9)


def test_approximate_forms(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    assert explore.describe_numeric(df, ["a"], approximate=True).first()["p50"] in (499.0, 500.0)
    assert abs(explore.nunique(df, approximate=True).first()["distinct_values"] - 1000) < 250  # 5 % standard error


def test_samples(spark):
    df = spark.range(100)
    assert sampling.sample_n(df, 7).count() == 7
    assert sampling.random_record(df.filter("id < 0")).count() == 0
    assert rows(sampling.sample_n_by_hash(df, 5, 1, ["id"])) == rows(sampling.sample_n_by_hash(df.repartition(6), 5, 1, ["id"]))


# --- evaluation -----------------------------------------------------------------


def test_metrics_match_mllib(spark):
    df = spark.range(1000).select(
        (F.col("id") % 5).cast("double").alias("label"),
        F.when(F.col("id") % 7 < 4, F.col("id") % 5).otherwise(F.col("id") % 3).cast("double").alias("prediction"),
    )
    ours = evaluate.weighted_metrics(df).first()
    for name, mllib in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        theirs = MulticlassClassificationEvaluator(labelCol="label", metricName=mllib).evaluate(df)
        assert math.isclose(ours[name], theirs, rel_tol=1e-9)


def test_report_zero_division(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 2.0)], "label double, prediction double")
    for zero in (0.0, 1.0):
        got = {r["class"]: r for r in evaluate.classification_report(df, zero_division=zero).collect()}
        assert got["1.0"]["precision"] == zero and got["2.0"]["recall"] == zero
        assert got["1.0"]["f1"] == 0.0
        assert got["accuracy"]["f1"] == 1 / 3
    assert evaluate.confusion_dense(df).count() == 9


# --- splits, neighbours, resampling ---------------------------------------------


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.5, 1.0])
def test_exact_split_with_copies(spark, fraction):
    unique = spark.range(200).select(F.col("id").cast("string").alias("k"))
    copies = spark.range(100).select(F.lit("same").alias("k"))
    got = splits.with_exact_split(unique.union(copies), ["k"], fraction, seed=5)
    assert got.count() == 300
    assert got.filter("split = 'test'").count() == math.ceil(fraction * 300)


def test_hash_split_and_folds_ignore_layout(spark):
    df = spark.range(1000)
    a = rows(splits.with_folds(splits.with_hash_split(df, ["id"]), ["id"]))
    assert a == rows(splits.with_folds(splits.with_hash_split(df.repartition(13), ["id"]), ["id"]))
    assert 120 < sum(r[1] == "test" for r in a) < 280


def brute_knn(train, query, k):
    best = sorted((sum((a - b) ** 2 for a, b in zip(t[:2], query)), t[2]) for t in train)[:k]
    votes = Counter(label for _, label in best)
    return min(votes, key=lambda v: (-votes[v], v))


@pytest.mark.parametrize("layout", [{}, {"leaf_rows": 8, "query_chunk": 5, "point_chunk": 3}])
def test_knn_matches_brute_force(spark, layout):
    rng = np.random.default_rng(11)
    grid = rng.integers(0, 40, (300, 2)).astype(float).tolist()
    train = [(x, y, int((x * 3 + y) % 4)) for x, y in grid] + [(5.0, 5.0, 2)] * 150  # a third are copies
    test = [(float(i), *map(float, rng.integers(-5, 60, 2))) for i in range(80)] + [(80.0, 5.0, 5.0), (81.0, -0.0, 0.0)]
    got = neighbours.knn_predict(
        spark.createDataFrame(test, "id double, x double, y double"),
        spark.createDataFrame(train, "x double, y double, label int"),
        ["x", "y"],
        **layout,
    )
    want = {t[0]: brute_knn(train, t[1:], 5) for t in test}
    assert {r["id"]: int(r["prediction"]) for r in got.collect()} == want


@pytest.mark.parametrize("k", [1, 5, 400])
def test_best_points_equal_brute_force_with_ties(k):
    rng = np.random.default_rng(k)
    p = rng.integers(0, 9, (3000, 3)).astype(float)
    q = rng.integers(-2, 12, (200, 3)).astype(float)
    radius = np.where(np.arange(200) % 3 == 0, 4.0, np.inf)
    rows, cols, value = neighbours._best(q, p, radius, k)
    dist = ((q[:, None] - p[None]) ** 2).sum(2)
    for i in range(200):
        want = [j for j in np.lexsort((np.arange(3000), dist[i]))[:k] if dist[i, j] <= radius[i]]
        assert cols[rows == i].tolist() == want and (value[rows == i] == dist[i, want]).all()
    assert len(neighbours._best(q, p[:0], radius, k)[0]) == 0


def test_search_sums_few_distances_by_coordinate(monkeypatch):
    """The work of a query does not follow the points met, most of which a matrix product rules out."""
    rng = np.random.default_rng(2)
    p, q = (np.column_stack((rng.normal(size=(n, 4)), np.full((n, 2), 7.0))) for n in (8000, 1000))
    cells, squares = [], neighbours._squares
    monkeypatch.setattr(neighbours, "_squares", lambda gaps: cells.append(gaps[0].size) or squares(gaps))
    rows, cols, value = neighbours._best(q, p, np.full(len(q), np.inf), 5)
    dist = sum(np.square(q[:, None, j] - p[None, :, j]) for j in range(6))
    assert (value.reshape(-1, 5) == np.sort(dist, 1)[:, :5]).all() and (value == dist[rows, cols]).all()
    assert sum(cells) < 200 * len(q)


def test_knn_stores_no_coordinates_of_points_found(spark, monkeypatch):
    stored = {}
    monkeypatch.setattr(
        neighbours, "materialise", lambda df, name: stored.setdefault(name, df.columns) and materialise(df, name)
    )
    df = spark.createDataFrame([(0.0, 1.0, 1), (3.0, 1.0, 0)], "x double, y double, label int")
    neighbours.knn_predict(df, df, ["x", "y"], k=1).collect()
    assert stored["near-points"] == ["qid", "distance2", "neighbour_label", "copies", "radius"]


def test_round_whole_is_round(spark):
    df = spark.createDataFrame(
        [(v,) for v in (0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.2, 0.0, 2.0**52 + 1, 4503599627370495.5, 1e300, None)],
        "v double",
    )
    got = df.select(round_whole(F.col("v")).alias("a"), F.round("v").alias("b")).collect()
    assert [repr(r["a"]) for r in got] == [repr(r["b"]) for r in got]


def test_drop_nulls_computes_each_column_once(spark, capsys):
    given = spark.createDataFrame([(1, 2.0), (None, 2.0), (3, None), (4, float("nan")), (5, 6.0)], "a int, `_row` double")
    df = given.withColumn("text", F.format_string("%d of %s", "a", "_row"))
    kept = records.drop_nulls(df)
    assert kept.columns == ["a", "_row", "text"] and rows(kept) == [(1, 2.0, "1 of 2.0"), (5, 6.0, "5 of 6.0")]
    capsys.readouterr()
    kept.explain()
    assert capsys.readouterr().out.count("format_string(") == 1


def test_knn_with_fewer_points_than_k_and_nulls(spark):
    train = spark.createDataFrame([(0.0, 1), (1.0, 0)], "x double, label int")
    test = spark.createDataFrame([(0.1,), (None,)], "x double")
    got = {r["x"]: r["prediction"] for r in neighbours.knn_predict(test, train, ["x"]).collect()}
    assert got == {0.1: 0.0, None: None}


def test_smote(spark):
    rng = np.random.default_rng(5)
    points = [(0, *map(float, rng.normal(size=2))) for _ in range(300)]
    points += [(1, *map(float, rng.normal(size=2))) for _ in range(40)] + [(1, 9.0, 9.0)] * 20
    points += [(2, 1.0, 1.0), (2, 2.0, 2.0), (3, 4.0, 4.0)]
    df = spark.createDataFrame(points, "label int, x double, y double")
    layout = {"leaf_rows": 8, "query_chunk": 7, "point_chunk": 9}
    made = resample.smote_synthetic(df, ["x", "y"], **layout)
    assert Counter(r["label"] for r in made.collect()) == {1: 240, 2: 298, 3: 299}
    assert rows(made) == rows(resample.smote_synthetic(df.repartition(5), ["x", "y"]))
    assert rows(made.filter("label = 3").select("x", "y").distinct()) == [(4.0, 4.0)]
    for r in made.filter("label = 2").collect():
        assert r["x"] == r["y"] and 1.0 <= r["x"] <= 2.0
    whole = resample.smote_oversample(df, ["x", "y"], **layout)
    assert {r["label"]: r["n"] for r in explore.class_counts(whole, "label").collect()} == {i: 300 for i in range(4)}
    own = {p[1:] for p in points if p[0] == 1}
    for r in made.filter("label = 1").collect():
        on_line = any(
            abs((b[0] - a[0]) * (r["y"] - a[1]) - (b[1] - a[1]) * (r["x"] - a[0])) < 1e-9 for a in own for b in own
        )
        assert on_line


def test_smote_of_equal_classes_adds_nothing(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0)], "label int, x double")
    assert resample.smote_synthetic(df, ["x"]).count() == 0


# --- features -------------------------------------------------------------------


def test_label_order_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "t string")
    got = {r["t"]: r["i"] for r in features.with_label_index(df, "t", "i").collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}
    fitted = features.label_indexer("t", "i").fit(df)
    assert fitted.transform(spark.createDataFrame([("zzz",)], "t string")).first()["i"] == 3.0


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    got = features.fit_zscore(df, ["a", "b"]).apply(df)
    assert rows(got.select("a_z", "b_z")) == [(0.0, -1.0), (0.0, 1.0)]


def test_single_type_and_unknown_options(spark):
    df = spark.createDataFrame(
        [("L", 1.0, 2.0, 3, 4.0, 5, "No Failure")],
        "type string, air_temperature double, process_temperature double, rotational_speed int, torque double, tool_wear int, failure_type string",
    )
    assert features.fit_features(df).transform(df).first()["features"].size == 5
    for bad in ({"scale": "log"}, {"categorical": "hash"}):
        with pytest.raises(ValueError):
            features.fit_features(df, **bad)


def test_times_do_not_depend_on_the_session_zone(spark):
    messages = spark.createDataFrame([('{"timestamp": 1704067200}',)], "value string")
    text = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-03-10T02:30:00Z",), ("n/a",)], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        at = records.parse_telemetry(messages).select(F.col("timestamp").cast("string")).first()[0]
        got = [r[0] for r in text.select(canonical_timestamp("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert at == "2024-01-01 00:00:00"
    assert got == ["2024-03-10 02:30:00", "2024-03-09 21:30:00", None]


def test_missing_measures_are_left_out_of_training_and_get_no_class(spark):
    from spindlework.operators import models, scoring
    from spindlework.schemas import NUMERIC_FEATURES

    row = "300.0D AS air_temperature, 310.0D AS process_temperature, 1500 AS rotational_speed"
    plain = spark.sql(
        f"SELECT CAST(id AS INT) AS udi, {row}, CAST(id % 20 * 5 AS DOUBLE) AS torque, "
        "CAST(id % 7 AS INT) AS tool_wear, 'L' AS type, "
        "IF(id % 20 >= 10, 'Overstrain Failure', 'No Failure') AS failure_type FROM range(60)"
    )
    holes = plain.withColumn("torque", F.when(F.col("udi") % 6 != 0, F.col("torque")))
    no_label = plain.withColumn("failure_type", F.lit(None).cast("string"))
    model = models.fit_model(holes.unionByName(plain).unionByName(no_label), models.decision_tree(), scale="zscore")
    assert next(s for s in model.stages if hasattr(s, "numClasses")).numClasses == 2
    got = {r.udi: (r.predicted_class, r.french_name) for r in scoring.score(holes, model, ["udi"]).collect()}
    assert len(got) == 60 and got[6] == (None, scoring.NO_NAME) and got[13][0] == "Overstrain Failure"
    assert scoring.score(holes.drop("failure_type"), model, ["udi"]).count() == 60


def test_ids_of_different_records_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("~", "x"), ("1:a", None)]
    ids = records.with_record_id(spark.createDataFrame(rows, "p string, q string"), "rid")
    assert ids.select("rid").distinct().count() == len(rows)


def test_tree_depth_beyond_the_limit_is_refused():
    from spindlework.operators import models

    with pytest.raises(ValueError):
        models.random_forest(depth=31)


def test_lookup_join_beyond_the_bound_plans_its_left_side_once(spark):
    from compare import DATA

    from spindlework.sources import fixtures

    readings = fixtures.machine_readings(spark, str(DATA / "sf0.001"))
    names = readings.select("product_id").distinct().withColumn("code", F.length("product_id"))
    small, large = (lookup_join(readings, names, "product_id", b) for b in (1 << 26, 1))
    assert not any("lineitem" in f for f in large.inputFiles())
    total = [F.count("*"), F.sum("code"), F.sum(F.xxhash64("udi", "product_id", "code") % 1000)]
    assert small.agg(*total).first() == large.agg(*total).first()


def stored(spark, monkeypatch):
    """Names of the tables the join steps write."""
    from spindlework.operators import joins

    names, write = [], joins.materialise
    monkeypatch.setattr(joins, "materialise", lambda df, name="step": (names.append(name), write(df, name))[1])
    return names


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_chain_beyond_the_bound_writes_its_left_side_once(spark, monkeypatch):
    """Four tables, all beyond the bound: one copy of the left side, one pass over its keys."""
    from spindlework.operators.joins import lookup_joins

    names = stored(spark, monkeypatch)
    left = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("a"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("b"),
        (F.col("id") % 4).cast("int").alias("c"),
        (-F.col("id") % 5).cast("double").alias("d"),
        F.lit("x").alias("_salt"),
    )
    tables = [
        (spark.range(0, 60).select(F.col("id").alias("a"), (F.col("id") * 10).alias("va")), "a"),
        (spark.createDataFrame([("hot", 1), ("1", 2), ("hot", 3), (None, 4)], "b string, vb int"), "b"),
        (spark.range(3).select(F.col("id").alias("c"), F.lit("t").alias("vc")), ["c"]),  # other width of numbers
        (spark.createDataFrame([(0.0, 1), (-1.0, 2)], "d double, vd int"), "d"),
    ]
    want = left
    for right, on in tables:
        want = want.join(right, on, "left")
    want = ordered(want.select(*left.columns, "va", "vb", "vc", "vd"))
    got = lookup_joins(left, tables, max_bytes=1)
    assert names.count("lookup-left") == 1 and names.count("key-counts") == 1
    assert got.columns == [*left.columns, "va", "vb", "vc", "vd"] and ordered(got) == want
    assert len(want) == 9000  # the hot key has two lookup rows
    assert ordered(lookup_joins(left, tables)) == want and names.count("lookup-left") == 1


def test_hot_rows_of_a_shuffled_join_are_dealt_over_tasks(spark):
    from spindlework.operators.joins import lookup_joins

    left = spark.range(0, 8000, 1, 4).select(F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).alias("k"))
    right = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for c, v in zip(before, ("-1", "false")):
        spark.conf.set(c, v)
    try:
        out = lookup_joins(left, [(right, "k")], max_bytes=1)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 8000 and max(sizes) < 3000  # one task would have 7200


def test_kpis_of_stored_readings_do_not_write_them_again(spark, monkeypatch):
    from spindlework.operators import joins

    names = []
    write = joins.materialise
    monkeypatch.setattr(joins, "materialise", lambda df, name="step": (names.append(name), write(df, name))[1])
    made = [
        reading(udi=i, type="LMH"[i % 3], product_id=None if i % 11 == 0 else f"p{i % 40}", failure_type="Overstrain Failure" if i % 5 == 0 else "x",
                tool_wear=i % 90, process_temperature=9.0, air_temperature=7.0)
        for i in range(400)
    ]
    m = write(spark.createDataFrame(made, READING_SCHEMA).repartition(4), "readings")
    want = Counter(map(tuple, kpi.with_kpis(m).collect()))
    names.clear()
    assert Counter(map(tuple, kpi.with_kpis(m, 1, stored=True).collect())) == want
    assert "key-counts" in names and "lookup-left" not in names
