"""Same seed same answer, better than the majority class, saved models equal."""

from __future__ import annotations

import pytest
from compare import DATA
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from spindlework.operators import evaluate, kernels, models, splits, tuning
from spindlework.plans.workspace import new_path
from spindlework.sources import fixtures


@pytest.fixture(scope="module")
def parts(spark):
    # classes that follow from the measures, so that there is something to learn
    load, power = F.col("tool_wear") * F.col("torque"), F.col("torque") * F.col("rotational_speed")
    m = fixtures.machine_readings(spark, str(DATA / "sf0.001")).withColumn(
        "failure_type",
        F.when(load > 7000, "Overstrain Failure").when(power > 110000, "Power Failure").otherwise("No Failure"),
    )
    m = splits.with_hash_split(m, ["udi"]).cache()
    return m.filter("split = 'train'"), m.filter("split = 'test'")


def score(df):
    return evaluate.weighted_metrics(df).first()["f1"]


def test_forest_repeats_and_beats_majority(parts):
    train, test = parts
    fits = [models.fit_model(train, models.random_forest(trees=8)).transform(test) for _ in range(2)]
    a, b = ([tuple(r) for r in f.select("udi", "prediction").orderBy("udi", "prediction").collect()] for f in fits)
    assert a == b
    assert score(fits[0]) > score(fits[0].withColumn("prediction", F.lit(0.0)))


def test_boosting_multiclass_with_all_parts(parts):
    train, test = parts
    model = models.fit_model(
        train,
        models.boosted_trees_multiclass(trees=3, rate=0.1, depth=3),
        categorical="one_hot_all",
        scale="zscore",
        label_order="text",
    )
    scored = model.transform(test)
    assert score(scored) > score(scored.withColumn("prediction", F.lit(0.0)))  # 0 is No Failure by text
    known = {r[0] for r in train.select("failure_type").distinct().collect()}
    assert {r[0] for r in scored.select("predicted_class").distinct().collect()} <= known


def test_saved_pipeline_scores_alike_and_takes_unseen_type(parts, spark):
    train, test = parts
    model = models.fit_model(train, models.decision_tree(), scale="zscore", categorical="one_hot_all")
    path = new_path(spark, "model")
    models.save_model(model, path)
    odd = test.withColumn("type", F.when(F.col("udi") % 2 == 0, "X").otherwise(F.col("type")))
    again = models.load_model(path)
    pick = ("udi", "prediction", "predicted_class")
    assert sorted(map(tuple, again.transform(odd).select(*pick).collect())) == sorted(
        map(tuple, model.transform(odd).select(*pick).collect())
    )


def test_kernel_svm_separates_a_ring(spark):
    ring = spark.range(400).select(
        (F.col("id") % 20 - 10).cast("double").alias("x"), (F.floor(F.col("id") / 20) - 10).cast("double").alias("y")
    ).withColumn("label", (F.col("x") ** 2 + F.col("y") ** 2 < 40).cast("double"))
    model = models.fit_kernel_svm(ring, ["x", "y"], c=10.0, size=96)
    right = model.transform(ring).filter("label = prediction").count()
    assert right > 360


def test_landmarks_come_closer_to_the_kernel_than_cosines(spark):
    blob = spark.range(3000).select(
        *[
            (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 500 + (F.col("id") % 5) * 2).alias(c)
            for i, c in enumerate(("x", "y", "z"))
        ]
    )
    names, gamma = ["x", "y", "z"], 0.05
    landmark = kernels.landmark_features(blob, names, gamma, 64)
    mean, most = kernels.kernel_error([landmark], blob, names, gamma)
    cosines = kernels.kernel_error(models.fourier_features(names, gamma, 64), blob, names, gamma)
    assert mean < 0.005 and most < 0.1 and mean < cosines[0] / 10
    points, root, _ = landmark.map()  # exact at the landmarks
    own = kernels.rbf(points, points, gamma)
    assert abs((own @ root) @ (own @ root).T - own).max() < 1e-6


def test_landmark_svm_separates_a_ring_and_can_be_saved(spark):
    ring = spark.range(400).select(
        (F.col("id") % 20 - 10).cast("double").alias("x"), (F.floor(F.col("id") / 20) - 10).cast("double").alias("y")
    ).withColumn("label", (F.col("x") ** 2 + F.col("y") ** 2 < 40).cast("double"))
    model = models.fit_kernel_svm(ring, ["x", "y"], c=10.0, kernel_map="landmarks")
    path = new_path(spark, "svm")
    models.save_model(model, path)
    for m in (model, models.load_model(path)):
        assert m.transform(ring).filter("label = prediction").count() > 380


def test_search_draws(spark):
    draws = tuning.draw_settings(tuning.FOREST_SPACE)
    assert len(draws) == 50 and draws == tuning.draw_settings(tuning.FOREST_SPACE)
    assert all(50 <= d["numTrees"] < 300 and d["maxDepth"] <= models.MAX_TREE_DEPTH for d in draws)


def test_fitted_comparison(spark):
    def scored(train_right, test_right):
        rows = [("train", i % 2, i % 2 if i < train_right else 1 - i % 2) for i in range(10)]
        rows += [("test", i % 2, i % 2 if i < test_right else 1 - i % 2) for i in range(10)]
        return spark.createDataFrame([(s, float(a), float(p)) for s, a, p in rows], "split string, label double, prediction double")

    tables = {"b": scored(10, 10), "a": scored(10, 10), "c": scored(10, 8)}
    got = {(r["model"], r["metric"]): r for r in evaluate.fitted_comparison(tables).collect()}
    assert len(got) == 12
    assert {m for (m, _), r in got.items() if r["best"]} == {"a"}
    assert tuple(got["c", "accuracy"])[2:4] == (1.0, 0.8)
    assert abs(got["c", "accuracy"]["gap"] - 0.2) < 1e-12


def test_model_learns_from_synthetic_rows(spark):
    """A rare class of a tenth of a percent is lost without them and found with them."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 200 == 0, "rare").otherwise("common").alias("failure_type"),
        (F.when(F.col("id") % 200 == 0, 60.0).otherwise(0.0) + F.col("id") % 70).alias("torque"),
        *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(50))).cast("double").alias(c) for c in ("air_temperature", "process_temperature", "rotational_speed", "tool_wear")],
        F.lit("L").alias("type"),
    )
    estimator = models.decision_tree(depth=3)
    found = {}
    for resample in (False, True):
        scored = models.fit_model(df, estimator, resample=resample, categorical="none").transform(df)
        found[resample] = scored.filter("failure_type = 'rare' AND predicted_class = 'rare'").count()
    assert found[True] > found[False]


def test_held_out_rows_never_shape_synthetic_ones(spark):
    """Whatever stands in a held-out fold, the round's training rows stay the same."""
    from spindlework.operators import resample

    def rounds(shift):
        rows = [(DenseVector([float(i % 13) + (shift if i % 3 == k else 0), float(i % 7)]), float(i % 10 == 0), i % 3) for i in range(120) for k in (0,)]
        ready = spark.createDataFrame(rows, ["features", "label", "fold"])
        return [[sorted((r.label, *r.features) for r in part.collect()) for part in pair] for pair in resample.resampled_rounds(ready, 3, 2)]

    plain, moved = rounds(0.0), rounds(1000.0)
    assert plain[0][0] == moved[0][0] and plain[0][1] != moved[0][1]  # fold 0 is held out in round 0
    assert plain[1][0] != moved[1][0]
    for train, test in plain:
        assert len(test) == 40 and sum(r[0] for r in train) == len(train) / 2  # the classes are even
    scores = tuning.cross_validate(
        spark.createDataFrame([(DenseVector([float(i % 10 == 0), float(i % 7)]), float(i % 10 == 0), i % 3) for i in range(300)], ["features", "label", "fold"]),
        models.decision_tree(), folds=3, binary=True, resample=True,
    )
    assert scores == [1.0, 1.0, 1.0]


def test_a_fit_on_counted_copies_is_the_fit_on_all_rows(spark):
    """Classifiers that take weights read every distinct row once, and give the model of all rows."""
    rows = spark.range(3000).select(
        array_to_vector(F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(6)).cast("double") for i in range(3)])).alias("features"),
        (F.pmod(F.xxhash64("id", F.lit(0)), F.lit(6)) + F.pmod(F.xxhash64("id", F.lit(9)), F.lit(3)) > 4).cast("double").alias("label"),
    ).cache()
    counted = models.counted_copies(rows.select(vector_to_array("features").alias("x"), "label"))
    assert counted.count() < 450 and counted.agg(F.sum("weight")).first()[0] == 3000
    for e in (models.decision_tree(), models.boosted_trees(trees=3)):
        scored = e.fit(rows).transform(rows).select("features", "label", F.col("probability").alias("p"))
        both = models.fit_on_copies(e, rows).transform(scored)
        gap = F.abs(vector_to_array("p")[1] - vector_to_array("probability")[1])
        assert both.agg(F.max(gap)).first()[0] < 1e-9
    a, b = (f(models.binary_regression(3000), rows).coefficients for f in (models.fit_on_copies, lambda e, r: e.fit(r)))
    assert max(abs(a.toArray() - b.toArray())) < 1e-6
    assert not models.weighs_copies(models.boosted_trees(subsample=0.9)) and not models.weighs_copies(models.boosted_trees(min_instances=2))


def test_fits_and_scores_on_counted_rows_are_those_on_all_rows(spark):
    rows = spark.range(600).select(
        (F.col("id") % 7).cast("double").alias("a"),
        (F.pmod(F.xxhash64("id"), F.lit(90)) / 2).alias("b"),
        (F.col("id") % 7 + F.pmod(F.xxhash64("id"), F.lit(90)) % 3 > 4).cast("double").alias("label"),
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"),
    )
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.unionByName(rows))
    plain = ready.select("features", "label", "split")
    x = F.col("features")
    counted = models.counted_copies(plain.select(vector_to_array(x).alias("features"), "label", "split")).withColumn(
        "features", array_to_vector("features")
    )
    assert counted.count() <= 600
    for estimator in (models.random_forest(trees=5, depth=4), models.decision_tree(), models.binary_regression(1200)):
        one = models.fit_on_copies(estimator, plain.select("features", "label"))
        two = models.fit_on_copies(estimator, counted.select("features", "label", "weight"), "weight")
        want, got = evaluate.fitted_comparison({"m": one.transform(plain)}), evaluate.fitted_comparison({"m": two.transform(counted)}, copies="weight")
        assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))
    least = models.decision_tree().setMinInstancesPerNode(3)  # counts rows, so it gets each copy
    one, two = models.fit_on_copies(least, plain.select("features", "label")), models.fit_on_copies(least, counted.select("features", "label", "weight"), "weight")
    assert one.toDebugString.split("\n")[1:] == two.toDebugString.split("\n")[1:]
    assert models.scale_gamma(rows, ["a", "b"]) == pytest.approx(models.scale_gamma(rows.withColumn("n", F.lit(2)), ["a", "b"], "n"))
