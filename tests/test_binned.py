"""Ensembles on a binned table: the same in a task and over partitions, and sound parts."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from spindlework.operators import binned, evaluate, forest, tuning
from spindlework.plans.workspace import new_path


@pytest.fixture(scope="module")
def rows(spark):
    """Three classes by thresholds of two of four measures, with rows that repeat and some noise."""
    df = spark.range(900).select(
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(8))).cast("double").alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(200)) / 7).alias("b"),
        (F.col("id") % 3).cast("double").alias("c"),
        F.lit(5.0).alias("d"),
        (F.col("id") % 5).cast("int").alias("fold"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10)).alias("noise"),
    )
    label = F.when(F.col("noise") == 0, F.col("c")).when(F.col("a") > 4, 2.0).when(F.col("b") > 12, 1.0).otherwise(0.0)
    return df.select(
        array_to_vector(F.array("a", "b", "c", "d")).alias("features"), label.alias("label"), "fold"
    ).cache()


def shape(tree):
    return tree.feature, tree.cut, tree.child, [v.tolist() for v in tree.value]


def test_edges_and_cells(rows):
    edges = binned.bin_edges(rows, max_bins=16)
    assert edges[0] == [x + 0.5 for x in range(7)] and edges[3] == [] and 8 < len(edges[1]) <= 16
    table = binned.cells(rows, edges, "fold")
    assert table.agg(F.sum("w")).first()[0] == 900 and table.count() < 900
    bins = binned.to_bins(np.array([[0.0, -9.0, 1.0, 5.0], [7.0, 99.0, 2.0, np.nan]]), edges)
    assert bins[0].tolist() == [0, 0, 1, 0] and bins[1].tolist()[:3] == [7, len(edges[1]), 2]


@pytest.mark.parametrize("subsample", [1.0, 0.7])
def test_boosting_is_the_same_over_partitions(rows, subsample):
    edges = binned.bin_edges(rows)
    table = binned.cells(rows, edges).repartition(3).cache()
    t = binned.Table.of(table.toArrow())
    own = binned.boost(t, edges, 3, 4, 0.3, 3, 2, subsample, 7)
    spread = binned.boost_distributed(table, edges, 3, 4, 0.3, 3, 2, subsample, 7, stride=2)
    assert own.start == spread.start
    assert [[shape(x) for x in r] for r in own.rounds] == [[shape(x) for x in r] for r in spread.rounds]


def test_first_round_equals_its_definition(rows):
    """Gradients of the prior, best split by squared error over all splits, Newton leaves."""
    edges = binned.bin_edges(rows, max_bins=8)
    t = binned.Table.of(binned.cells(rows, edges).toArrow())
    model = binned.boost(t, edges, 3, 1, 1.0, 1, 5, 1.0, 0)
    share = np.bincount(t.label, t.w, 3) / t.w.sum()
    for k, tree in enumerate(model.rounds[0]):
        r = (t.label == k) - share[k]
        best = max(
            (
                sum((t.w * r)[side].sum() ** 2 / t.w[side].sum() for side in (t.bins[:, f] <= c, t.bins[:, f] > c)), -f, -c
            )
            for f in range(4) for c in range(8)
            if min(t.w[t.bins[:, f] <= c].sum(), t.w[t.bins[:, f] > c].sum()) >= 5
        )
        assert (tree.feature[0], tree.cut[0]) == (-best[1], -best[2])
        left = t.bins[:, tree.feature[0]] <= tree.cut[0]
        size = np.abs(r)
        step = 2 / 3 * (t.w * r)[left].sum() / (t.w * size * (1 - size))[left].sum()
        assert abs(model.values(tree)[1] - step) < 1e-4


def test_boosting_learns_and_scores(rows):
    model = binned.fit_boosted(rows, 3, trees=30, rate=0.3, depth=3)
    right = model.transform(rows).filter("label = prediction").count()
    assert right > 800


def test_forest_is_the_same_over_partitions(rows):
    edges = binned.bin_edges(rows)
    table = binned.cells(rows, edges, "fold").repartition(3).cache()
    t = binned.Table.of(table.toArrow())
    spread = binned.forest_distributed(table, 1, 9, 5, 2, 6, 3, together=2)
    train = np.where(t.fold == 1, 0.0, t.w)
    for n, tree in enumerate(spread):
        own, _ = binned.forest_tree(t, binned.drawn(t.key, train, 9 * 7919 + 2 * n), n, 9, 6, 2, 3)
        assert shape(own) == shape(tree)


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_search_is_the_same_over_partitions_and_prefixes_are_fits(rows, kind):
    few = {"forest": {"numTrees": (1, 4), "maxDepth": [2, 4], "minInstancesPerNode": [2]},
           "boosting": {"maxIter": (1, 4), "stepSize": [0.3], "maxDepth": [2], "minInstancesPerNode": [2], "subsamplingRate": [0.8]}}[kind]
    own = [tuple(r) for r in tuning.shared_search(rows, kind, few, draws=4, folds=2).collect()]
    spread = [tuple(r) for r in tuning.shared_search(rows, kind, few, draws=4, folds=2, max_bytes=0).collect()]
    assert own == spread and [r[0] for r in own] == [1, 2, 3, 4]
    alone = {json.dumps(s, sort_keys=True): s for s in tuning.draw_settings(few, 4)}
    for _, score, text in own[:1] + own[-1:]:  # a draw searched alone scores as among the others
        only = {k: [v] for k, v in alone[text].items()}
        assert tuning.shared_search(rows, kind, only, draws=1, folds=2).first()["mean_score"] == score


def test_fold_scores_equal_the_metrics(spark, rows):
    guess = rows.withColumn("prediction", F.when(F.col("fold") == 0, 1.0).otherwise(F.col("label")))
    counts = guess.groupBy("fold", "label", "prediction").agg(F.count("*").alias("n")).withColumns(
        {"unit": F.lit(0), "trees": F.lit(1), "depth": F.lit(1)}
    )
    want = np.mean([evaluate.weighted_metrics(guess.filter(F.col("fold") == f)).first()["f1"] for f in range(5)])
    assert abs(tuning.fold_f1(counts).first()["mean_score"] - want) < 1e-12
    two = counts.withColumns({c: (F.col(c) == 1).cast("int") for c in ("label", "prediction")})
    flags = guess.select("fold", *[(F.col(c) == 1).cast("int").alias(f"{c}_bin") for c in ("label", "prediction")])
    want = np.mean([evaluate.binary_metrics(flags.filter(F.col("fold") == f)).first()["f1"] for f in range(5)])
    assert abs(tuning.fold_f1(two, binary=True).first()["mean_score"] - want) < 1e-12


def test_draws_follow_their_laws():
    key = np.arange(200_000, dtype=np.uint64)
    for w in (1.0, 6.0, 900.0):
        x = binned.drawn(key, np.full(len(key), w), 5)
        assert abs(x.mean() / w - 1) < 0.01 and abs(x.var() / w - 1) < 0.03
        x = binned.drawn(key, np.full(len(key), w), 5, 0.8)
        assert abs(x.mean() / (0.8 * w) - 1) < 0.01 and abs(x.var() / (0.16 * w) - 1) < 0.03 and x.max() <= w
    assert (binned.drawn(key, np.zeros(len(key)), 5) == 0).all()


def test_sister_sums_and_pieces_give_the_trees_of_direct_sums(rows, monkeypatch):
    """Trees grown from the smaller sister's sums, in levels of any number of pieces, are those of sums over all rows."""
    edges = binned.bin_edges(rows)
    t = binned.Table.of(binned.cells(rows, edges, "fold").toArrow())
    whole, at = t.merged
    assert len(whole.w) < len(t.w) and whole.w.sum() == 900
    w = binned.drawn(t.key, t.w, 5)

    def direct(t, w):
        values = np.zeros((len(w), 3))
        values[np.arange(len(w)), t.label] = w

        def sums(tree, level, last):
            return binned.sums_of(t.bins, binned.numbered(binned.descend(tree, t.bins)[0], level), values, len(level), t.n_bins)

        return shape(binned.finish(binned.forest_growth(3, 9, 12, 1), sums))

    for together in (1024, 4, 2):
        monkeypatch.setattr(binned, "TOGETHER", together)
        assert shape(binned.forest_tree(t, w, 3, 9, 12, 1, 3)[0]) == direct(t, w)
        merged = np.bincount(at, w, len(whole.w))
        assert shape(binned.forest_tree(whole, merged, 3, 9, 12, 1, 3)[0]) == direct(t, w)


def test_two_classes_share_a_tree_with_the_sign_changed(rows):
    two = rows.withColumn("label", (F.col("label") == 1).cast("double"))
    edges = binned.bin_edges(two)
    t = binned.Table.of(binned.cells(two, edges).toArrow())
    for a, b in binned.boost(t, edges, 2, 3, 0.3, 3, 1, 0.8, 7).rounds:
        assert (a.feature, a.cut, a.child) == (b.feature, b.cut, b.child)
        assert all((x == y * (-1, 1, 1)).all() for x, y in zip(a.value, b.value))


def test_forest_stage(rows, spark):
    """Copies are cells, trees the same in tasks and over partitions, a saved model the same."""
    stage = forest.BinnedForest(numTrees=6, maxDepth=8, minInstancesPerNode=2)
    model = stage.fit(rows)
    assert model.transform(rows).filter("label = prediction").count() > 750
    _, own = binned.fit_forest(rows, 3, 6, 8, 2)
    _, spread = binned.fit_forest(rows, 3, 6, 8, 2, max_bytes=0)
    assert [shape(x) for x in own] == [shape(x) for x in spread] == [shape(x) for x in model.trees]
    path = new_path(spark, "forest")
    PipelineModel(stages=[model]).write().save(path)
    pick = [vector_to_array("features"), "probability", "prediction"]
    again = PipelineModel.load(path).transform(rows).select(*pick).collect()
    assert sorted(map(str, again)) == sorted(map(str, model.transform(rows).select(*pick).collect()))
    first = model.transform(rows).first()
    bins = binned.to_bins(np.array([first["features"]]), model.edges)
    votes = np.mean([binned.shares(x)[binned.descend(x, bins)[0]][0] for x in model.trees], 0)
    assert np.allclose(votes, first["probability"]) and votes.argmax() == first["prediction"]
    _, few = binned.fit_forest(rows, 3, 6, 8, 2, min_gain=0.01)
    assert sum(len(x.feature) for x in few) < sum(len(x.feature) for x in own)


def test_cells_of_several_hundred_rows_are_drawn_by_their_law():
    """A tenth to the power of 400 is no double; such a cell gave one row."""
    key = np.arange(50_000, dtype=np.uint64)
    for w in (320.0, 400.0):
        x = binned.drawn(key, np.full(len(key), w), 5, 0.9)
        assert abs(x.mean() / (0.9 * w) - 1) < 0.01 and abs(x.var() / (0.09 * w) - 1) < 0.05


@pytest.mark.parametrize("subsample", [1.0, 0.7])
def test_fits_that_share_groups_have_the_margins_of_fits_on_cells(rows, subsample):
    edges = binned.bin_edges(rows, max_bins=8)
    t = binned.Table.of(binned.cells(rows, edges, "fold").toArrow())
    units = {
        7: {"trees": 6, "rate": 0.3, "depth": 2, "least": 2},
        9: {"trees": 4, "rate": 0.1, "depth": 3, "least": 5},
    }
    shared, order = {}, np.concatenate((np.flatnonzero(t.fold == 1), binned.by_weight(t, 1)))

    def each(unit, number, margin, groups):
        assert (groups.t.key == t.key[order]).all() and len(margin) == len(groups.parent)
        shared[unit, number] = margin[groups.number]

    binned.boost_together(t, 3, units, subsample, 11, 1, each, most=100_000)
    for u, s in units.items():

        def alone(number, margin, at, u=u):
            assert (margin[at][order] == shared.pop((u, number))).all()

        binned.boost(t, edges, 3, s["trees"], s["rate"], s["depth"], s["least"], subsample, 11, 1, alone)
    assert not shared
    with pytest.raises(binned.ManyGroups):
        binned.boost_together(t, 3, units, subsample, 11, 1, each, most=5)


def test_a_search_counts_the_same_with_any_number_of_groups(rows, spark):
    edges = binned.bin_edges(rows, max_bins=8)
    table = binned.cells(rows, edges, "fold")
    units = [
        {"kind": "boosting", "least": least, "wanted": [(2, 2), (3, 2)], "rate": 0.2, "subsample": subsample}
        for least, subsample in ((1, 0.8), (4, 0.8), (2, 1.0))
    ]
    found = [
        sorted(map(tuple, binned.search_counts(spark, table, units, 3, 2, 5, len(edges), edges, most_groups=n).collect()))
        for n in (100_000, 3)
    ]
    assert found[0] == found[1] and {r[0] for r in found[0]} == {0, 1, 2}


def test_forests_that_differ_in_least_leaf_share_trees(rows, monkeypatch):
    """Each gives the predictions of its trees grown alone, but a tree that no least changes is grown once."""
    x = vector_to_array("features")
    clean = rows.withColumn("label", F.when(x[0] > 4, 2.0).when(x[1] > 12, 1.0).otherwise(0.0))
    edges = binned.bin_edges(clean)
    t = binned.Table.of(binned.cells(clean, edges, "fold").toArrow())
    wanted = {1: {(3, 2), (5, 12)}, 2: {(4, 5)}, 3: {(4, 12), (2, 5)}}
    grown, tree = [], binned.forest_tree
    monkeypatch.setattr(binned, "forest_tree", lambda *a, **k: grown.append(a[5]) or tree(*a, **k))
    found = {(x, n, d): guess for x, n, d, guess in binned.forest_prefixes(t, 1, 9, wanted, 3)}
    assert len(found) == 5 and len(grown) < 5 + 4 + 4
    whole, at = t.merged
    test = at[t.fold == 1]
    for least, pairs in wanted.items():
        for trees, depth in pairs:
            votes = np.zeros((len(test), 3))
            for n in range(trees):
                w = binned.drawn(t.key, np.where(t.fold == 1, 0.0, t.w), 9 * 7919 + 2 * n)
                one, _ = tree(whole, np.bincount(at, w, len(whole.w)), n, 9, depth, least, 3)
                votes += binned.shares(one)[binned.descend(one, whole.bins)[0]][test]
            assert (votes.argmax(1) == found[least, trees, depth]).all()
