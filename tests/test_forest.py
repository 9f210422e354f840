"""Forests: cut and shortened ones against directly grown ones, a plain tree, bounds, and scoring on workers."""

import numpy as np
import pytest
from conftest import frame, training_rows
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from profilespark.contract import SURVEY
from profilespark.operators import features, forest

CLASSES = tuple(sorted(SURVEY.labels))


@pytest.fixture(scope="module")
def noisy(spark):
    """The separable rows with every seventh label moved on, as (id, label, vector)."""
    rows = training_rows(400)
    for i in range(0, 400, 7):
        rows[i]["Stress_Level"] = SURVEY.labels[(i + 1) % 4]
    df = frame(spark, *rows).withColumn("row_id", F.monotonically_increasing_id())
    prep = features.fit_preparation(df, SURVEY)
    return prep.transform(df, SURVEY).select("row_id", "Stress_Level", "features").cache()


@pytest.fixture(scope="module")
def data(noisy):
    return forest.sample(noisy, "Stress_Level", "row_id", CLASSES, 42)


def fitted(spark, data, leaf, trees, depth=None):
    return forest.Forest.of(forest.fit_trees(spark, data, [leaf], trees, 42, depth).toArrow(), CLASSES)


def same(a, b):
    return all(np.array_equal(getattr(a, f), getattr(b, f)) for f in ("roots", "feature", "below", "depth", "counts")) and np.array_equal(
        np.where(a.feature >= 0, a.threshold, 0), np.where(b.feature >= 0, b.threshold, 0))


def points(data):
    """Values in the middle of the bins of the sample."""
    columns = [np.concatenate(([e[0] - 1], (e[1:] + e[:-1]) / 2, [e[-1] + 1])) if len(e) else np.zeros(1) for e in data.edges]
    return np.column_stack([c[data.bins[:, f]] for f, c in enumerate(columns)])


def reachable(one):
    """A forest without the nodes below its leaves, which a cut leaves in place."""
    x_nodes, number = [], {}
    for root in one.roots.tolist():
        level = [root]
        while level:
            for v in level:
                number[v] = len(number)
                x_nodes.append(v)
            level = [w for v in level if one.feature[v] >= 0 for w in (one.below[v], one.below[v] + 1)]
    at = np.array(x_nodes)
    roots = np.array([number[r] for r in one.roots.tolist()])
    below = np.array([number[one.below[v]] if one.feature[v] >= 0 else -1 for v in x_nodes])
    return forest.Forest(one.classes, roots, one.feature[at], one.threshold[at], below, one.depth[at], one.counts[at])


@pytest.mark.parametrize("leaf", [1, 3])
def test_a_cut_and_shortened_forest_is_the_one_grown_so(spark, data, leaf):
    whole = fitted(spark, data, leaf, 20)
    assert whole.depth.max() > 5
    for trees, depth in ((20, 4), (8, None), (8, 3)):
        assert same(reachable(whole.part(trees, depth)), reachable(fitted(spark, data, leaf, trees, depth)))


def test_leaves_hold_enough_rows_and_agree_with_their_rows(spark, data):
    one = fitted(spark, data, 3, 5)
    ends = one.feature < 0
    assert one.counts[ends].sum(axis=1).min() >= 3
    drawn = np.random.default_rng((42, 2)).integers(0, len(data.label), len(data.label))
    leaves = one.leaves(points(data)[drawn])[:, 2]
    for v in np.unique(leaves):
        assert np.array_equal(one.counts[v], np.bincount(data.label[drawn][leaves == v], minlength=4))


def plain_tree(bins, label, columns, leaf, depth):
    """Every cut of every column, recursively: (purity of the whole tree's leaves)."""
    n = np.bincount(label, minlength=4)
    if depth == 0 or n.max() == n.sum() or n.sum() < 2 * leaf:
        return (n * n).sum() / n.sum()
    best = None
    for f in columns:
        for b in np.unique(bins[:, f])[:-1]:
            left = bins[:, f] <= b
            if leaf <= left.sum() <= len(left) - leaf:
                sides = [np.bincount(label[s], minlength=4) for s in (left, ~left)]
                score = sum((s * s).sum() / s.sum() for s in sides)
                if best is None or score > best[0]:
                    best = (score, left)
    if best is None:
        return (n * n).sum() / n.sum()
    return sum(plain_tree(bins[s], label[s], columns, leaf, depth - 1) for s in (best[1], ~best[1]))


def test_a_tree_makes_the_best_cuts(data, monkeypatch):
    monkeypatch.setattr(np, "sqrt", lambda x: x)  # every node tries every column
    for tree in range(3):
        one = forest.grow(data, 2, tree, 42, 2)
        drawn = np.random.default_rng((42, tree)).integers(0, len(data.label), len(data.label))
        ends = one["counts"][one["feature"] < 0]
        purity = ((ends * ends).sum(axis=1) / ends.sum(axis=1)).sum()
        assert purity == pytest.approx(plain_tree(data.bins[drawn], data.label[drawn], range(data.bins.shape[1]), 2, 2))


def test_scores_on_workers_and_all_settings_at_once(spark, noisy, data):
    forests = {leaf: fitted(spark, data, leaf, 30) for leaf in (1, 3)}
    settings = [(leaf, trees, depth) for leaf in (1, 3) for trees in (10, 30) for depth in (None, 4)]
    rows = forest.setting_labels(noisy, forests, settings, "features", "at").orderBy("row_id").collect()
    for k, (leaf, trees, depth) in enumerate(settings):
        scored = forest.score(noisy, forests[leaf].part(trees, depth), "features", "p").orderBy("row_id").collect()
        assert [r.at[k] for r in rows] == [int(np.argmax(r.p)) for r in scored]
        assert all(sum(r.p) == pytest.approx(1) for r in scored)
    right = sum(CLASSES[r.at[4]] == r.Stress_Level for r in rows)
    assert right > 0.8 * len(rows)


def test_trees_go_to_a_table_and_back(spark, data):
    one = fitted(spark, data, 1, 6)
    assert same(one, forest.Forest.of(one.table(spark).repartition(3).toArrow(), CLASSES))


def test_the_sample_is_bounded_by_label(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, "a").when(F.col("id") == 1, "c").otherwise("b").alias("y"),
                                    array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    data = forest.sample(rows, "y", "id", ("a", "b", "c"), 42, rows=300)
    assert np.bincount(data.label).tolist() == [30, 269, 1]
    again = forest.sample(rows.repartition(7), "y", "id", ("a", "b", "c"), 42, rows=300)
    assert np.array_equal(data.bins, again.bins) and np.array_equal(data.label, again.label)
    assert len(data.edges[0]) == forest.BINS - 1


def test_rows_go_on_from_a_smaller_depth():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    # full trees of four levels, and one that is a single leaf
    size = 31
    inner = np.arange(size) < 15
    below = np.where(inner, 2 * np.arange(size) + 1, -1)
    levels = np.floor(np.log2(np.arange(size) + 1)).astype(int)
    roots = np.array([0, size, 2 * size])
    whole = forest.Forest(
        ("a", "b"), roots,
        np.concatenate([np.where(inner, rng.integers(0, 4, size), -1), np.where(inner, rng.integers(0, 4, size), -1), [-1]]).astype(np.int32),
        rng.normal(size=2 * size + 1),
        np.concatenate([below, np.where(inner, below + size, -1), [-1]]).astype(np.int32),
        np.concatenate([levels, levels, [0]]).astype(np.int32), rng.integers(1, 9, (2 * size + 1, 2)),
    )

    def down(row, node, depth):
        for _ in range(depth):
            if whole.feature[node] >= 0:
                node = whole.below[node] + int(row[whole.feature[node]] > whole.threshold[node])
        return node

    ends = {d: whole.leaves(x, d) for d in (0, 2, None)}
    for d, found in ends.items():
        assert found.tolist() == [[down(row, root, 9 if d is None else d) for root in roots] for row in x]
    assert (whole.leaves(x, 2, (ends[0], 0)) == ends[2]).all() and (whole.leaves(x, None, (ends[2], 2)) == ends[None]).all()
