import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from profilespark.operators import cluster, evaluate, importance, knn

LABELS = ("Low", "Medium", "High")


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "actual string, predicted string")


def test_two_averaging_sets_and_zero_division(spark):
    df = scored(spark, [("Low", "Low"), ("Low", "Low"), ("Medium", "Low")])
    per = evaluate.per_label(evaluate.confusion(df, LABELS))
    present = evaluate.scalar_metrics(per).first()
    contract = evaluate.scalar_metrics(per, label_set="contract").first()
    assert present.n == 3 and present.accuracy == pytest.approx(2 / 3)
    assert present.f1_macro == pytest.approx(0.8 / 2) and contract.f1_macro == pytest.approx(0.8 / 3)
    assert present.balanced_accuracy == contract.balanced_accuracy == pytest.approx(0.5)
    assert present.f1_weighted == pytest.approx(0.8 * 2 / 3)
    cells = {(r.actual, r.predicted): r.n for r in evaluate.confusion(df, LABELS).collect()}
    assert len(cells) == 9 and cells[("High", "High")] == 0 and cells[("Medium", "Low")] == 1


def test_majority_row_matches_the_closed_form(spark):
    """324 of 999 rows: accuracy .3243, macro precision .0811, F1 .1224."""
    df = spark.range(999).select(
        F.when(F.col("id") < 324, "Very High").when(F.col("id") < 600, "High").when(F.col("id") < 860, "Medium").otherwise("Low").alias("actual"),
        F.lit("Very High").alias("predicted"),
    )
    m = evaluate.classification_metrics(df, ("Low", "Medium", "High", "Very High")).first()
    assert (round(m.accuracy, 4), round(m.precision_macro, 4), round(m.recall_macro, 4), round(m.f1_macro, 4)) == (0.3243, 0.0811, 0.25, 0.1224)


def auc_by_pairs(rows, label):
    pos = [s for a, s in rows if a == label]
    neg = [s for a, s in rows if a != label]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("steps", [5, 10**6])
def test_auc_equals_pair_counting(spark, steps):
    rng = random.Random(steps)
    rows = [(rng.choice(LABELS), [rng.randint(0, steps) / steps for _ in LABELS]) for _ in range(400)]
    df = spark.createDataFrame([(a, dict(zip(LABELS, p))) for a, p in rows], "actual string, probabilities map<string,double>")
    got = {r.label: r.auc for r in evaluate.roc_auc_per_label(df, LABELS).collect()}
    for i, name in enumerate(LABELS):
        assert got[name] == pytest.approx(auc_by_pairs([(a, p[i]) for a, p in rows], name))
    assert evaluate.roc_auc(df, LABELS).first()[0] == pytest.approx(np.mean(list(got.values())))
    # undefined when the labels that occur are not the model's classes
    assert evaluate.roc_auc(df.filter("actual <> 'Low'"), LABELS).first()[0] is None
    assert evaluate.roc_auc(df, LABELS[:2]).first()[0] is None


def brute_neighbours(queries, train, k):
    ids = np.array([t[0] for t in train])
    order = np.argsort(ids)
    points = np.array([train[i][1] for i in order])
    found = {}
    for q, x, _ in queries:
        d = np.round(((points - np.array(x)) ** 2).sum(axis=1), 9)
        found[q] = [int(ids[order[i]]) for i in np.argsort(d, kind="stable")[:k]]
    return found


@pytest.mark.parametrize("options", [{}, {"pivots": 12, "block_rows": 25, "query_rows": 15}])
@pytest.mark.parametrize("kind", ["gauss", "lattice", "hot"])
def test_neighbours_equal_brute_force(spark, options, kind):
    rng = np.random.default_rng(7)
    n = 600
    if kind == "gauss":
        x = rng.normal(size=(n, 4))
    elif kind == "lattice":
        x = rng.integers(0, 5, size=(n, 3)).astype(float)
    else:  # a third of all rows on one point
        x = rng.normal(size=(n, 3))
        x[: n // 3] = 0.0
    rows = [(i, [float(v) for v in p], str(i % 4)) for i, p in enumerate(x)]
    queries, train = rows[::5], [r for r in rows if r[0] % 5]
    schema = "id long, x array<double>, label string"
    got = knn.neighbors(
        spark.createDataFrame(queries, schema), spark.createDataFrame(train, schema), 5,
        query_id="id", train_id="id", label="label", **options,
    )
    assert {r.id: [m.id for m in r.neighbors] for r in got.collect()} == brute_neighbours(queries, train, 5)


def test_an_index_is_built_once_and_saved(spark, tmp_path, monkeypatch):
    """Cells in groups and a local index: the loaded one answers like the built one, without building anything."""
    rng = np.random.default_rng(11)
    rows = [(i, [float(v) for v in p], str(i % 3)) for i, p in enumerate(rng.normal(size=(900, 5)))]
    schema = "id long, x array<double>, label string"
    train, queries = spark.createDataFrame(rows[:700], schema), spark.createDataFrame(rows[700:], schema)
    wanted = brute_neighbours(rows[700:], rows[:700], 5)
    for name, options in (("cells", {"block_rows": 20}), ("local", {})):
        index = knn.build(train, 7, train_id="id", label="label", **options)
        index.save(str(tmp_path / name))
        monkeypatch.setattr(knn, "build", None)
        loaded = knn.NeighborIndex.load(spark, str(tmp_path / name))
        for one in (index, loaded):
            assert one.is_local == (name == "local")
            got = knn.neighbors(queries, one, 5, query_id="id")
            assert {r.id: [m.id for m in r.neighbors] for r in got.collect()} == wanted
        with pytest.raises(ValueError, match="up to 7"):
            knn.with_neighbors(queries, loaded, 8)
        assert knn.with_neighbors(queries.limit(0), loaded, 5).count() == 0
        monkeypatch.undo()
    assert len(index.counts) == 1 and len(knn.build(train, 7, train_id="id", label="label", block_rows=20).cells.centers) == 6


def test_groups_leave_out_no_cell_that_may_hold_a_neighbour():
    rng = np.random.default_rng(3)
    points, asked = rng.normal(size=(2000, 3)), rng.normal(size=(50, 3))
    cells = knn.Cells.around(points[:150])
    at, reach, group_reach = cells.nearest(points, np.ones(150, dtype=bool))
    far = np.array([reach[at == c].max(initial=-np.inf) for c in range(150)])
    far_group = np.array([group_reach[cells.group[at] == g].max(initial=-np.inf) for g in range(len(cells.centers))])
    limit = rng.uniform(0, 0.3, size=50)
    row, cell = cells.within(asked, limit, far, far_group)
    found = set(zip(row.tolist(), cell.tolist()))
    for q in range(50):
        near = np.flatnonzero(((points - asked[q]) ** 2).sum(axis=1) <= limit[q])
        assert {(q, int(at[i])) for i in near} <= found


@pytest.mark.parametrize("kind", ["unit", "lattice", "copies"])
def test_leaves_give_the_points_that_all_pairs_give(kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 8)) if kind == "unit" else rng.integers(0, 4, size=(3000, 5)).astype(float)
    if kind == "copies":
        x[:2000] = x[0]
    points, asked = x[:2600] + 1e3, x[2600:] + 1e3
    limit = np.where(np.arange(400) % 3 == 0, 1.0, np.inf)
    for own in (limit, np.full(400, np.inf)):
        for got, wanted in zip(knn.nearest_points(asked, points, 7, own), knn._one_by_one(asked, points, 7, own)):
            assert np.array_equal(got, wanted)


def test_small_cells_share_a_shard(spark, monkeypatch):
    """However small the cells, a query goes to blocks of rows, not to every cell that may hold a neighbour."""
    rng = np.random.default_rng(13)
    rows = [(i, [float(v) for v in p], str(i % 3)) for i, p in enumerate(rng.normal(size=(700, 6)))]
    schema = "id long, x array<double>, label string"
    train, queries = spark.createDataFrame(rows[:600], schema), spark.createDataFrame(rows[600:], schema)
    index = knn.build(train, 5, train_id="id", label="label", block_rows=10)
    assert len(index.counts) == 60 and index.shards().max() == 0
    monkeypatch.setattr(knn, "BLOCK_ROWS", 100)
    held = np.bincount(index.shards(), weights=index.counts)
    assert 3 <= len(held) <= 7 and held.sum() == 600
    got = knn.neighbors(queries, index, 5, query_id="id")
    assert {r.id: [m.id for m in r.neighbors] for r in got.collect()} == brute_neighbours(rows[600:], rows[:600], 5)


def test_votes(spark):
    near = "array<struct<rank:int,d2:double,id:long,label:string>>"
    rows = [
        (1, [(1, 1.0, 1, "b"), (2, 4.0, 2, "a"), (3, 4.0, 3, "a")]),  # uniform a, distance tie -> a
        (2, [(1, 0.0, 1, "b"), (2, 0.1, 2, "a"), (3, 0.1, 3, "a")]),  # exact match decides
        (3, [(1, 1.0, 1, "b"), (2, 1.0, 2, "a"), (3, 9.0, 3, "c")]),  # tie -> first label
    ]
    df = spark.createDataFrame(rows, f"i int, neighbors {near}")
    uniform = {r.i: r.predicted for r in df.withColumns(knn.vote("neighbors", 3, "uniform", ["a", "b", "c"])).collect()}
    distance = {r.i: r for r in df.withColumns(knn.vote("neighbors", 3, "distance", ["a", "b", "c"])).collect()}
    assert uniform == {1: "a", 2: "a", 3: "a"}
    assert {i: r.predicted for i, r in distance.items()} == {1: "a", 2: "b", 3: "a"}
    assert distance[2].probabilities == {"a": 0.0, "b": 1.0, "c": 0.0}


def test_votes_take_one_pass_over_the_neighbours(spark):
    near = "array<struct<rank:int,d2:double,id:long,label:string>>"
    rng = np.random.default_rng(5)
    labels = ["a", "b", "c", "x", None]  # the last two are no class, but vote
    rows = [(i, [(j + 1, float(d), j, labels[rng.integers(0, 5)]) for j, d in enumerate(np.sort(rng.integers(0, 4, rng.integers(1, 12))))]) for i in range(60)]
    rows += [(60, None)]
    df = spark.createDataFrame(rows, f"i int, neighbors {near}").repartition(3)
    classes, settings = ["c", "a", "b"], [(k, w) for k in (1, 3, 9) for w in ("uniform", "distance")]
    asked = {}
    for j, (k, w) in enumerate(settings):
        votes = knn.vote("neighbors", k, w, classes)
        asked |= {f"p{j}": votes["predicted"], f"s{j}": votes["probabilities"]}
    scored = df.withColumns(asked)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("ArrowEvalPython") == 1
    got = {r.i: r for r in scored.collect()}
    assert len(got) == len(rows)
    for i, hits in rows[:-1]:
        for j, (k, w) in enumerate(settings):
            first = hits[:k]
            exact = any(h[1] == 0 for h in first)
            weight = [1.0 if w == "uniform" else float(h[1] == 0) if exact else 1 / np.sqrt(h[1]) for h in first]
            share = {c: sum(v for v, h in zip(weight, first) if h[3] == c) / sum(weight) for c in classes}
            assert got[i][f"s{j}"] == pytest.approx(share)
            assert got[i][f"p{j}"] == min(sorted(classes), key=lambda c: round(-share[c], 12))
    assert got[60].p0 == "a" and got[60].s0 == {"a": None, "b": None, "c": None}


def test_leaves_of_points_hold_one_category():
    rng = np.random.default_rng(8)
    category = rng.integers(0, 4, 4000)
    x = np.concatenate([rng.uniform(-1.8, 1.8, (4000, 2)), np.eye(4)[category]], axis=1)
    order, edges = knn._leaves(x)
    assert sorted(order) == list(range(4000)) and edges[-1] == 4000
    sizes = np.diff(edges)
    assert sizes.min() > 0 and sizes.max() <= knn.LEAF_ROWS
    assert all(len(set(category[order[a:b]])) == 1 for a, b in zip(edges[:-1], edges[1:]))
    equal, cuts = knn._leaves(np.ones((1000, 3)))  # nothing to cut at
    assert sorted(equal) == list(range(1000)) and np.diff(cuts).max() <= knn.LEAF_ROWS
    asked = x[:300] + rng.normal(0, 0.01, (300, 6))
    row, point, d2 = knn.nearest_points(asked, x, 5)
    every = knn.squared_distances(asked, x)
    near = np.argsort(every, axis=1, kind="stable")[:, :5]
    assert (point.reshape(300, 5) == near).all() and (row == np.repeat(np.arange(300), 5)).all()
    assert (d2.reshape(300, 5) == np.take_along_axis(every, near, axis=1)).all()


def test_silhouette_equals_the_definition(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (30, 2)), rng.normal(4, 1, (25, 2)), [[20.0, 20.0]]])
    c = np.array([0] * 30 + [1] * 25 + [2])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    expected = []
    for i in range(len(x)):
        same = (c == c[i]).sum()
        a = d[i][c == c[i]].sum() / max(same - 1, 1)
        b = min(d[i][c == k].mean() for k in set(c) - {c[i]})
        expected.append(0.0 if same == 1 else (b - a) / max(a, b))
    df = spark.createDataFrame([(i, int(k), [float(v) for v in p]) for i, (k, p) in enumerate(zip(c, x))], "id long, cluster int, x array<double>")
    got = {r.id: r.s for r in cluster.silhouette_points(df, "id").collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(expected)


def test_permutation_moves_values_without_changing_them(spark):
    df = spark.range(500).select(
        F.col("id"), F.col("id").cast("double").alias("a"), F.concat(F.lit("t"), F.col("id") % 7).alias("b"), (F.col("id") % 2).cast("string").alias("y")
    )
    copies = importance.permuted_copies(df, "id", ["a", "b"], 2, 42, keep=["y"]).collect()
    assert len(copies) == 500 * 4
    for feature, repeat in (("a", 0), ("a", 1), ("b", 0)):
        part = [r for r in copies if r.feature == feature and r["repeat"] == repeat]
        values = sorted(getattr(r, feature) for r in part)
        assert values == sorted(float(i) if feature == "a" else f"t{i % 7}" for i in range(500))
        other = "b" if feature == "a" else "a"
        assert all(getattr(r, other) == (f"t{r.id % 7}" if other == "b" else float(r.id)) for r in part)
    moved = {r.id: r.a for r in copies if r.feature == "a" and r["repeat"] == 0}
    assert sum(moved[i] != i for i in range(500)) > 450


def test_importance_is_zero_for_unused_columns(spark):
    df = spark.range(400).select(
        F.col("id"), (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
        F.when(F.col("id") % 2 == 0, "Low").otherwise("High").alias("y"),
    )
    result = importance.permutation_importance(
        df, lambda rows: rows.withColumn("predicted", F.when(F.col("a") == 0, "Low").otherwise("High")), "id", "y", ["a", "b"], LABELS, repeats=3
    )
    got = {r.feature: r for r in result.collect()}
    assert got["b"].importance == 0 and got["b"]["std"] == 0 and 0.3 < got["a"].importance < 0.7


def test_neighbours_do_not_depend_on_ids(spark):
    """Repeated and null query ids: every row keeps its own neighbours, and no row is lost."""
    train = spark.createDataFrame([(i, [float(i)], "A" if i < 50 else "B") for i in range(100)], "id long, x array<double>, label string")
    asked = [("r1", [1.0]), ("r1", [99.0]), (None, [2.0]), ("r2", [98.0]), (None, [97.0]), ("r3", [97.0])]
    queries = spark.createDataFrame(asked, "rid string, x array<double>")
    got = knn.with_neighbors(queries, train, 3, train_id="id", label="label").withColumns(knn.vote("neighbors", 3, "uniform", ["A", "B"]))
    rows = sorted((r.rid or "", r.x[0], r.predicted) for r in got.collect())
    assert rows == sorted((i or "", x[0], "A" if x[0] < 50 else "B") for i, x in asked)
