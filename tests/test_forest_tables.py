"""Forests of all rows, as tables: no cap, the same trees and labels however large the table and the forest are."""

import numpy as np
import pytest
from conftest import frame, training_rows
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from profilespark.contract import SURVEY
from profilespark.operators import classify, features, forest

CLASSES = tuple(sorted(SURVEY.labels))
SETTINGS = [(leaf, trees, depth) for leaf in (1, 3) for trees in (4, 10) for depth in (None, 3)]


@pytest.fixture(scope="module")
def noisy(spark):
    """The separable rows with every fifth label moved on, as (id, label, vector)."""
    rows = training_rows(300)
    for i in range(0, 300, 5):
        rows[i]["Stress_Level"] = SURVEY.labels[(i + 1) % 4]
    df = frame(spark, *rows).withColumn("row_id", F.monotonically_increasing_id())
    prep = features.fit_preparation(df, SURVEY)
    return prep.transform(df, SURVEY).select("row_id", "Stress_Level", "features").cache()


def sampled(rows):
    return forest.sample(rows, "Stress_Level", "row_id", CLASSES, 42)


def numbers(spark, n):
    value = F.col("id").cast("double")
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"),
                                 array_to_vector(F.array(F.floor(value / 7).cast("double"), value % 4, F.lit(1.0))).alias("features"))


def test_every_labelled_row_is_in_the_sample(spark):
    rows = numbers(spark, 12_345)
    unlabelled = rows.limit(5).withColumn("y", F.lit(None).cast("string"))
    data = forest.sample(rows.unionByName(unlabelled), "y", "id", ("a", "b"), 42)
    assert np.bincount(data.label).tolist() == [4115, 8230]
    one = forest.grow(data, 1, 0, 42)
    assert one["counts"][0].sum() == 12_345


def test_a_fitted_forest_is_grown_on_every_row(spark):
    model = classify.fit_forest({"min_samples_leaf": 1, "n_estimators": 2, "max_depth": 3}, numbers(spark, 12_345), ("a", "b"), target="y", row_id="id", seed=42)
    assert model.counts[model.roots].sum(axis=1).tolist() == [12_345, 12_345]


def test_edges_are_those_of_all_values(spark):
    x = F.array((F.col("id") * F.col("id") % 1009).cast("double"), (F.col("id") % 4).cast("double"), F.lit(1.0))
    n, found = forest.column_edges(spark.range(5000).select(x.alias("x")), 3)
    values = (np.arange(5000) ** 2 % 1009).astype(float)
    wanted = np.unique(np.quantile(values, np.linspace(0, 1, forest.BINS), method="nearest"))
    assert n == 5000
    assert [e.tolist() for e in found] == [((wanted[1:] + wanted[:-1]) / 2).tolist(), [0.5, 1.5, 2.5], []]


def test_trees_of_a_spread_table_are_the_same(spark, noisy, monkeypatch):
    here = sampled(noisy)
    monkeypatch.setattr(forest, "SHARED_CELLS", 0)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 50)
    try:
        spread = sampled(noisy.repartition(5))
    finally:
        spark.conf.set(batch, before)
    assert isinstance(spread, forest.Spread) and spread.blocks.count() > 1
    first, second = (forest.fit_trees(spark, data, [1, 3], 6, 42).orderBy("leaf", "tree").collect() for data in (here, spread))
    assert len(first) == 12 and first == second


def test_trees_and_points_meet_in_tasks(spark, noisy, monkeypatch):
    rows = forest.fit_trees(spark, sampled(noisy), [1, 3], 10, 42).localCheckpoint()
    asked = noisy.unionByName(noisy.limit(3))  # equal rows stay rows of their own
    here = forest.by_leaf(rows, CLASSES)
    labels = forest.setting_labels(asked, here, SETTINGS, "features", "at").orderBy("row_id").collect()
    shares = forest.score(asked, here[3], "features", "p").orderBy("row_id").collect()
    monkeypatch.setattr(forest, "SHARED_NODES", 0)
    monkeypatch.setattr(forest, "GROUP_NODES", 100)
    monkeypatch.setattr(forest, "POINT_ROWS", 32)
    monkeypatch.setattr(forest, "GROUP_SUMS", 1000)
    table = forest.by_leaf(rows, CLASSES)
    assert isinstance(table, forest.TreeTable)
    assert forest.setting_labels(asked, table, SETTINGS, "features", "at").orderBy("row_id").collect() == labels
    table = forest.of_trees(rows.filter("leaf = 3"), CLASSES)
    assert forest.score(asked, table, "features", "p").orderBy("row_id").collect() == shares
    assert len(shares) == 303


def test_a_table_of_trees_is_saved_and_loaded(spark, noisy, monkeypatch, tmp_path):
    monkeypatch.setattr(forest, "SHARED_NODES", 0)
    parameters = {"min_samples_leaf": 3, "n_estimators": 5, "max_depth": 4}
    model = classify.fit(classify.FOREST, parameters, noisy, 300, CLASSES, target="Stress_Level", row_id="row_id")
    classify.save_model(model, str(tmp_path / "m"), spark)
    again = classify.load_model(spark, classify.FOREST, parameters, CLASSES, str(tmp_path / "m"), "row_id", 42)
    assert isinstance(model.model, forest.TreeTable) and isinstance(again.model, forest.TreeTable)
    first, second = (m.score(noisy).orderBy("row_id").collect() for m in (model, again))
    assert first == second and len(first) == 300
    right = sum(r.predicted == r.Stress_Level for r in first)
    assert right > 200
