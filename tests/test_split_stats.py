import math
import random

import numpy as np
import pytest
from conftest import frame, row, training_rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from profilespark.contract import SURVEY
from profilespark.operators import features, quality, split, stats
from profilespark.operators.ordered import exact_quantiles, global_rank, running_totals, seeded_hash

S = SURVEY.with_(row_id="row_id")


def test_quota_sizes():
    sizes = {"Low": 643, "Medium": 1293, "High": 1438, "Very High": 1619}
    quotas = split.split_quotas(sizes)
    total = {p: sum(q[p] for q in quotas.values()) for p in ("train", "val", "test")}
    assert total == {"train": 2995, "val": 999, "test": 999}
    for name, n in sizes.items():
        assert sum(quotas[name].values()) == n
    folds = split.fold_quotas({"a": 5, "b": 4}, 3)
    assert [sum(f) for f in zip(*folds.values())] == [3, 3, 3] and sum(folds["a"]) == 5


def test_split_is_disjoint_complete_and_stratified(spark):
    labels = SURVEY.labels * 30
    df = frame(spark, *[row(Daily_Unlocks=70.0 + i, Stress_Level=name) for i, name in enumerate(labels)])
    prepared = split.with_row_id(quality.prepare(df, SURVEY), SURVEY.features)
    parts = split.stratified_split(prepared, S)
    counts = {r.label: (r.train, r.val, r.test) for r in split.split_label_counts(parts, S).collect()}
    assert counts == {name: (18, 6, 6) for name in SURVEY.labels}
    assert {r.check: r.violations for r in split.split_checks(parts, prepared, S).collect()} == dict.fromkeys(
        ["row_in_two_parts", "row_without_part", "row_not_in_source", "profile_in_two_parts",
         "label_missing_in_part", "excluded_column_present"], 0)
    again = {r.row_id: r.split for r in split.stratified_split(prepared.repartition(7), S).collect()}
    assert again == {r.row_id: r.split for r in parts.collect()}
    folds = split.stratified_folds(parts.filter("split = 'train'"), S)
    assert {(r.Stress_Level, r.fold): r["count"] for r in folds.groupBy("Stress_Level", "fold").count().collect()} == {
        (name, f): 6 for name in SURVEY.labels for f in range(3)}


def test_small_classes_are_refused(spark):
    df = split.with_row_id(frame(spark, *[row(Daily_Unlocks=float(i)) for i in range(20)]), SURVEY.features)
    with pytest.raises(ValueError, match="at least 15"):
        split.stratified_split(df, S)


def test_empty_training_columns_are_named(spark):
    with pytest.raises(ValueError, match="Study_Hours"):
        split.require_usable_columns(frame(spark, row(Study_Hours=None)), SURVEY)


@pytest.mark.parametrize("kind", ["continuous", "lattice", "hot"])
def test_exact_quantiles_equal_numpy(spark, kind):
    rng = random.Random(5)
    groups = {}
    for g, n in (("a", 1), ("b", 7), ("c", 96), ("d", 5003)):
        groups[g] = [
            rng.gauss(0, 1) if kind == "continuous" else rng.randint(0, 9) / 10 if kind == "lattice"
            else 5.0 if rng.random() < 0.6 else rng.random() for _ in range(n)
        ]
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.probability): r.quantile for r in exact_quantiles(df, ["v"], shares, by=["g"], sketch=500).collect()}
    for g, vs in groups.items():
        for p in shares:
            assert math.isclose(got[(g, p)], np.percentile(vs, 100 * p), abs_tol=1e-12)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert {r["column"]: r["quantile"] for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()} == {"a": None, "b": 1.0}


def test_running_totals_and_global_rank(spark):
    rng = random.Random(3)
    values = sorted({rng.randint(0, 10**6) / 1000 for _ in range(4000)})
    df = spark.createDataFrame([("k", v, i % 3) for i, v in enumerate(values)], "k string, v double, n long")
    got = {r.v: r.before_n for r in running_totals(df, ["k"], "v", ["n"]).collect()}
    total = 0
    for i, v in enumerate(values):
        assert got[v] == total
        total += i % 3
    ranked = global_rank(df.withColumn("h", seeded_hash(1, "v")), ["k"], "h", "rank", 10**9).orderBy("h").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(values) + 1))


def test_thresholds(spark):
    df = spark.createDataFrame(
        [(4.0, 2.0, 50.0, 0.0, 1.0), (6.0, 4.0, 100.0, 1.0, 3.0), (8.0, 6.0, 150.0, 2.0, 5.0), (10.0, 8.0, 200.0, 3.0, 7.0)],
        "Sleep_Hours_Per_Night double, Avg_Daily_Usage_Hours double, Daily_Unlocks double, Physical_Activity_Hours double, Study_Hours double",
    )
    got = {(r["column"], r["threshold"]): r["value"] for r in stats.thresholds(df).collect()}
    assert got[("Sleep_Hours_Per_Night", "low")] == 5.5
    assert got[("Avg_Daily_Usage_Hours", "high")] == 6.5
    assert got[("Daily_Unlocks", "reference")] == 125


def test_histogram_keeps_empty_bins_and_constant_columns(spark):
    df = spark.createDataFrame([(0.0, 3.0), (10.0, 3.0), (10.0, 3.0), (None, 3.0)], "a double, b double")
    rows = stats.histogram(df, ["a", "b"], bins=20).collect()
    a = {r["bin"]: r["n"] for r in rows if r["column"] == "a"}
    assert len(a) == 20 and a[1] == 1 and a[20] == 2 and sum(a.values()) == 3
    b = {r["bin"]: r["n"] for r in rows if r["column"] == "b"}
    assert sum(b.values()) == 4 and b[11] == 4


def test_imputation_is_frozen_and_unseen_categories_are_zero(spark):
    train = frame(spark, row(Sleep_Hours_Per_Night=6.0), row(Sleep_Hours_Per_Night=8.0, Most_Used_Platform="YouTube"))
    prep = features.fit_preparation(train, SURVEY)
    assert prep.medians["Sleep_Hours_Per_Night"] == 7.0 and prep.stds["Age" if "Age" in prep.stds else "Study_Hours"] == 1.0
    new = frame(spark, row(Sleep_Hours_Per_Night=100.0, Most_Used_Platform="Unseen"))
    x = prep.transform(new, SURVEY).select(vector_to_array("features")).first()[0]
    named = dict(zip(prep.names, x))
    assert named["Sleep_Hours_Per_Night"] == 0.0
    assert named["Most_Used_Platform_Facebook"] == named["Most_Used_Platform_YouTube"] == 0.0
    assert features.matrix_check(prep.transform(new, SURVEY)).first().not_finite == 0
    again = features.Preparation.from_dict(prep.to_dict())
    assert again.transform(new, SURVEY).first().features == prep.transform(new, SURVEY).first().features


def test_age_has_no_effect_on_the_matrix(spark):
    train = frame(spark, row(Age=18.0), row(Age=24.0, Daily_Unlocks=150.0))
    prep = features.fit_preparation(train, SURVEY)
    out = prep.transform(frame(spark, row(Age=15.0), row(Age=72.0)), SURVEY).collect()
    assert out[0].features == out[1].features and "Age" not in prep.names


def test_population_scaling_and_mode_ties(spark):
    train = frame(spark, *[row(Study_Hours=float(v), Most_Used_Platform=p) for v, p in ((1, "b"), (2, "a"), (3, "b"), (6, "a"))])
    prep = features.fit_preparation(train, SURVEY)
    assert math.isclose(prep.stds["Study_Hours"], np.std([1, 2, 3, 6])) and prep.modes["Most_Used_Platform"] == "a"


def test_all_rows_of_the_training_fixture_are_distinct(spark):
    df = frame(spark, *training_rows())
    assert quality.prepare(df, SURVEY).count() == 160
    assert df.filter(F.col("Stress_Level") == "Low").count() == 40
