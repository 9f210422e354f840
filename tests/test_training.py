"""End to end on the separable fixture: train, save, reload, score, evaluate, stream."""

import json

import numpy as np
import pytest
from conftest import frame, row, training_rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from profilespark.contract import SURVEY
from profilespark.operators import cluster, features
from profilespark.operators.classify import GRID, settings
from profilespark.plans import external, train
from profilespark.sources.bundle import Bundle
from profilespark.streaming.score_stream import score_requests, score_stream


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    df = frame(spark, *training_rows())
    bundle = train.train(df, SURVEY, quick=True, k_values=(2, 3), restarts=2, repeats=2)
    path = str(tmp_path_factory.mktemp("bundle"))
    bundle.save(path)
    return bundle, Bundle.load(spark, path), path


def payload(**changes):
    values = {k: v for k, v in row(**changes).items() if k not in ("Stress_Level", "Mental_Health_Score")}
    return {**values, "Age": int(values["Age"]), "Daily_Unlocks": int(values["Daily_Unlocks"]), **changes}


def test_grid_has_the_listed_settings():
    assert [len(settings(g)) for g in GRID.values()] == [8, 3, 8]
    assert settings(GRID["KNN"], quick=True) == [{"n_neighbors": 3, "weights": "uniform"}]


def test_result_tables(trained):
    bundle, _, _ = trained
    metrics = {r.model: r for r in bundle.tables["metrics"].collect()}
    assert len(metrics) == 4 and {r.n for r in metrics.values()} == {32}
    for name in ("KNN", "Logistic Regression", "Random Forest"):
        assert metrics[name].f1_macro > metrics["Majority baseline"].f1_macro
    assert metrics["Majority baseline"].roc_auc_ovr_macro == 0.5
    importance = {r.feature: r.importance for r in bundle.tables["importance"].collect()}
    assert importance["Age"] == 0.0 and set(importance) == set(SURVEY.features)
    ranks = [r["rank"] for r in bundle.tables["cv_results"].collect()]
    assert ranks == [1, 1, 1]
    assert bundle.metadata["split_sizes"] == {"train": 96, "val": 32, "test": 32}
    scores = {s["k"]: s["inertia"] for s in bundle.cluster.scores}
    assert scores[3] <= scores[2]
    assert json.dumps(bundle.metadata)


def test_saved_predictions_equal_direct_ones(spark, trained):
    bundle, loaded, _ = trained
    rows = frame(spark, *training_rows()[:24]).withColumn("row_id", F.col("Daily_Unlocks").cast("string"))
    first, second = (b.score_with_recommendations(rows.drop("Stress_Level")).orderBy("row_id").collect() for b in (bundle, loaded))
    assert first == second
    for r in first:
        assert sum(r.probabilities.values()) == pytest.approx(1) and set(r.probabilities) == set(SURVEY.labels)
        assert r.probabilities[r.label] == max(r.probabilities.values())
        assert len(r.models) == 3 and 1 <= r.agreement <= 3 and len(r.comparisons) == 6
        assert r.recommendations.predicted_risk == r.label
        assert r.recommendations.threshold_source == "training_split_quantiles"
        assert 1 <= len(r.recommendations["items"]) <= 6


def test_age_never_changes_the_label_and_unseen_values_are_noted(spark, trained):
    _, loaded, _ = trained
    base = row(Avg_Daily_Usage_Hours=5.6, Study_Hours=4.2, Physical_Activity_Hours=1.8, Sleep_Hours_Per_Night=5.6)
    df = frame(spark, *[{**base, "Age": a} for a in (15.0, 32.0, 72.0)], {**base, "Most_Used_Platform": "New platform"})
    out = loaded.score(df.drop("Stress_Level").withColumn("row_id", F.monotonically_increasing_id().cast("string"))).collect()
    assert len({r.label for r in out}) == 1
    assert all(any("age group is unverified" in n for n in r.notes) for r in out if r.Age > 24 or r.Age < 18)
    assert any("unseen" in n for r in out for n in r.notes if r.Most_Used_Platform == "New platform")


def test_bundle_gates(spark, trained, tmp_path):
    _, _, path = trained
    with pytest.raises(FileNotFoundError):
        Bundle.load(spark, str(tmp_path / "nothing"))
    document = json.loads(spark.read.text(f"{path}/metadata").first().value)

    def rewrite(name, content):
        target = tmp_path / name / "metadata"
        target.mkdir(parents=True)
        (target / "part-0.txt").write_text(json.dumps(content))
        return str(tmp_path / name)

    with pytest.raises(TypeError):
        Bundle.load(spark, rewrite("strange", [1]))
    with pytest.raises(ValueError, match="version"):
        Bundle.load(spark, rewrite("old", {**document, "artifact_version": 1}))


def test_missing_primary_model_is_refused(trained):
    bundle, _, _ = trained
    with pytest.raises(ValueError, match="missing from"):
        Bundle(bundle.contract, bundle.preparation, {}, None, None, {"primary_model": "KNN"}).primary
    with pytest.raises(ValueError, match="does not name"):
        Bundle(bundle.contract, bundle.preparation, bundle.models, None, None, {}).primary


def test_external_evaluation_by_age_group(spark, trained, tmp_path):
    _, loaded, _ = trained
    base = training_rows()
    df = frame(spark, *[{**base[i], "Age": a} for i, a in ((0, 15.0), (1, 32.0), (2, 72.0))])
    results = external.evaluate_external(loaded, df)
    groups = {r.group for r in results["metrics_by_group"].collect()}
    assert groups == {"all", "13-17", "25-34", "60-120"}
    assert results["metrics"].first().n == 3
    predictions = results["predictions"].collect()
    assert results["predictions"].columns[:2] == ["Age", "Age_Group"]
    for r in predictions:
        assert r.Correct == (r.Actual_Stress_Level == r.Predicted_Stress_Level)
        assert sum(r[f"Prob_{name}"] for name in SURVEY.labels) == pytest.approx(1)
    external.write_external(results, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "predictions")).count() == 3
    with pytest.raises(ValueError, match="Missing values"):
        external.evaluate_external(loaded, df.withColumn("Age", F.when(F.col("Age") > 15, F.col("Age"))))


def test_lenient_evaluation_prepares_first(spark, trained):
    bundle, _, _ = trained
    df = frame(spark, *training_rows(), *training_rows()[:5], row(Stress_Level=None))
    assert {r.n for r in train.evaluate_table(bundle, df)["metrics"].collect()} == {160}


def test_stream_output_equals_batch_output(spark, trained, tmp_path):
    _, loaded, _ = trained
    requests = [(f"r{i}", json.dumps(payload(**{k: r[k] for k in ("Avg_Daily_Usage_Hours", "Study_Hours", "Sleep_Hours_Per_Night")})))
                for i, r in enumerate(training_rows()[:12])]
    requests += [("bad1", json.dumps(payload(Age=12))), ("bad2", json.dumps({**payload(), "Mental_Health_Score": 8})), ("bad3", "{")]
    df = spark.createDataFrame(requests, "request_id string, payload string")
    df.repartition(3).write.json(str(tmp_path / "in"))
    query = score_stream(spark, loaded, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"), files_per_trigger=2)
    query.awaitTermination()
    assert query.exception() is None
    streamed = spark.read.parquet(str(tmp_path / "out" / "scored"))
    refused = spark.read.parquet(str(tmp_path / "out" / "quarantine"))
    scored, quarantined = score_requests(loaded, df)
    fields = ["request_id", "label", "agreement", "notes"]
    assert sorted(streamed.select(*fields).collect()) == sorted(scored.select(*fields).collect())
    codes = {r.request_id: list(r.error_codes) for r in refused.collect()}
    assert codes == {r.request_id: list(r.error_codes) for r in quarantined.collect()}
    assert codes == {"bad1": ["Age:range"], "bad2": ["Mental_Health_Score:extra"], "bad3": ["payload:malformed"]}


def test_pca_equals_eigen_decomposition(spark):
    df = frame(spark, *training_rows())
    columns = SURVEY.model_numeric
    prep = features.fit_preparation(df, SURVEY, columns)
    vectors = prep.transform(df, SURVEY)
    components, explained = cluster.pca(vectors)
    x = np.array([r[0] for r in vectors.select(vector_to_array("features")).collect()])
    values, axes = np.linalg.eigh(np.cov(x.T))
    assert explained == pytest.approx(list((values[::-1] / values.sum())[:2]))
    for i, component in enumerate(components):
        axis = axes[:, -1 - i]
        assert np.abs(np.dot(axis, component)) == pytest.approx(1, abs=1e-6)
        assert component[int(np.argmax(np.abs(component)))] > 0


def test_sweep_scores_every_row(spark):
    from pyspark.ml.functions import array_to_vector

    draw = np.random.default_rng(4)
    points = np.round(draw.normal(size=(1300, 2)) + 2.5 * draw.integers(0, 3, size=(1300, 1)), 3)
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, x array<double>")
    scores, centers = cluster.kmeans_sweep(rows.select("id", array_to_vector("x").alias("features")), "id", (2, 3), restarts=1)
    squared = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    for s in scores:
        near = ((points[:, None] - np.array(centers[s["k"]])[None]) ** 2).sum(axis=2).argmin(axis=1)
        sums = np.stack([squared[:, near == c].sum(axis=1) for c in range(s["k"])], axis=1)
        sizes, own = np.bincount(near), np.arange(len(points))
        a = sums[own, near] / (sizes[near] - 1)
        means = sums / sizes
        means[own, near] = np.inf
        b = means.min(axis=1)
        assert s["silhouette"] == pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-9)
        assert 0 < s["silhouette_sampled"] < 1
    assert cluster.best_k([{"k": 2, "silhouette": 0.1, "silhouette_sampled": 0.9}, {"k": 3, "silhouette": 0.2, "silhouette_sampled": 0.1}]) == 3
