"""Fitted models: no SQL form, so rows only here and property checks in the tests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import query
from catalog.features import sql_train
from catalog.neighbours import embeddings
from catalog.profiling import rounded
from catalog.splitting import survey_parts
from catalog.tables import SURVEY_ROWS, survey
from profilespark.operators import classify, cluster, features, quality
from profilespark.operators.evaluate import classification_metrics
from profilespark.plans import external, select_model, train
from profilespark.session import ensure_checkpoint_dir, materialize
from profilespark.sources.bundle import Bundle
from profilespark.streaming.score_stream import score_requests, score_stream

#: where the bundle of a session and a table lies; the training run is made once
_BUNDLES: dict[tuple[str, str], str] = {}


def vectors(spark, sf_dir, columns=None):
    """(parts with a feature vector, preparation), learned on the training rows."""
    parts = materialize(survey_parts(spark, sf_dir))
    prep = features.fit_preparation(parts.filter("split = 'train'"), SURVEY_ROWS, columns)
    # fits and evaluations both read the vectors, so they are written once
    rows = prep.transform(parts, SURVEY_ROWS).select("row_id", "split", "Stress_Level", "features")
    return materialize(rows), prep


def trained(spark, sf_dir) -> Bundle:
    """The bundle of the whole training run (search over the full grid, k of 2 to 6, importance), loaded from where the first query saved it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUNDLES:
        path = f"{ensure_checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
        train.train(survey(spark, sf_dir), SURVEY_ROWS).save(path)
        _BUNDLES[key] = path
    return Bundle.load(spark, _BUNDLES[key])


@query("kmeans_sweep")
def kmeans_sweep(spark, sf_dir):
    """k = 2..6 with ten restarts each: inertia, silhouette over all rows, the k chosen on it, and the silhouette of a sample."""
    rows, _ = vectors(spark, sf_dir, SURVEY_ROWS.model_numeric)
    scores, _ = cluster.kmeans_sweep(rows.filter("split = 'train'"), "row_id")
    chosen = cluster.best_k(scores)
    return spark.createDataFrame(
        [(s["k"], s["inertia"], s["silhouette"], s["k"] == chosen, s["silhouette_sampled"]) for s in scores],
        "k int, inertia double, silhouette double, chosen boolean, silhouette_sampled double",
    )


_NUM = SURVEY_ROWS.model_numeric
_SCALED = (
    f"{sql_train()}, scaled as (select row_id, Stress_Level, "
    + ", ".join(f"(coalesce({c}, m.med_{c}) - mean_{c}) / std_{c} as z{i}" for i, c in enumerate(_NUM)) + " from train, params)"
)
#: the covariance matrix is squared so often: its first column is the first component then
SQUARINGS = 16


def _component_sql(name: str, matrix: str) -> str:
    """CTE `name` (i, v, value): the first component of a matrix table (i, j, v), largest loading positive, and its eigenvalue."""
    ctes, last = [], matrix
    for k in range(SQUARINGS):
        product = f"select a.i, b.j, sum(a.v * b.v) as v from {last} a join {last} b on a.j = b.i group by 1, 2"
        ctes.append(f"{name}_{k} as materialized (select i, j, v / max(abs(v)) over () as v from ({product}))")
        last = f"{name}_{k}"
    ctes.append(f"{name}_c as materialized (select i, v / sqrt(sum(v * v) over ()) as v from {last} where j = (select i from {last} where i = j order by v desc, i limit 1))")
    ctes.append(
        f"{name} as materialized (select c.i, c.v * (select sign(v) from {name}_c order by abs(v) desc, i limit 1) as v, "
        f"(select sum(x.v * m.v * y.v) from {matrix} m join {name}_c x on x.i = m.i join {name}_c y on y.i = m.j) as value from {name}_c c)"
    )
    return ", ".join(ctes)


@query(
    "pca_2d",
    f"{_SCALED}, covariance as materialized ("
    + " union all ".join(f"select {i} as i, {j} as j, covar_samp(z{i}, z{j}) as v from scaled" for i in range(len(_NUM)) for j in range(len(_NUM)))
    + f"), {_component_sql('first', 'covariance')}, rest as materialized (select m.i, m.j, m.v - x.value * x.v * y.v as v from covariance m "
    f"join first x on x.i = m.i join first y on y.i = m.j), {_component_sql('second', 'rest')} select row_id, "
    + ", ".join(
        "round(" + " + ".join(f"z{i} * (select v from {name} where i = {i})" for i in range(len(_NUM))) + f", 4) as {column}"
        for name, column in (("first", "PC1"), ("second", "PC2"))
    )
    + " from scaled",
)
def pca_2d(spark, sf_dir):
    """Coordinates of the training rows on two components; the oracle finds these by squaring the covariance matrix."""
    parts = materialize(survey_parts(spark, sf_dir)).filter("split = 'train'")
    prep = features.fit_preparation(parts, SURVEY_ROWS, _NUM)
    components, explained = cluster.pca(prep.transform(parts, SURVEY_ROWS))
    zero = [[0.0] * len(prep.numeric)]
    model = cluster.ClusterModel(prep, prep.numeric, zero, {}, 1, [], components, explained)
    return rounded(model.coordinates(parts, SURVEY_ROWS).select("row_id", "PC1", "PC2"), 4)


#: a strong penalty, so that plain gradient steps reach the optimum too
STRONG = 0.001
GRADIENT_STEPS, STEP_SIZE = 500, 0.5
_CLASSES = tuple(sorted(SURVEY_ROWS.labels))


def _gradient_sql() -> str:
    """Multinomial logistic regression from zero by gradient steps, one recursion step for each."""
    places = [(c, f) for c in range(len(_CLASSES)) for f in range(-1, len(_NUM))]

    def x(f: int) -> str:
        return "1.0" if f < 0 else f"z{f}"

    def w(c: int, f: int) -> str:
        return f"w{c}_{f + 1}"

    start = ", ".join(f"0.0::double as {w(c, f)}" for c, f in places)
    logits = ", ".join("exp(" + " + ".join(f"{w(c, f)} * {x(f)}" for f in range(-1, len(_NUM))) + f") as e{c}" for c in range(len(_CLASSES)))
    total = " + ".join(f"e{c}" for c in range(len(_CLASSES)))
    steps = ", ".join(
        f"any_value({w(c, f)}) - {STEP_SIZE} * (avg((e{c} / ({total}) - case when Stress_Level = '{name}' then 1 else 0 end) * {x(f)})"
        + ("" if f < 0 else f" + any_value({w(c, f)}) / ({STRONG} * count(*))") + ")"
        for c, name in enumerate(_CLASSES) for f in range(-1, len(_NUM))
    )
    rows = " union all ".join(
        f"select '{name}' as label, '{'(intercept)' if f < 0 else _NUM[f]}' as feature, round({w(c, f)}, 4) as weight from last"
        for c, name in enumerate(_CLASSES) for f in range(-1, len(_NUM))
    )
    return (
        _SCALED.replace("with ", "with recursive ", 1)
        + f", descent as (select 0 as step, {start} union all select step + 1, {steps} from (select d.*, s.*, {logits} from descent d, scaled s "
        f"where step < {GRADIENT_STEPS}) group by step), last as (select * from descent where step = {GRADIENT_STEPS}) {rows}"
    )


@query("logreg_weights", _gradient_sql())
def logreg_weights(spark, sf_dir):
    """Weights of a strongly penalised fit on the scaled numbers; the oracle takes gradient steps of the same loss."""
    rows, prep = vectors(spark, sf_dir, _NUM)
    train_rows = rows.filter("split = 'train'").drop("split")
    fitted = classify.fit(
        classify.LOGISTIC, {"C": STRONG}, train_rows, train_rows.count(), _CLASSES, target="Stress_Level", row_id="row_id", tol=1e-12)
    weights, intercepts = fitted.model.coefficientMatrix.toArray(), fitted.model.interceptVector.toArray()
    found = [
        (name, feature, float(w)) for c, name in enumerate(_CLASSES)
        for feature, w in zip(("(intercept)", *prep.numeric), (intercepts[c], *weights[c]))
    ]
    return rounded(spark.createDataFrame(found, "label string, feature string, weight double"), 4)


def _fit_and_evaluate(spark, sf_dir, kind, parameters):
    rows, _ = vectors(spark, sf_dir)
    fit_rows = rows.filter("split = 'train'").drop("split")
    model = classify.fit(
        kind, parameters, fit_rows, fit_rows.count(), SURVEY_ROWS.labels, target="Stress_Level", row_id="row_id"
    )
    test = rows.filter("split = 'test'").withColumn("actual", F.col("Stress_Level"))
    scored = model.score(test).withColumn("model", F.lit(kind))
    return rounded(classification_metrics(scored, SURVEY_ROWS.labels, sorted(SURVEY_ROWS.labels), ["model"]))


@query("logreg")
def logreg(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, classify.LOGISTIC, {"C": 1.0})


@query("random_forest")
def random_forest(spark, sf_dir):
    return _fit_and_evaluate(
        spark, sf_dir, classify.FOREST, {"n_estimators": 100, "max_depth": 12, "min_samples_leaf": 3}
    )


@query("knn_survey")
def knn_survey(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, classify.KNN, {"n_neighbors": 5, "weights": "uniform"})


@query("grid_search_knn_logreg")
def grid_search(spark, sf_dir):
    """All eight neighbour settings and all three penalties over three folds."""
    parts = materialize(survey_parts(spark, sf_dir))
    grid = {k: classify.GRID[k] for k in (classify.KNN, classify.LOGISTIC)}
    result = select_model.train_classifiers(
        parts.filter("split = 'train'").drop("split"), parts.filter("split = 'val'").drop("split"), SURVEY_ROWS, grid=grid
    )
    return rounded(result.cv_results)


@query("model_selection")
def model_selection(spark, sf_dir):
    """The whole search: 19 settings over three folds, refit, and the choice by validation."""
    return rounded(trained(spark, sf_dir).tables["selection"].drop("fit_seconds"))


@query("cv_results")
def cv_results(spark, sf_dir):
    """Mean, deviation and rank of each of the 19 settings."""
    return rounded(trained(spark, sf_dir).tables["cv_results"])


@query("evaluate_holdout")
def evaluate_holdout(spark, sf_dir):
    """Test metrics of the three models and the baseline."""
    return rounded(trained(spark, sf_dir).tables["metrics"])


@query("evaluate_table")
def evaluate_table(spark, sf_dir):
    """Lenient evaluation: the raw table is prepared first."""
    return rounded(train.evaluate_table(trained(spark, sf_dir), survey(spark, sf_dir))["metrics"])


def _valid_rows(spark, sf_dir):
    """Survey rows without missing or impossible cells, as an external table would hold them."""
    rows = survey(spark, sf_dir)
    cleaned = quality.clean_features(rows, SURVEY_ROWS, keep=["row_id", "Stress_Level"])
    complete = F.lit(True)
    for c in (*SURVEY_ROWS.features, "Stress_Level"):
        complete = complete & F.col(c).isNotNull()
    return cleaned.filter(complete & (F.col("Stress_Level") != ""))


@query("external_evaluation")
def external_evaluation(spark, sf_dir):
    """Strict validation, the primary model only, metrics overall and by age group."""
    result = external.evaluate_external(trained(spark, sf_dir), _valid_rows(spark, sf_dir))
    return rounded(result["metrics_by_group"])


@query("global_importance")
def global_importance(spark, sf_dir):
    """Importance of the columns for the chosen, tuned model."""
    return rounded(trained(spark, sf_dir).tables["importance"])


@query("score_requests")
def score_batch(spark, sf_dir):
    """Every survey row as a JSON request: scored, or quarantined with its codes."""
    scored, refused = score_requests(trained(spark, sf_dir), _requests(spark, sf_dir))
    done = scored.select(
        "request_id", "label", "agreement", F.col("cluster.id").alias("cluster"), F.size("notes").alias("notes"),
        F.size("recommendations.items").alias("items"), F.lit("").alias("codes"),
    )
    nothing = [F.lit(None).cast(t).alias(n) for n, t in done.dtypes[1:-1]]
    return done.unionByName(refused.select("request_id", *nothing, F.array_join("error_codes", ",").alias("codes")))


def _requests(spark, sf_dir):
    rows = _valid_rows(spark, sf_dir)
    typed = [F.col(c).cast("int").alias(c) if c in SURVEY_ROWS.integers else F.col(c) for c in SURVEY_ROWS.features]
    # some requests carry a forbidden key
    score = F.when(F.col("row_id") % 9 == 0, F.lit(5)).alias("Mental_Health_Score")
    return rows.select(F.col("row_id").cast("string").alias("request_id"), F.to_json(F.struct(*typed, score)).alias("payload"))


@query("score_stream")
def stream(spark, sf_dir):
    """The same requests through a file stream; the result is the stream's own output table."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    _requests(spark, sf_dir).write.json(f"{base}/in")
    started = score_stream(spark, trained(spark, sf_dir), f"{base}/in", f"{base}/out", f"{base}/progress")
    started.awaitTermination()
    if started.exception():
        raise started.exception()
    scored = spark.read.parquet(f"{base}/out/scored")
    refused = spark.read.parquet(f"{base}/out/quarantine")
    return scored.select("request_id", "label", F.lit(True).alias("accepted")).unionByName(
        refused.select("request_id", F.lit(None).cast("string").alias("label"), F.lit(False).alias("accepted"))
    )


@query("embedding_kmeans")
def embedding_kmeans(spark, sf_dir):
    """The sweep on 64 columns."""
    from pyspark.ml.functions import array_to_vector

    rows = materialize(embeddings(spark, sf_dir).withColumn("features", array_to_vector("x")).select("vec_id", "features"))
    scores, _ = cluster.kmeans_sweep(rows, "vec_id")
    return spark.createDataFrame(
        [(s["k"], s["inertia"], s["silhouette"], s["silhouette_sampled"]) for s in scores],
        "k int, inertia double, silhouette double, silhouette_sampled double",
    )
