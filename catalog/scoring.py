"""A saved bundle whose answers SQL can work out too: five neighbours, the majority baseline, and three fixed cluster centres."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import query
from catalog.evaluation import sql_auc, sql_matrix, sql_scalars
from catalog.features import sql_train
from catalog.models import _requests, _valid_rows, trained
from catalog.neighbours import FIXED
from catalog.profiling import rounded
from catalog.splitting import survey_parts
from catalog.tables import SURVEY_RAW_CTE, SURVEY_ROWS, sql_clean_cte, sql_strip, survey
from profilespark.contract import AGE_EDGES, AGE_GROUPS
from profilespark.operators import classify, cluster, dictionary, features, stats
from profilespark.operators.baseline import majority_label
from profilespark.plans import external, train
from profilespark.plans.select_model import score_models
from profilespark.session import ensure_checkpoint_dir, materialize
from profilespark.sources.bundle import ARTIFACT_VERSION, Bundle
from profilespark.streaming.score_stream import score_requests, score_stream

LABELS = tuple(sorted(SURVEY_ROWS.labels))
_NUM, _CAT = SURVEY_ROWS.model_numeric, SURVEY_ROWS.categorical
K = 5


#: where the bundle of a session and a table lies
_PATHS: dict[tuple[str, str], str] = {}


def neighbour_bundle(spark, sf_dir) -> Bundle:
    """Fitted on the training rows and saved by the first query of a session, and loaded by each."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PATHS:
        _PATHS[key] = _fitted(spark, sf_dir)
    return Bundle.load(spark, _PATHS[key])


def _fitted(spark, sf_dir) -> str:
    train_rows = materialize(survey_parts(spark, sf_dir).filter("split = 'train'"))
    prep = features.fit_preparation(train_rows, SURVEY_ROWS)
    vectors = prep.transform(train_rows, SURVEY_ROWS).select("row_id", "Stress_Level", "features")
    model = classify.fit(
        classify.KNN, {"n_neighbors": K, "weights": "uniform"}, vectors, train_rows.count(), LABELS, target="Stress_Level", row_id="row_id")
    baseline = classify.FittedModel(classify.BASELINE, LABELS, {"label": majority_label(train_rows, SURVEY_ROWS)}, row_id="row_id")
    centers = spark.createDataFrame(
        [(k, j, c, center[j]) for k, center in enumerate(FIXED) for j, c in enumerate(_NUM)], "cluster int, position int, column string, value double")
    said = {str(r.cluster): r.description for r in cluster.cluster_traits(centers, SURVEY_ROWS).collect()}
    clusters = cluster.ClusterModel(features.fit_preparation(train_rows, SURVEY_ROWS, _NUM), _NUM, FIXED, said, 3, [], [], [])
    known = dictionary.build(train_rows, _CAT)
    metadata = {
        "artifact_version": ARTIFACT_VERSION, "primary_model": classify.KNN, "category_sizes": known.sizes,
        "medians": {r["column"]: r["median"] for r in stats.medians(train_rows, SURVEY_ROWS.numeric).collect()},
        "training_ranges": {r["column"]: [r.low, r.high] for r in stats.ranges(train_rows, SURVEY_ROWS.numeric).collect()},
    }
    path = f"{ensure_checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    Bundle(SURVEY_ROWS, prep, {classify.KNN: model}, baseline, clusters, metadata, {"categories": known.table}).save(path)
    return path


def _answers_sql(asked: str) -> str:
    """CTE `winner` (row_id, actual, label, share, place) for the rows of a CTE `asked`, which has the survey's clean columns."""
    z = ", ".join(f"(coalesce({c}, m.med_{c}) - mean_{c}) / std_{c} as z{i}" for i, c in enumerate(_NUM))
    g = ", ".join(f"coalesce({c}, mode_{c}) as g{i}" for i, c in enumerate(_CAT))
    seen = ", ".join(f"coalesce({c}, mode_{c}) in (select {c} from train where {c} is not null) as s{i}" for i, c in enumerate(_CAT))
    apart = " + ".join(f"(q.z{i} - t.z{i}) * (q.z{i} - t.z{i})" for i in range(len(_NUM)))
    apart += "".join(f" + case when q.g{i} = t.g{i} then 0 when q.s{i} then 2 else 1 end" for i in range(len(_CAT)))
    return (
        f"t as materialized (select row_id, Stress_Level as label, {z}, {g} from train, params), "
        f"q as materialized (select row_id, Stress_Level as actual, {z}, {g}, {seen} from {asked}, params), "
        f"near as (select row_id, actual, unnest(labels) as label from (select q.row_id, any_value(q.actual) as actual, "
        f"arg_min(t.label, struct_pack(d := round({apart}, 9), i := t.row_id), {K}) as labels from q, t group by q.row_id)), "
        f"votes as (select row_id, any_value(actual) as actual, label, count(*) / {float(K)} as share from near group by row_id, label), "
        "winner as materialized (select *, row_number() over (partition by row_id order by share desc, label) as place from votes)"
    )


_NAMES = ", ".join(f"('{c}')" for c in LABELS)
_TEST = f"{sql_train()}, test as (select * from parts where split = 'test'), {_answers_sql('test')}"
_SCORED = (
    "answers as (select w.row_id, w.actual, w.label as predicted, "
    + ", ".join(f"coalesce((select share from votes v where v.row_id = w.row_id and v.label = '{c}'), 0.0) as \"p_{c}\"" for c in LABELS)
    + " from winner w where place = 1), major as (select Stress_Level as m from train group by 1 order by count(*) desc, 1 limit 1), "
    "scored as (select 'KNN' as model, * from answers union all select 'Majority baseline', row_id, actual, m, "
    + ", ".join(f"case when m = '{c}' then 1.0 else 0.0 end" for c in LABELS) + " from answers, major)"
)


@query(
    "holdout_of_neighbours",
    f"{_TEST}, {_SCORED}, {sql_matrix(labels=SURVEY_ROWS.labels)}, " + sql_auc(labels=LABELS, score=lambda c: f'"p_{c}"')
    + f", s as ({sql_scalars()}), a as (select model, round(avg(auc), 6) as roc_auc_ovr_macro from areas group by 1) "
    "select s.*, a.roc_auc_ovr_macro from s join a using (model)",
)
def holdout_of_neighbours(spark, sf_dir):
    """Test metrics of the bundle's model and of the baseline."""
    bundle = neighbour_bundle(spark, sf_dir)
    vectors = bundle.vectors(survey_parts(spark, sf_dir).filter("split = 'test'")).select("row_id", "Stress_Level", "features")
    long = materialize(score_models(vectors, {**bundle.models, classify.BASELINE: bundle.baseline}, "row_id").drop("features"))
    return rounded(train.metric_tables(long, SURVEY_ROWS, "Stress_Level")["metrics"])


_FIXED_ROWS = ", ".join(
    f"({k}, {j}, '{SURVEY_ROWS.display(c)}', {center[j]}, abs({center[j]}))" for k, center in enumerate(FIXED) for j, c in enumerate(_NUM))
_VALID = (
    f"{SURVEY_RAW_CTE}, {sql_clean_cte(SURVEY_ROWS, 'survey', 'cleaned', f'row_id, nullif({sql_strip(SURVEY_ROWS.target)}, chr(0)) as Stress_Level')}, "
    "valid as (select * from cleaned where " + " and ".join(f"{c} is not null" for c in SURVEY_ROWS.features) + " and Stress_Level is not null and Stress_Level <> '')"
)


def _with_valid(sql: str) -> str:
    """The CTEs of valid rows behind those of `sql`, whose raw survey they share."""
    return f"{sql}, {_VALID[_VALID.index('cleaned as'):]}"


@query(
    "score_of_neighbours",
    f"{_with_valid(sql_train())}, asked as (select * from valid where row_id % 9 <> 0), {_answers_sql('asked')}, "
    + "sides as (select row_id, " + ", ".join("+".join(f"(z{i} - ({v})) * (z{i} - ({v}))" for i, v in enumerate(c)) + f" as d{k}" for k, c in enumerate(FIXED))
    + f" from q), centers(cluster, position, name, v, size) as (values {_FIXED_ROWS}), "
    "top as (select *, row_number() over (partition by cluster order by size desc, position) as rk from centers), "
    "said as (select cluster, string_agg(name || case when v >= 0 then ': above' else ': below' end || ' training average', '; ' order by rk) as description from top where rk <= 2 group by 1) "
    "select cast(w.row_id as varchar) as request_id, w.label, round(w.share, 6) as probability, said.cluster as cluster, said.description "
    "from winner w join sides using (row_id) join said on said.cluster = case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end where place = 1",
)
def score_of_neighbours(spark, sf_dir):
    """Every valid survey row as a JSON request: label, its probability, cluster and the cluster's text."""
    scored, _ = score_requests(neighbour_bundle(spark, sf_dir), _requests(spark, sf_dir))
    return rounded(scored.select(
        "request_id", "label", F.element_at("probabilities", F.col("label")).alias("probability"),
        F.col("cluster.id").alias("cluster"), F.col("cluster.description").alias("description"),
    ))


_GROUP = "case " + " ".join(
    f"when Age {'>=' if i == 0 else '>'} {a} and Age <= {b} then '{name}'" for i, (a, b, name) in enumerate(zip(AGE_EDGES, AGE_EDGES[1:], AGE_GROUPS))) + " end"


@query(
    "external_of_neighbours",
    f"{_with_valid(sql_train())}, {_answers_sql('valid')}, scored as (select unnest(['all', {_GROUP}]) as \"group\", w.actual, w.label as predicted "
    f"from winner w join valid using (row_id) where place = 1), {sql_matrix(by='\"group\"', labels=SURVEY_ROWS.labels)} "
    + sql_scalars(by='"group"', label_set="contract"),
)
def external_of_neighbours(spark, sf_dir):
    """Strict validation, the bundle's primary model, metrics overall and by age group."""
    return rounded(external.evaluate_external(neighbour_bundle(spark, sf_dir), _valid_rows(spark, sf_dir))["metrics_by_group"])


@query(
    "table_of_neighbours",
    f"{sql_train()}, {_answers_sql('prepared')}, scored as (select 'KNN' as model, actual, label as predicted from winner where place = 1), "
    f"{sql_matrix(labels=SURVEY_ROWS.labels)} select * from grid",
)
def table_of_neighbours(spark, sf_dir):
    """Lenient evaluation of the raw table: it is prepared first; confusion counts of the model."""
    tables = train.evaluate_table(neighbour_bundle(spark, sf_dir), survey(spark, sf_dir))
    return tables["confusion"].filter(F.col("model") == classify.KNN)


@query("stream_acceptance", f"with {_VALID} select cast(row_id as varchar) as request_id, row_id % 9 <> 0 as accepted from valid")
def stream_acceptance(spark, sf_dir):
    """Which requests a file stream scores and which it refuses."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    _requests(spark, sf_dir).write.json(f"{base}/in")
    started = score_stream(spark, neighbour_bundle(spark, sf_dir), f"{base}/in", f"{base}/out", f"{base}/progress")
    started.awaitTermination()
    if started.exception():
        raise started.exception()
    parts = [spark.read.parquet(f"{base}/out/{name}").select("request_id", F.lit(ok).alias("accepted")) for name, ok in (("scored", True), ("quarantine", False))]
    return parts[0].unionByName(parts[1])


@query(
    "bundle_round_trip",
    f"with {_VALID} select model, (select count(*) from valid) as n, cast(0 as bigint) as different "
    f"from (values ('{classify.KNN}'), ('{classify.LOGISTIC}'), ('{classify.FOREST}')) v(model)",
)
def bundle_round_trip(spark, sf_dir):
    """Predictions of a saved and reloaded bundle beside those of the one it was saved from."""
    bundle = trained(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    bundle.save(path)
    loaded = Bundle.load(spark, path)
    rows = _valid_rows(spark, sf_dir).drop("Stress_Level")
    first = bundle.predict(rows).select("row_id", "model", F.col("predicted").alias("before"))
    second = loaded.predict(rows).select("row_id", "model", F.col("predicted").alias("after"))
    both = first.join(second, ["row_id", "model"])
    return both.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") != F.col("after")).alias("different"))
