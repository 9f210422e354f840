"""Nearest neighbours and clustering against fixed centres, on the embeddings table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import query
from catalog.evaluation import sql_auc, sql_matrix, sql_scalars
from catalog.profiling import rounded
from catalog.tables import SURVEY_ROWS, sql_split_ctes, table
from profilespark.contract import Contract
from profilespark.operators import cluster, evaluate, features, kmeans, knn, split
from catalog.features import sql_train
from profilespark.session import ensure_checkpoint_dir
from catalog.splitting import survey_parts

CLASSES = tuple(str(i) for i in range(10))
#: rows for each pivot of the index of `knn_cells`
CELL_ROWS = 25
EMBEDDINGS = Contract("embeddings", (), (), "label", CLASSES, row_id="vec_id")


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), F.col("label").cast("string").alias("label")
    )


def embedding_parts(spark, sf_dir):
    return split.stratified_split(embeddings(spark, sf_dir), EMBEDDINGS)


_BASE = "prepared as (select vec_id, cast(embedding as double[]) as x, cast(label as varchar) as label from embeddings)"
_PARTS = f"with {_BASE}, {sql_split_ctes(EMBEDDINGS)}"
_NEAR = (
    f"{_PARTS}, q as (select * from parts where split <> 'train'), t as (select * from parts where split = 'train'), "
    "pairs as (select q.vec_id, q.label as actual, t.vec_id as id, t.label, "
    "round(list_sum(list_transform(list_zip(q.x, t.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) as d2 from q, t), "
    "near as (select *, row_number() over (partition by vec_id order by d2, id) as rk from pairs)"
)


def _votes(k: int, weights: str) -> str:
    weight = "1.0::double" if weights == "uniform" else (
        "case when min(d2) over (partition by vec_id) = 0 then case when d2 = 0 then 1.0 else 0.0 end else 1 / sqrt(d2) end"
    )
    return (
        f"{_NEAR}, w as (select vec_id, actual, label, {weight} as w from near where rk <= {k}), "
        "votes as (select vec_id, any_value(actual) as actual, label, sum(w) as v, round(sum(w) / sum(sum(w)) over (partition by vec_id), 12) as share from w group by vec_id, label), "
        "winner as (select *, row_number() over (partition by vec_id order by share desc, label) as place from votes)"
    )


def _neighbors(spark, sf_dir, k):
    parts = embedding_parts(spark, sf_dir)
    held, train = parts.filter("split <> 'train'"), parts.filter("split = 'train'")
    found = knn.neighbors(held, train, k, query_id="vec_id", train_id="vec_id", label="label")
    return held.select("vec_id", F.col("label").alias("actual")).join(found, "vec_id")


@query("knn_neighbors", f"{_NEAR} select vec_id, cast(rk as integer) as rank, id, label, round(d2, 6) as d2 from near where rk <= 9")
def knn_neighbors(spark, sf_dir):
    found = _neighbors(spark, sf_dir, 9)
    return rounded(found.select("vec_id", F.inline("neighbors")).select("vec_id", "rank", "id", "label", "d2"))


@query("knn_cells", f"{_NEAR} select vec_id, cast(rk as integer) as rank, id, label, round(d2, 6) as d2 from near where rk <= 9")
def knn_cells(spark, sf_dir):
    """The same neighbours from an index of many cells in groups, which is saved and loaded before it is searched."""
    parts = embedding_parts(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/neighbours-{uuid.uuid4().hex}"
    knn.build(parts.filter("split = 'train'"), 9, train_id="vec_id", label="label", block_rows=CELL_ROWS).save(path)
    found = knn.neighbors(parts.filter("split <> 'train'"), knn.NeighborIndex.load(spark, path), 9, query_id="vec_id")
    return rounded(found.select("vec_id", F.inline("neighbors")).select("vec_id", "rank", "id", "label", "d2"))


@query("knn_uniform", f"{_votes(5, 'uniform')} select vec_id, actual, label as predicted, round(share, 6) as probability from winner where place = 1")
def knn_uniform(spark, sf_dir):
    return _predicted(_neighbors(spark, sf_dir, 5), 5, "uniform")


@query("knn_distance", f"{_votes(7, 'distance')} select vec_id, actual, label as predicted, round(share, 6) as probability from winner where place = 1")
def knn_distance(spark, sf_dir):
    return _predicted(_neighbors(spark, sf_dir, 7), 7, "distance")


def _predicted(found, k, weights):
    scored = found.withColumns(knn.vote("neighbors", k, weights, CLASSES))
    return rounded(scored.select(
        "vec_id", "actual", "predicted", F.element_at("probabilities", F.col("predicted")).alias("probability")
    ))


_CLASS_NAMES = ", ".join(f"('{c}')" for c in CLASSES)


@query(
    "knn_metrics",
    f"{_votes(5, 'uniform')}, probs as (select q.vec_id, q.label as actual, c.label, coalesce(v.v / 5, 0) as p from q "
    f"cross join (values {_CLASS_NAMES}) c(label) left join votes v on v.vec_id = q.vec_id and v.label = c.label), "
    "scored as (select 'KNN' as model, vec_id, actual, predicted, "
    + ", ".join(f"max(p) filter (l = '{c}') as p_{c}" for c in CLASSES)
    + " from (select probs.vec_id, probs.actual, probs.label as l, p, winner.label as predicted from probs join winner on "
    "winner.vec_id = probs.vec_id and place = 1) group by vec_id, actual, predicted), "
    + sql_matrix(labels=CLASSES) + ", " + sql_auc(labels=CLASSES) + f", s as ({sql_scalars()}), "
    "a as (select model, round(avg(auc), 6) as roc_auc_ovr_macro from areas group by 1) select s.*, a.roc_auc_ovr_macro from s join a using (model)",
)
def knn_metrics(spark, sf_dir):
    found = _neighbors(spark, sf_dir, 5).withColumns(knn.vote("neighbors", 5, "uniform", CLASSES))
    scored = found.select(F.lit("KNN").alias("model"), "actual", "predicted", "probabilities")
    return rounded(evaluate.classification_metrics(scored, CLASSES, CLASSES, ["model"]))


# ------------------------------------------------------------- clusters, fixed centres


def label_centers(df, d: int):
    """Mean vector per label, rounded: ten short rows."""
    columns = [F.round(F.avg(F.element_at("x", i + 1)), 6).alias(f"c{i}") for i in range(d)]
    rows = df.groupBy("label").agg(*columns).orderBy("label").collect()
    return [[r[f"c{i}"] for i in range(d)] for r in rows]


_CENTERS = (
    f"with {_BASE}, long as (select label, unnest(x) as v, generate_subscripts(x, 1) as i from prepared), "
    "means as (select label, i, round(avg(v), 6) as v from long group by 1, 2), "
    "centers as (select row_number() over (order by label) - 1 as cluster, label, list(v order by i) as c from means group by label), "
    "dist as (select p.vec_id, p.x, cluster, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d2 from prepared p, centers), "
    "near as (select *, row_number() over (partition by vec_id order by d2, cluster) as rk from dist), "
    "assigned as (select vec_id, x, cast(cluster as integer) as cluster, d2 from near where rk = 1)"
)


def _assigned(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    centers = label_centers(rows, 64)
    return rows, centers


@query("assign_cluster", f"{_CENTERS} select vec_id, cluster from assigned")
def assign_cluster(spark, sf_dir):
    rows, centers = _assigned(spark, sf_dir)
    return cluster.assign(rows, centers).select("vec_id", "cluster")


@query("inertia", f"{_CENTERS} select cluster, count(*) as members, round(sum(d2), 6) as inertia from assigned group by 1")
def inertia(spark, sf_dir):
    rows, centers = _assigned(spark, sf_dir)
    return rounded(cluster.inertia(rows, centers))


@query(
    "silhouette_sample",
    f"{_CENTERS}, sample as (select * from assigned order by md5(concat_ws('|', '42', cast(vec_id as varchar))) limit 1000), "
    "pairs as (select p.vec_id, p.cluster, o.cluster as other, p.vec_id = o.vec_id as same, "
    "sqrt(list_sum(list_transform(list_zip(p.x, o.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) as d from sample p, sample o), "
    "sums as (select vec_id, cluster, other, sum(d) as s, count(*) as n from pairs group by 1, 2, 3), "
    "parts as (select vec_id, cluster, max(case when other = cluster then case when n > 1 then s / (n - 1) else 0 end end) as a, "
    "max(case when other = cluster then n end) as own, min(case when other <> cluster then s / n end) as b from sums group by 1, 2) "
    "select vec_id, cluster, round(a, 6) as a, round(b, 6) as b, round(case when own > 1 and greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end, 6) as s from parts",
)
def silhouette_sample(spark, sf_dir):
    rows, centers = _assigned(spark, sf_dir)
    return rounded(cluster.silhouette_points(cluster.assign(rows, centers), "vec_id"))


@query(
    "silhouette_all",
    f"{_CENTERS}, pairs as (select p.vec_id, p.cluster, o.cluster as other, "
    "list_sum(list_transform(list_zip(p.x, o.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d from assigned p, assigned o), "
    "sums as (select vec_id, cluster, other, sum(d) as s, count(*) as n from pairs group by 1, 2, 3), "
    "parts as (select vec_id, cluster, max(case when other = cluster then case when n > 1 then s / (n - 1) else 0 end end) as a, "
    "max(case when other = cluster then n end) as own, min(case when other <> cluster then s / n end) as b from sums group by 1, 2), "
    "scored as (select cluster, case when own > 1 and greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end as s from parts) "
    "select cluster, round(avg(s), 6) as silhouette, count(*) as members from scored group by cluster",
)
def silhouette_all(spark, sf_dir):
    """Over every row, with squared distances; the oracle compares all pairs."""
    rows, centers = _assigned(spark, sf_dir)
    return rounded(cluster.silhouette_all(cluster.assign(rows, centers)))


#: (k, restart) runs whose draws and first steps are redone in SQL
STEP_RUNS = tuple((k, r) for k in (2, 3, 5) for r in (0, 1))
STEPS = 3


def _d2(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _kmeans_sql(runs, steps: int) -> str:
    """Starts drawn one centre after the other, then assignment and means, each step a table of its own."""
    digits = " + ".join(f"(strpos('0123456789abcdef', substr(m, {i + 1}, 1)) - 1) * {16 ** (6 - i)}" for i in range(7))
    draws = ", ".join(f"({k}, {r}, {d}, {kmeans.stream((k, r), d)[0]}, {kmeans.stream((k, r), d)[1]})" for k, r in runs for d in range(k))
    ctes = [
        _BASE,
        f"p as materialized (select vec_id, x, cast({digits} as bigint) as h from (select vec_id, x, md5(concat_ws('|', '42', cast(vec_id as varchar))) as m from prepared))",
        f"draws(k, r, draw, a, b) as (values {draws})",
    ]
    time = f"-ln(((h * a + b) % {kmeans.PRIME} + 0.5) / {float(kmeans.PRIME)})"
    for d in range(max(k for k, _ in runs)):
        away = "1" if d == 0 else f"(select min({_d2('p.x', 'c.x')}) from s{d - 1} c where c.k = w.k and c.r = w.r)"
        before = "" if d == 0 else f"select * from s{d - 1} union all "
        ctes.append(
            f"s{d} as materialized ({before}select k, r, cast({d} as integer) as cluster, x from (select w.k, w.r, p.x, row_number() over "
            f"(partition by w.k, w.r order by {time} / {away}, vec_id) as rk from p, draws w where w.draw = {d}) where rk = 1)"
        )
    table = f"s{max(k for k, _ in runs) - 1}"
    for step in range(steps + 1):
        ctes.append(
            f"a{step} as materialized (select * from (select c.k, c.r, c.cluster, c.x as center, p.x, d2, row_number() over "
            f"(partition by c.k, c.r, p.vec_id order by d2, c.cluster) as rk from p, {table} c, lateral (select {_d2('p.x', 'c.x')} as d2)) where rk = 1)"
        )
        ctes.append(
            f"m{step} as materialized (select k, r, cluster, list(v order by i) as x from (select k, r, cluster, i, avg(v) as v from "
            f"(select k, r, cluster, unnest(x) as v, generate_subscripts(x, 1) as i from a{step}) group by 1, 2, 3, 4) group by 1, 2, 3)"
        )
        table = f"m{step}"
    return (
        "with " + ", ".join(ctes) + " select cast(k as integer) as k, cast(r as integer) as restart, cluster, count(*) as members, "
        f"round(sum(d2), 6) as cost, round(any_value(center[1]), 6) as first_coordinate from a{steps} group by 1, 2, 3"
    )


@query("kmeans_steps", _kmeans_sql(STEP_RUNS, STEPS))
def kmeans_steps(spark, sf_dir):
    """k-means++ starts and three steps of six runs in one scan each: members, cost and first coordinate of every centre."""
    points = kmeans.hashed_points(embeddings(spark, sf_dir), "vec_id", "x", 42).persist()
    moved = kmeans.lloyd(points, kmeans.plus_plus(points, STEP_RUNS), STEPS, tol=0.0)
    centers = {run: fit.centers for run, fit in moved.items()}
    rows = [
        (*run, c, int(total[0]), round(float(total[1]), 6), round(float(center[0]), 6))
        for run, totals in kmeans.scan(points, centers).items() for c, (total, center) in enumerate(zip(totals, centers[run]))
    ]
    points.unpersist()
    return spark.createDataFrame(rows, "k int, restart int, cluster int, members bigint, cost double, first_coordinate double")


_NUM = SURVEY_ROWS.model_numeric
#: three fixed centres in scaled survey columns
FIXED = [[-1.0, -1.0, 0.5, 1.0, 1.0], [0.25, 0.0, -0.5, 0.0, -0.25], [1.25, 1.0, 0.0, -1.0, -1.25]]
_SURVEY_ASSIGNED = (
    f"{sql_train()}, filled as (select row_id, "
    + ", ".join(f"coalesce({c}, m.med_{c}) as {c}" for c in _NUM) + ", "
    + ", ".join(f"(coalesce({c}, m.med_{c}) - mean_{c}) / std_{c} as z{i}" for i, c in enumerate(_NUM))
    + " from train, params), dist as (select *, "
    + ", ".join("+".join(f"(z{i} - ({v}))*(z{i} - ({v}))" for i, v in enumerate(c)) + f" as d{k}" for k, c in enumerate(FIXED))
    + " from filled), assigned as (select *, case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end as cluster from dist)"
)


@query(
    "cluster_profiles",
    f"{_SURVEY_ASSIGNED} select cast(cluster as integer) as cluster, "
    + ", ".join(f"round(avg({c}), 6) as {c}" for c in _NUM) + ", count(*) as members from assigned group by 1",
)
def cluster_profiles(spark, sf_dir):
    train = survey_parts(spark, sf_dir).filter("split = 'train'")
    prep = features.fit_preparation(train, SURVEY_ROWS, _NUM)
    model = cluster.ClusterModel(prep, _NUM, FIXED, {}, 3, [], [], [])
    return rounded(model.profiles(train, SURVEY_ROWS))


@query(
    "cluster_traits",
    f"{_SURVEY_ASSIGNED}, centers as ("
    + " union all ".join(
        f"select cluster, {i} as position, '{SURVEY_ROWS.display(c)}' as name, avg(z{i}) as v from assigned group by 1" for i, c in enumerate(_NUM)
    )
    + "), top as (select *, row_number() over (partition by cluster order by abs(round(v, 9)) desc, position) as rk from centers) "
    "select cast(cluster as integer) as cluster, string_agg(name || case when v >= 0 then ': above' else ': below' end || ' training average', '; ' order by rk) as description "
    "from top where rk <= 2 group by 1",
)
def cluster_traits(spark, sf_dir):
    """Traits of the mean scaled row of each cluster."""
    train = survey_parts(spark, sf_dir).filter("split = 'train'")
    prep = features.fit_preparation(train, SURVEY_ROWS, _NUM)
    rows = features.with_array(prep.transform(train, SURVEY_ROWS))
    assigned = cluster.assign(rows, FIXED)
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.element_at("x", i + 1).alias("v")) for i, c in enumerate(_NUM)
    ]
    centers = (
        assigned.select("cluster", F.inline(F.array(*entries)))
        .groupBy("cluster", "position", "column")
        .agg(F.round(F.avg("v"), 9).alias("value"))
    )
    return cluster.cluster_traits(centers, SURVEY_ROWS)
