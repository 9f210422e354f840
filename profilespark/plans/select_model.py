"""Grid search over stratified folds, refit, and choice by validation macro F1."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import quoted
from profilespark.operators.baseline import majority_label
from profilespark.operators import forest, knn
from profilespark.operators.classify import (
    BASELINE, FOREST, GRID, KNN, FittedModel, fit, fit_forests, forest_settings, points, settings,
)
from profilespark.operators.evaluate import confusion, per_label, scalar_metrics
from profilespark.operators.features import Preparation, fit_preparation
from profilespark.operators.split import stratified_folds
from profilespark.session import materialize


def score_models(vectors: DataFrame, models: Mapping[str, FittedModel], row_id: str) -> DataFrame:
    """Long table: every column of `vectors` plus (model, predicted, probabilities).

    All tree and linear models are applied in one chain over one scan.
    """
    scored = vectors
    entries = []
    for i, (name, model) in enumerate(models.items()):
        scored = replace(model, row_id=row_id).score(scored)
        scored = scored.withColumn(f"_s{i}", F.struct(F.lit(name).alias("model"), "predicted", "probabilities"))
        scored = scored.drop("predicted", "probabilities")
        entries.append(F.col(f"_s{i}"))
    return scored.select(*[F.col(quoted(c)) for c in vectors.columns], F.inline(F.array(*entries)))


@dataclass
class Training:
    preparation: Preparation
    models: dict[str, FittedModel]
    baseline: FittedModel
    primary_model: str
    selection: DataFrame
    cv_results: DataFrame


def _fold_scores(
    folds: DataFrame, fold: int, contract: Contract, classes: Sequence[str], grid: Mapping, quick: bool, parallel: int
) -> list[tuple[str, int, int, float]]:
    """(model, setting, fold, macro F1) of every setting on one held-out fold."""
    train = folds.filter(F.col("fold") != fold)
    held = folds.filter(F.col("fold") == fold)
    prep = fit_preparation(train, contract)
    keep = [contract.row_id, contract.target, "features"]
    fit_rows = prep.transform(train, contract).select(*keep).persist()
    held_rows = prep.transform(held, contract).select(*keep)
    try:
        n = fit_rows.count()
        names = {"target": contract.target, "row_id": contract.row_id, "seed": contract.seed}
        listed = {kind: settings(values, quick) for kind, values in grid.items()}
        tasks = [(kind, i, s) for kind, choices in listed.items() if kind not in (KNN, FOREST) for i, s in enumerate(choices)]
        # all forest settings are parts of one forest per smallest leaf
        tasks += [(FOREST, None, listed[FOREST])] if FOREST in grid else []

        def run(task):
            kind, i, s = task
            if kind == FOREST:
                return kind, i, fit_forests(s, fit_rows, classes, **names)
            return kind, i, fit(kind, s, fit_rows, n, classes, **names)

        with ThreadPool(parallel) as pool:
            fitted = pool.map(run, tasks, chunksize=1)

        scored = held_rows
        entries = []
        for j, (kind, i, model) in enumerate(fitted):
            if kind == FOREST:
                scored = forest.setting_labels(scored, model, forest_settings(listed[FOREST]), "features", "_forest")
                named = F.array(*[F.lit(c) for c in classes])
                entries += [
                    F.struct(F.lit(kind).alias("model"), F.lit(k).alias("setting"), F.element_at(named, F.element_at("_forest", k + 1) + 1).alias("predicted"))
                    for k in range(len(listed[FOREST]))
                ]
                continue
            scored = model.score(scored).withColumnRenamed("predicted", f"_y{j}").drop("probabilities")
            entries.append(F.struct(F.lit(kind).alias("model"), F.lit(i).alias("setting"), F.col(f"_y{j}").alias("predicted")))
        if KNN in grid:
            # one index and one neighbour table with the largest k serve every KNN setting
            largest = max(s["n_neighbors"] for s in listed[KNN])
            index = knn.build(points(fit_rows, contract.target, contract.row_id), largest, train_id="tid", label="label", seed=contract.seed)
            scored = knn.with_neighbors(scored.withColumn("_x", vector_to_array("features")), index, largest, x="_x")
            votes = [knn.vote("neighbors", s["n_neighbors"], s["weights"], classes)["predicted"] for s in listed[KNN]]
            scored = scored.withColumns({f"_k{i}": predicted for i, predicted in enumerate(votes)})
            entries += [F.struct(F.lit(KNN).alias("model"), F.lit(i).alias("setting"), F.col(f"_k{i}").alias("predicted")) for i in range(len(votes))]
        by = ["model", "setting"]
        long = scored.select(F.col(quoted(contract.target)).alias("actual"), F.inline(F.array(*entries)))
        table = scalar_metrics(per_label(confusion(long, contract.labels, by), by), by)
        return [(r.model, r.setting, fold, r.f1_macro) for r in table.select(*by, "f1_macro").collect()]
    finally:
        fit_rows.unpersist()


def cv_table(scores: DataFrame) -> DataFrame:
    """Mean and population std per setting, and its rank within the model (1 is best)."""
    order = Window.partitionBy("model").orderBy(F.desc(F.round("mean_score", 12)))
    return (
        scores.groupBy("model", "setting", "parameters")
        .agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))
        .withColumn("rank", F.rank().over(order))
    )


def train_classifiers(
    train: DataFrame, validation: DataFrame, contract: Contract, *, quick: bool = False,
    grid: Mapping[str, Mapping] = GRID, folds: int = 3, parallel: int = 4,
) -> Training:
    """Tune each classifier on the training rows, refit its best setting, choose by validation."""
    spark = train.sparkSession
    classes = sorted(contract.labels)
    # every fold and every fit reads this table, so it is written once
    folded = materialize(stratified_folds(train, contract, folds))
    seconds: dict[str, float] = {}
    listed = {kind: settings(values, quick) for kind, values in grid.items()}
    # one fold after the other: each fills the cluster, and the driver holds the plans, jobs and broadcasts of one alone
    per_fold = [_fold_scores(folded, f, contract, classes, grid, quick, parallel) for f in range(folds)]
    rows = [score for scores in per_fold for score in scores]
    scores = spark.createDataFrame(
        [(m, s, json.dumps(listed[m][s], sort_keys=True), f, v) for m, s, f, v in rows],
        "model string, setting int, parameters string, fold int, score double",
    )
    results = cv_table(scores)
    best: dict[str, tuple[int, float]] = {}
    for r in results.orderBy("model", "rank", "setting").collect():  # one row per setting
        best.setdefault(r.model, (r.setting, r.mean_score))

    prep = fit_preparation(train, contract)
    keep = [contract.row_id, contract.target, "features"]
    fit_rows = materialize(prep.transform(train, contract).select(*keep))
    n = fit_rows.count()
    models: dict[str, FittedModel] = {}
    for kind in grid:
        start = time.perf_counter()
        models[kind] = fit(
            kind, listed[kind][best[kind][0]], fit_rows, n, classes,
            target=contract.target, row_id=contract.row_id, seed=contract.seed,
        )
        seconds[kind] = time.perf_counter() - start

    held = prep.transform(validation, contract).select(*keep)
    long = score_models(held, models, contract.row_id).withColumnRenamed(contract.target, "actual")
    table = scalar_metrics(per_label(confusion(long, contract.labels, ["model"]), ["model"]), ["model"])
    validated = {r.model: r.f1_macro for r in table.collect()}
    order = {kind: i for i, kind in enumerate(grid)}
    # a stable order: the better score first, the listed order on ties
    ranked = sorted(grid, key=lambda kind: (-round(validated[kind], 12), order[kind]))
    selection = spark.createDataFrame(
        [
            (i, kind, best[kind][1], validated[kind], seconds[kind], json.dumps(models[kind].parameters, sort_keys=True))
            for i, kind in enumerate(ranked)
        ],
        "position int, model string, cv_macro_f1 double, validation_macro_f1 double, fit_seconds double, best_parameters string",
    )
    majority = FittedModel(BASELINE, tuple(classes), {"label": majority_label(train, contract)}, row_id=contract.row_id)
    return Training(prep, models, majority, ranked[0], selection, results)
