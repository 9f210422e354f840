"""The whole training run: prepare, split, tune, cluster, evaluate, explain, bundle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import quoted
from profilespark.operators import dictionary, quality, split, stats
from profilespark.operators.classify import BASELINE, GRID
from profilespark.operators.cluster import train_clusters
from profilespark.operators.evaluate import classification_metrics, confusion, label_report
from profilespark.operators.features import COLLECTED, Preparation
from profilespark.operators.importance import permutation_importance
from profilespark.operators.recommend import thresholds_from_rows
from profilespark.plans.select_model import Training, score_models, train_classifiers
from profilespark.session import materialize
from profilespark.sources.bundle import ARTIFACT_VERSION, Bundle
from profilespark.sources.readers import source_manifest

def _with_id(df: DataFrame, contract: Contract) -> tuple[DataFrame, Contract]:
    """Prepared rows get an id from their (unique) profile when the table has no key."""
    if contract.row_id:
        return df, contract
    return split.with_row_id(df, contract.features), contract.with_(row_id="row_id")


def metric_tables(long: DataFrame, contract: Contract, target: str) -> dict[str, DataFrame]:
    """Scalar metrics, confusion counts and label report of a long scored table."""
    scored = long.withColumn("actual", F.col(quoted(target)))
    classes = sorted(contract.labels)
    matrix = confusion(scored, contract.labels, ["model"])
    return {
        "metrics": classification_metrics(scored, contract.labels, classes, ["model"]),
        "confusion": matrix,
        "label_report": label_report(matrix, ["model"]),
    }


def evaluate_models(training: Training, df: DataFrame, contract: Contract) -> dict[str, DataFrame]:
    """Metrics of every model and the baseline on rows that took no part in training."""
    vectors = training.preparation.transform(df, contract).select(contract.row_id, contract.target, "features")
    models = {**training.models, BASELINE: training.baseline}
    long = materialize(score_models(vectors, models, contract.row_id).drop("features"))
    return metric_tables(long, contract, contract.target)


def evaluate_table(bundle: Bundle, df: DataFrame) -> dict[str, DataFrame]:
    """Lenient evaluation on any labelled table: prepare it first, then score every model."""
    contract = bundle.contract
    if contract.row_id and contract.row_id not in df.columns:
        contract = contract.with_(row_id=None)
    prepared, contract = _with_id(quality.prepare(df, contract), contract)
    models = dict(bundle.models) | ({BASELINE: bundle.baseline} if bundle.baseline else {})
    vectors = bundle.preparation.transform(prepared, contract).select(contract.row_id, contract.target, "features")
    long = materialize(score_models(vectors, models, contract.row_id).drop("features"))
    return metric_tables(long, contract, contract.target)


def global_importance(
    training: Training, validation: DataFrame, contract: Contract, repeats: int = 5
) -> DataFrame:
    """Permutation importance of the primary model on validation rows."""
    model = replace(training.models[training.primary_model], row_id="_copy")
    prep: Preparation = training.preparation

    def score(rows: DataFrame) -> DataFrame:
        return model.score(prep.transform(rows, contract))

    return permutation_importance(
        validation, score, contract.row_id, contract.target, contract.features, contract.labels, repeats, contract.seed
    )


def train(
    df: DataFrame, contract: Contract, *, quick: bool = False, k_values: Sequence[int] = range(2, 7),
    restarts: int = 10, repeats: int = 5, grid=GRID, parallel: int = 4, source: str | None = None,
) -> Bundle:
    """Run every step and return a bundle with its result tables.

    With `source`, the path that `df` was read from, the bundle keeps the digests of its files and compares them when it is loaded.
    """
    audit = quality.audit(df, contract)
    prepared, contract = _with_id(quality.prepare(df, contract), contract)
    # folds, fits and evaluations all read this table
    parts = materialize(split.stratified_split(materialize(prepared), contract))
    part = {name: parts.filter(F.col("split") == name).drop("split") for name in split.PARTS}
    split.require_usable_columns(part["train"], contract)

    # one after the other: each has plans and jobs in parallel of its own, and the driver holds those of all that run
    clustering = train_clusters(part["train"], contract, k_values, restarts, parallel)
    training = train_classifiers(part["train"], part["val"], contract, quick=quick, grid=grid, parallel=parallel)
    ranked = materialize(global_importance(training, part["val"], contract, repeats))
    evaluation = evaluate_models(training, part["test"], contract)

    numeric, categorical = contract.numeric, contract.categorical
    wanted = {c: n for c, n in stats.THRESHOLD_QUANTILES.items() if c in numeric}
    audit_rows = audit.collect()  # a fixed number of counters
    sizes = {r["split"]: r["n"] for r in parts.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = dictionary.build(part["train"], categorical)
    profiles = materialize(clustering.profiles(part["train"], contract))
    metadata = {
        "artifact_version": ARTIFACT_VERSION,
        "created_utc": datetime.now(timezone.utc).isoformat(),
        "seed": contract.seed, "labels": list(contract.labels), "features": list(contract.features),
        "model_features": list(contract.model_features),
        "numeric_features": list(numeric), "categorical_features": list(categorical),
        "excluded_columns": [*contract.excluded, contract.target],
        "primary_model": training.primary_model, "selection_rule": "Highest validation macro F1",
        "selection": [r.asDict() for r in training.selection.collect()],
        "categories": _categories(known, categorical), "category_sizes": {c: list(s) for c, s in known.sizes.items()},
        "medians": {r["column"]: r["median"] for r in stats.medians(part["train"], numeric).collect()},
        "training_ranges": {r["column"]: [r.low, r.high] for r in stats.ranges(part["train"], numeric).collect()},
        "recommendation_thresholds": thresholds_from_rows(stats.thresholds(part["train"], wanted).collect()) if wanted else None,
        "split_sizes": {p: sizes.get(p, 0) for p in split.PARTS},
        "dataset_audit": [r.asDict() for r in audit_rows],
        "evaluation": [r.asDict() for r in evaluation["metrics"].collect()],
        "limitations": list(contract.limitations),
        "cluster_count": clustering.best_k, "cluster_descriptions": clustering.descriptions, "cluster_scores": clustering.scores,
        "cluster_profiles": [r.asDict() for r in profiles.orderBy("cluster").collect()],
        "global_importance": [r.asDict() for r in ranked.orderBy(F.desc("importance"), "feature").collect()],
    }
    tables = {
        "prepared": parts.drop("split"),
        "split_assignments": parts.select(quoted(contract.row_id), "split"),
        "selection": training.selection, "cv_results": training.cv_results, **evaluation,
        "cluster_profiles": profiles, "importance": ranked, "categories": known.table,
    }
    if source:
        tables["sources"] = materialize(source_manifest(df.sparkSession, source))
        metadata["source"] = {"path": source, "files": tables["sources"].count()}
    return Bundle(contract, training.preparation, training.models, training.baseline, clustering, metadata, tables)


def _categories(known: dictionary.Dictionary, columns: Sequence[str]) -> dict[str, list[str]] | None:
    """The categories by column, in text order; null if they are too many to be listed, and stand in the table alone."""
    if sum(n for n, _ in known.sizes.values()) > COLLECTED:
        return None
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in known.table.orderBy("column", "position").collect():
        found[r["column"]].append(r["value"])
    return found
