"""The three tuned classifiers behind one interface: fit on vectors, score vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilespark.operators import forest, knn
from profilespark.operators.baseline import score_majority

KNN = "KNN"
LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
BASELINE = "Majority baseline"

# The searched settings of each classifier, in listed order.
GRID: Mapping[str, Mapping[str, tuple]] = {
    KNN: {"n_neighbors": (3, 5, 7, 9), "weights": ("uniform", "distance")},
    LOGISTIC: {"C": (0.1, 1.0, 10.0)},
    FOREST: {"n_estimators": (100, 200), "max_depth": (None, 12), "min_samples_leaf": (1, 3)},
}
MAX_ITER = 3000


def settings(grid: Mapping[str, tuple], quick: bool = False) -> list[dict]:
    """Every combination of a grid, names in text order; `quick` keeps the first value of each list."""
    names = sorted(grid)
    values = [grid[n][:1] if quick else grid[n] for n in names]
    return [dict(zip(names, combination)) for combination in product(*values)]


def label_index(labels: Sequence[str], target: Column) -> Column:
    return (F.array_position(F.array(*[F.lit(x) for x in labels]), target) - 1).cast("double")


@dataclass
class FittedModel:
    """A fitted classifier. `score` adds `predicted` and `probabilities` to rows with
    a row id and a `features` vector."""

    kind: str
    classes: tuple[str, ...]
    parameters: dict = field(default_factory=dict)
    #: what the kind's own module fits: an index of neighbours, a Spark ML model, a forest
    model: object = None
    row_id: str | None = None
    seed: int = 42

    def score(self, vectors: DataFrame, features: str = "features") -> DataFrame:
        if self.kind == BASELINE:
            return score_majority(vectors, self.parameters["label"], self.classes)
        if self.kind == KNN:
            found = knn.with_neighbors(vectors.withColumn("_x", vector_to_array(features)), self.model, self.parameters["n_neighbors"], x="_x")
            votes = knn.vote("neighbors", self.parameters["n_neighbors"], self.parameters["weights"], self.classes)
            return found.withColumns(votes).drop("_x", "neighbors")
        names = F.array(*[F.lit(c) for c in self.classes])
        if self.kind == FOREST:
            scored = forest.score(vectors, self.model, features, "_shares")
            # of equal shares the first class, in text order
            likeliest = F.array_position("_shares", F.array_max("_shares")).cast("int")
            return scored.withColumns({
                "predicted": F.element_at(names, likeliest), "probabilities": F.map_from_arrays(names, F.col("_shares")),
            }).drop("_shares")
        model = self.model
        model.setFeaturesCol(features)
        model.setPredictionCol("_prediction").setProbabilityCol("_probability").setRawPredictionCol("_raw")
        scored = model.transform(vectors)
        return scored.withColumns({
            "predicted": F.element_at(names, F.col("_prediction").cast("int") + 1),
            "probabilities": F.map_from_arrays(names, vector_to_array("_probability")),
        }).drop("_prediction", "_probability", "_raw")


def fit(
    kind: str, parameters: dict, vectors: DataFrame, rows: int, classes: Sequence[str], *,
    target: str, row_id: str, seed: int = 42, tol: float = 1e-6,
) -> FittedModel:
    """Fit one setting on (row id, target, features). `classes` is in text order; `tol` ends the logistic regression's steps."""
    classes = tuple(sorted(classes))
    if kind == KNN:
        index = knn.build(points(vectors, target, row_id), parameters["n_neighbors"], train_id="tid", label="label", x="x", seed=seed)
        return FittedModel(kind, classes, parameters, index, row_id=row_id, seed=seed)
    if kind == FOREST:
        return FittedModel(kind, classes, parameters, fit_forest(parameters, vectors, classes, target=target, row_id=row_id, seed=seed), row_id=row_id, seed=seed)
    if kind != LOGISTIC:
        raise ValueError(f"Unknown classifier {kind!r}")
    labelled = vectors.withColumn("_label", label_index(classes, F.col(target)))
    # a penalty of |w|^2 / 2 against C times the summed loss, in Spark's mean-loss form
    estimator = LogisticRegression(
        family="multinomial", featuresCol="features", labelCol="_label", maxIter=MAX_ITER, tol=tol,
        elasticNetParam=0.0, standardization=False, regParam=1.0 / (parameters["C"] * rows),
    )
    return FittedModel(kind, classes, parameters, model=estimator.fit(labelled), row_id=row_id, seed=seed)


def points(vectors: DataFrame, target: str, row_id: str) -> DataFrame:
    """(tid, x, label): what an index of neighbours is built from."""
    return vectors.select(F.col(row_id).alias("tid"), vector_to_array("features").alias("x"), F.col(target).alias("label"))


def fit_forest(
    parameters: dict, vectors: DataFrame, classes: Sequence[str], *, target: str, row_id: str, seed: int
) -> forest.Forest | forest.TreeTable:
    data = forest.sample(vectors, target, row_id, classes, seed)
    leaf, trees = parameters["min_samples_leaf"], parameters["n_estimators"]
    return forest.of_trees(forest.grown(vectors.sparkSession, data, [leaf], trees, seed, parameters["max_depth"]), classes)


def forest_settings(choices: Sequence[dict]) -> list[tuple[int, int, int | None]]:
    """(leaf, trees, depth) of each setting."""
    return [(s["min_samples_leaf"], s["n_estimators"], s["max_depth"]) for s in choices]


def fit_forests(
    choices: Sequence[dict], vectors: DataFrame, classes: Sequence[str], *, target: str, row_id: str, seed: int
) -> dict[int, forest.Forest] | forest.TreeTable:
    """For each smallest leaf the forest that all settings with it are parts of: the most trees, grown the deepest."""
    data = forest.sample(vectors, target, row_id, classes, seed)
    wanted = forest_settings(choices)
    trees = max(t for _, t, _ in wanted)
    depths = [d for _, _, d in wanted]
    deepest = None if None in depths else max(depths)
    rows = forest.grown(vectors.sparkSession, data, sorted({leaf for leaf, _, _ in wanted}), trees, seed, deepest)
    return forest.by_leaf(rows, classes)


def save_model(fitted: FittedModel, path: str, spark: SparkSession) -> None:
    if fitted.kind == KNN:
        fitted.model.save(path)
    elif fitted.kind == FOREST:
        fitted.model.table(spark, fitted.parameters["min_samples_leaf"]).write.mode("overwrite").parquet(path)
    elif fitted.kind != BASELINE:
        fitted.model.write().overwrite().save(path)


def load_model(spark: SparkSession, kind: str, parameters: dict, classes: Sequence[str], path: str, row_id: str, seed: int) -> FittedModel:
    fitted = FittedModel(kind, tuple(classes), parameters, row_id=row_id, seed=seed)
    if kind == KNN:
        fitted.model = knn.NeighborIndex.load(spark, path)
    elif kind == LOGISTIC:
        fitted.model = LogisticRegressionModel.load(path)
    elif kind == FOREST:
        fitted.model = forest.of_trees(spark.read.parquet(path), classes)
    return fitted
