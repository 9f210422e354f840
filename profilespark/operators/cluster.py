"""K-Means sweep with model choice, cluster descriptions, assignment and PCA."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import quoted
from profilespark.operators import kmeans
from profilespark.operators.features import Preparation, fit_preparation
from profilespark.operators.ordered import seeded_hash

# task functions travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SILHOUETTE_SAMPLE = 1000


def nearest_center(x: Column, centers: Sequence[Sequence[float]]) -> Column:
    """Struct (distance, cluster) of the closest centre; the lower number wins ties.

    The centres are a fitted parameter of k rows, so they are literals of the expression.
    """
    def squared(center: Sequence[float]) -> Column:
        point = F.array(*[F.lit(float(v)) for v in center])
        return F.aggregate(
            F.zip_with(x, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, v: total + v
        )

    return F.array_min(
        F.array(*[
            F.struct(squared(center).alias("distance"), F.lit(i).alias("cluster")) for i, center in enumerate(centers)
        ])
    )


def assign(df: DataFrame, centers: Sequence[Sequence[float]], x: str = "x", output: str = "cluster") -> DataFrame:
    return df.withColumn(output, nearest_center(F.col(x), centers).getField("cluster"))


def inertia(df: DataFrame, centers: Sequence[Sequence[float]], x: str = "x") -> DataFrame:
    """Sum of squared distances to the closest centre, per cluster."""
    near = df.select(nearest_center(F.col(x), centers).alias("_near"))
    return near.groupBy(F.col("_near.cluster").alias("cluster")).agg(
        F.count(F.lit(1)).alias("members"), F.sum("_near.distance").alias("inertia")
    )


def silhouette_points(
    df: DataFrame, row_id: str, cluster: str = "cluster", x: str = "x",
    seed: int | str = 42, sample_size: int = SILHOUETTE_SAMPLE, by: Sequence[str] = (),
) -> DataFrame:
    """(by..., row id, cluster, a, b, s) of a hash-ordered sample of `sample_size` rows.

    The sample is the operator's definition: a top-k by hash, not a sort of the table.
    Each group then holds at most `sample_size` rows, whatever the input size.
    """
    hashed = df.select(
        *by, F.col(quoted(row_id)).alias(row_id), F.col(cluster).alias("cluster"), F.col(x).alias("x"),
        seeded_hash(seed, F.col(quoted(row_id))).alias("_h"),
    )
    if by:
        order = Window.partitionBy(*by).orderBy("_h")
        sample = hashed.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= sample_size).drop("_r")
    else:
        sample = hashed.orderBy("_h").limit(sample_size)
    kinds = dict(hashed.dtypes)
    schema = ", ".join(
        [f"`{c}` {kinds[c]}" for c in by]
        + [f"`{row_id}` {kinds[row_id]}", f"cluster {kinds['cluster']}", "a double", "b double", "s double"]
    )

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(pdf["x"].to_numpy()).astype(float)
        clusters = pdf["cluster"].to_numpy()
        names, position = np.unique(clusters, return_inverse=True)
        sizes = np.bincount(position, minlength=len(names))
        sums = np.zeros((len(points), len(names)))
        for start in range(0, len(points), 128):
            block = points[start:start + 128]
            distance = np.zeros((len(block), len(points)))
            for j in range(points.shape[1]):
                distance += (block[:, j, None] - points[None, :, j]) ** 2
            np.sqrt(distance, out=distance)
            for c in range(len(names)):
                sums[start:start + 128, c] = distance[:, position == c].sum(axis=1)
        row = np.arange(len(points))
        own = sizes[position]
        a = np.divide(sums[row, position], own - 1, out=np.zeros(len(points)), where=own > 1)
        means = sums / sizes
        means[row, position] = np.inf
        b = means.min(axis=1) if len(names) > 1 else np.full(len(points), np.nan)
        top = np.maximum(a, b)
        s = np.divide(b - a, top, out=np.zeros(len(points)), where=(top > 0) & (own > 1))
        if len(names) < 2:
            s[:] = np.nan
        return pdf[[*by, row_id, "cluster"]].assign(a=a, b=b, s=s)

    # one group per `by` value (the candidate k); each is a sample of bounded size
    grouped = sample.groupBy(*by) if by else sample.withColumn("_all", F.lit("all")).groupBy("_all")
    return grouped.applyInPandas(score, schema)


def silhouette(df: DataFrame, row_id: str, **options) -> DataFrame:
    by = list(options.get("by", ()))
    points = silhouette_points(df, row_id, **options)
    return points.groupBy(*by).agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("sampled"))


def silhouette_all(df: DataFrame, cluster: str = "cluster", x: str = "x") -> DataFrame:
    """(cluster, silhouette, members) over every row, with squared Euclidean distances.

    A row's mean squared distance to a cluster follows from the cluster's size, vector sum and sum of squared
    lengths, so the work is linear in the rows. What goes into the second pass is one row per cluster.
    Rows that are alone in their cluster score 0; with one cluster there is no score.
    """
    rows = df.select(F.col(cluster).alias("cluster"), F.col(x).cast("array<double>").alias("x"))
    first = rows.select(F.size("x")).first()
    width = first[0] if first else 0
    length = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    known = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(length).alias("q"), *[F.sum(F.element_at("x", i + 1)).alias(f"s{i}") for i in range(width)]
    ).orderBy("cluster").collect()

    def mean_to(k) -> Column:
        total = F.array(*[F.lit(k[f"s{i}"]) for i in range(width)])
        dot = F.aggregate(F.zip_with("x", total, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return F.lit(k["n"]) * F.col("l") - 2 * dot + F.lit(k["q"])

    scored = rows.withColumn("l", length)
    own = F.coalesce(*[F.when(F.col("cluster") == F.lit(k["cluster"]), mean_to(k) / max(1, k["n"] - 1)) for k in known], F.lit(None)) if known else F.lit(None)
    others = [F.when(F.col("cluster") != F.lit(k["cluster"]), mean_to(k) / k["n"]) for k in known]
    other = F.least(*others) if len(others) > 1 else F.lit(None)
    alone = F.coalesce(*[F.when(F.col("cluster") == F.lit(k["cluster"]), F.lit(k["n"] == 1)) for k in known], F.lit(False)) if known else F.lit(False)
    top = F.greatest("a", "b")
    s = F.when(F.col("b").isNull(), F.lit(None).cast("double")).when(alone | (top <= 0), 0.0).otherwise((F.col("b") - F.col("a")) / top)
    scored = scored.withColumns({"a": own.cast("double"), "b": other.cast("double")}).withColumn("s", s)
    return scored.groupBy("cluster").agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("members"))


def cluster_profiles(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean of each (imputed) raw column and member count per cluster."""
    return df.groupBy(F.col(cluster).alias("cluster")).agg(
        *[F.avg(F.col(quoted(c))).alias(c) for c in columns], F.count(F.lit(1)).alias("members")
    )


def cluster_traits(centers: DataFrame, contract: Contract, top: int = 2) -> DataFrame:
    """(cluster, description) from a long centre table (cluster, position, column, value)."""
    names = F.create_map(*[F.lit(v) for c in contract.features for v in (c, contract.display(c))])
    order = Window.partitionBy("cluster").orderBy(F.abs("value").desc(), "position")
    trait = F.concat(
        F.coalesce(names[F.col("column")], F.col("column")),
        F.when(F.col("value") >= 0, F.lit(": above training average")).otherwise(F.lit(": below training average")),
    )
    return (
        centers.withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") <= top)
        .groupBy("cluster")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", trait.alias("t")))), lambda s: s.t), "; ").alias("description"))
    )


@dataclass
class ClusterModel:
    """The chosen clustering; clusters are numbered by size, largest first."""

    preparation: Preparation
    columns: tuple[str, ...]
    centers: list[list[float]]
    descriptions: dict[str, str]
    best_k: int
    scores: list[dict]
    components: list[list[float]]
    explained: list[float]

    def to_dict(self) -> dict:
        return {
            "preparation": self.preparation.to_dict(), "columns": list(self.columns), "centers": self.centers,
            "descriptions": self.descriptions, "best_k": self.best_k, "scores": self.scores,
            "components": self.components, "explained": self.explained,
        }

    @classmethod
    def from_dict(cls, data: Mapping) -> "ClusterModel":
        return cls(
            Preparation.from_dict(data["preparation"]), tuple(data["columns"]), data["centers"],
            data["descriptions"], data["best_k"], data["scores"], data["components"], data["explained"],
        )

    def _scaled(self, df: DataFrame, contract: Contract) -> DataFrame:
        prepared = self.preparation.transform(df, contract, output="_cluster_vector")
        return prepared.withColumn("_cluster_x", vector_to_array("_cluster_vector")).drop("_cluster_vector")

    def assign(self, df: DataFrame, contract: Contract, output: str = "cluster") -> DataFrame:
        return assign(self._scaled(df, contract), self.centers, "_cluster_x", output).drop("_cluster_x")

    def profiles(self, df: DataFrame, contract: Contract) -> DataFrame:
        # the cleaned and imputed raw value is the scaled one put back on its scale
        scaled = self._scaled(df, contract)
        back = {
            c: F.element_at("_cluster_x", i + 1) * F.lit(self.preparation.stds[c]) + F.lit(self.preparation.means[c])
            for i, c in enumerate(self.columns)
        }
        found = nearest_center(F.col("_cluster_x"), self.centers).getField("cluster").alias("cluster")
        return cluster_profiles(scaled.select(found, *[v.alias(c) for c, v in back.items()]), self.columns)

    def coordinates(self, df: DataFrame, contract: Contract) -> DataFrame:
        """Rows with `PC1`, `PC2` and `cluster`."""
        scaled = self.assign(df, contract)
        scaled = self._scaled(scaled, contract)
        for name, component in zip(("PC1", "PC2"), self.components):
            weights = F.array(*[F.lit(float(v)) for v in component])
            product = F.aggregate(F.zip_with("_cluster_x", weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
            scaled = scaled.withColumn(name, product)
        return scaled.drop("_cluster_x")


def kmeans_sweep(
    vectors: DataFrame, row_id: str, k_values: Sequence[int] = range(2, 7), restarts: int = 10,
    seed: int = 42, vector: str = "features", max_iter: int = 300, tol: float = 1e-4, parallel: int = 8,
) -> tuple[list[dict], dict[int, list[list[float]]]]:
    """Best of `restarts` runs per k, with inertia, the silhouette over all rows and, as `silhouette_sampled`,
    the one of a sample with plain distances.

    All runs of all k share each scan (`kmeans.lloyd`). `vectors` is scanned by many jobs: pass a materialised table.
    """
    data = kmeans.hashed_points(vectors.withColumn("_x", vector_to_array(vector)), row_id, "_x", seed).persist()
    try:
        starts = kmeans.plus_plus(data, [(k, r) for k in k_values for r in range(restarts)])
        fits = kmeans.lloyd(data, starts, max_iter, tol)
        best: dict[int, tuple[float, list[list[float]], int]] = {}
        for k, r in sorted(fits, key=lambda run: (run[0], fits[run].inertia, run[1])):
            # a k that there are not enough different rows for
            if (fits[k, r].members > 0).sum() >= 2:
                best.setdefault(k, (fits[k, r].inertia, fits[k, r].centers.tolist(), fits[k, r].steps))

        x = data.select(F.col("id").alias(row_id), "x")
        choices = {k: nearest_center(F.col("x"), centers).getField("cluster") for k, (_, centers, _) in best.items()}
        if not choices:
            raise ValueError("Clustering needs at least two distinct profiles.")

        def over_all(k: int) -> float | None:
            parts = [r for r in silhouette_all(x.withColumn("cluster", choices[k])).collect() if r.silhouette is not None]
            return sum(r.silhouette * r.members for r in parts) / sum(r.members for r in parts) if parts else None

        with ThreadPool(min(parallel, len(choices))) as pool:
            found = dict(zip(choices, pool.map(over_all, list(choices), chunksize=1)))
        # the samples of all candidate clusterings are scored in one job
        clusters = [F.struct(F.lit(k).alias("k"), cluster.alias("cluster")) for k, cluster in choices.items()]
        spread = x.select(row_id, "x", F.inline(F.array(*clusters)))
        sampled = {r.k: r.silhouette for r in silhouette(spread, row_id, seed=seed, by=["k"]).collect() if not np.isnan(r.silhouette)}
    finally:
        data.unpersist()
    scores = [
        {"k": k, "inertia": float(best[k][0]), "silhouette": float(found[k]), "silhouette_sampled": sampled.get(k), "steps": best[k][2]}
        for k in sorted(best) if found.get(k) is not None and not np.isnan(found[k])
    ]
    if not scores:
        raise ValueError("Clustering needs at least two distinct profiles.")
    return scores, {k: centers for k, (_, centers, _) in best.items()}


def best_k(scores: Sequence[Mapping]) -> int:
    return min(scores, key=lambda s: (-s["silhouette"], s["k"]))["k"]


def pca(vectors: DataFrame, k: int = 2, vector: str = "features") -> tuple[list[list[float]], list[float]]:
    """Principal components (largest loading positive) and explained variance shares."""
    model = PCA(k=k, inputCol=vector, outputCol="_pc").fit(vectors)
    matrix = model.pc.toArray()
    components = []
    for j in range(matrix.shape[1]):
        column = matrix[:, j]
        sign = 1.0 if column[np.argmax(np.abs(column))] >= 0 else -1.0
        components.append([float(v) * sign for v in column])
    return components, [float(v) for v in model.explainedVariance]


def train_clusters(
    train: DataFrame, contract: Contract, k_values: Sequence[int] = range(2, 7), restarts: int = 10, parallel: int = 8
) -> ClusterModel:
    """Sweep k on the scaled behaviour columns, keep the best silhouette, describe it."""
    columns = contract.model_numeric
    prep = fit_preparation(train, contract, columns)
    vectors = prep.transform(train, contract).select(contract.row_id, "features").persist()
    try:
        scores, centers_by_k = kmeans_sweep(
            vectors, contract.row_id, k_values, restarts, contract.seed, parallel=parallel
        )
        chosen = best_k(scores)
        raw = centers_by_k[chosen]
        sizes = {
            r.cluster: r.members
            for r in inertia(vectors.withColumn("x", vector_to_array("features")), raw).collect()
        }
        order = sorted(range(len(raw)), key=lambda i: (-sizes.get(i, 0), raw[i]))
        centers = [raw[i] for i in order]
        long = train.sparkSession.createDataFrame(
            [(i, j, c, float(center[j])) for i, center in enumerate(centers) for j, c in enumerate(columns)],
            "cluster int, position int, column string, value double",
        )
        descriptions = {str(r.cluster): r.description for r in cluster_traits(long, contract).orderBy("cluster").collect()}
        components, explained = pca(vectors, min(2, len(columns)))
    finally:
        vectors.unpersist()
    return ClusterModel(
        prep, tuple(columns), centers,
        descriptions, chosen, scores, components, explained,
    )
