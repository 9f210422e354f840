"""Feature preparation: learned on training rows only, applied anywhere.

Fitting runs a few aggregations and keeps a small record of numbers; applying is a
chain of Column expressions and Spark ML transformers, so one scan does it all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import canonical_text, in_bounds, quoted, to_number
from profilespark.operators import dictionary
from profilespark.operators.dictionary import Dictionary
from profilespark.operators.ordered import exact_quantiles
from profilespark.operators.quality import clean_column, clean_features, require_columns, stage
from profilespark.operators.stats import category_counts, modes_of

#: categories that are collected, over all columns together; columns of a larger dictionary are looked up in it by join
COLLECTED = 100_000


class FeatureCleaner(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Lenient cleaning as a pipeline stage; the same rules in training and scoring.

    All parameters are plain lists, so the stage can be saved in any pipeline.
    `bounds` holds "column|low|high" and `aliases` "column|from|to" entries.
    """

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "category columns", TypeConverters.toListString)
    bounds = Param(Params._dummy(), "bounds", "column|low|high", TypeConverters.toListString)
    aliases = Param(Params._dummy(), "aliases", "column|from|to", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None, bounds=None, aliases=None):
        super().__init__()
        self._setDefault(numeric=[], categorical=[], bounds=[], aliases=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def for_contract(cls, contract: Contract, features: Sequence[str] | None = None) -> "FeatureCleaner":
        columns = tuple(features or contract.features)
        return cls(
            numeric=[c for c in columns if c in contract.numeric],
            categorical=[c for c in columns if c in contract.categorical],
            bounds=[f"{c}|{float(lo)!r}|{float(hi)!r}" for c, (lo, hi) in contract.bounds.items() if c in columns],
            aliases=[f"{c}|{a}|{b}" for c, m in contract.aliases.items() if c in columns for a, b in m.items()],
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        require_columns(dataset, [*numeric, *categorical], "feature")
        bounds = {}
        for entry in self.getOrDefault("bounds"):
            column, low, high = entry.rsplit("|", 2)
            bounds[column] = (float(low), float(high))
        aliases: dict[str, dict[str, str]] = {}
        for entry in self.getOrDefault("aliases"):
            column, old, new = entry.split("|", 2)
            aliases.setdefault(column, {})[old] = new
        cleaned = {}
        for c in numeric:
            cleaned[c] = in_bounds(to_number(F.col(quoted(c)), dataset.schema[c].dataType), bounds.get(c))
        for c in categorical:
            cleaned[c] = canonical_text(F.col(quoted(c)), aliases.get(c))
        return dataset.withColumns(cleaned)


@dataclass(frozen=True)
class Preparation:
    """Everything learned on the training rows, in feature order."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    medians: Mapping[str, float]
    means: Mapping[str, float]
    stds: Mapping[str, float]
    modes: Mapping[str, str | None]
    vocabulary: Mapping[str, tuple[str, ...]]
    #: the dictionary, where its categories are too many to be collected; `vocabulary` is empty then
    dictionary: Dictionary | None = None

    @property
    def names(self) -> list[str]:
        """Names of the encoded columns, scaled numbers first."""
        if self.dictionary:
            raise ValueError("The categories were not collected; feature_names gives their names as a table.")
        return [*self.numeric, *[f"{c}_{v}" for c in self.categorical for v in self.vocabulary[c]]]

    def categories(self, column: str) -> int:
        """How many categories a column has."""
        return self.dictionary.sizes.get(column, (0, 0))[0] if self.dictionary else len(self.vocabulary[column])

    def to_dict(self) -> dict:
        """All but the dictionary, which is a table."""
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "dictionary"}

    @classmethod
    def from_dict(cls, data: Mapping, dictionary: Dictionary | None = None) -> "Preparation":
        return cls(
            numeric=tuple(data["numeric"]), categorical=tuple(data["categorical"]),
            medians=dict(data["medians"]), means=dict(data["means"]), stds=dict(data["stds"]),
            modes=dict(data["modes"]), vocabulary={c: tuple(v) for c, v in data["vocabulary"].items()}, dictionary=dictionary,
        )

    def _scaled(self, cleaned: Column, column: str) -> Column:
        mean, std = float(self.means[column]), float(self.stds[column])
        return (F.coalesce(cleaned, F.lit(float(self.medians[column]))) - F.lit(mean)) / F.lit(std)

    def transform(self, df: DataFrame, contract: Contract, output: str = "features") -> DataFrame:
        """Clean, impute, scale and encode into a vector column; all other columns stay."""
        # cleaned values live in columns of their own: callers keep their raw input
        temporary = {f"_p_{i}": c for i, c in enumerate([*self.numeric, *self.categorical])}
        require_columns(df, list(temporary.values()), "feature")
        columns = list(temporary.values())
        parsed = stage(df, contract, columns)
        cleaned = parsed.withColumns({n: clean_column(parsed, contract, c) for n, c in temporary.items()})
        staged = cleaned.withColumns({
            n: self._scaled(F.col(n), c) if c in self.numeric else F.coalesce(F.col(n), F.lit(self.modes[c]))
            for n, c in temporary.items()
        }).drop(*[f"_s_{c}" for c in columns])
        inputs = [n for n, c in temporary.items() if c in self.numeric]
        dropped = list(temporary)
        texts = [n for n, c in temporary.items() if c in self.categorical and self.categories(c)]
        if texts:
            indexed = [f"{n}_i" for n in texts]
            encoded = [f"{n}_v" for n in texts]
            sizes = [self.categories(temporary[n]) for n in texts]
            for n, size in zip(texts, sizes):
                # unseen values get the index after the last one
                if self.dictionary:
                    staged = self.dictionary.with_position(staged, F.col(n), temporary[n], f"{n}_p")
                    staged = staged.withColumn(f"{n}_i", F.coalesce(f"{n}_p", F.lit(size)).cast("double")).drop(f"{n}_p")
                else:
                    labels = list(self.vocabulary[temporary[n]])
                    staged = StringIndexerModel.from_labels(labels, n, f"{n}_i", handleInvalid="keep").transform(staged)
            # fitted on the largest indices alone; the last index is dropped, so unseen values are all zeros
            largest = df.sparkSession.createDataFrame([tuple(float(size) for size in sizes)], indexed)
            encoder = OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error")
            staged = encoder.fit(largest).transform(staged)
            inputs += encoded
            dropped += indexed + encoded
        assembled = VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep").transform(staged)
        return assembled.drop(*dropped)


def fit_preparation(
    train: DataFrame, contract: Contract, features: Sequence[str] | None = None, accuracy: int | None = None
) -> Preparation:
    """Medians, then mean and population std of the imputed column, modes and vocabularies."""
    columns = tuple(features or contract.model_features)
    numeric = tuple(c for c in columns if c in contract.numeric)
    categorical = tuple(c for c in columns if c in contract.categorical)
    cleaned = clean_features(train, contract, columns)

    medians: dict[str, float] = {}
    means: dict[str, float] = {}
    stds: dict[str, float] = {}
    if numeric:
        found = exact_quantiles(cleaned, numeric, [0.5], accuracy=accuracy).collect()
        # a column without any value is kept and filled with zero
        medians = {r["column"]: 0.0 if r.quantile is None else r.quantile for r in found}
        medians = {c: medians.get(c, 0.0) for c in numeric}
        filled = [F.coalesce(F.col(quoted(c)), F.lit(medians[c])) for c in numeric]
        row = cleaned.agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)],
            *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)],
        ).first()
        for i, c in enumerate(numeric):
            means[c] = row[f"m{i}"] or 0.0
            std = row[f"s{i}"] or 0.0
            stds[c] = std if std > 1e-12 * max(abs(means[c]), 1e-300) else 1.0

    modes: dict[str, str | None] = {c: None for c in categorical}
    vocabulary: dict[str, tuple[str, ...]] = {c: () for c in categorical}
    known = None
    if categorical:
        counts = category_counts(cleaned, categorical)
        rows = counts.limit(COLLECTED + 1).collect()
        if len(rows) > COLLECTED:
            known = dictionary.build(cleaned, categorical)
            modes |= {r["column"]: r["mode"] for r in modes_of(known.table).collect()}
        else:
            for c in categorical:
                own = {r["value"]: r["n"] for r in rows if r["column"] == c}
                vocabulary[c] = tuple(sorted(own))
                modes[c] = min(own, key=lambda v: (-own[v], v)) if own else None
    return Preparation(numeric, categorical, medians, means, stds, modes, vocabulary, known)


def preparation_table(prep: Preparation, df: DataFrame) -> DataFrame:
    """The learned values as a long table: (column, statistic, number, text)."""
    rows = []
    for c in prep.numeric:
        rows += [(c, "median", prep.medians[c], None), (c, "mean", prep.means[c], None), (c, "std", prep.stds[c], None)]
    for c in prep.categorical:
        rows.append((c, "mode", None, prep.modes[c]))
    return df.sparkSession.createDataFrame(rows, "column string, statistic string, number double, text string")


def feature_names(prep: Preparation, df: DataFrame) -> DataFrame:
    """(position, name) of the encoded columns."""
    schema = "position long, name string"
    if not prep.dictionary:
        return df.sparkSession.createDataFrame(list(enumerate(prep.names)), schema)
    table, at = df.sparkSession.createDataFrame(list(enumerate(prep.numeric)), schema), len(prep.numeric)
    for c in prep.categorical:
        own = prep.dictionary.entries(c)
        table = table.unionByName(own.select((F.col("position") + at).alias("position"), F.concat(F.lit(f"{c}_"), "value").alias("name")))
        at += prep.categories(c)
    return table


def with_array(df: DataFrame, vector: str = "features", output: str = "x") -> DataFrame:
    return df.withColumn(output, vector_to_array(F.col(vector)))


def long_matrix(df: DataFrame, row_id: str, vector: str = "features") -> DataFrame:
    """(row id, position, value) of every matrix cell."""
    return df.select(quoted(row_id), F.posexplode(vector_to_array(F.col(vector))).alias("position", "value"))


def matrix_check(df: DataFrame, by: Sequence[str] = (), vector: str = "features") -> DataFrame:
    """Rows, and rows with a NaN or infinite cell, per part."""
    bad = F.exists(vector_to_array(F.col(vector)), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("not_finite"))

