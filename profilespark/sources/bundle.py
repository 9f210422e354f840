"""The fitted bundle: one JSON metadata row, model folders and result tables."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from profilespark.contract import Contract
from profilespark.functions.clean import quoted
from profilespark.operators import dictionary
from profilespark.operators import recommend as R
from profilespark.operators import score as S
from profilespark.operators.classify import BASELINE, FittedModel, load_model, save_model
from profilespark.operators.cluster import ClusterModel
from profilespark.operators.features import Preparation
from profilespark.plans.select_model import score_models
from profilespark.sources.readers import manifest_changes, manifest_notes, source_manifest
from profilespark.sources.writers import write_table

ARTIFACT_VERSION = 2


def contract_to_dict(contract: Contract) -> dict:
    return {
        "name": contract.name, "numeric": list(contract.numeric), "categorical": list(contract.categorical),
        "target": contract.target, "labels": list(contract.labels),
        "bounds": {c: list(b) for c, b in contract.bounds.items()},
        "aliases": {c: dict(m) for c, m in contract.aliases.items()},
        "display_names": dict(contract.display_names), "report_only": list(contract.report_only),
        "excluded": list(contract.excluded), "integers": list(contract.integers), "row_id": contract.row_id, "limitations": list(contract.limitations),
        "max_text_length": contract.max_text_length, "min_class_rows": contract.min_class_rows, "seed": contract.seed,
    }


def contract_from_dict(data: Mapping) -> Contract:
    tuples = ("numeric", "categorical", "labels", "report_only", "excluded", "integers", "limitations")
    values = {k: tuple(v) if k in tuples else v for k, v in data.items()}
    values["bounds"] = {c: tuple(b) for c, b in data["bounds"].items()}
    return Contract(**values)


def plain(value):
    """JSON-ready copy: text keys, non-finite numbers as null."""
    if isinstance(value, Mapping):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value


@dataclass
class Bundle:
    contract: Contract
    preparation: Preparation
    models: dict[str, FittedModel]
    baseline: FittedModel | None
    cluster: ClusterModel | None
    metadata: dict
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def primary(self) -> str:
        name = self.metadata.get("primary_model")
        if not name:
            raise ValueError("The saved bundle does not name its primary model.")
        if name not in self.models:
            raise ValueError(f"Primary model {name!r} is missing from the saved bundle.")
        return name

    # ------------------------------------------------------------------ scoring
    def vectors(self, df: DataFrame) -> DataFrame:
        return self.preparation.transform(df, self.contract)

    def predict(self, df: DataFrame, names: list[str] | None = None) -> DataFrame:
        """Long table: input columns plus (model, predicted, probabilities)."""
        chosen = {n: self.models[n] for n in (names or self.models)}
        return score_models(self.vectors(df), chosen, self.contract.row_id).drop("features")

    def score(self, df: DataFrame) -> DataFrame:
        """One result row per input row, whatever its row id is."""
        contract, meta = self.contract, self.metadata
        scored = self.vectors(df)
        entries = []
        labels = [F.lit(c) for c in contract.labels]
        for i, (name, model) in enumerate(self.models.items()):
            scored = replace(model, row_id=contract.row_id).score(scored)
            ordered = F.map_from_arrays(
                F.array(*labels), F.array(*[F.coalesce(F.element_at("probabilities", c), F.lit(0.0)) for c in labels])
            )
            scored = scored.withColumn(
                f"_m{i}",
                F.struct(F.lit(name).alias("model"), F.col("predicted").alias("label"), ordered.alias("probabilities")),
            ).drop("predicted", "probabilities")
            entries.append(F.col(f"_m{i}"))
        main = entries[list(self.models).index(self.primary)]
        if self.cluster is not None:
            scored = self.cluster.assign(scored, contract, "_cluster")
            descriptions = F.create_map(*[
                F.lit(v) for k, text in self.cluster.descriptions.items() for v in (int(k), text)
            ])
            cluster = F.struct(F.col("_cluster").alias("id"), descriptions[F.col("_cluster")].alias("description"))
        else:
            cluster = F.lit(None).cast("struct<id:int,description:string>")
        models = F.array(*entries)
        scored, flags = S.with_unseen(scored, contract, dictionary.Dictionary(self.tables["categories"], meta["category_sizes"]))
        return scored.select(
            *[F.col(quoted(c)) for c in df.columns],
            main.label.alias("label"),
            F.lit(self.primary).alias("primary_model"),
            main.probabilities.alias("probabilities"),
            models.alias("models"),
            S.agreement(F.transform(models, lambda m: m.label), main.label).alias("agreement"),
            cluster.alias("cluster"),
            S.median_comparison(df, contract, meta["medians"]).alias("comparisons"),
            R.prompts(df, meta["medians"]).alias("suggestions"),
            S.notes(df, contract, meta["training_ranges"], flags).alias("notes"),
            F.array(*[F.lit(x) for x in meta.get("limitations", [])]).cast("array<string>").alias("limitations"),
        )

    def score_with_recommendations(self, df: DataFrame, rules: R.RuleSet = R.SURVEY_RULES) -> DataFrame:
        thresholds = self.metadata.get("recommendation_thresholds") or R.DEFAULT_THRESHOLDS
        return R.recommend(self.score(df), "label", self.contract.labels, thresholds, rules)

    def source_notes(self, path: str | None = None) -> list[str]:
        """What has changed in the files that the bundle was made of, or in those under another path."""
        if "sources" not in self.tables:
            return []
        expected = self.tables["sources"]
        return manifest_notes(manifest_changes(source_manifest(expected.sparkSession, path or self.metadata["source"]["path"]), expected))

    # -------------------------------------------------------------- persistence
    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        document = {
            **self.metadata,
            "contract": contract_to_dict(self.contract),
            "preparation": self.preparation.to_dict(),
            "cluster": self.cluster.to_dict() if self.cluster else None,
            "model_files": {
                name: {"kind": m.kind, "parameters": m.parameters, "classes": list(m.classes), "folder": f"m{i}"}
                for i, (name, m) in enumerate(self.models.items())
            },
            "baseline": self.baseline.parameters if self.baseline else None,
            "tables": sorted(self.tables), "has_dictionary": self.preparation.dictionary is not None,
        }
        for name, entry in document["model_files"].items():
            save_model(self.models[name], f"{path}/models/{entry['folder']}", spark)
        for name, table in self.tables.items():
            write_table(table, f"{path}/tables/{name}")
        if self.preparation.dictionary:
            write_table(self.preparation.dictionary.table, f"{path}/dictionary")
        # the metadata row is written last: a half-written bundle does not load
        text = json.dumps(plain(document), allow_nan=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str, check_sources: bool = False) -> "Bundle":
        """The saved bundle. With `check_sources`, `metadata["source_notes"]` says what has changed in the files it was made of."""
        try:
            rows = spark.read.text(f"{path}/metadata").collect()  # one row
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                raise FileNotFoundError(f"No model bundle at {path}. Train and save one first.") from error
            raise
        document = json.loads(rows[0].value) if rows else None
        if not isinstance(document, dict) or "model_files" not in document or "contract" not in document:
            raise TypeError(f"Unexpected content in {path}: not a trained bundle.")
        if document.get("artifact_version") != ARTIFACT_VERSION:
            raise ValueError("Unsupported bundle version. Train and save it again.")
        contract = contract_from_dict(document.pop("contract"))
        known = dictionary.of_table(spark.read.parquet(f"{path}/dictionary")) if document.pop("has_dictionary", False) else None
        prep = Preparation.from_dict(document.pop("preparation"), known)
        cluster = document.pop("cluster")
        files = document.pop("model_files")
        base = document.pop("baseline")
        models = {
            name: load_model(
                spark, e["kind"], e["parameters"], e["classes"], f"{path}/models/{e['folder']}", contract.row_id, contract.seed
            )
            for name, e in files.items()
        }
        classes = tuple(sorted(contract.labels))
        bundle = cls(
            contract, prep, models,
            FittedModel(BASELINE, classes, base, row_id=contract.row_id) if base else None,
            ClusterModel.from_dict(cluster) if cluster else None, document,
            {name: spark.read.parquet(f"{path}/tables/{name}") for name in document.pop("tables", [])},
        )
        bundle.primary  # raises when it is not named or not present
        if check_sources:
            bundle.metadata["source_notes"] = bundle.source_notes()
        return bundle

