"""Evaluation. A scored table holds `actual`, `predicted` and, for AUC, `probabilities`
(map label -> probability); `by` names columns such as the model or a group.

Scored rows are read once into label x label counts; every metric but AUC is
derived from that tiny table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilespark.functions.clean import quoted
from profilespark.operators.ordered import running_totals

METRICS = ("accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted")


def confusion(scored: DataFrame, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., actual, predicted, n) in label order with zeros for absent pairs."""
    pairs = scored.groupBy(*by, "actual", "predicted").agg(F.count(F.lit(1)).alias("_n"))
    cells = [
        F.struct(
            F.lit(i).alias("actual_position"), F.lit(a).alias("actual"),
            F.lit(j).alias("predicted_position"), F.lit(p).alias("predicted"),
            F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("_n"))), F.lit(0)).alias("n"),
        )
        for i, a in enumerate(labels) for j, p in enumerate(labels)
    ]
    # at most labels^2 rows per group reach this second step
    return pairs.groupBy(*by).agg(F.array(*cells).alias("_cells")).select(*by, F.inline("_cells"))


def _ratio(top: Column, bottom: Column) -> Column:
    """Division that gives 0 when there is nothing to divide by."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def per_label(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label, from a confusion table."""
    sides = matrix.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("actual_position").alias("position"),
                         F.col("n").alias("_support"), F.lit(0).cast("long").alias("_predicted"),
                         F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("_hit")),
                F.struct(F.col("predicted").alias("label"), F.col("predicted_position").alias("position"),
                         F.lit(0).cast("long").alias("_support"), F.col("n").alias("_predicted"),
                         F.lit(0).cast("long").alias("_hit")),
            )
        ),
    )
    sums = sides.groupBy(*by, "label", "position").agg(
        F.sum("_support").alias("support"), F.sum("_predicted").alias("n_predicted"), F.sum("_hit").alias("hits")
    )
    precision = _ratio(F.col("hits"), F.col("n_predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return sums.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", _ratio(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def scalar_metrics(labels_table: DataFrame, by: Sequence[str] = (), label_set: str = "present") -> DataFrame:
    """One row per group. Macro averages run over labels that occur as actual or predicted
    ("present"), or over every label of the contract ("contract")."""
    if label_set not in ("present", "contract"):
        raise ValueError("label_set must be 'present' or 'contract'")
    counted = (F.col("support") + F.col("n_predicted") > 0) if label_set == "present" else F.lit(True)

    def macro(name: str) -> Column:
        return F.coalesce(F.avg(F.when(counted, F.col(name))), F.lit(0.0)).alias(f"{name}_macro")

    support = F.sum("support")
    return labels_table.groupBy(*by).agg(
        support.alias("n"),
        _ratio(F.sum("hits"), support).alias("accuracy"),
        F.coalesce(F.avg(F.when(F.col("support") > 0, F.col("recall"))), F.lit(0.0)).alias("balanced_accuracy"),
        macro("precision"), macro("recall"), macro("f1"),
        _ratio(F.sum(F.col("f1") * F.col("support")), support).alias("f1_weighted"),
    )


def label_report(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per label plus the accuracy, macro and weighted average rows."""
    table = per_label(matrix, by)
    rows = table.select(*by, F.col("label").alias("entry"), "precision", "recall", "f1", "support")
    total = F.sum("support")
    accuracy = _ratio(F.sum("hits"), total)
    averages = table.groupBy(*by).agg(
        F.array(
            F.struct(F.lit("accuracy").alias("entry"), accuracy.alias("precision"), accuracy.alias("recall"),
                     accuracy.alias("f1"), total.alias("support")),
            F.struct(F.lit("macro avg").alias("entry"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support")),
            F.struct(F.lit("weighted avg").alias("entry"),
                     *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in ("precision", "recall", "f1")],
                     total.alias("support")),
        ).alias("_rows")
    )
    return rows.unionByName(averages.select(*by, F.inline("_rows")))


def roc_auc_per_label(scored: DataFrame, classes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact one-vs-rest AUC per label: pairs ordered right, ties count half.

    Rows collapse to one row per (label, distinct score) before anything is ordered, and
    the running count of negatives is built from even score buckets.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("label"),
                F.element_at("probabilities", F.lit(c)).alias("score"),
                (F.col("actual") == F.lit(c)).cast("long").alias("_positive"),
            )
            for c in classes
        ]
    )
    grouped = (
        scored.select(*by, F.inline(entries))
        .groupBy(*by, "label", "score")
        .agg(F.sum("_positive").alias("_pos"), F.sum(1 - F.col("_positive")).alias("_neg"))
    )
    ordered = running_totals(grouped, [*by, "label"], "score", ["_neg"])
    won = F.sum(F.col("_pos").cast("double") * (F.col("before__neg") + F.col("_neg") / 2.0))
    area = ordered.groupBy(*by, "label").agg(
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), won.alias("_won")
    )
    defined = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return area.select(
        *by, "label", "positives", "negatives",
        F.when(defined, F.col("_won") / (F.col("positives").cast("double") * F.col("negatives"))).alias("auc"),
    )


def roc_auc(scored: DataFrame, classes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Macro AUC per group; null unless the actual labels are exactly the model's classes."""
    per = roc_auc_per_label(scored, classes, by)
    # every label sees all rows, so rows with another actual label are those no label claims
    rows = F.max(F.col("positives") + F.col("negatives"))
    usable = (F.count_if(F.col("positives") == 0) == 0) & (rows == F.sum("positives"))
    return per.groupBy(*by).agg(F.when(usable, F.avg("auc")).alias("roc_auc_ovr_macro"))


def classification_metrics(
    scored: DataFrame, labels: Sequence[str], classes: Sequence[str] | None = None,
    by: Sequence[str] = (), label_set: str = "present",
) -> DataFrame:
    """All scalar metrics per group; AUC when `classes` (the model's own labels) is given."""
    table = scalar_metrics(per_label(confusion(scored, labels, by), by), by, label_set)
    if classes is None:
        return table
    auc = roc_auc(scored, classes, by)
    return table.join(auc, list(by)) if by else table.withColumn("roc_auc_ovr_macro", auc.scalar())


def metrics_by_group(
    scored: DataFrame, labels: Sequence[str], group: Column, label_set: str = "contract"
) -> DataFrame:
    """Metrics of each non-empty group and of all rows ("all"), from one scan.

    The counts of all rows are the sums of the group counts, not a second pass.
    """
    pairs = (
        scored.select(group.alias("_g"), "actual", "predicted")
        .groupBy("_g", "actual", "predicted")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    spread = pairs.select(
        F.explode(F.array_compact(F.array(F.lit("all"), F.col("_g")))).alias("group"), "actual", "predicted", "_n"
    )
    cells = [
        F.struct(
            F.lit(i).alias("actual_position"), F.lit(a).alias("actual"),
            F.lit(j).alias("predicted_position"), F.lit(p).alias("predicted"),
            F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("_n"))), F.lit(0)).alias("n"),
        )
        for i, a in enumerate(labels) for j, p in enumerate(labels)
    ]
    matrix = spread.groupBy("group").agg(F.array(*cells).alias("_cells")).select("group", F.inline("_cells"))
    return scalar_metrics(per_label(matrix, ["group"]), ["group"], label_set)


def prediction_table(
    scored: DataFrame, labels: Sequence[str], target: str, keep: Sequence[str] = (),
    group: Column | None = None, group_name: str = "group",
) -> DataFrame:
    """Kept columns, group, actual, predicted, correct flag and one probability per label."""
    groups = [group.alias(group_name)] if group is not None else []
    return scored.select(
        *[F.col(quoted(c)) for c in keep],
        *groups,
        F.col("actual").alias(f"Actual_{target}"),
        F.col("predicted").alias(f"Predicted_{target}"),
        (F.col("actual") == F.col("predicted")).alias("Correct"),
        *[F.element_at("probabilities", F.lit(name)).alias(f"Prob_{name}") for name in labels],
    )


def long_metrics(table: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by..., metric, value): one row per scalar metric."""
    names = [c for c in table.columns if c not in by and c != "n"]
    entries = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names]
    return table.select(*by, F.inline(F.array(*entries)))
