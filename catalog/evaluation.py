"""Evaluation queries on deterministic scores over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.profiling import rounded
from catalog.tables import LINEITEM_KEY, LINEITEM_WIDE, lineitem_keyed, sql_prepared_ctes, sql_split_ctes, table
from profilespark.operators import baseline, evaluate, quality, split
from profilespark.functions.clean import right_closed_group
from profilespark.session import materialize

LABELS = ("A", "N", "R")

# Three scores per lineitem row: shares of whole-number weights, with many ties.
_W = {"A": "(1 + cast(l_quantity as bigint) % 7)", "N": "(1 + l_partkey % 5)", "R": "(1 + l_suppkey % 6)"}
_TOTAL = "({A} + {N} + {R})".format(**_W)
_SCORED_COLUMNS = (
    ", ".join(f"cast({w} as double) / {_TOTAL} as p_{k}" for k, w in _W.items())
    + f", case when {_W['A']} >= {_W['N']} and {_W['A']} >= {_W['R']} then 'A' when {_W['N']} >= {_W['R']} then 'N' else 'R' end as predicted"
)
#: the second "model" never answers R and so leaves one label without a prediction
_MODELS = (
    "select 'weights' as model, l_returnflag as actual, predicted, p_A, p_N, p_R, l_quantity, l_linestatus from base union all "
    "select 'no_r' as model, l_returnflag, case when predicted = 'R' then 'N' else predicted end, p_A, p_N, p_R, l_quantity, l_linestatus from base"
)
SCORED_CTE = f"with base as (select *, {_SCORED_COLUMNS} from lineitem), scored as ({_MODELS})"


def scored(spark, sf_dir):
    base = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag as actual", "l_quantity", "l_linestatus", *_SCORED_COLUMNS.replace(", cast", "\ncast").replace(", case", "\ncase").split("\n")
    )
    base = base.withColumn("probabilities", F.create_map(*[v for k in LABELS for v in (F.lit(k), F.col(f"p_{k}"))]))
    second = F.when(F.col("predicted") == "R", F.lit("N")).otherwise(F.col("predicted"))
    answers = F.array(
        F.struct(F.lit("weights").alias("model"), F.col("predicted").alias("answer")),
        F.struct(F.lit("no_r").alias("model"), second.alias("answer")),
    )
    return base.select("actual", "l_quantity", "l_linestatus", "probabilities", F.inline(answers)).withColumnRenamed("answer", "predicted")


def sql_matrix(by: str = "model", source: str = "scored", labels=LABELS) -> str:
    """CTEs `grid` (by, actual, predicted, n) and `per` (per label) for a scored CTE."""
    names = ", ".join(f"({i}, '{x}')" for i, x in enumerate(labels))
    return (
        f"names as (select * from (values {names}) v(position, label)), "
        f"groups as (select distinct {by} from {source}), "
        f"grid as (select g.{by}, a.position as actual_position, a.label as actual, p.position as predicted_position, p.label as predicted, "
        f"(select count(*) from {source} s where s.{by} = g.{by} and s.actual = a.label and s.predicted = p.label) as n "
        "from groups g, names a, names p), "
        f"tallies as (select g.{by}, l.label, l.position, (select sum(n) from grid x where x.{by} = g.{by} and x.actual = l.label) as support, "
        f"(select sum(n) from grid x where x.{by} = g.{by} and x.predicted = l.label) as n_predicted, "
        f"(select sum(n) from grid x where x.{by} = g.{by} and x.actual = l.label and x.predicted = l.label) as hits from groups g, names l), "
        "rates as (select *, case when n_predicted > 0 then hits / n_predicted else 0 end as precision, "
        "case when support > 0 then hits / support else 0 end as recall from tallies), "
        "per as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from rates)"
    )


def sql_scalars(by: str = "model", label_set: str = "present") -> str:
    keep = "support + n_predicted > 0" if label_set == "present" else "true"
    return (
        f"select {by}, cast(sum(support) as bigint) as n, round(sum(hits) / sum(support), 6) as accuracy, "
        f"round(avg(recall) filter (support > 0), 6) as balanced_accuracy, "
        f"round(avg(precision) filter ({keep}), 6) as precision_macro, round(avg(recall) filter ({keep}), 6) as recall_macro, "
        f"round(avg(f1) filter ({keep}), 6) as f1_macro, round(sum(f1 * support) / sum(support), 6) as f1_weighted from per group by 1"
    )


def sql_auc(source: str = "scored", by: str = "model", labels=LABELS, score=lambda name: f"p_{name}") -> str:
    """CTE `areas` (by, label, positives, negatives, auc) by the rank-sum formula."""
    entries = " union all ".join(
        f"select {by}, '{x}' as label, {score(x)} as score, case when actual = '{x}' then 1 else 0 end as positive from {source}" for x in labels
    )
    return (
        f"entries as ({entries}), mid as (select *, rank() over (partition by {by}, label order by score) + "
        f"(count(*) over (partition by {by}, label, score) - 1) / 2 as r from entries), "
        f"areas as (select {by}, label, sum(positive) as positives, sum(1 - positive) as negatives, "
        "case when sum(positive) > 0 and sum(1 - positive) > 0 then "
        "(sum(r * positive) - sum(positive) * (sum(positive) + 1) / 2) / (cast(sum(positive) as double) * sum(1 - positive)) end as auc "
        f"from mid group by {by}, label)"
    )


@query("confusion", f"{SCORED_CTE}, {sql_matrix()} select * from grid")
def confusion(spark, sf_dir):
    return evaluate.confusion(scored(spark, sf_dir), LABELS, ["model"])


@query("metrics", f"{SCORED_CTE}, {sql_matrix()}, {sql_auc()}, s as ({sql_scalars()}), "
                  "a as (select model, round(avg(auc), 6) as roc_auc_ovr_macro from areas group by 1) select s.*, a.roc_auc_ovr_macro from s join a using (model)")
def metrics(spark, sf_dir):
    return rounded(evaluate.classification_metrics(scored(spark, sf_dir), LABELS, LABELS, ["model"]))


# the contract may name labels that never occur: they count in one averaging set only
_FOUR = (*LABELS, "X")


@query(
    "metrics_present_vs_contract",
    f"{SCORED_CTE}, {sql_matrix(labels=_FOUR)}, both_sets as (select 'present' as label_set, * from ({sql_scalars()}) "
    f"union all select 'contract', * from ({sql_scalars(label_set='contract')})) select * from both_sets",
)
def metrics_present_vs_contract(spark, sf_dir):
    per = evaluate.per_label(evaluate.confusion(scored(spark, sf_dir), _FOUR, ["model"]), ["model"])
    tables = [
        evaluate.scalar_metrics(per, ["model"], s).withColumn("label_set", F.lit(s)) for s in ("present", "contract")
    ]
    return rounded(tables[0].unionByName(tables[1]))


@query(
    "label_report",
    f"{SCORED_CTE}, {sql_matrix()} select model, label as entry, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, cast(support as bigint) as support from per "
    "union all select model, 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), cast(sum(support) as bigint) from per group by 1 "
    "union all select model, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from per group by 1 "
    "union all select model, 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
    "round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from per group by 1",
)
def label_report(spark, sf_dir):
    return rounded(evaluate.label_report(evaluate.confusion(scored(spark, sf_dir), LABELS, ["model"]), ["model"]))


@query(
    "roc_auc_ovr",
    f"{SCORED_CTE}, {sql_auc()} select model, label, cast(positives as bigint) as positives, cast(negatives as bigint) as negatives, round(auc, 6) as auc from areas",
)
def roc_auc_ovr(spark, sf_dir):
    return rounded(evaluate.roc_auc_per_label(scored(spark, sf_dir), LABELS, ["model"]))


_BIN = (
    "case when l_quantity <= 17 and l_quantity >= 12 then '13-17' when l_quantity < 12 then null when l_quantity <= 24 then '18-24' "
    "when l_quantity <= 34 then '25-34' when l_quantity <= 44 then '35-44' when l_quantity <= 59 then '45-59' when l_quantity <= 120 then '60-120' end"
)


@query(
    "metrics_by_group",
    f"{SCORED_CTE}, spread as (select 'all' as \"group\", actual, predicted from scored where model = 'weights' union all "
    f"select {_BIN}, actual, predicted from scored where model = 'weights' and {_BIN} is not null), "
    + sql_matrix(by='"group"', source="spread") + " " + sql_scalars(by='"group"', label_set="contract"),
)
def metrics_by_group(spark, sf_dir):
    from profilespark.contract import AGE_EDGES, AGE_GROUPS

    rows = scored(spark, sf_dir).filter("model = 'weights'")
    group = right_closed_group(F.col("l_quantity"), AGE_EDGES, AGE_GROUPS)
    return rounded(evaluate.metrics_by_group(rows, LABELS, group))


@query(
    "prediction_table",
    f"{SCORED_CTE} select l_quantity, {_BIN} as quantity_group, actual as Actual_returnflag, predicted as Predicted_returnflag, "
    "actual = predicted as Correct, round(p_A, 6) as Prob_A, round(p_N, 6) as Prob_N, round(p_R, 6) as Prob_R from scored where model = 'weights'",
)
def prediction_table(spark, sf_dir):
    from profilespark.contract import AGE_EDGES, AGE_GROUPS

    rows = scored(spark, sf_dir).filter("model = 'weights'")
    group = right_closed_group(F.col("l_quantity"), AGE_EDGES, AGE_GROUPS)
    return rounded(evaluate.prediction_table(rows, LABELS, "returnflag", ["l_quantity"], group, "quantity_group"))


@query(
    "metric_table",
    f"{SCORED_CTE}, {sql_matrix()}, s as ({sql_scalars()}) unpivot (select * exclude (n) from s) on columns(* exclude (model)) into name metric value value",
)
def metric_table(spark, sf_dir):
    table_ = evaluate.classification_metrics(scored(spark, sf_dir), LABELS, by=["model"])
    return rounded(evaluate.long_metrics(table_))


@query(
    "majority_baseline",
    f"with keyed as (select *, {LINEITEM_KEY} as row_key from lineitem), {sql_prepared_ctes(LINEITEM_WIDE, 'keyed', 'row_key')}, "
    f"{sql_split_ctes(LINEITEM_WIDE)}, major as (select l_returnflag as m from parts where split = 'train' group by 1 order by count(*) desc, 1 limit 1), "
    "scored as (select 'Majority baseline' as model, l_returnflag as actual, m as predicted, "
    "case when m = 'A' then 1.0 else 0.0 end as p_A, case when m = 'N' then 1.0 else 0.0 end as p_N, case when m = 'R' then 1.0 else 0.0 end as p_R "
    f"from parts, major where split = 'test'), {sql_matrix()}, {sql_auc()}, s as ({sql_scalars()}), "
    "a as (select model, round(avg(auc), 6) as roc_auc_ovr_macro from areas group by 1) select s.*, a.roc_auc_ovr_macro from s join a using (model)",
)
def majority_baseline(spark, sf_dir):
    """Flagship: prepare, split, fit the baseline on training rows, evaluate on test rows."""
    prepared = materialize(quality.prepare(lineitem_keyed(spark, sf_dir), LINEITEM_WIDE))
    parts = split.stratified_split(prepared, LINEITEM_WIDE)
    label = baseline.majority_label(parts.filter("split = 'train'"), LINEITEM_WIDE)
    test = parts.filter("split = 'test'").withColumn("actual", F.col("l_returnflag"))
    result = baseline.score_majority(test, label, LABELS).withColumn("model", F.lit("Majority baseline"))
    return rounded(evaluate.classification_metrics(result, LABELS, LABELS, ["model"]))


@query(
    "quality_by_source",
    "with scored as (select source, cast(quality as varchar) as actual, case when n_chars > 300 then '1' else '0' end as predicted "
    f"from documents join labels using (doc_id)), {sql_matrix(by='source', labels=('0', '1'))} {sql_scalars(by='source')}",
)
def quality_by_source(spark, sf_dir):
    """A length rule against the labelled documents, per source."""
    # labels carry one row per document; the join is on its key
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"
    )
    guessed = rows.select(
        "source", F.col("quality").cast("string").alias("actual"), F.when(F.col("n_chars") > 300, "1").otherwise("0").alias("predicted")
    )
    return rounded(evaluate.classification_metrics(guessed, ("0", "1"), by=["source"]))
