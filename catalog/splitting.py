"""Splits, folds and leakage checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import (
    LINEITEM_KEY,
    LINEITEM_WIDE,
    ORDERS,
    SURVEY_PARTS,
    SURVEY_ROWS,
    lineitem_keyed,
    sql_prepared_ctes,
    sql_split_ctes,
    survey,
    table,
)
from profilespark.operators import quality, split
from profilespark.session import materialize


def survey_parts(spark, sf_dir):
    """Prepared and split survey rows; written once, because several jobs read them."""
    prepared = materialize(quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, check=False))
    return split.stratified_split(prepared, SURVEY_ROWS)


_ORDERS_PREPARED = f"with {sql_prepared_ctes(ORDERS, 'orders', 'o_orderkey')}"
_WIDE_PREPARED = (
    f"with keyed as (select *, {LINEITEM_KEY} as row_key from lineitem), {sql_prepared_ctes(LINEITEM_WIDE, 'keyed', 'row_key')}"
)


@query(
    "stratified_split",
    f"{_ORDERS_PREPARED}, {sql_split_ctes(ORDERS)} select o_orderkey, o_orderpriority, split from parts",
)
def stratified_split(spark, sf_dir):
    prepared = materialize(quality.prepare(table(spark, sf_dir, "orders"), ORDERS))
    return split.stratified_split(prepared, ORDERS).select("o_orderkey", "o_orderpriority", "split")


@query(
    "split_label_counts",
    f"{_WIDE_PREPARED}, {sql_split_ctes(LINEITEM_WIDE)} select l_returnflag as label, "
    "count(*) filter (split = 'train') as train, count(*) filter (split = 'val') as val, "
    "count(*) filter (split = 'test') as test, count(*) as total from parts group by 1",
)
def split_label_counts(spark, sf_dir):
    prepared = materialize(quality.prepare(lineitem_keyed(spark, sf_dir), LINEITEM_WIDE, check=False))
    return split.split_label_counts(split.stratified_split(prepared, LINEITEM_WIDE), LINEITEM_WIDE)


@query(
    "split_sizes",
    f"{SURVEY_PARTS} select split, count(*) as n from parts group by 1",
)
def split_sizes(spark, sf_dir):
    return survey_parts(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "kfold",
    f"{SURVEY_PARTS}, train as (select * from parts where split = 'train'), "
    "starts as (select position, label, (select count(*) from train where Stress_Level = label) as c from labels_in_order), "
    "offsets as (select label, c, coalesce(sum(c) over (order by position rows between unbounded preceding and 1 preceding), 0) as s from starts), "
    # rows of fold f in a label: how many of its positions s .. s+c-1 leave the rest f
    "fold_quota as (select label, c, (s + c + 2) // 3 - (s + 2) // 3 as f0, (s + c + 1) // 3 - (s + 1) // 3 as f1 from offsets), "
    "ordered as (select row_id, Stress_Level, row_number() over (partition by Stress_Level order by "
    "md5(concat_ws('|', '42|fold', cast(row_id as varchar)))) as k from train) "
    "select row_id, case when k <= f0 then 0 when k <= f0 + f1 then 1 else 2 end as fold from ordered o join fold_quota q on o.Stress_Level = q.label",
)
def kfold(spark, sf_dir):
    train = survey_parts(spark, sf_dir).filter("split = 'train'")
    return split.stratified_folds(train, SURVEY_ROWS).select("row_id", "fold")


@query(
    "split_leakage",
    f"{SURVEY_PARTS}, per_id as (select row_id, count(distinct split) as s from parts group by 1), "
    "per_profile as (select count(distinct split) as s from parts group by "
    + ", ".join(SURVEY_ROWS.features) + ") "
    "select 'row_in_two_parts' as \"check\", (select count(*) from per_id where s > 1) as violations "
    "union all select 'row_without_part', (select count(*) from prepared where row_id not in (select row_id from parts)) "
    "union all select 'row_not_in_source', (select count(*) from parts where row_id not in (select row_id from prepared)) "
    "union all select 'profile_in_two_parts', (select count(*) from per_profile where s > 1) "
    "union all select 'label_missing_in_part', 12 - (select count(*) from (select distinct split, Stress_Level from parts)) "
    "union all select 'excluded_column_present', 0",
)
def split_leakage(spark, sf_dir):
    prepared = materialize(quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, check=False))
    return split.split_checks(split.stratified_split(prepared, SURVEY_ROWS), prepared, SURVEY_ROWS)
