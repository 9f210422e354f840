"""Feature preparation learned on the training rows of the survey table."""

from __future__ import annotations


from catalog import query
from catalog.profiling import rounded
from catalog.splitting import survey_parts
from catalog.tables import SURVEY_PARTS, SURVEY_ROWS
from profilespark.operators import features

_NUM = SURVEY_ROWS.model_numeric
_CAT = SURVEY_ROWS.categorical


def fitted(spark, sf_dir):
    parts = survey_parts(spark, sf_dir)
    return parts, features.fit_preparation(parts.filter("split = 'train'"), SURVEY_ROWS)


def sql_params(train: str = "train") -> str:
    """CTE `params` (one row): med_*, mean_*, std_*, mode_* of the training rows."""
    medians = ", ".join(f"quantile_cont({c}, 0.5) as med_{c}" for c in _NUM)
    modes = ", ".join(
        f"(select {c} from {train} where {c} is not null group by {c} order by count(*) desc, {c} limit 1) as mode_{c}" for c in _CAT
    )
    moments = ", ".join(
        f"avg(coalesce({c}, med_{c})) as mean_{c}, "
        f"case when stddev_pop(coalesce({c}, med_{c})) = 0 then 1 else stddev_pop(coalesce({c}, med_{c})) end as std_{c}" for c in _NUM
    )
    return (
        f"med as (select {medians} from {train}), params as (select any_value(med) as m, {moments}, {modes} from {train}, med)"
    )


def sql_train() -> str:
    return f"{SURVEY_PARTS}, train as (select * from parts where split = 'train'), {sql_params()}"


def sql_vocabulary(train: str = "train") -> str:
    """CTE `vocab` (c, value, pos): categories in feature order, text order within."""
    union = " union all ".join(f"select distinct {i} as ci, '{c}' as c, {c} as value from {train} where {c} is not null" for i, c in enumerate(_CAT))
    return f"vocab as (select ci, c, value, {len(_NUM)} + row_number() over (order by ci, value) - 1 as pos from ({union}))"


@query(
    "prep_params",
    f"{sql_train()} "
    + " union all ".join(
        f"select '{c}' as \"column\", '{s}' as statistic, round({v}, 6) as number, cast(null as varchar) as text from params"
        for c in _NUM for s, v in (("median", f"m.med_{c}"), ("mean", f"mean_{c}"), ("std", f"std_{c}"))
    )
    + " union all "
    + " union all ".join(f"select '{c}', 'mode', null, mode_{c} from params" for c in _CAT),
)
def prep_params(spark, sf_dir):
    parts, prep = fitted(spark, sf_dir)
    return rounded(features.preparation_table(prep, parts))


@query(
    "prep_transform",
    f"{sql_train()}, {sql_vocabulary()}, "
    + "cells as ("
    + " union all ".join(
        f"select row_id, split, {i} as position, (coalesce({c}, m.med_{c}) - mean_{c}) / std_{c} as value from parts, params"
        for i, c in enumerate(_NUM)
    )
    + " union all "
    + " union all ".join(
        f"select row_id, split, pos as position, case when coalesce({c}, mode_{c}) = vocab.value then 1.0::double else 0.0::double end as value "
        f"from parts, params, vocab where c = '{c}'" for c in _CAT
    )
    + ") select row_id, cast(position as integer) as position, round(value, 6) + 0.0 as value from cells where split <> 'train'",
)
def prep_transform(spark, sf_dir):
    parts, prep = fitted(spark, sf_dir)
    held = prep.transform(parts.filter("split <> 'train'"), SURVEY_ROWS)
    return rounded(features.long_matrix(held, "row_id"))


@query(
    "feature_names",
    f"{sql_train()}, {sql_vocabulary()} "
    + " union all ".join(f"select cast({i} as bigint) as position, '{c}' as name" for i, c in enumerate(_NUM))
    + " union all select cast(pos as bigint), c || '_' || value from vocab",
)
def feature_names(spark, sf_dir):
    parts, prep = fitted(spark, sf_dir)
    return features.feature_names(prep, parts)


@query("matrix_check", f"{SURVEY_PARTS} select split, count(*) as n, cast(0 as bigint) as not_finite from parts group by 1")
def matrix_check(spark, sf_dir):
    parts, prep = fitted(spark, sf_dir)
    return features.matrix_check(prep.transform(parts, SURVEY_ROWS), ["split"])


@query(
    "cleaner_stage",
    "select event_id, case when value between 0 and 40 then value end as value, "
    "case event_type when 'error' then 'failure' else event_type end as event_type from events",
)
def cleaner_stage(spark, sf_dir):
    """Cleaning as a pipeline stage on another table."""
    from catalog.tables import table
    from profilespark.contract import Contract

    contract = Contract("events", ("value",), ("event_type",), bounds={"value": (0, 40)}, aliases={"event_type": {"error": "failure"}})
    stage = features.FeatureCleaner.for_contract(contract)
    return stage.transform(table(spark, sf_dir, "events").select("event_id", "value", "event_type"))
