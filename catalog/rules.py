"""Scoring notes, prompts, recommendations and permutation importance."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.evaluation import SCORED_CTE, scored, sql_matrix
from catalog.profiling import rounded
from catalog.splitting import survey_parts
from catalog.tables import SURVEY_PARTS, SURVEY_PREPARED, SURVEY_ROWS, survey, table
from profilespark.operators import dictionary, importance, quality, recommend, score, stats

_NUM = SURVEY_ROWS.numeric
_TRAIN = f"{SURVEY_PARTS}, train as (select * from parts where split = 'train')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@query(
    "agreement",
    f"{SCORED_CTE}, pair as (select row_number() over () as i, * from base) "
    "select predicted, cast(1 + case when predicted = l_returnflag then 1 else 0 end + case when (case when predicted = 'R' then 'N' else predicted end) = predicted then 1 else 0 end as integer) as agreement, "
    "count(*) as n from pair group by 1, 2",
)
def agreement(spark, sf_dir):
    """How many of three answers (the score's, the label's own, the one without R) equal the first."""
    rows = scored(spark, sf_dir).filter("model = 'weights'")
    third = F.when(F.col("predicted") == "R", F.lit("N")).otherwise(F.col("predicted"))
    answers = F.array(F.col("predicted"), F.col("actual"), third)
    return rows.groupBy("predicted", score.agreement(answers, F.col("predicted")).alias("agreement")).agg(F.count(F.lit(1)).alias("n"))


def _medians(spark, sf_dir, parts):
    train = parts.filter("split = 'train'")
    return {r["column"]: r["median"] for r in stats.medians(train, _NUM).collect()}


@query(
    "median_comparison",
    f"{_TRAIN}, med as (select " + ", ".join(f"quantile_cont({c}, 0.5) as {c}" for c in _NUM) + " from train) "
    + " union all ".join(
        f"select p.row_id, '{c}' as feature, {_text(SURVEY_ROWS.display(c))} as name, round(p.{c}, 6) as value, round(med.{c}, 6) as training_median from parts p, med"
        for c in _NUM
    ),
)
def median_comparison(spark, sf_dir):
    parts = survey_parts(spark, sf_dir)
    rows = parts.select("row_id", F.inline(score.median_comparison(parts, SURVEY_ROWS, _medians(spark, sf_dir, parts))))
    return rounded(rows)


#: observed ranges used by the notes; narrower than the table, so notes appear
RANGES = {
    "Age": (18, 60), "Avg_Daily_Usage_Hours": (1.5, 6.25), "Daily_Unlocks": (70, 210), "Study_Hours": (0.5, 20.5),
    "Physical_Activity_Hours": (1.25, 3.5), "Sleep_Hours_Per_Night": (5.75, 9),
}


def _range_cases() -> list[str]:
    cases = []
    for c in _NUM:
        low, high = RANGES[c]
        span = f"({low:g}-{high:g})"
        if c in SURVEY_ROWS.report_only:
            text = f"{c} is outside the observed training range {span}. {c} is excluded from prediction, but performance for this {c.lower()} group is unverified."
        else:
            text = f"{SURVEY_ROWS.display(c)} is outside the observed training range {span}; this prediction may be less reliable."
        cases.append(f"case when {c} not between {low} and {high} then {_text(text)} end")
    return cases


@query("range_notes", f"{SURVEY_PREPARED} select row_id, concat_ws(' | ', {', '.join(_range_cases())}) as notes from prepared")
def range_notes(spark, sf_dir):
    rows = quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, check=False)
    found = F.array_compact(F.array(*score.range_notes(rows, SURVEY_ROWS, RANGES)))
    return rows.select("row_id", F.array_join(found, " | ").alias("notes"))


KNOWN = {
    "Academic_Level": ("Graduate",), "Most_Used_Platform": tuple(f"Platform {i}" for i in range(10)),
    "Purpose_Of_Use": ("Education", "Networking", "News"),
}


@query(
    "unseen_notes",
    f"{SURVEY_PREPARED} select row_id, concat_ws(' | ', " + ", ".join(
        f"case when {c} not in ({', '.join(_text(v) for v in KNOWN[c])}) then "
        f"{_text(SURVEY_ROWS.display(c) + ' was unseen in training and is encoded as an unknown category.')} end"
        for c in SURVEY_ROWS.categorical
    ) + ") as notes from prepared",
)
def unseen_notes(spark, sf_dir):
    rows = quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, check=False)
    rows, flags = score.with_unseen(rows, SURVEY_ROWS, dictionary.of_values(spark, KNOWN))
    found = F.array_compact(F.array(*score.unseen_notes(SURVEY_ROWS, flags)))
    return rows.select("row_id", F.array_join(found, " | ").alias("notes"))


_PROMPTS = (
    ("Sleep_Hours_Per_Night", "<", "A little more sleep may help you feel more rested."),
    ("Avg_Daily_Usage_Hours", ">", "Consider setting aside one screen-free period each day."),
    ("Daily_Unlocks", ">", "Turning off non-essential notifications may help reduce interruptions."),
)


@query(
    "prompts",
    f"{_TRAIN}, med as (select " + ", ".join(f"quantile_cont({c}, 0.5) as {c}" for c, _, _ in _PROMPTS) + " from train) "
    "select row_id, concat_ws(' | ', " + ", ".join(f"case when p.{c} {op} med.{c} then {_text(t)} end" for c, op, t in _PROMPTS)
    + ") as prompts from parts p, med",
)
def prompts(spark, sf_dir):
    parts = survey_parts(spark, sf_dir)
    medians = _medians(spark, sf_dir, parts)
    return parts.select("row_id", F.array_join(recommend.prompts(parts, medians), " | ").alias("prompts"))


# ------------------------------------------------------------------- recommendations


def _sql_short(x: str) -> str:
    """Six significant digits; the survey numbers have at most three decimals and are below 1000."""
    return f"regexp_replace(regexp_replace(cast(cast({x} as decimal(12,4)) as varchar), '0+$', ''), '\\.$', '')"


# Fixed values, stated here apart from the code's own: what each rule compares, and its category, in the order of the rules.
_RULE_LIMITS = (
    ("Sleep_Hours_Per_Night", "<", 5.6, "Sleep"),
    ("Sleep_Hours_Per_Night", ">", 8.3, "Sleep"),
    ("Avg_Daily_Usage_Hours", ">", 6.3, "Screen time"),
    ("Daily_Unlocks", ">", 204.0, "Digital interruptions"),
    ("Physical_Activity_Hours", "<", 1.3, "Physical activity"),
    ("Study_Hours", ">", 4.2, "Study balance"),
)


def _items_sql() -> str:
    """One select per rule: row_id, label, rank, relevance and the item's fields."""
    platform = "coalesce(Most_Used_Platform, 'your most-used platform')"
    purpose = "coalesce(Purpose_Of_Use, 'your usual purpose')"

    def fill(template: str, value: str) -> str:
        parts = []
        rest = template
        while rest:
            before, brace, after = rest.partition("{")
            if before:
                parts.append(_text(before))
            if not brace:
                break
            name, _, rest = after.partition("}")
            parts.append({"value": _sql_short(value), "platform": platform, "purpose": purpose,
                          "label_lower": "lower(Stress_Level)", "label": "Stress_Level"}[name])
        return " || ".join(parts)

    selects = []
    for (feature, op, limit, category), rule in zip(_RULE_LIMITS, recommend.SURVEY_RULES.rules, strict=True):
        selects.append(
            f"select row_id, Stress_Level, {_text(category)} as category, {_text(rule.title)} as title, {fill(rule.reason, feature)} as reason, "
            f"{fill(rule.action, feature)} as action, '{feature}' as source_feature, {feature} as observed_value, "
            f"cast({limit} as double) as threshold_value, abs({feature} - cast({limit} as double)) / greatest(cast({limit} as double), 1) as relevance "
            f"from prepared where {feature} {op} {limit}"
        )
    rules = recommend.SURVEY_RULES
    selects.append(
        f"select row_id, Stress_Level, {_text(rules.support_category)}, {_text(rules.support_title)}, {fill(rules.support_reason, 'Age')}, "
        f"case when Age < 18 then {_text(rules.minor_action)} else {_text(rules.support_action)} end, null, null, null, 10.0::double "
        "from prepared where Stress_Level in ('High', 'Very High')"
    )
    fired = " union all ".join(selects)
    category, title, reason, action = rules.fallback
    return (
        f"fired as ({fired}), everything as (select * from fired union all select row_id, Stress_Level, {_text(category)}, {_text(title)}, "
        f"{_text(reason)}, {_text(action)}, null, null, null, 0.0::double from prepared where row_id not in (select row_id from fired)), "
        "placed as (select *, row_number() over (partition by row_id order by relevance desc, category) as position from everything)"
    )


@query(
    "recommend_long",
    f"{SURVEY_PREPARED}, {_items_sql()} select row_id, cast(position as integer) as position, category, title, "
    "case Stress_Level when 'Low' then 'Low' when 'Medium' then 'Medium' else 'High' end as priority, reason, reason as description, action, "
    "source_feature, round(observed_value, 6) as observed_value, threshold_value from placed where position <= 6",
)
def recommend_long(spark, sf_dir):
    """Items of every prepared survey row, its own label standing in for the predicted one."""
    rows = quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, check=False)
    result = recommend.recommend(rows, "Stress_Level", SURVEY_ROWS.labels)
    return rounded(recommend.recommend_long(result, "row_id"))


@query(
    "recommend",
    f"{SURVEY_PREPARED}, {_items_sql()} select row_id, any_value(Stress_Level) as predicted_risk, 'checked_training_split_quantiles' as threshold_source, "
    "'Your ' || any_value(Stress_Level) || ' result sets the priority shown below. The suggestions focus on the habits in your answers that may benefit from a small change.' as summary, "
    "string_agg(category, '; ' order by position) as categories, count(*) as items, "
    "'These are general lifestyle suggestions, not medical advice or a diagnosis.' as disclaimer from placed where position <= 6 group by row_id",
)
def recommend_result(spark, sf_dir):
    rows = quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, check=False)
    r = F.col("recommendations")
    return recommend.recommend(rows, "Stress_Level", SURVEY_ROWS.labels).select(
        "row_id", r.predicted_risk.alias("predicted_risk"), r.threshold_source.alias("threshold_source"), r.summary.alias("summary"),
        F.array_join(F.transform(r.getField("items"), lambda i: i.category), "; ").alias("categories"),
        F.size(r.getField("items")).cast("long").alias("items"), r.disclaimer.alias("disclaimer"),
    )


@query(
    "recommend_earlier_shape",
    f"{SURVEY_PREPARED}, {_items_sql()} select row_id, any_value(Stress_Level) as risk_level, cast(row_id % 3 as integer) as cluster_id, "
    "'Your ' || any_value(Stress_Level) || ' result sets the priority shown below. The suggestions focus on the habits in your answers that may benefit from a small change.' as overall_summary, "
    "count(*) as actions from placed where position <= 6 group by row_id",
)
def recommend_earlier_shape(spark, sf_dir):
    rows = quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, check=False).withColumn("cluster", (F.col("row_id") % 3).cast("int"))
    result = recommend.earlier_shape(recommend.recommend(rows, "Stress_Level", SURVEY_ROWS.labels))
    r = F.col("recommendations")
    return result.select(
        "row_id", r.risk_level.alias("risk_level"), r.cluster_id.alias("cluster_id"), r.overall_summary.alias("overall_summary"),
        F.size("recommendations.actions").cast("long").alias("actions"),
    )


_PRIORITY_ORDER = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")


@query(
    "priority_levels",
    "select o_orderpriority, case when o_orderpriority = '5-LOW' then 'Low' when o_orderpriority in ('4-NOT SPECIFIED', '3-MEDIUM') then 'Medium' else 'High' end as priority, "
    "o_orderpriority in ('2-HIGH', '1-URGENT') as elevated, count(*) as n from orders group by 1, 2, 3",
)
def priority_levels(spark, sf_dir):
    """Five ordered labels: the middle one is Medium."""
    label = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").groupBy(
        label, recommend.priority_for(label, _PRIORITY_ORDER).alias("priority"), recommend.is_elevated(label, _PRIORITY_ORDER).alias("elevated")
    ).agg(F.count(F.lit(1)).alias("n"))


EVENT_RULES = recommend.RuleSet(
    rules=(
        recommend.Rule("value", "above", "high", "Spend", "High value", "Value {value} on {kind}.", "Look at {kind}."),
        recommend.Rule("k", "below", "low", "Key", "Low key", "Key {value} on {kind}.", "Raise the key."),
        recommend.Rule("k", "above", "high", "Key", "High key", "Key {value} on {kind}.", "Lower the key."),
        # shares a category with another rule: only the more relevant of the two stays
        recommend.Rule("value", "below", "low", "Key", "Low value", "Value {value} on {kind}.", "Check {kind}."),
    ),
    texts={"kind": ("event_type", "any event")},
    support_category="Errors", support_title="Check errors", support_reason="The {label_lower} event needs a look.",
    support_action="Open the log.", minor_action="Open the log.", minor_column=None, minor_below=0.0,
    fallback=("Nothing", "All fine", "No rule applies.", "Go on."),
    summary="Result for {label}.", disclaimer="Test rules.",
)
EVENT_LIMITS = {"source": "fixed", "value": {"high": 40.0, "low": 3.0}, "k": {"low": 20.0, "high": 80.0}}


@query(
    "recommend_events",
    "with types as (select distinct event_type as label from events), rows_ as (select event_id, event_type, value, cast(json_extract_string(props, '$.k') as double) as k from events), "
    "fired as (select event_id, event_type, 'Spend' as category, 'High value' as title, abs(value - 40) / 40 as relevance from rows_ where value > 40 "
    "union all select event_id, event_type, 'Key', 'Low key', abs(k - 20) / 20 from rows_ where k < 20 "
    "union all select event_id, event_type, 'Key', 'High key', abs(k - 80) / 80 from rows_ where k > 80 "
    "union all select event_id, event_type, 'Key', 'Low value', abs(value - 3) / 3 from rows_ where value < 3 "
    "union all select event_id, event_type, 'Errors', 'Check errors', 10.0 from rows_ where event_type = 'error'), "
    "everything as (select * from fired union all select event_id, event_type, 'Nothing', 'All fine', 0 from rows_ where event_id not in (select event_id from fired)), "
    "once as (select *, row_number() over (partition by event_id, category order by relevance desc, title) as c from everything), "
    "placed as (select *, row_number() over (partition by event_id order by relevance desc, category) as position from once where c = 1) "
    "select event_id, cast(position as integer) as position, category, title from placed where position <= 2",
)
def recommend_events(spark, sf_dir):
    """A rule table on another schema, with shared categories and a cap of two items."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") == "error", "error").otherwise("fine").alias("state"),
    )
    result = recommend.recommend(rows, "state", ("fine", "error"), EVENT_LIMITS, EVENT_RULES, max_items=2)
    return recommend.recommend_long(result, "event_id").select("event_id", "position", "category", "title")


# ---------------------------------------------------------------- permutation importance

_REPEATS = 5
_STUMP = (
    "case when coalesce(Avg_Daily_Usage_Hours, 4) + case when Sleep_Hours_Per_Night < 7 then 1.5 else 0 end < 3 then 'Low' "
    "when coalesce(Avg_Daily_Usage_Hours, 4) + case when Sleep_Hours_Per_Night < 7 then 1.5 else 0 end < 5 then 'Medium' "
    "when coalesce(Avg_Daily_Usage_Hours, 4) + case when Purpose_Of_Use = 'News' then 1 else 0 end < 6 then 'High' else 'Very High' end"
)


def _permuted_sql() -> str:
    shuffled = []
    for c in SURVEY_ROWS.features:
        columns = ", ".join(f"v.{x}" if x == c else f"b.{x}" for x in SURVEY_ROWS.features)
        shuffled.append(
            f"select '{c}' as feature, v.repeat, b.Stress_Level as actual, {columns} from base_rank b join "
            f"(select r as repeat, {c}, row_number() over (partition by r order by md5(concat_ws('|', '42', cast(r as varchar), '{c}', cast(row_id as varchar)))) as rk "
            f"from val, range({_REPEATS}) g(r)) v on b.rk = v.rk"
        )
    return " union all ".join(shuffled)


@query(
    "permutation_importance",
    f"{SURVEY_PARTS}, val as (select * from parts where split = 'val'), "
    "base_rank as (select * exclude (rk), row_number() over (order by md5(concat_ws('|', '42', 'base', cast(row_id as varchar)))) as rk from val), "
    f"copies as ({_permuted_sql()} union all select 'none', -1, Stress_Level, {', '.join(SURVEY_ROWS.features)} from val), "
    f"scored as (select feature || '#' || cast(repeat as varchar) as model, feature, actual, {_STUMP} as predicted from copies), "
    f"{sql_matrix(labels=SURVEY_ROWS.labels)}, f as (select model, avg(f1) filter (support + n_predicted > 0) as f1 from per group by 1), "
    "base_f as (select f1 as b from f where model = 'none#-1') "
    "select split_part(model, '#', 1) as feature, round(avg(b - f1), 6) + 0.0 as importance, round(stddev_pop(b - f1), 6) as std from f, base_f where model <> 'none#-1' group by 1",
)
def permutation_importance(spark, sf_dir):
    """Importance of a fixed rule model on the validation rows of the survey table."""
    val = survey_parts(spark, sf_dir).filter("split = 'val'")
    result = importance.permutation_importance(
        val, lambda rows: rows.withColumn("predicted", F.expr(_STUMP)), "row_id", SURVEY_ROWS.target,
        SURVEY_ROWS.features, SURVEY_ROWS.labels, repeats=_REPEATS, seed=SURVEY_ROWS.seed,
    )
    return rounded(result)
