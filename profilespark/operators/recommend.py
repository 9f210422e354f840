"""Rule-based recommendations as Column expressions.

A rule compares one number with a fitted threshold and yields one item. Items of a row
are ordered by priority, relevance and category, made unique per category and cut
at `max_items`, all inside one array expression per row: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilespark.contract import Contract
from profilespark.functions.clean import finite, quoted, short_number, strip, to_number

# Fallback thresholds used when no fitted ones are given.
DEFAULT_THRESHOLDS: Mapping[str, object] = {
    "source": "checked_training_split_quantiles",
    "Sleep_Hours_Per_Night": {"low": 5.6, "very_low": 5.0, "high": 8.3, "reference": 6.6},
    "Avg_Daily_Usage_Hours": {"high": 6.3, "very_high": 7.3, "reference": 5.0},
    "Daily_Unlocks": {"high": 204.0, "very_high": 230.0, "reference": 171.0},
    "Physical_Activity_Hours": {"low": 1.3, "very_low": 0.9, "reference": 1.7},
    "Study_Hours": {"high": 4.2, "very_high": 5.3, "reference": 2.8},
}
PRIORITIES = ("High", "Medium", "Low")
MAX_ITEMS = 6


@dataclass(frozen=True)
class Rule:
    """`side` is "below" or "above" the named threshold of `feature`.

    Texts may use {value} (the observed number) and {name} for each entry of the rule
    set's `texts`.
    """

    feature: str
    side: str
    threshold: str
    category: str
    title: str
    reason: str
    action: str


@dataclass(frozen=True)
class RuleSet:
    rules: tuple[Rule, ...]
    #: name -> (column, words used when the column is blank)
    texts: Mapping[str, tuple[str, str]]
    #: item added when the label is in the upper half of the label order
    support_category: str
    support_title: str
    support_reason: str
    support_action: str
    minor_action: str
    minor_column: str | None
    minor_below: float
    #: item used when nothing else applies
    fallback: tuple[str, str, str, str]
    summary: str
    disclaimer: str


# Wording of the survey's items.
SURVEY_RULES = RuleSet(
    rules=(
        Rule("Sleep_Hours_Per_Night", "below", "low", "Sleep", "Make more room for sleep",
             "You reported {value} hours of sleep. A little more sleep may help you "
             "feel more rested and ready for the day.",
             "Try going to bed 15–30 minutes earlier for the next few nights."),
        Rule("Sleep_Hours_Per_Night", "above", "high", "Sleep", "Check how rested you feel",
             "You reported {value} hours of sleep. Sleep length does not always show "
             "how restful your sleep was.",
             "Keep a regular sleep and wake time. If you often feel tired after sleeping, "
             "consider speaking with a qualified health professional."),
        Rule("Avg_Daily_Usage_Hours", "above", "high", "Screen time", "Take control of your screen time",
             "You reported {value} hours of daily screen use, mainly using {platform} "
             "for {purpose}. Long screen sessions can leave less time for rest and other activities.",
             "Choose one {platform} session to shorten and set aside one screen-free period each day."),
        Rule("Daily_Unlocks", "above", "high", "Digital interruptions", "Reduce avoidable phone checks",
             "You reported checking your phone about {value} times a day. Frequent "
             "checks can interrupt focus and relaxation.",
             "Turn off non-essential notifications and put your phone out of reach during "
             "one study, work, or rest period."),
        Rule("Physical_Activity_Hours", "below", "low", "Physical activity", "Add a little more movement",
             "You reported {value} hours of physical activity. A short movement "
             "break may help refresh your body and mind.",
             "Start with a short walk or stretch that fits your routine, then build up gradually."),
        Rule("Study_Hours", "above", "high", "Study balance", "Plan breaks during study time",
             "You reported studying for {value} hours. Long study sessions can make it "
             "harder to rest, move, and stay focused.",
             "Study in shorter focused blocks, take a brief break between them, and choose "
             "a clear time to finish."),
    ),
    texts={
        "platform": ("Most_Used_Platform", "your most-used platform"),
        "purpose": ("Purpose_Of_Use", "your usual purpose"),
    },
    support_category="General wellbeing",
    support_title="Talk to someone if stress continues",
    support_reason="Your result shows a {label_lower} stress level. This is a "
                   "helpful signal to check in with yourself, but it is not a diagnosis.",
    support_action="If ongoing stress is affecting daily life, consider checking in with "
                   "someone you trust or a qualified counselor or health professional.",
    minor_action="If ongoing stress is affecting daily life, consider checking in with a "
                 "trusted adult, school counselor, or qualified health professional.",
    minor_column="Age",
    minor_below=18.0,
    fallback=(
        "Routine balance", "Keep reviewing what works",
        "Your answers did not highlight a specific habit that needs attention right now.",
        "Check in with your sleep, screen time, movement, and study balance each week. "
        "If something feels difficult, change one small thing at a time.",
    ),
    summary="Your {label} result sets the priority shown below. The suggestions "
            "focus on the habits in your answers that may benefit from a small change.",
    disclaimer="These are general lifestyle suggestions, not medical advice or a diagnosis.",
)


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """A text template as one concat; unknown placeholders raise."""
    parts: list[Column] = []
    rest = template
    while rest:
        before, brace, after = rest.partition("{")
        if before:
            parts.append(F.lit(before))
        if not brace:
            break
        name, _, rest = after.partition("}")
        parts.append(values[name])
    return F.concat(*parts) if parts else F.lit("")


def priority_for(label: Column, labels: Sequence[str]) -> Column:
    """First label: Low; lower half: Medium; upper half: High; unknown label: Medium."""
    if len(labels) < 2:
        return F.lit("Medium")
    middle = (len(labels) + 1) // 2
    chain = F.when(label == labels[0], F.lit("Low"))
    return chain.when(label.isin(*labels[middle:]), F.lit("High")).otherwise(F.lit("Medium"))


def is_elevated(label: Column, labels: Sequence[str]) -> Column:
    upper = list(labels)[(len(labels) + 1) // 2:]
    return F.coalesce(label.isin(*upper), F.lit(False)) if upper else F.lit(False)


def _number(df: DataFrame, column: str) -> Column:
    """A finite number; booleans, other texts and absent columns are missing."""
    if column not in df.columns or df.schema[column].dataType.simpleString() == "boolean":
        return F.lit(None).cast("double")
    return finite(to_number(F.col(quoted(column)), df.schema[column].dataType))


def _item(category: Column, title, priority, reason, action, feature, observed, threshold, relevance) -> Column:
    rank = F.when(priority == "High", 0).when(priority == "Medium", 1).otherwise(2)
    return F.struct(
        rank.alias("_rank"), (-relevance).alias("_order"), category.alias("category"),
        title.alias("title"), priority.alias("priority"), reason.alias("reason"), action.alias("action"), feature.alias("source_feature"), observed.alias("observed_value"),
        threshold.alias("threshold_value"),
    )


def with_items(
    df: DataFrame, label: str, labels: Sequence[str], thresholds: Mapping[str, object] | None = None,
    rules: RuleSet = SURVEY_RULES, max_items: int = MAX_ITEMS, output: str = "items",
) -> DataFrame:
    """Add array<struct<category, title, priority, reason, description, action,
    source_feature, observed_value, threshold_value>> to each row.

    The steps are separate projections: an array that is read twice is built once.
    """
    limits = thresholds or DEFAULT_THRESHOLDS
    predicted = F.col(quoted(label)).cast("string")
    features = {rule.feature for rule in rules.rules} | ({rules.minor_column} if rules.minor_column else set())
    numbers = {f: f"_v_{i}" for i, f in enumerate(sorted(features))}
    texts_at = {name: f"_t_{i}" for i, name in enumerate(rules.texts)}
    staged: dict[str, Column] = {v: _number(df, f) for f, v in numbers.items()}
    for name, (column, _) in rules.texts.items():
        found = strip(F.col(quoted(column)).cast("string")) if column in df.columns else F.lit(None).cast("string")
        staged[texts_at[name]] = found
    source = df.withColumns(staged)
    source = source.withColumns({
        **{f"{v}s": short_number(F.col(v)) for v in numbers.values()},
        **{t: F.coalesce(F.nullif(F.col(t), F.lit("")), F.lit(rules.texts[n][1])) for n, t in texts_at.items()},
        "_priority": priority_for(predicted, labels),
    })
    helpers = [*numbers.values(), *[f"{v}s" for v in numbers.values()], *texts_at.values(), "_priority"]
    priority = F.col("_priority")
    words: dict[str, Column] = {"label": predicted, "label_lower": F.lower(predicted)}
    words.update({name: F.col(t) for name, t in texts_at.items()})

    candidates: list[Column] = []
    for rule in rules.rules:
        value = F.col(numbers[rule.feature])
        limit = float(limits[rule.feature][rule.threshold])
        fired = value < F.lit(limit) if rule.side == "below" else value > F.lit(limit)
        texts = {**words, "value": F.col(numbers[rule.feature] + "s")}
        candidates.append(F.when(fired, _item(
            F.lit(rule.category), F.lit(rule.title), priority, fill(rule.reason, texts), fill(rule.action, texts),
            F.lit(rule.feature), value, F.lit(limit), F.abs(value - F.lit(limit)) / F.lit(max(limit, 1.0)),
        )))
    nothing = F.lit(None).cast("double")
    if rules.minor_column:
        minor = F.coalesce(F.col(numbers[rules.minor_column]) < F.lit(rules.minor_below), F.lit(False))
        support_action = F.when(minor, F.lit(rules.minor_action)).otherwise(F.lit(rules.support_action))
    else:
        support_action = F.lit(rules.support_action)
    candidates.append(F.when(is_elevated(predicted, labels), _item(
        F.lit(rules.support_category), F.lit(rules.support_title), priority, fill(rules.support_reason, words),
        support_action, F.lit(None).cast("string"), nothing, nothing, F.lit(10.0),
    )))
    category, title, reason, action = rules.fallback
    fallback = F.array(_item(
        F.lit(category), F.lit(title), priority, F.lit(reason), F.lit(action),
        F.lit(None).cast("string"), nothing, nothing, F.lit(0.0),
    ))

    items = F.col(output)
    result = source.withColumn(output, F.array_compact(F.array(*candidates)))
    # the leading struct fields are the sort key
    result = result.withColumn(output, F.array_sort(F.when(F.size(items) > 0, items).otherwise(fallback)))
    categories = {rule.category for rule in rules.rules} | {rules.support_category}
    if len(categories) < len(rules.rules) + 1:
        result = result.withColumn("_names", F.transform(items, lambda item: item.category))
        first = F.filter(
            F.transform(
                items, lambda item, i: F.when(F.array_position(F.col("_names"), item.category) == i + 1, item)
            ),
            lambda item: item.isNotNull(),
        )
        result = result.withColumn(output, first).drop("_names")

    def public(item: Column) -> Column:
        kept = [item.getField(f).alias(f) for f in ("category", "title", "priority", "reason")]
        rest = [item.getField(f).alias(f) for f in ("action", "source_feature", "observed_value", "threshold_value")]
        return F.struct(*kept, item.reason.alias("description"), *rest)

    return result.withColumn(output, F.transform(F.slice(items, 1, max_items), public)).drop(*helpers)


def recommend(
    df: DataFrame, label: str, labels: Sequence[str], thresholds: Mapping[str, object] | None = None,
    rules: RuleSet = SURVEY_RULES, max_items: int = MAX_ITEMS, output: str = "recommendations",
) -> DataFrame:
    """Add the result struct: predicted_risk, threshold_source, summary, items, disclaimer."""
    limits = thresholds or DEFAULT_THRESHOLDS
    predicted = F.col(quoted(label)).cast("string")
    result = F.struct(
        predicted.alias("predicted_risk"),
        F.lit(str(limits.get("source", "model_training_data"))).alias("threshold_source"),
        fill(rules.summary, {"label": predicted}).alias("summary"),
        F.col("_items").alias("items"),
        F.lit(rules.disclaimer).alias("disclaimer"),
    )
    itemised = with_items(df, label, labels, limits, rules, max_items, "_items")
    return itemised.withColumn(output, result).drop("_items")


def recommend_long(df: DataFrame, row_id: str, column: str = "recommendations") -> DataFrame:
    """One row per item, with its 1-based position."""
    # item lists are never empty; the outer form keeps the optimizer from copying their whole
    # expression into a "not empty" filter below every projection
    return df.select(F.col(quoted(row_id)), F.posexplode_outer(F.col(column).getField("items")).alias("_p", "_item")).select(
        quoted(row_id), (F.col("_p") + 1).alias("position"), "_item.*"
    )


def earlier_shape(df: DataFrame, column: str = "recommendations", cluster: str | None = "cluster") -> DataFrame:
    """The older result shape: risk_level, cluster_id, cluster_insight, overall_summary, actions, disclaimer."""
    result = F.col(column)
    return df.withColumn(column, F.struct(
        result.predicted_risk.alias("risk_level"),
        (F.col(cluster) if cluster else F.lit(None).cast("int")).alias("cluster_id"),
        result.summary.alias("cluster_insight"),
        result.summary.alias("overall_summary"),
        result.getField("items").alias("actions"),
        result.disclaimer.alias("disclaimer"),
    ))


def prompts(df: DataFrame, medians: Mapping[str, float]) -> Column:
    """Short prompts: sleep below, screen time above, unlocks above the training median."""
    # Column, side, median used when none was fitted, text.
    entries = (
        ("Sleep_Hours_Per_Night", "below", 7.0, "A little more sleep may help you feel more rested."),
        ("Avg_Daily_Usage_Hours", "above", 3.0, "Consider setting aside one screen-free period each day."),
        ("Daily_Unlocks", "above", 60.0, "Turning off non-essential notifications may help reduce interruptions."),
    )
    return prompt_column(df, [(c, side, float(medians.get(c, default)), text) for c, side, default, text in entries])


def prompt_column(df: DataFrame, entries: Sequence[tuple[str, str, float, str]]) -> Column:
    texts = []
    for column, side, median, text in entries:
        value = _number(df, column)
        fired = value < F.lit(median) if side == "below" else value > F.lit(median)
        texts.append(F.when(fired, F.lit(text)))
    return F.array_compact(F.array(*texts))


def thresholds_from_rows(rows, source: str = "training_split_quantiles") -> dict:
    """Collected (column, threshold, value) rows as the mapping the rules read."""
    result: dict = {"source": source}
    for r in rows:
        result.setdefault(r["column"], {})[r["threshold"]] = r["value"]
    return result
