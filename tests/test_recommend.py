import pytest
from conftest import row

from profilespark.contract import SURVEY
from profilespark.operators import dictionary, recommend, score

FIELDS = (
    "Age double, Academic_Level string, Avg_Daily_Usage_Hours double, Most_Used_Platform string, Purpose_Of_Use string, "
    "Daily_Unlocks double, Study_Hours double, Physical_Activity_Hours double, Sleep_Hours_Per_Night double"
)
DEFAULTS = dict(
    Age=30.0, Academic_Level="Graduate", Avg_Daily_Usage_Hours=5.0, Most_Used_Platform="YouTube", Purpose_Of_Use="Education",
    Daily_Unlocks=171.0, Study_Hours=2.8, Physical_Activity_Hours=1.7, Sleep_Hours_Per_Night=6.6,
)
EVERYTHING = dict(Sleep_Hours_Per_Night=4.0, Avg_Daily_Usage_Hours=9.0, Daily_Unlocks=260.0, Study_Hours=8.0, Physical_Activity_Hours=0.0)


def run(spark, label, thresholds=None, schema=FIELDS, max_items=6, **changes):
    values = {**DEFAULTS, **changes}
    names = [f.split()[0] for f in schema.split(", ")]
    df = spark.createDataFrame([tuple(values[n] for n in names) + (label,)], schema + ", label string")
    return recommend.recommend(df, "label", SURVEY.labels, thresholds, max_items=max_items).first().recommendations


def item(result, category):
    return next(i for i in result["items"] if i.category == category)


@pytest.mark.parametrize("changes, category", [
    ({"Sleep_Hours_Per_Night": 4.5}, "Sleep"), ({"Avg_Daily_Usage_Hours": 8.0}, "Screen time"),
    ({"Daily_Unlocks": 250.0}, "Digital interruptions"), ({"Physical_Activity_Hours": 0.5}, "Physical activity"),
    ({"Study_Hours": 7.0}, "Study balance"),
])
def test_each_rule_alone(spark, changes, category):
    result = run(spark, "Low", **changes)
    assert [i.category for i in result["items"]] == [category]
    found = result["items"][0]
    feature, value = next(iter(changes.items()))
    assert found.source_feature == feature and found.observed_value == value and found.threshold_value is not None
    assert f"{value:g}" in found.reason and found.description == found.reason and found.action


def test_long_sleep_is_a_different_item(spark):
    found = item(run(spark, "Low", Sleep_Hours_Per_Night=9.5), "Sleep")
    assert found.title == "Check how rested you feel" and found.threshold_value == 8.3


def test_screen_item_names_platform_and_purpose(spark):
    found = item(run(spark, "Medium", Avg_Daily_Usage_Hours=8.0, Most_Used_Platform=" Instagram ", Purpose_Of_Use="Networking"), "Screen time")
    assert "mainly using Instagram for Networking" in found.reason and "Instagram" in found.action
    found = item(run(spark, "Medium", Avg_Daily_Usage_Hours=8.0, Most_Used_Platform=None, Purpose_Of_Use="  "), "Screen time")
    assert "your most-used platform for your usual purpose" in found.reason


@pytest.mark.parametrize("label, priority", [("Low", "Low"), ("Medium", "Medium"), ("High", "High"), ("Very High", "High"), ("?", "Medium")])
def test_priority_follows_the_label(spark, label, priority):
    result = run(spark, label, **EVERYTHING)
    assert {i.priority for i in result["items"]} == {priority}
    assert ("General wellbeing" in [i.category for i in result["items"]]) == (label in ("High", "Very High"))


def test_support_wording_depends_on_age_only(spark):
    young, old = (item(run(spark, "Very High", Age=a), "General wellbeing") for a in (15.0, 72.0))
    assert young.priority == old.priority == "High"
    assert "trusted adult" in young.action and "trusted adult" not in old.action
    assert "very high stress level" in young.reason and "not a diagnosis" in young.reason


def test_invalid_values_fall_back(spark):
    schema = "Sleep_Hours_Per_Night double, Avg_Daily_Usage_Hours string, Daily_Unlocks double, Study_Hours boolean"
    result = run(spark, "Low", schema=schema, Sleep_Hours_Per_Night=None, Avg_Daily_Usage_Hours="unknown", Daily_Unlocks=float("nan"), Study_Hours=True)
    assert [i.category for i in result["items"]] == ["Routine balance"]


def test_unique_ordered_and_capped(spark):
    result = run(spark, "Very High", **EVERYTHING)
    categories = [i.category for i in result["items"]]
    assert len(categories) == 6 == len(set(categories)) and categories[0] == "General wellbeing"
    # relevance: activity 1.3/1.3, study 3.8/4.2, screen 2.7/6.3, sleep 1.6/5.6, unlocks 56/204
    assert categories[1:] == ["Physical activity", "Study balance", "Screen time", "Sleep", "Digital interruptions"]
    assert len(run(spark, "Very High", max_items=2, **EVERYTHING)["items"]) == 2


def test_envelope(spark):
    result = run(spark, "Low")
    assert result.predicted_risk == "Low" and result.threshold_source == "checked_training_split_quantiles"
    assert result.summary.startswith("Your Low result") and "not medical advice" in result.disclaimer
    custom = {**recommend.DEFAULT_THRESHOLDS, "source": "training_split_quantiles"}
    assert run(spark, "Low", custom).threshold_source == "training_split_quantiles"


def test_earlier_shape(spark):
    names = [f.split()[0] for f in FIELDS.split(", ")]
    df = spark.createDataFrame([tuple(DEFAULTS[n] for n in names) + ("Low", 0)], FIELDS + ", label string, cluster int")
    out = recommend.earlier_shape(recommend.recommend(df, "label", SURVEY.labels)).first().recommendations
    assert out.risk_level == "Low" and out.cluster_id == 0 and out.cluster_insight == out.overall_summary
    assert [a.category for a in out.actions] == ["Routine balance"]


def test_prompts_and_notes(spark):
    r = row(Sleep_Hours_Per_Night=6.0, Avg_Daily_Usage_Hours=5.0, Daily_Unlocks=50.0, Age=40.0, Study_Hours=9.0, Most_Used_Platform=" Facebook ", Academic_Level="Postgraduate", Purpose_Of_Use="Chess")
    df = spark.createDataFrame([tuple(r.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in r.items()))
    medians = {"Sleep_Hours_Per_Night": 6.5, "Avg_Daily_Usage_Hours": 4.0, "Daily_Unlocks": 100.0}
    assert df.select(recommend.prompts(df, medians)).first()[0] == [
        "A little more sleep may help you feel more rested.", "Consider setting aside one screen-free period each day."]
    ranges = {c: (0.0, 8.0) if c == "Study_Hours" else (18.0, 24.0) if c == "Age" else (0.0, 2000.0) for c in SURVEY.numeric}
    known = {"Academic_Level": ["Graduate"], "Most_Used_Platform": ["Facebook"], "Purpose_Of_Use": ["News"]}
    flagged, flags = score.with_unseen(df, SURVEY, dictionary.of_values(spark, known))
    assert flagged.select(score.notes(flagged, SURVEY, ranges, flags)).first()[0] == [
        "Age is outside the observed training range (18-24). Age is excluded from prediction, but performance for this age group is unverified.",
        "Study hours is outside the observed training range (0-8); this prediction may be less reliable.",
        "Main purpose was unseen in training and is encoded as an unknown category.",
    ]
