import pytest
from conftest import frame, row
from pyspark.sql import functions as F

from profilespark.contract import AGE_EDGES, AGE_GROUPS, SURVEY, Contract
from profilespark.functions.clean import right_closed_group, short_number, strip, to_number
from profilespark.operators import features, quality, validate
from profilespark.sources import read_csv_text, read_table, result_json
from profilespark.sources.readers import file_fingerprints, table_fingerprint


def audit_of(df, contract=SURVEY):
    return {(r["metric"], r["column"]): r["value"] for r in quality.audit(df, contract).collect()}


def test_impossible_values_become_null_and_outcomes_are_dropped(spark):
    df = frame(spark, row(Physical_Activity_Hours=-0.4))
    out = quality.clean_features(df, SURVEY)
    assert out.columns == list(SURVEY.features)
    assert out.first()["Physical_Activity_Hours"] is None
    assert df.first()["Physical_Activity_Hours"] == -0.4


def test_duplicates_conflicts_and_repeats(spark):
    df = frame(spark, row(), row(), row(Stress_Level="High"), row(Age=22.0), row(Age=22.0, Mental_Health_Score=7.0))
    prepared = quality.prepare(df, SURVEY).collect()
    assert [r.Age for r in prepared] == [22.0]
    audit = audit_of(df)
    assert audit[("exact_duplicates_removed", None)] == 1
    assert audit[("conflicting_profile_rows_removed", None)] == 2
    assert audit[("repeated_profile_rows_removed", None)] == 1
    assert audit[("prepared_rows", None)] == 1
    assert audit[("raw_rows", None)] == 5


def test_null_labels_are_removed_and_never_conflict(spark):
    df = frame(spark, row(Stress_Level=None), row(Stress_Level="  "), row(), row(Age=30.0, Stress_Level=None))
    assert quality.prepare(df, SURVEY).count() == 1
    assert audit_of(df)[("missing_target_rows_removed", None)] == 3


def test_unknown_labels_raise_with_the_sorted_set(spark):
    with pytest.raises(ValueError, match=r"unknown labels.*Moderate.*Zero"):
        quality.prepare(frame(spark, row(Stress_Level="Zero"), row(Stress_Level="Moderate")), SURVEY)


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="Sleep_Hours_Per_Night"):
        quality.prepare(frame(spark, row()).drop("Sleep_Hours_Per_Night"), SURVEY)


def test_wide_ages_are_kept(spark):
    df = frame(spark, row(Age=15.0), row(Age=32.0), row(Age=72.0))
    assert sorted(r.Age for r in quality.prepare(df, SURVEY).collect()) == [15, 32, 72]


def test_aliases_after_strip_and_blank_to_null(spark):
    df = frame(spark, row(Academic_Level=" Postgraduate\t", Purpose_Of_Use="Academic"),
               row(Academic_Level="Graduate", Purpose_Of_Use="Education"), row(Academic_Level=" \n "))
    levels = [r.Academic_Level for r in quality.clean_features(df, SURVEY).collect()]
    assert levels == ["Graduate", "Graduate", None]


def test_number_texts(spark):
    texts = ["1", " 2.5 ", "1d", "2f", ".5", "5.", "1e3", "-4", "0x10", "1,000", "", "nan", "inf", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", to_number(F.col("t"), df.schema["t"].dataType).alias("v")).orderBy("i").collect()]
    assert got == [1.0, 2.5, None, None, 0.5, 5.0, 1000.0, -4.0, None, None, None, None, float("inf"), None]


def test_short_number_matches_general_format(spark):
    values = [0.0, 4.5, 250.0, 1234567.0, 0.0001234, 0.00001, 6.0, 100000.0, 999999.0, 1000000.0, -2.25, 0.1, 123.456789]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.s for r in df.select("i", short_number(F.col("v")).alias("s")).orderBy("i").collect()]
    assert got == [f"{v:g}" for v in values]


def test_age_groups_are_right_closed(spark):
    ages = [11.9, 12.0, 17.0, 17.5, 24.0, 60.0, 120.0, 121.0]
    df = spark.createDataFrame([(a,) for a in ages], "a double")
    got = [r.g for r in df.select("a", right_closed_group(F.col("a"), AGE_EDGES, AGE_GROUPS).alias("g")).collect()]
    assert got == [None, "13-17", "13-17", "18-24", "18-24", "60-120", "60-120", None]


def test_strip_takes_every_kind_of_space(spark):
    text = "\t\n\x0b\x0c\r  　a b \x1f"
    assert spark.createDataFrame([(text,)], "t string").select(strip(F.col("t"))).first()[0] == text.strip()


def test_csv_scan_keeps_text_and_drops_missing_words(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,NA,"x, y"\nnull,nan,None\n007,1d, padded \n')
    rows = [tuple(r) for r in read_csv_text(spark, str(path)).collect()]
    assert rows == [("1", None, "x, y"), (None, None, None), ("007", "1d", " padded ")]
    assert read_table(spark, str(path)).count() == 3
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="Unsupported"):
        read_table(spark, str(tmp_path / "book.xlsx"))
    digest = file_fingerprints(spark, str(path)).first()
    assert len(digest.sha256) == 64 and digest.length == path.stat().st_size


def test_fingerprint_ignores_order_and_sees_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "i int, t string")
    b = spark.createDataFrame([("y", 2), ("x", 1), ("y", 2)], "t string, i int")
    c = spark.createDataFrame([(1, "x"), (3, "z"), (3, "z")], "i int, t string")
    prints = [table_fingerprint(d).first() for d in (a, b, c)]
    assert prints[0] == prints[1] != prints[2]


def test_json_rows_without_non_finite_numbers(spark):
    df = spark.createDataFrame([(1.5, [float("nan"), 2.0], {"k": float("inf")})], "a double, b array<double>, c map<string,double>")
    assert result_json(df).first().value == '{"a":1.5,"b":[null,2.0],"c":{"k":null}}'


def test_cleaner_stage_round_trip(spark, tmp_path):
    stage = features.FeatureCleaner.for_contract(SURVEY)
    stage.save(str(tmp_path / "stage"))
    again = features.FeatureCleaner.load(str(tmp_path / "stage"))
    df = frame(spark, row(Age=5.0, Purpose_Of_Use=" Social "))
    first, second = stage.transform(df).first(), again.transform(df).first()
    assert first == second and first.Age is None and first.Purpose_Of_Use == "Networking"


# ---------------------------------------------------------------------- validation


def rules_of(df, contract=SURVEY):
    return {(r["rule"], r["column"]): r["n"] for r in validate.strict_violations(df, contract).collect()}


def test_strict_rules_and_their_order(spark):
    good = frame(spark, row(), row(Age=30.0))
    assert rules_of(good) == {}
    assert validate.validate_strict(good, SURVEY).count() == 2
    bad = frame(spark, row(Age=12.0), row(Age=None), row(Most_Used_Platform="  "), row(Stress_Level="Moderate"))
    assert rules_of(bad) == {
        ("missing_value", "Age"): 1, ("out_of_range", "Age"): 1,
        ("blank_text", "Most_Used_Platform"): 1, ("unknown_label", "Stress_Level"): 1,
    }
    with pytest.raises(ValueError, match=r"Missing values detected: \{'Age': 1\}"):
        validate.validate_strict(bad, SURVEY)
    with pytest.raises(ValueError, match="13-120 in column 'Age' \\(1 rows\\)"):
        validate.validate_strict(bad.filter("Age is not null"), SURVEY)
    with pytest.raises(ValueError, match="Missing required columns"):
        validate.validate_strict(good.drop("Age"), SURVEY)
    with pytest.raises(ValueError, match="empty"):
        validate.validate_strict(good.filter("Age < 0"), SURVEY)
    text = good.withColumn("Age", F.lit("old"))
    with pytest.raises(ValueError, match="Invalid numeric values detected in column 'Age'"):
        validate.validate_strict(text, SURVEY)


PAYLOAD = (
    '{"Age": %s, "Avg_Daily_Usage_Hours": 4.0, "Daily_Unlocks": %s, "Study_Hours": 4.5, "Physical_Activity_Hours": 2.2, '
    '"Sleep_Hours_Per_Night": %s, "Academic_Level": "Undergraduate", "Most_Used_Platform": %s, "Purpose_Of_Use": "News"%s}'
)


@pytest.mark.parametrize("text, codes", [
    (PAYLOAD % ("21", "130", "6.7", '"Facebook"', ""), []),
    (PAYLOAD % ("12", "130", "6.7", '"Facebook"', ""), ["Age:range"]),
    (PAYLOAD % ("21", "130", "-1", '"Facebook"', ""), ["Sleep_Hours_Per_Night:range"]),
    (PAYLOAD % ("21", "2.5", "6.7", '"Facebook"', ""), ["Daily_Unlocks:type"]),
    (PAYLOAD % ("21.0", "130", "6.7", '"Facebook"', ""), ["Age:type"]),
    (PAYLOAD % ('"21"', "130", "6.7", '"Facebook"', ""), ["Age:type"]),
    (PAYLOAD % ("21", "130", "6.7", '"Facebook"', ', "Mental_Health_Score": 8'), ["Mental_Health_Score:extra"]),
    (PAYLOAD % ("21", "130", "6.7", '"   "', ""), ["Most_Used_Platform:blank"]),
    (PAYLOAD % ("21", "130", "6.7", '"' + "x" * 81 + '"', ""), ["Most_Used_Platform:too_long"]),
    (PAYLOAD % ("21", "130", "6.7", "null", ""), ["Most_Used_Platform:type"]),
    ('{"Age": 21}', [f"{c}:missing" for c in SURVEY.features if c != "Age"]),
    ("not json", ["payload:malformed"]),
    ("[1]", ["payload:malformed"]),
])
def test_json_requests(spark, text, codes):
    df = spark.createDataFrame([("r", text)], "request_id string, payload string")
    got = validate.parse_requests(df, SURVEY).first()
    assert list(got.error_codes) == codes
    if not codes:
        assert got.Age == 21 and got.Daily_Unlocks == 130


def test_hot_profile_is_absorbed_by_partial_aggregation(spark):
    """A third of the rows on one profile: the plan aggregates before it shuffles."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("v"), F.lit("a").alias("t")
    )
    contract = Contract("hot", ("v",), (), "t", ("a", "b"))
    prepared = quality.prepare(df, contract)
    assert prepared.count() == 1 + sum(1 for i in range(3000) if i % 3 and i != 1)
    plan = prepared._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min" in plan and "Window" not in plan
