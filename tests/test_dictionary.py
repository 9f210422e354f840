"""Dictionaries of any size: positions, lookups by both ways, sparse encoding, and sums over many distinct scores."""

import random

import pytest
from conftest import frame, training_rows
from pyspark.sql import functions as F

from profilespark.contract import SURVEY, Contract
from profilespark.operators import dictionary, evaluate, features, ordered, score, stats
from profilespark.sources.bundle import Bundle

WIDE = Contract("wide", ("x",), ("word", "kind"), row_id="id")


@pytest.fixture(scope="module")
def words(spark):
    """300,000 rows: a third of them holds one value, the rest some 170,000 different ones; nulls among them."""
    word = F.when(F.col("id") % 3 == 0, "the").when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.concat(F.lit("w"), F.xxhash64("id") % 250_000))
    return spark.range(300_000).select("id", F.rand(1).alias("x"), word.alias("word"), F.concat(F.lit("k"), F.col("id") % 5).alias("kind")).cache()


def test_positions_without_one_task_per_key(spark, words):
    got = stats.vocabulary(words, ["word", "kind"]).cache()
    wanted = sorted({r.word for r in words.select("word").distinct().collect()} - {None})
    rows = {r.position: r.value for r in got.filter("column = 'word'").collect()}
    assert [rows[i] for i in range(len(rows))] == wanted
    assert [r.value for r in got.filter("column = 'kind'").orderBy("position").collect()] == [f"k{i}" for i in range(5)]
    ranges = ordered._in_ranges(stats.category_counts(words, ["word", "kind"]), ["column"], "value")
    sizes = [r["count"] for r in ranges.groupBy(F.shiftright("_at", 33)).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / 8


@pytest.mark.parametrize("sent", [10**6, 50])
def test_lookups_by_broadcast_and_by_shuffle(spark, words, monkeypatch, sent):
    monkeypatch.setattr(dictionary, "SENT_VALUES", sent)
    known = dictionary.build(words.filter("id < 200000"), ["word"])
    assert known.is_small("word") == (sent > 50)
    rows = words.filter("id >= 150000 or id % 7 = 0")
    got = known.with_position(rows, F.col("word"), "word", "at")
    assert got.count() == rows.count() and got.columns == [*rows.columns, "at"]
    table = {r.value: r.position for r in known.table.collect()}
    assert all(table.get(r.word) == r.at for r in got.select("word", "at").collect())
    assert got.filter("word is null and at is not null").count() == 0


def test_a_million_categories_encode(spark):
    rows = spark.range(1_000_000).select("id", F.lit(1.0).alias("x"), F.concat(F.lit("c"), F.col("id")).alias("word"), F.lit("k").alias("kind"))
    prep = features.fit_preparation(rows, WIDE)
    assert prep.dictionary and prep.categories("word") == 1_000_000 and prep.modes["kind"] == "k"
    asked = spark.createDataFrame([(1, 1.0, "c5", "k"), (2, None, "new", "k"), (3, 1.0, None, "other")], "id long, x double, word string, kind string")
    vectors = {r.id: r.features for r in prep.transform(asked, WIDE).select("id", "features").collect()}
    assert {v.size for v in vectors.values()} == {1_000_002}
    names = features.feature_names(prep, rows)
    at = names.filter("name = 'word_c5'").first().position
    assert list(vectors[1].indices)[-2:] == [at, 1_000_001] and list(vectors[2].indices) == [1_000_001]
    # a missing value is the mode: the smallest text, as all are met once
    assert vectors[3][names.filter("name = 'word_c0'").first().position] == 1.0
    assert names.count() == 1_000_002
    with pytest.raises(ValueError, match="feature_names"):
        prep.names


def test_both_ways_of_encoding_agree(spark, monkeypatch):
    df = frame(spark, *training_rows(60)).withColumn("row_id", F.monotonically_increasing_id())
    small = features.fit_preparation(df, SURVEY)
    monkeypatch.setattr(features, "COLLECTED", 2)
    monkeypatch.setattr(dictionary, "SENT_VALUES", 1)
    large = features.fit_preparation(df, SURVEY)
    assert large.dictionary and not small.dictionary and large.modes == small.modes
    one, other = ({r.row_id: r.features for r in p.transform(df, SURVEY).select("row_id", "features").collect()} for p in (small, large))
    assert one == other
    assert features.feature_names(large, df).orderBy("position").collect() == features.feature_names(small, df).orderBy("position").collect()


def test_a_plan_does_not_grow_with_the_known_values(spark):
    df = frame(spark, *training_rows(8))
    sizes = []
    for n in (3, 3000):
        rows, flags = score.with_unseen(df, SURVEY, dictionary.of_values(spark, {"Purpose_Of_Use": [f"v{i}" for i in range(n)]}))
        sizes.append(len(rows.select(*score.unseen_notes(SURVEY, flags))._jdf.queryExecution().optimizedPlan().toString()))
        assert rows.filter("_unseen_2").count() == 8
    assert abs(sizes[0] - sizes[1]) < 200


def test_auc_over_more_scores_than_any_fixed_number_of_buckets(spark):
    draw = random.Random(9)
    rows = [(draw.choice("ab"), draw.random()) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "actual string, p double").select(
        "actual", F.lit("a").alias("predicted"), F.create_map(F.lit("a"), "p", F.lit("b"), 1 - F.col("p")).alias("probabilities"))
    order = sorted(p for _, p in rows)
    place = {p: i for i, p in enumerate(order)}
    positives = [place[p] for y, p in rows if y == "a"]
    wins = sum(positives) - len(positives) * (len(positives) - 1) / 2
    area = wins / (len(positives) * (len(rows) - len(positives)))
    assert evaluate.roc_auc(df, ("a", "b")).first()[0] == pytest.approx(area)
    ranges = ordered._in_ranges(df.select(F.lit("a").alias("label"), F.element_at("probabilities", F.lit("a")).alias("p")), ["label"], "p")
    assert max(r["count"] for r in ranges.groupBy(F.shiftright("_at", 33)).count().collect()) <= 2 * len(rows) / 8


def test_box_statistics_exchange_no_rows(spark):
    rows = spark.range(5000).select((F.col("id") % 3).cast("string").alias("y"), F.rand(2).alias("a"), F.rand(3).alias("b"))
    plan = stats.box_stats(rows, ["a", "b"], "y")._jdf.queryExecution().executedPlan().toString()
    # what is exchanged are partial sums: every exchange stands above an aggregate
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    lines = [line for line in plan.splitlines() if "- Exchange" in line]
    below = [plan.splitlines()[plan.splitlines().index(line) + 1] for line in lines]
    assert all("HashAggregate" in line for line in below), plan


def test_a_bundle_with_a_dictionary_is_saved_and_loaded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(features, "COLLECTED", 2)
    df = frame(spark, *training_rows(60)).withColumn("row_id", F.monotonically_increasing_id())
    prep = features.fit_preparation(df, SURVEY)
    bundle = Bundle(SURVEY.with_(row_id="row_id"), prep, {}, None, None, {"artifact_version": 2, "primary_model": "none"})
    bundle.save(str(tmp_path / "b"))
    monkeypatch.setattr(Bundle, "primary", "none")
    loaded = Bundle.load(spark, str(tmp_path / "b"))
    one, other = ({r.row_id: r.features for r in b.vectors(df).select("row_id", "features").collect()} for b in (bundle, loaded))
    assert one == other
