import uuid

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from conftest_llm import corpus, prose, table
from profilespark.llm import jaccard, secrets, toxicity
from profilespark.llm.queries import QUERIES, piece_model
from test_quality_and_toxicity import toxic_text


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with toxic documents, near copies and secrets planted among clean ones."""
    base = tmp_path_factory.mktemp(f"tables-{uuid.uuid4().hex[:6]}")
    rows = [(i, t) for i, t in corpus() if i not in (64, 65, 66, 67)] + [(1000 + i, toxic_text(i)) for i in range(60)]
    rows += [(2000 + i, prose(i + 50, 90)) for i in range(120)] + [(3000, prose(3000, 40) + " password=hunter2hunter2 end"), (3001, None), (3002, "")]
    table(spark, rows).write.parquet(f"{base}/documents.parquet")
    labels = [(i, 1, int(1000 <= i < 2000)) for i, _ in rows if i < 3000]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


def test_each_stage_does_its_own_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = f"{folder}/after-{name}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = (before, docs)
        if name != "pieces":
            assert docs.columns == names
    before, after = kept["toxicity"]
    left = {r.doc_id for r in after.collect()}
    assert sum(1000 + i in left for i in range(60)) <= 6 and {r.doc_id for r in before.collect() if r.doc_id < 1000 or r.doc_id >= 2000} - left == set()
    before, after = kept["jaccard"]
    assert {r.doc_id for r in after.collect()} == {r.class_id for r in jaccard.join(before).collect()}
    before, after = kept["secrets"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == {i: secrets.redact(t) for i, t in texts.items()}
    assert "[assign]" in {r.doc_id: r.text for r in after.collect()}[3000]
    before, after = kept["mixing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} and after.count() >= before.count()
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for r in kept["pieces"][1].collect():
        assert r.ids == library.encode(r.text or "", add_eos=True) and r.n_tokens == len(r.ids)


def test_an_empty_table_goes_through(spark, empty, folder):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_odd_rows_and_columns_go_through(spark, folder):
    """Repeated and missing ids, null and empty texts, and columns of any name: no clean text is lost before the last stage."""
    clean = [prose(7000 + k, 60) for k in range(6)]
    rows = [(1, clean[0]), (1, clean[1]), (None, clean[2]), (None, clean[3]), (None, clean[3]), (2, None), (2, clean[4]), (3, ""), (4, clean[5]), (4, clean[5])]
    labelled = spark.read.parquet(f"{folder}/documents.parquet")
    docs = table(spark, rows).unionByName(labelled).withColumns({c: F.lit(c) for c in ("copy", "times", "copy number", "ids", "score")})
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "pieces":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert set(clean) <= {r.text for r in docs.collect()}


def test_labels_of_one_kind_stop_the_first_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 0").write.parquet(f"{tmp_path}/labels.parquet")
    with pytest.raises(ValueError, match="both kinds"):
        corpus_pipeline.without_toxic(spark, docs, str(tmp_path))


def test_every_operator_is_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert toxicity.PREDICTED_AT == 0.7 and corpus_pipeline.ORACLE_SQL is None
