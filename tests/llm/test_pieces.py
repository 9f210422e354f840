import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from conftest_llm import EDGES, corpus
from profilespark.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return pieces.pieces(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_encoding_and_decoding_equal_the_library(own, library):
    draw = random.Random(1)
    letters = "ab the ing  \n1▁é梦́Z<>/{}_\t"
    texts = ["", " ", "a", "▁x", "a▁b", "\x00a", "\U0001f600x", "<s>a</s><0x41>", "a" * 1000, "xyz" * 3000]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(draw.choice([" ", "▁", "a", "t", "\n", "     ", "{"]) for _ in range(draw.randint(0, 60))) for _ in range(1000)]
    texts += [" " * n + tail for n in range(1, 80) for tail in ("", "x", "the")]
    texts += [t or "" for _, t in corpus() + EDGES]
    for text in texts:
        ids = library.encode(text, add_eos=True)
        assert own.encode(text) == ids, text[:80]
        assert own.decode(ids) == library.decode(ids), text[:80]


def test_search_goes_back_where_longest_matches_fail(own):
    draw = random.Random(4)
    words = ["".join(draw.choice("etaoinshr") for _ in range(12)) for _ in range(300)]
    greedy = [[p for _, p in own.automaton.iter_long(w)] for w in words]
    right = [own.merged(w) for w in words]
    assert any(a != b for a, b in zip(greedy, right))
    assert [own.segment(w) for w in words] == right


def test_table_forms(spark, documents, edges, empty, library):
    rows = {(r.doc_id, r.ids_sha256): r for r in pieces.digests(documents, MODEL).collect()}
    assert len(rows) == len(corpus())
    for doc_id, text in corpus():
        ids = library.encode(text, add_eos=True)
        row = rows[doc_id, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()]
        assert (row.n_tokens, row.decoded_sha256) == (len(ids), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert pieces.digests(edges, MODEL).count() == len(EDGES) and pieces.digests(empty, MODEL).count() == 0
    back = pieces.decode(pieces.encode(edges, MODEL), MODEL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, library.decode(library.encode(t or ""))) for i, t in EDGES)
    assert pieces.with_ids(documents, MODEL).columns == [*documents.columns, "ids", "n_tokens"]


def test_a_column_named_as_the_result_is_refused(documents):
    for name in ("ids", "N_TOKENS"):
        with pytest.raises(ValueError, match="named as the result"):
            pieces.with_ids(documents.withColumn(name, documents["source"]), MODEL)
