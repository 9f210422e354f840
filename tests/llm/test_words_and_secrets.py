import hashlib
import random
import re

import numpy as np
import pytest

from conftest_llm import EDGES, corpus
from profilespark.llm import secrets
from profilespark.llm.anchors import anchors, merged
from profilespark.llm.text import Words, crc_fold, encoded, inside, run_hash


def test_words_are_those_of_the_pattern():
    texts = [t for _, t in corpus() + EDGES]
    data = encoded(texts)
    words = Words(data)
    got = [words.buffer[a:b] for a, b in zip(words.start, words.end)]
    assert got == [w for t in texts for w in (x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", t or ""))]
    assert len(set(words.hash.tolist())) == len(set(got))
    for n in (1, 3, 20):
        at = inside(words.first, n)
        runs = [tuple(got[i:i + n]) for i in at]
        assert len(set(run_hash(words.hash, n)[at].tolist())) == len(set(runs))


def test_every_window_has_an_anchor_and_equal_windows_share_its_hash():
    draw = random.Random(5)
    for alphabet in (1, 2, 5):
        values = np.array([draw.randrange(alphabet) for _ in range(400)], dtype=np.uint64)
        hashes = run_hash(values, 3)
        places = anchors(hashes, 10, np.array([0, len(values)]))
        for s in range(len(hashes) - 9):
            own = places[(places >= s) & (places < s + 10)]
            assert len(own) and hashes[s:s + 10].min() in hashes[own]


def test_merged_spans():
    a, b = merged(np.array([5, 1, 3, 20]), np.array([9, 4, 5, 21]))
    assert (a.tolist(), b.tolist()) == ([1, 20], [9, 21])


def test_fold_of_ids():
    assert crc_fold(None, 7) == 0 and crc_fold(123, 1000) == __import__("zlib").crc32(b"123") % 1000


def brute(text):
    text = text or ""
    out = [(m.start(), m.end(), "assign") for m in secrets.ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), m.end(), "access") for m in secrets.ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), "hex") for m in secrets.HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


PARTS = ["token", "secret=", "api_key", "ApiKey:", " ", "=", ":", "\"'", "abcdef0123456789", "AKIA", "akia", "ABCDEFGH12345678",
         "é", "ſecret=abcdefghij", "\n", "password : ", "deadbeef" * 4, "TOKEN"]


def test_base_spans_equal_a_plain_scan():
    draw = random.Random(2)
    for _ in range(5000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14)))
        assert [s for s in secrets.find(text) if s[2] in secrets.BASE_KINDS] == brute(text)


def test_embedded_checksums_decide():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = "ghp_" + body + secrets.base62(__import__("zlib").crc32(body.encode()), 6)
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert secrets.find(f"x {good} y") == [(2, 2 + len(good), "hosting")]
    assert secrets.find(f"x {bad} y") == []
    assert [s[2] for s in secrets.find("eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc-_")] == ["web"]
    assert secrets.find("eyJhbGciOiJI.eyJzdWIiOiIxIn0.abc") == []


def test_redaction_and_table_form(spark, edges, empty):
    assert secrets.redact("é password=abcdefgh12 .") == "é [assign] ."
    rows = secrets.summary(edges).collect()
    assert len(rows) == len(EDGES)
    nothing = hashlib.sha256(b"").hexdigest()
    assert all((r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == (0, 0, 0, nothing, "") for r in rows)
    assert secrets.summary(empty).count() == 0 and secrets.redacted(empty).count() == 0
    long = "x" * 300_000 + " token: 0123456789abcdef0123456789abcdef"
    docs = spark.createDataFrame([(1, long, None, None, None), (2, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = {r.doc_id: r for r in secrets.summary(docs).collect()}
    assert found[1].spans == f"assign:300001:{len(long)},hex:300008:{len(long)}"
    kept = {r.doc_id: r for r in secrets.redacted(docs).collect()}
    assert kept[1].text == "x" * 300_000 + " [assign]" and kept[1].n_chars == 300_009 and kept[2].text is None
