import hashlib

import numpy as np
import xxhash

from conftest_llm import EDGES, corpus, prose, table
from profilespark.llm import imatch
from profilespark.llm.text import encoded


def band(spark, docs):
    return imatch.lexicon(docs, min_share=0.02, max_share=0.4)


def test_document_frequency_and_band_equal_brute_force(spark, documents):
    texts = [t.encode().lower().split() for _, t in corpus()]
    counts = {}
    for words in texts:
        for w in set(words):
            counts[w] = counts.get(w, 0) + 1
    found = sorted(r.documents for r in imatch.document_frequency(documents).collect())
    assert found == sorted(counts.values())
    n = len(texts)
    assert len(band(spark, documents)) == sum(max(2, 0.02 * n) <= c <= 0.4 * n for c in counts.values())


def test_rows_equal_brute_force(spark, documents):
    rows = sorted(corpus())
    known = band(spark, documents)
    got = {r.doc_id: r for r in imatch.compare_neighbours(documents, known).collect()}
    assert len(got) == len(rows)
    own = imatch.Fingerprints(encoded([t for _, t in rows]), known).as_text()
    for k, (doc_id, text) in enumerate(rows):
        changed = imatch.edit(text, rows[(k + 1) % len(rows)][1])
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), own[k])
        assert r.edited_fingerprint == imatch.Fingerprints(encoded([changed]), known).as_text()[0]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len({got[i].fingerprint for i in (3, 60, 61, 62, 63)}) == 1  # copies
    assert got[60].near_next == got[61].near_next == 1
    plain = [got[i] for i in range(38)]
    assert np.mean([r.near_edited for r in plain]) > 0.3 > 0.1 > np.mean([r.near_next for r in plain])


def test_order_ties_and_nulls(spark, edges, empty):
    got = imatch.compare_neighbours(edges, band(spark, edges)).collect()
    assert len(got) == len(EDGES)
    def version(text):
        return np.uint64(xxhash.xxh64((text or "").encode(), seed=42).intdigest()).astype(np.int64)

    order = sorted(EDGES, key=lambda r: (-(1 << 63) if r[0] is None else r[0], version(r[1])))
    want = sorted(hashlib.sha256(imatch.edit(t or "", order[(k + 1) % len(order)][1] or "").encode()).hexdigest() for k, (_, t) in enumerate(order))
    assert sorted(r.edited_sha256 for r in got) == want
    assert imatch.compare_neighbours(empty, band(spark, empty)).count() == 0
    one = imatch.compare_neighbours(table(spark, [(1, prose(1, 30))]), np.zeros(0, dtype=np.uint64)).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(imatch.edit(prose(1, 30), prose(1, 30)).encode()).hexdigest()
