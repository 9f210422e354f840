from collections import defaultdict

import numpy as np
import pytest

from conftest_llm import EDGES, corpus, prose, table
from profilespark.llm import jaccard
from profilespark.llm.components import components


def brute(rows):
    """(class of each row, links of each row); a row is one (id, text)."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().split()
        sets.append(frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else []))
    distinct = [s for s in dict.fromkeys(sets) if s]
    near = {s: {t for t in distinct if t != s and 5 * len(s & t) >= 4 * len(s | t)} for s in distinct}
    ids = defaultdict(list)
    for (doc_id, _), s in zip(rows, sets):
        ids[s].append(doc_id)
    out = []
    for (doc_id, _), s in zip(rows, sets):
        if not s:
            out.append((doc_id, doc_id, 0))
            continue
        seen, todo = {s}, [s]
        while todo:
            for t in near[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        reached = [i for t in seen for i in ids[t]]
        out.append((doc_id, None if None in reached else min(reached), len(near[s])))
    return out


def found(docs):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.join(docs).collect()), key=str)


def near_group(n, seed):
    base = prose(seed, 200).split()
    rows = []
    for i in range(n):
        words = list(base)
        for k in range(i % 3):
            words[(17 * i + 61 * k) % 200] = f"changed{i}x{k}"
        rows.append((1000 + i, " ".join(words)))
    return rows


def test_join_equals_brute_force(spark, documents):
    assert found(documents) == sorted(brute(corpus()), key=str)


def test_large_buckets_give_the_same_links(spark, monkeypatch):
    rows = corpus()[:30] + near_group(45, 77) + near_group(5, 78)[:0] + [(2000 + i, near_group(9, 77)[i][1]) for i in range(9)]
    want = sorted(brute(rows), key=str)
    assert found(table(spark, rows)) == want
    monkeypatch.setattr(jaccard, "SMALL", 3)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 7)
    assert found(table(spark, rows)) == want
    assert max(r[2] for r in want) > 20


def test_edge_rows(spark, edges, empty):
    assert found(edges) == sorted(brute(EDGES), key=str)
    assert jaccard.join(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0


def test_one_document_of_each_group_stays(spark, documents):
    rows = corpus()
    left = jaccard.one_of_each(documents)
    assert left.columns == documents.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c, _ in brute(rows)})


def test_rows_that_share_an_id_or_have_none_are_told_apart(spark):
    text, clean, real = prose(500, 120), prose(501, 120), prose(502, 120)
    near = " ".join([*text.split()[:-1], "changed"])
    rows = [(3, text), (7, near), (7, clean), (8, None), (8, real), (None, near), (None, prose(503, 90)), (None, prose(503, 90)), (9, ""), (10, "")]
    got = sorted((r.doc_id, r.text) for r in jaccard.one_of_each(table(spark, rows)).filter("doc_id is not null").collect() if r.text)
    assert got == [(3, text), (7, clean), (8, real)]
    left = jaccard.one_of_each(table(spark, rows)).collect()
    assert [(r.doc_id, r.text) for r in left if r.doc_id is None] == [(None, prose(503, 90))]
    assert sorted(r.doc_id for r in left if not r.text) == [8, 9, 10]


def test_a_class_without_ids_and_columns_of_any_name(spark, edges):
    copies = [(None, prose(600, 80)), (None, prose(600, 79) + " other"), (None, prose(600, 80))]
    assert jaccard.one_of_each(table(spark, copies)).count() == 1
    left = jaccard.one_of_each(edges)
    assert left.columns == edges.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted({(str(i), str(t)) for i, t in EDGES})


def test_banding_reaches_its_recall():
    bands, rows = jaccard.BANDS, jaccard.ROWS
    assert 1 - (1 - 0.8**rows) ** bands >= jaccard.RECALL and bands * rows <= 128
    a = np.arange(900, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hits = 0
    for k in range(200):
        x, y = a[k:k + 500], a[k + 50:k + 550]  # similarity 0.82
        hits += bool((jaccard.band_hashes([x])[0] == jaccard.band_hashes([y])[0]).any())
    assert hits == 200


@pytest.mark.parametrize("edges_of", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(1, 2), (3, 4), (2, 4), (9, 8)]])
def test_components_of_chains_and_stars(spark, edges_of):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges_of, "a bigint, b bigint")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges_of:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert got == {n: root(n) for n in {x for e in edges_of for x in e}}
