"""Ranked search by brute force: scores of all documents, from the contract's formula."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from parley.llm import lexical_search as L

SF = "/root/testdata/sf0.001"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_brute_force(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in counted if c]
    N, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * N) // total
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def ranked(spark, docs, items, **more):
    d, q = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, L.rank_documents(d, q, **more).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("shard,block", [(8192, 4 << 20), (7, 300)])
def test_by_brute_force(spark, monkeypatch, shard, block):
    """All rows of a small table, with one large shard a task and with many small ones and several blocks of items."""
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    monkeypatch.setattr(L, "SHARD_DOCS", shard)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()][: 40 if shard > 7 else 6]
    assert ranked(spark, docs, items) == sorted(by_brute_force(docs, items), key=str)


def test_shards_by_brute_force():
    """Random lists of few terms, so that many scores are equal: the best and their order, down from any floor."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 300):
        sizes, lists = [], []
        for p in (1.0, 0.5, 0.1):
            d = np.flatnonzero(rng.random(n) < p)
            v = rng.integers(1, 5, len(d))
            by = np.lexsort((d, -v))
            lists.append((d[by], v[by]))
            sizes.append(len(d))
        doc, value = (np.concatenate([x[j] for x in lists]) for j in (0, 1))
        bits = b"".join(np.packbits(b).tobytes() for b, _ in L.levels(doc, L._depth(n)))
        shard = L.Shard([*range(n)], ["a", "b", "c"], np.append(0, np.cumsum(sizes)).astype("<i4").tobytes(), bits, value.astype("<i4").tobytes())
        score = np.zeros(n, int)
        for (d, v), w in zip(lists, (3, 5, 7)):
            score[d] += v * w
        expected = sorted(((int(s), i) for i, s in enumerate(score) if s), key=lambda x: (-x[0], x[1]))
        weights = {b"a": 3, b"b": 5, b"c": 7, b"absent": 9}
        for k in (1, 4, 10):
            assert shard.search(weights, k, 0) == expected[:k]
            for floor in {s for s, _ in expected}:
                assert [x for x in shard.search(weights, k, floor)] == [x for x in expected[:k] if x[0] >= floor]


def test_rows(spark):
    """Null, empty, blank, repeated and null-id rows; equal scores; items that are repeated, empty or found nowhere."""
    docs = [(1, None), (2, ""), (3, " !? "), (9, "Red Apple, red"), (4, "red apple red"), (4, "red apple red"), (None, "red apple red"), (7, "été ÉTÉ x" * 3), (8, "pear " * 500)]
    items = [(1, "RED apple apple"), (2, None), (3, ""), (4, "..."), (5, "nowhere"), (6, "été É pear"), (1, "RED apple apple"), (None, "pear"), (6, "x")]
    assert ranked(spark, docs, items) == sorted(by_brute_force(docs, items), key=str)
    assert ranked(spark, [], items) == ranked(spark, docs, []) == []
    # a term of every document weighs nothing much: documents of score 0 are no results
    assert all(s > 0 for *_, s in ranked(spark, [(i, "same") for i in range(600)], [(1, "same")]))


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "same line the w7"), (2, "id")], "item_id int, text string").selectExpr("*", "'x' as rank", "'x' as query", "'x' as doc_id")
    found = [tuple(r) for r in L.rank_documents(edge_docs, items).collect()]
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert sorted(found, key=str) == sorted(by_brute_force(docs, [(1, "same line the w7"), (2, "id")]), key=str)
    assert L.rank_documents(no_docs, items).count() == 0


def test_ids_that_are_text_and_a_lasting_index(spark):
    docs = spark.createDataFrame([(f"doc-{i}", f"word{i} common") for i in range(50)], "name string, body string")
    index = L.build_index(docs, id_col="name", text_col="body")
    assert (index.n_docs, index.n_words) == (50, 100)
    found = L.search_index(index, [("a", "word7"), ("b", "word1 word2")], docs.schema["name"].dataType).collect()
    assert sorted((r.item_id, r.doc_id) for r in found) == [("a", "doc-7"), ("b", "doc-1"), ("b", "doc-2")]
