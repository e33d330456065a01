"""Periodic runs by brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq

from parley.llm import periodic_runs as P

SF = "/root/testdata/sf0.001"


def runs_by_brute_force(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smallest = next(p for p in range(1, q + 1) if all(w[k] == w[k + p] for k in range(i, i + length - p)))
            if length >= max(6, 4 * q) and smallest == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(w):
    ids = P.numbered([x.encode() for x in w])
    return P.runs(ids, P.lags([ids])[0])


def made(rng):
    w = []
    while len(w) < rng.randint(0, 90):
        part = [rng.choice("abcd") for _ in range(rng.randint(1, rng.choice([2, 4, 9])))]
        w += (part * rng.randint(1, 9))[: rng.randint(1, 60)]
    return w


def test_runs_by_brute_force():
    rng = random.Random(1)
    texts = [made(rng) for _ in range(400)]
    for w in texts:
        assert found(w) == runs_by_brute_force(w), w
    # many texts at once give the lags that each gives alone
    ids = [P.numbered([x.encode() for x in w]) for w in texts]
    assert P.lags(ids) == [P.lags([i])[0] for i in ids]
    assert sum(len(found(w)) > 1 for w in texts) > 30


def test_no_lag_is_missed():
    """The lags before the bit planes hold every period of a run, and few others."""
    rng, extra = random.Random(2), 0
    for _ in range(300):
        ids = P.numbered([x.encode() for x in made(rng)])
        lags, periods = set(P.lags([ids])[0]), {q for _, _, q in P.runs(ids, [*range(1, len(ids) // 4 + 1)])}
        assert periods <= lags
        extra += len(lags - periods)
    assert extra < 300


def test_long_texts():
    """A long period, a long run of one word, and half a million different words."""
    rng = random.Random(3)
    base = [str(rng.random()) for _ in range(30_000)]
    w = base * 5 + ["x"] * 100_000 + [str(i) for i in range(500_000)]
    assert found(w) == [(0, 150_000, 30_000), (150_000, 100_000, 1)]


def expected(doc_id, text):
    """The contract's columns, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    rs = runs_by_brute_force(w)
    gone = {k for s, ln, q in rs for k in range(s + q, s + ln)}
    best = sorted(rs, key=lambda r: (-r[1], r[0], r[2]))[0] if rs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(rs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{ln},{q}\n" for s, ln, q in rs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_documents_by_brute_force(spark):
    rows = [r for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist() if len(r["text"]) < 2500][:60]
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    assert sorted(map(tuple, P.run_digests(docs).collect())) == sorted(expected(r["doc_id"], r["text"]) for r in rows)


def test_rows(spark, edge_docs, no_docs):
    """Null, empty, blank, repeated, null-id rows, one very long text, odd white space, by value."""
    small = edge_docs.where("text is null or length(text) < 10000")
    more = spark.createDataFrame([(7, "a\x0bb c\x1ca\x85 a a a a a a"), (41, "x y " * 40), (None, "z " * 7)], "doc_id long, text string")
    both = small.select("doc_id", "text").union(more)
    found = sorted(map(tuple, P.run_digests(both).collect()), key=str)
    assert found == sorted([expected(r.doc_id, r.text) for r in both.collect()], key=str)
    assert P.run_digests(edge_docs).count() == 10 and P.run_digests(no_docs).count() == 0


def test_columns(spark):
    rows = spark.createDataFrame([("so a b a b a b a b end",), (None,), ("",)], "text string")
    found = [r.p for r in rows.select(P.periodic(rows.text).alias("p")).collect()]
    assert [tuple(x) for x in found[0].runs] == [(1, 8, 2)] and found[0].collapsed == "so a b end"
    assert [(p.runs, p.collapsed) for p in found[1:]] == [([], "")] * 2
