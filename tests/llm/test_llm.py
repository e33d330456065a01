"""Each operator against brute force, a library, an exact round trip or held-out accuracy; edge cases; the pipeline."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parley.llm import bpe_codec, decontaminate, doc_fingerprint, html_extract, language_id, license_scan, line_dedup, ngram_join, queries, suffix_dedup, token_count

SF = "/root/testdata/sf0.001"
ODD = ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "  ", "\n", "\x85", "\x1c", "Σ", "İ", "é", "日本", "🙂", "٣", "²", "a", "b", "ab", "!", "​"]


def odd_texts(n=1500):
    rng = random.Random(5)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["a" * 3000, "!" * 2000, "\n" * 40, "é" * 500]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").limit(200).cache()


@pytest.fixture(scope="module")
def pdf(docs):
    return docs.toPandas()


def test_codec_like_library(pdf):
    path = bpe_codec.default_path()
    lib, own = Tokenizer.from_file(path), bpe_codec.codec(path)
    for t in odd_texts() + pdf.text.tolist():
        ids = own.encode(t)
        assert ids == lib.encode(t, add_special_tokens=False).ids
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_counts_like_library(pdf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, own = Tokenizer.from_file(path), token_count.counter(path)
    texts = odd_texts() + pdf.text.tolist()
    assert own.count_all(texts) == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def _lines_by_pairs(rows):
    occ = [(d, i, x) for d, t in sorted(rows) for i, line in enumerate((t or "").split("\n")) if (x := line_dedup.normalised(line))]
    first = {}
    for d, i, x in occ:
        first.setdefault(x, (d, i))
    lines = list(first)
    h, up = line_dedup.simhashes(lines), list(range(len(lines)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    # the edits are at least the characters that one line has more of than the other
    bags = np.stack([np.bincount(np.frombuffer(x.encode("utf-32-le"), "<u4") % 512, minlength=512) for x in lines]).astype(np.int32)
    for i in range(len(lines)):
        apart = bags[:i] - bags[i]
        least = np.maximum(np.where(apart > 0, apart, 0).sum(1), np.where(apart < 0, -apart, 0).sum(1))
        for j in np.flatnonzero(least <= 0.2 * np.maximum(bags[:i].sum(1), len(lines[i])) + 1e-9).tolist():
            most = 0.2 * max(len(lines[i]), len(lines[j])) + 1e-9
            if int(h[i] ^ h[j]).bit_count() <= line_dedup.DISTANCE and line_dedup.edit_distance(lines[i], lines[j]) <= most:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    stays = {x: root(k) == k for k, x in enumerate(lines)}
    out = {d: [] for d, _ in rows}
    for d, i, x in occ:
        if not stays[x] or first[x] != (d, i):
            out[d].append(i)
    return out


def test_line_dedup(spark, pdf):
    rng = random.Random(1)
    base = [" ".join(f"word{rng.randint(0, 5000)}" for _ in range(60)) for _ in range(3)]
    rows = [*zip(pdf.doc_id.tolist(), pdf.text.tolist())]
    for k in range(40):  # near copies of one line
        ws = rng.choice(base).split()
        ws[rng.randrange(60)] = f"new{k}"
        rows.append((10_000 + k, " ".join(ws) + "\nThe same short line"))
    got = {r.doc_id: r.removed for r in line_dedup.duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _lines_by_pairs(rows)


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert line_dedup.edit_distance(a, b) == row[-1]


def test_language_id(docs, pdf, spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in queries.op2_language_id(spark, "/root/testdata/sf0.01").collect()}
    true = {r.doc_id: r.lang for r in big.select("doc_id", "lang").collect()}
    held = [d for d in true if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d].held_out == (d in set(held)) for d in true)
    assert sum(got[d].lang_pred == true[d] for d in held) / len(held) > 0.95
    model = language_id.train(big)
    (label, s, rejected), _, far = model.predict(["the and of that", None, "漢字仮名交文日本語中文漢字"])
    assert not rejected and 0 <= s <= 1 and far[2] and model.predict(["123 !"])[0] == ("und", 0.0, True)
    rows = [(r.lang, language_id.ngram_counts(r.text)) for r in big.select("lang", "text").collect()]
    rows = [(n, c) for n, c in rows if n and c is not None]
    lost = [p for p in model.predict([r.text for r in big.where("lang is not null").select("text").collect()]) if p[2]]
    assert len(lost) <= 0.005 * len(rows)
    # a language that was not learned is rejected
    others = language_id.fit([(n, c.astype("f4")) for n, c in rows if n != "es"])
    far = others.predict([r.text for r in big.where("lang = 'es'").select("text").collect()])
    assert sum(p[2] for p in far) / len(far) > 0.9


def _components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and 100 * n >= 85 * (len(a) + len(sets[j]) - n) and root(i) != root(j):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


@pytest.mark.parametrize("tokens", [ngram_join.TASK_TOKENS, 600])
def test_ngram_join(spark, pdf, tokens):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 3000)}" for _ in range(120)]
    rows = [*zip(pdf.doc_id.tolist(), pdf.text.tolist())]
    for k in range(60):  # a chain and a cloud of near copies
        base = base[:] if k % 3 else base[1:] + [f"n{k}"]
        copy = base[:]
        copy[rng.randrange(120)] = f"x{k}"
        rows.append((10_000 + k, " ".join(copy)))
    rows += [(20_000, "one two"), (20_001, "ONE  two"), (20_002, "three")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string"), task_tokens=tokens).collect()}
    assert got == _components(rows)


def test_html(spark):
    model = html_extract.trained()
    rng = np.random.default_rng(77)
    x, y = html_extract.labelled_rows([html_extract.training_page(rng) for _ in range(60)])
    assert ((model.probability(x) > 0.5) == y).mean() > 0.95
    page = ("<html><body><header class='site-header'><a href='/'>Home</a></header><nav><ul><li><a href='/a'>A</a></li></ul></nav><article><h1>T &amp; U</h1><p>First  <b>bold</b>\n text, of some length"
            " that goes on for a while.</p><p>Second one, longer than the first one by some words.</article><div class='comments'><p>nice</p></div><footer>&copy; x</footer><script>var a='<p>no</p>'</script>")  # fmt: skip
    assert html_extract.extract(page, model) == "T & U First bold text, of some length that goes on for a while. Second one, longer than the first one by some words."
    got = queries.op5_html_extract(spark, SF).collect()
    for r, h in zip(sorted(got), spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()):
        inner = re.sub(r"</?(p|br|h1)>", "\n", h.html[h.html.index("<article>") + 9 : h.html.rindex("</article>")])
        assert r.text == " ".join(x for b in re.sub(r"<[^>]+>", "", inner).split("\n") if (x := " ".join(html.unescape(b).split())))
        assert r.n_chars == len(r.text)
    assert [html_extract.extract(p, model) for p in (None, "", "</div></div>")] == ["", "", ""]


def test_licenses(spark, pdf):
    s = license_scan.scanner()
    labels = lambda t: sorted({x[0] for x in s.scan(t)["spans"]})
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["gpl", "gpl-notice"]
    assert labels("Licensed under CC BY-NC 4.0") == ["cc-by", "cc-by-nc"] and labels("Copyright (c) 2020 Someone. All rights reserved.") == ["copyright", "reserved"]
    assert labels("Released under the MIT License.") == ["mit"] and labels("the mit of license") == [] and s.scan(None)["n_words"] == 0
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(pdf[["doc_id", "text"]])).collect()}
    for d, t in zip(pdf.doc_id, pdf.text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        at = [(label, i) for label, p in license_scan.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (got[d].n_words, got[d].n_base, got[d].base_labels) == (len(w), len(at), ",".join(sorted({x for x, _ in at})))
        assert got[d].first_word == min((i for _, i in at), default=None) and got[d].last_word == max((i for _, i in at), default=None)


def _passages(rows, least):
    words = {d: re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for d, t in rows}
    where, out = {}, set()
    for d, w in words.items():
        for i in range(len(w) - least + 1):
            where.setdefault(tuple(w[i : i + least]), set()).add(d)
    for d, w in words.items():
        now = None
        for i in range(len(w) - least + 1):
            if len(where[tuple(w[i : i + least])]) > 1:
                if now and i > now[1]:
                    out.add((d, *now))
                    now = None
                now = (now[0] if now else i, i + least)
        if now:
            out.add((d, *now))
    return out


@pytest.mark.parametrize("chunk,hot", [(20_000, 50_000), (16, 50_000), (16, 5)])
def test_suffix_dedup(spark, pdf, chunk, hot, monkeypatch):
    whole = suffix_dedup._neighbours
    monkeypatch.setattr(suffix_dedup, "_neighbours", lambda p: whole(p, chunk))
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(80)]
    rows = [*zip(pdf.doc_id.tolist(), pdf.text.tolist())]
    for k in range(40):
        a, n = rng.randrange(30), rng.randrange(45, 60)
        rows.append((10_000 + k, " ".join([f"l{k}"] * rng.randrange(5) + passage[a : a + n] + [f"r{k}"])))
    got = {(r.doc_id, r.start, r.stop) for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), hot_rows=hot).collect()}
    assert got == _passages(rows, 50)


def test_fingerprints(spark, pdf):
    got = {r.doc_id: r for r in doc_fingerprint.compare_neighbours(spark.createDataFrame(pdf[["doc_id", "text"]]), rows_per_range=7).collect()}
    rows = sorted(zip(pdf.doc_id, pdf.text))
    for (d, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b = (set(doc_fingerprint.digests(x).tolist()) for x in (t, e))
        assert abs(got[d].near_edited - (2 * len(a & b) / (len(a) + len(b)) if a or b else 1)) < 1e-9
    x, y = doc_fingerprint.Fingerprint("a\nb\nc\nc"), doc_fingerprint.Fingerprint("a\nc\nd")
    here, there = x.difference(y)
    assert (len(here), len(there)) == (2, 1)


def test_leaks(spark, docs, pdf):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r.item_id, decontaminate.words_of(r.text)) for r in bench.collect()]
    index, rng = decontaminate.LeakIndex(items), random.Random(6)
    hits = total = 0
    for i, ws in items * 3:
        x = list(ws)
        for _ in range(len(ws) // 5):
            j = rng.randrange(len(x))
            x[j : j + 1] = rng.choice(([], ["new"], [x[j], "more"]))
        total += 1
        hits += any(r[0] == i for r in index.leaks([["lead"] * rng.randrange(9) + x + ["tail"] * 5])[0])
    assert hits / total >= 0.9
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    exact = {(d, i) for d, t in zip(pdf.doc_id, pdf.text) for i, ws in items if f" {' '.join(ws)} " in f" {' '.join(decontaminate.words_of(t))} "}
    assert exact <= found and len(found) <= len(exact) + 2
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench, block_words=300).collect()} == found


OPS = {
    "lines": (line_dedup.duplicate_lines, 9), "codec": (bpe_codec.encode_decode, 10), "join": (ngram_join.components, 10), "licenses": (license_scan.scan_licenses, 10),
    "passages": (suffix_dedup.repeated_passages, 2), "fingerprints": (doc_fingerprint.compare_neighbours, 10), "counts": (token_count.count_tokens, 10),
    "languages": (lambda d: language_id.identify(d, language_id.train(d)), 10),
}


@pytest.mark.parametrize("name", OPS)
def test_edge_cases(spark, edge_docs, no_docs, name):
    op, n = OPS[name]
    assert op(no_docs).count() == 0
    assert op(edge_docs).count() == n


def test_edge_leaks(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "same line of text here"), (3, "no id"), (None, "x y z")], "item_id long, text string")
    assert decontaminate.find_leaks(no_docs, bench).count() == 0 and decontaminate.find_leaks(edge_docs, no_docs.selectExpr("doc_id item_id", "text")).count() == 0
    got = sorted((r.doc_id or 0, r.item_id) for r in decontaminate.find_leaks(edge_docs, bench).collect())
    assert got == [(0, 3), (4, 3), (5, 3), (5, 3)]


def test_pipeline(spark, edge_docs, no_docs, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    removed = _lines_by_pairs(rows)
    lines = {r.doc_id: r.text for r in p.lines(spark, docs, SF).collect()}
    for d, t in rows:
        left = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(removed[d]))
        assert lines.get(d) == (left if left.strip() or not removed[d] else None)
    comp = _components(rows)
    assert {r.doc_id for r in p.near_duplicates(spark, docs, SF).collect()} == {d for d, (_, c) in comp.items() if c == d}
    out = p.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "text", "token_ids"} <= set(out.columns)
    for name, stage in p.STAGES:
        assert stage(spark, no_docs, SF).count() == 0
        kept = stage(spark, edge_docs, SF)
        kept.count()
        assert name == "tokens" or kept.columns == edge_docs.columns
