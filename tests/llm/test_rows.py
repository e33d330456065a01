"""Rows that share an id or have none, clashing columns, broken pages, long runs, and models against brute force."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parley.llm import common, decontaminate, doc_fingerprint, html_extract, language_id, license_scan, line_dedup, ngram_join, suffix_dedup, token_count

DOC = "doc_id long, text string"


def _words(rng, n):
    return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]


def test_join_keeps_rows(spark):
    rng = random.Random(1)
    a, b, c = (_words(rng, 60) for _ in range(3))
    near = lambda x: " ".join([*x[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (None, " ".join(c)), (None, near(c)), (None, near(a)), (9, ""), (9, None), (4, " ".join(a)), (4, " ".join(a)), (None, "alone by itself")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.components(spark.createDataFrame(rows, DOC)).collect()), key=repr)
    want = [(1, 57, 1), (1, 57, 1), (2, 57, 1), (3, 57, 1), (None, 57, None), (None, 57, None), (None, 57, 1), (9, 0, 9), (9, 0, 9), (4, 57, 1), (4, 57, 1), (None, 1, None)]
    assert got == sorted(want, key=repr)
    # the two null-id documents that link are one component: one of them stays
    stays = ngram_join.components(spark.createDataFrame(rows, DOC), with_places=True).where("stays and n_shingles > 0").groupBy("doc_id").count().collect()
    assert sorted(((r[0], r[1]) for r in stays), key=repr) == [(1, 2), (None, 2)]


@pytest.mark.parametrize("paired", [200, 2])
def test_join_of_many_groups_with_a_common_token(spark, monkeypatch, paired):
    """Hundreds of groups that share frequent shingles, and two large chains: the links are those of all pairs."""
    monkeypatch.setattr(ngram_join, "MOST_PAIRED", paired)
    monkeypatch.setattr(ngram_join, "FREQUENT", 10**9)
    monkeypatch.setattr(ngram_join, "TASK_SETS", 40)
    rng = random.Random(2)
    common_words = [f"c{i}" for i in range(12)]
    rows = []
    for k in range(120):
        base = common_words + _words(rng, 14)
        rows += [(10 * k, " ".join(base)), (10 * k + 1, " ".join([*base[:-1], "x"])), (10 * k + 2, " ".join([*base[:-4], *_words(rng, 4)]))]
    docs = spark.createDataFrame(rows, DOC)
    got = {r.doc_id: r.component_id for r in ngram_join.components(docs).collect()}
    sets = {d: set(zip(*[t.split()[i:] for i in range(4)])) for d, t in rows}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for x, y in itertools.combinations(sorted(sets), 2):
        n = len(sets[x] & sets[y])
        if 100 * n >= 85 * (len(sets[x]) + len(sets[y]) - n):
            i, j = sorted((root(x), root(y)))
            up[j] = i
    assert got == {d: root(d) for d in sets}


def test_joined_sets_in_blocks(spark):
    """Linked members of a set are found wherever the blocks put them."""
    rows = [(k, 0 if k < 400 else 1, 0.07, k // 100) for k in range(430)]
    sets = spark.createDataFrame(rows, "node long, part long, size double, payload int")

    def solve(payloads, labels, asked):
        labels = list(labels)
        for i, j in itertools.combinations(range(len(labels)), 2):
            if (asked[i] or asked[j]) and payloads[i] == payloads[j] and labels[i] != labels[j]:
                old, new = max(labels[i], labels[j]), min(labels[i], labels[j])
                labels = [new if x == old else x for x in labels]
        return labels

    got = {r.node: r.root for r in common.joined_sets(sets.select("node", "part", "size"), lambda t: t.join(sets.select("node", "payload"), "node"), solve, "test").collect()}
    assert got == {k: (k // 100) * 100 for k in range(430)}


def test_lines_values(spark):
    rows = [(1, "Header line of the site\nown text one"), (2, "header LINE of the site!\n\nown text two"), (2, "header line of the site\nown text three"), (None, "header line of the site"), (5, None), (6, ""), (7, "!!!\n!!!")]
    got = sorted(((r.doc_id, r.n_lines, r.n_kept, r.removed) for r in line_dedup.duplicate_lines(spark.createDataFrame(rows, DOC)).collect()), key=repr)
    two = [(2, 3, 2, [0]), (2, 2, 1, [0])]
    assert got == sorted([(1, 2, 1, [0]), *two, (None, 1, 1, []), (5, 0, 0, []), (6, 0, 0, []), (7, 2, 2, [])], key=repr)


def test_many_alike_but_not_similar_lines(spark):
    """Shuffled lines of the same words are candidates of each other; they all stay, and do not take long."""
    rng = random.Random(3)
    ws = _words(rng, 300)
    rows = [(k, " ".join(rng.sample(ws, 300))) for k in range(120)]
    assert line_dedup.duplicate_lines(spark.createDataFrame(rows, DOC)).where("n_kept = 1").count() == 120


def test_bridged_is_an_upper_bound():
    rng = random.Random(4)
    for _ in range(400):
        a = [rng.choice("ab cd efg hij k lmno".split()) for _ in range(rng.randint(0, 12))]
        b = [x for x in a if rng.random() < 0.8] + [rng.choice("ab zz".split()) for _ in range(rng.randint(0, 2))]
        x, y = " ".join(a), " ".join(b)
        d = line_dedup.edit_distance(x, y)
        assert not any(line_dedup.bridged(a, b, most) for most in range(d))
        assert d <= 3 or line_dedup.edit_distance(x, y, d - 1) > d - 1


def test_stages_with_clashing_columns(spark):
    import corpus_pipeline as p

    names = ("_cut", "_cut_id", "_leaks", "_t", "_stays", "_found", "_text_key", "_key_of_text", "n_tokens", "token_ids", "text_key", "row", "of_id", "cut", "stays", "leaks")
    rows = [(1, "some words of the first\nanother line here"), (2, "some words of the first\nthe third line is this"), (None, "same text\nsame text"), (None, None)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'en' as lang", *[f"'x' as {c}" for c in names])
    for name, stage in p.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
        if name == "tokens":
            assert len(set(out.columns)) == len(out.columns) and out.count() == 4
            continue
        assert out.columns == docs.columns
        if name == "lines":
            assert kept == sorted([(1, rows[0][1]), (2, "the third line is this"), (None, "same text"), (None, None)], key=repr)
        elif name == "language":
            assert set(kept) <= set(rows[:3])  # so few rows say little about a language
        else:
            assert kept == sorted(rows, key=repr)
    blocks = decontaminate.with_leaks(docs, spark.createDataFrame([(1, "the third line is this"), (2, "another line here")], "item_id long, text string"), block_words=2, out_col="found")
    assert {(r.doc_id, tuple(x.item_id for x in r.found)) for r in blocks.collect()} == {(1, (2,)), (2, (1,)), (None, ())}


def test_fingerprints_of_hot_ids(spark):
    """Null ids and a repeated id are cut into ranges of their own, in the order of all."""
    rows = [(None, f"null text {k}") for k in range(40)] + [(7, f"seven {k}") for k in range(40)] + [(k, f"own {k}") for k in range(8, 30)] + [(-(2**63), "least")]
    docs = spark.createDataFrame(rows, DOC)
    ordered = [(r[0], r[1]) for r in docs.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text").collect()]
    want = sorted(((d, len(t), doc_fingerprint.Fingerprint(t).text(), doc_fingerprint.Fingerprint(t).likeness(doc_fingerprint.Fingerprint(n))) for (d, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1])), key=repr)
    for size in (3, 500):
        got = sorted(((r.doc_id, r.n_chars, r.fingerprint, r.near_next) for r in doc_fingerprint.compare_neighbours(docs, rows_per_range=size).collect()), key=repr)
        assert got == want
    with pytest.raises(TypeError):
        doc_fingerprint.compare_neighbours(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_broken_pages():
    model = html_extract.trained()
    body = "Some text of the article, and it goes on for a while."
    for page, want in (
        (f'<article><h1>A title</h1><svg class="i"/><p>{body}</p></article>', f"A title {body}"), (f'<article><h1>A title</h1><object data="x"/><p>{body}</p></article>', f"A title {body}"),
        (f'<article><h1>A title</h1><math/><iframe src="x"/><p>{body}</p></article>', f"A title {body}"), (f'<article><h1>A title</h1><p><a title="oops>link</a> {body}</p></article>', f"A title link {body}"),
        (f"<article><h1>A title</h1><p>{body}</p></article><div class", f"A title {body}"), (f"<article><p>{body}<svg><title>no</title><path d='M0'/></svg></p></article>", body),
        (f'<article><p data-x="a > b">{body}</p><noscript><p>more</noscript>', body),
    ):
        assert html_extract.extract(page, model) == want
    html_extract.extract("<p " + "a=b " * 20_000, model)


def test_decoding_is_the_likeliest_consistent_choice():
    """Against all choices of small trees: leaves kept or dropped, where a parent kept (dropped) whole keeps (drops) its leaves."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        top = html_extract.Unit(html_extract.Node("#root", None))
        flat = [top]
        for k in range(int(rng.integers(1, 4))):
            node = html_extract.Node("div", top.node)
            u = html_extract.Unit(node)
            top.kids.append(u)
            flat.append(u)
            for _ in range(int(rng.integers(0, 3))):
                text = html_extract.Node("#text", node, text="x" * int(rng.integers(1, 60)))
                leaf = html_extract.Unit(node, [text])
                u.kids.append(leaf)
                flat.append(leaf)
        html_extract._measure(top.node)
        for i, u in enumerate(flat):
            u.row = i
        for u in flat[1:]:
            if u.parts is None and not u.kids:
                u.node.chars = 5
        p = rng.uniform(0.02, 0.98, len(flat))
        size = np.array([u.node.chars if u.parts is None else sum(x.chars for x in u.parts) for u in flat], float)
        w = np.log1p(size)

        def best(u, p=p, w=w):
            i = u.row
            below = lambda v: (w[v.row] * np.log(p[v.row]) + sum(below(k)[0] for k in v.kids), w[v.row] * np.log(1 - p[v.row]) + sum(below(k)[1] for k in v.kids))
            keep, drop = below(u)
            leaves = lambda v: [v] if not v.kids else [x for k in v.kids for x in leaves(k)]
            ways = [(keep, [x.row for x in leaves(u)]), (drop, [])]
            if u.kids:
                parts = [best(k) for k in u.kids]
                ways.append((sum(x[0] for x in parts) + min(0.0, np.log(1 - abs(2 * p[i] - 1) * 0.5)) * w[i] * 0.2, [r for x in parts for r in x[1]]))
            return max(ways, key=lambda x: x[0])

        assert [u.row for u in html_extract.decode(top, flat, p)] == best(top)[1]


def test_nearest_centroid_by_brute_force():
    rng = random.Random(6)
    alphabets = {"a": "abcdef", "b": "ghijkl", "c": "abgh xy"}
    rows = [(n, language_id.ngram_counts(" ".join("".join(rng.choice(x) for _ in range(5)) for _ in range(40))).astype("f4")) for n, x in alphabets.items() for _ in range(20)]
    model = language_id.fit(rows)
    texts = ["".join(rng.choice("abcdefghijklxy ") for _ in range(60)) for _ in range(50)]
    counts = [np.bincount([], minlength=language_id.BUCKETS) if (c := language_id.ngram_counts(t)) is None else c for t in texts]
    df = sum((c > 0).astype(int) for _, c in rows)
    idf = np.log((1 + len(rows)) / (1 + df)) + 0.05
    for t, c, (label, score, _) in zip(texts, counts, model.predict(texts)):
        x = np.log1p(c) * idf
        cos = [float(x @ m) / (np.linalg.norm(x) * np.linalg.norm(m)) for m in model.centroids.astype("f8")]
        assert label == model.labels[int(np.argmax(cos))] and abs(score - max(cos)) < 1e-4, t
    assert model.predict([None, ""]) == [("und", 0.0, True)] * 2


def test_any_number_of_labels(spark):
    docs = spark.range(1200).selectExpr("id doc_id", "concat('l', id % 400) lang", "concat('text of label ', repeat(char(97 + cast(id % 26 as int)), 5), ' ', id % 400) text")
    assert len(set(language_id.train(docs, sample_rows=400, per_label=1).labels)) == 400


def test_license_texts():
    s = license_scan.scanner()
    for label, template in license_scan.TEMPLATES:
        text = license_scan.re.sub(r"\{\{(\d+)-\d+\}\}", lambda m: " ".join(["Someone"] * int(m[1])), template.replace("[[", "").replace("]]", ""))
        found = s.scan(f"some lead {text} and a tail")
        assert label in {x[0] for x in found["spans"]} and found["score"] == 1.0
    automaton = license_scan.compile_template("x", "{{1-2}} is free [[as in beer]] software")
    own = license_scan.LicenseScanner((), (("x", "{{1-2}} is free [[as in beer]] software"),))
    assert own.scan("the thing is free software")["spans"] == [("x", 0, 4 + 1, False), ("x", 1, 5, False)] and automaton.mandatory == 3
    assert own.scan("is free software")["spans"] == [] and own.scan("this is free as in speech software")["spans"] == []
    assert (s.scan("all of it")["score"], s.scan("cc")["score"]) == (0.0, 0.0)
    part = license_scan.TEMPLATES[3][1].split()[:120]
    assert 0.5 < license_scan.LicenseScanner((), license_scan.TEMPLATES[3:4]).scan(" ".join(part))["score"] < 1


def test_labels_by_brute_force():
    """Every accepted stretch of small templates, against all strings the template stands for."""
    template = "a [[b [[c]]]] {{1-2}} d"
    own = license_scan.LicenseScanner((), (("x", template),))
    rng = random.Random(7)
    for _ in range(400):
        words = [rng.choice("abcde") for _ in range(rng.randint(0, 9))]
        want = []
        for i in range(len(words)):
            ends = [i + n for n in range(1, len(words) - i + 1) if any(
                words[i : i + n] == [*head, *words[i + len(head) : i + len(head) + k], "d"] for head in (["a"], ["a", "b"], ["a", "b", "c"]) for k in (1, 2) if len(head) + k + 1 == n)]
            if ends:
                want.append(("x", i, max(ends), False))
        assert own.scan(" ".join(words))["spans"] == want


def test_long_runs_of_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, own, rng = Tokenizer.from_file(path), token_count.TokenCounter(path), random.Random(8)
    texts = ["".join(rng.choice("abcdefghijklmnop") for _ in range(30_000)), "a" * 20_000, "é" * 9_999, "ab" * 15_000, "one two"]
    assert own.count_all(texts) == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert all(len(p) <= token_count.REMEMBERED for p in own._known)


def test_edit_span_by_brute_force():
    rng = random.Random(9)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(300):
        item, words = ([rng.randint(1, 3) for _ in range(rng.randint(1, hi))] for hi in (5, 9))
        best = min(distance(item, words[i:j]) for i in range(len(words) + 1) for j in range(i, len(words) + 1))
        hit = decontaminate.edit_span(np.array(item), np.array(words), 99)
        assert hit[0] == best == distance(item, words[hit[1] : hit[2]])


def test_leak_recall_by_length():
    """Every item length at the limit of similarity, against what brute force accepts."""
    rng = random.Random(10)
    vocabulary = [f"v{i}" for i in range(3_000)]
    items = [(n * 1_000 + k, [rng.choice(vocabulary) for _ in range(n)]) for n in (3, 5, 8, 12, 16, 20, 21, 22, 23, 25, 28, 32, 40, 50, 60) for k in range(30)]
    index = decontaminate.LeakIndex(items)
    docs, owner = [], []
    for i, ws in items:
        x = list(ws)
        for _ in range(len(ws) // 5):
            j = rng.randrange(len(x))
            x[j : j + 1] = rng.choice(([], ["new"], [x[j], "more"]))
        docs.append([rng.choice(vocabulary) for _ in range(rng.randrange(30))] + x + [rng.choice(vocabulary) for _ in range(rng.randrange(30))])
        owner.append((i, len(ws)))
    hits: dict[int, list[bool]] = {}
    for (i, n), found in zip(owner, index.leaks(docs)):
        hits.setdefault(n, []).append(any(r[0] == i for r in found))
    print({n: sum(h) / len(h) for n, h in hits.items()})
    assert all(sum(h) / len(h) >= 0.9 for h in hits.values())


def test_passages_of_a_hot_seed(spark):
    """One short passage in many documents with other surroundings, by both ways."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for k in range(300):
        tail = [f"t{k % 100}x{i}" for i in range(12)]
        rows.append((k, " ".join([f"l{k}", *passage, *tail, f"r{k}"])))
    docs = spark.createDataFrame(rows, DOC)
    want = {(k, 1, 53) for k in range(300)}
    for hot in (50_000, 50):
        assert {(r.doc_id, r.start, r.stop) for r in suffix_dedup.repeated_passages(docs, hot_rows=hot).collect()} == want


def test_shared_folder_is_asked_for(spark):
    class Cluster:
        conf, sparkContext = {}, type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        common.shared_dir(Cluster)
