"""Where an operator once did less than its whole job."""

import random

from parley.llm import decontaminate, language_id, line_dedup

DOC = "doc_id long, text string"


def _word(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))


def _edited(rng, line, how):
    """A copy with words replaced or characters changed, as many as leave it at least 0.8 alike."""
    best, ws, x = line, line.split(), line
    for _ in range(12):
        if how == "words":
            ws[rng.randrange(len(ws))] = _word(rng)
            x = " ".join(ws)
        else:
            i = rng.randrange(len(x))
            x = x[:i] + rng.choice("abcdefghij") + x[i + 1 :]
        if not line_dedup.alike(line, x):
            break
        best = x
        if how == "chars" and 10 * line_dedup.edit_distance(line, x) >= len(line):
            break
    return best


def test_lines_by_edit_similarity_alone(spark):
    rng = random.Random(8)
    for how, least in (("words", 0.85),):
        pairs = {}
        for n in (2, 3, 5, 7, 10, 15, 20, 40, 80):
            for _ in range(60):
                x = " ".join(_word(rng) for _ in range(n))
                if (y := _edited(rng, x, how)) != x:
                    pairs[len(pairs)] = (n, x, y)
        rows = [(k, x) for k, (_, x, _) in pairs.items()] + [(10_000 + k, y) for k, (_, _, y) in pairs.items()]
        gone = {r.doc_id - 10_000 for r in line_dedup.duplicate_lines(spark.createDataFrame(rows, DOC)).where("n_kept = 0").collect()}
        assert gone <= set(pairs)
        by_length = {}
        for k, (n, _, _) in pairs.items():
            by_length.setdefault(n, []).append(k in gone)
        recall = {n: (round(sum(h) / len(h), 3), len(h)) for n, h in by_length.items()}
        print(how, recall)
        assert all(r >= least or count < 10 for r, count in recall.values()), recall


def test_short_items_with_edits():
    rng = random.Random(9)
    items = [(n * 100 + k, [_word(rng) for _ in range(n)]) for n in (1, 3, 5, 7, 9, 10, 12, 15, 18, 21) for k in range(20)]
    index = decontaminate.LeakIndex(items)
    docs, wanted = [], []
    for i, ws in items:
        x = list(ws)
        for _ in range(len(ws) // 5):
            j = rng.randrange(len(x))
            x[j : j + 1] = rng.choice(([], ["new"], [x[j], "more"]))
        docs.append(["lead"] * rng.randrange(9) + x + ["tail"] * rng.randrange(5))
        wanted.append(i)
    assert all(any(r[0] == i for r in found) for i, found in zip(wanted, index.leaks(docs)))
    assert index.leaks([[]]) == [[]]


def test_lines_of_null_and_repeated_ids(spark):
    import corpus_pipeline as p

    rows = [(None, "x y z\nx y z"), (None, "a b\nunique line"), (7, "q r s\nq r s"), (7, "c d\nanother line")]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "length(text) n_chars")
    cut = p.lines(spark, docs, "")
    assert sorted(r.text for r in cut.collect()) == ["a b\nunique line", "c d\nanother line", "q r s", "x y z"]
    assert sorted(r.text for r in p.near_duplicates(spark, cut, "").collect()) == ["a b\nunique line", "c d\nanother line", "q r s", "x y z"]


def test_language_sample_of_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(language_id, "fit", lambda rows, *_: rows)
    for i in ("null", "7"):
        docs = spark.range(3000).selectExpr(f"cast({i} as long) doc_id", "concat('some words of row ', id) text", "if(id % 2 = 0, 'a', 'b') lang")
        sample = language_id.train(docs, sample_rows=100)
        assert 40 <= len(sample) <= 100 and {r[0] for r in sample} == {"a", "b"}


def test_texts_without_letters_take_no_place_in_the_sample(spark):
    """A label is learned from its few good rows, however many others it has."""
    rows = [(i, "12 34 -- !!", "fr") for i in range(400)] + [(1000 + i, "le chat est sur la table et le chien dort", "fr") for i in range(3)]
    rows += [(2000 + i, "the cat is on the table and the dog sleeps", "en") for i in range(100)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=40)
    assert set(model.labels) == {"en", "fr"} and model.predict(["le chien est sur la table"])[0][0] == "fr"


def test_large_families_of_lines_lose_no_link(spark, monkeypatch):
    """More than 24 lines share a band; links that are not those of nearest sketches count too, in one block and in several."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))
    base = [word() for _ in range(40)]
    lines = [" ".join(base)]
    for _ in range(149):
        x = list(base)
        for i in r.sample(range(40), 7):
            x[i] = word()
        lines.append(" ".join(x))
    assert sum(line_dedup.alike(lines[0], x) for x in lines) == 150
    docs = spark.createDataFrame(list(enumerate(lines)), DOC)
    left = []
    for most in (line_dedup.TASK_LINES, 40):
        monkeypatch.setattr(line_dedup, "TASK_LINES", most)
        left.append(line_dedup.duplicate_lines(docs).where("n_kept = 1").count())
    assert max(left) <= 15, left  # 102 when each line was compared with the one of the nearest sketch alone
