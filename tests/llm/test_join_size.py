"""What the join does on large tables, seen on small ones."""

import random

from pyspark.sql import functions as F

from parley.llm import common, ngram_join

DOC = "doc_id long, text string"


def test_thinly_spread_tokens_are_frequent(spark):
    """Two documents a task share a passage: no task has it often, the table has it 320 times."""
    rng = random.Random(3)
    passage = " ".join(f"passage{i}" for i in range(12))
    rows = [(i, passage + "".join(f" w{rng.randint(0, 10**9)}" for _ in range(20))) for i in range(320)]
    docs = spark.createDataFrame(rows, DOC).repartition(160)
    tokens, n = ngram_join._frequent_tokens(docs, 1000)
    assert set(ngram_join.shingle_sets([passage])[0].tolist()) == set(tokens.tolist())
    assert n.min() >= 8


def test_only_rows_that_may_match_travel(spark):
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("k"))
    keys = rows.where("id % 50 = 7").select("k")
    got = {r.id for r in common.maybe_among(rows, "k", keys).collect()}
    assert got >= set(range(7, 20_000, 50)) and len(got) <= 410
    assert common.maybe_among(rows, "k", keys.limit(0)).count() == 0


def test_small_sets_link_with_equal_ones_only(spark):
    """Sets of 5 and less; of 6 with one of 7."""
    text = lambda n, last="": " ".join([*(f"w{i}" for i in range(n + 3)), *([last] if last else [])])
    rows = [(k, text(n)) for k, n in enumerate((4, 5, 5, 6, 7))] + [(9, text(4, "z"))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {0: (4, 0), 1: (5, 1), 2: (5, 1), 3: (6, 3), 4: (7, 3), 9: (5, 9)}


def test_pipeline_deals_rows_out_once(spark, monkeypatch):
    """Rows of one id and text are where the join has put them; their contents are not shuffled again."""
    import corpus_pipeline

    found = lambda docs, with_places: docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.lit(3).alias("n_shingles"), F.lit(True).alias("stays"))
    monkeypatch.setattr(ngram_join, "components", found)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "d"), (0, "d")], DOC)
        kept = corpus_pipeline.near_duplicates(spark, docs, "")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 3  # the join's sides and what was found, made distinct
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == [(0, "d"), (1, "a b c"), (None, "a b c"), (None, "d")]
    finally:
        spark.conf.set(key, before)
