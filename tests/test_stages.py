"""Stage commands, untyped validation, tokenizer fallback, ranks, row numbers, reports."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from parley.operators import clean, report, score, tokens, validate
from parley.plans import ranks, stages
from parley.sources import io

RAW = "row_id long, instruction string, response string, category string, intent string, flags string"


def test_stage_commands(spark, sf, tmp_path):
    rows = io.interactions(spark, sf)
    total = rows.count()
    io.write_csv(rows.drop("row_id"), f"{tmp_path}/raw.csv")
    go = lambda *a: stages.run(spark, stages.parser().parse_args([*a, "--reports_dir", f"{tmp_path}/reports"]))
    path = lambda x: f"{tmp_path}/{x}"
    eda = go("eda", "--input", path("raw.csv"), "--output", path("kept"))["eda"]
    assert eda["n_rows"] == total and eda["distinct_category"] == len(eda["categories"]) and spark.read.parquet(path("kept")).count() == total
    cleaned = go("clean", "--input", path("raw.csv"), "--output", path("cleaned.csv"))["cleaning"]
    quality = go("score", "--input", path("cleaned.csv"), "--output", path("scored.csv"), "--threshold", "7")["quality"]
    go("enrich", "--input", path("scored.csv"), "--output", path("enriched.jsonl"))
    augmented = go("augment", "--input", path("enriched.jsonl"), "--output", path("augmented"))["augmentation"]
    formatted = go("format", "--input", path("augmented"), "--output", path("final"))["formatting"]
    n = spark.read.parquet(path("augmented")).count()
    assert quality["n_rows"] == cleaned["final_rows"] and n == 4 * quality["passed"] == sum(augmented.values()) == formatted["chat_records"]
    with open(path("final/alpaca.json"), encoding="utf-8") as f:
        assert len(json.load(f)) == n
    lines = spark.read.parquet(path("augmented")).select(F.to_json(F.struct("instruction", F.lit("").alias("input"), F.col("response").alias("output"))).alias("value"))
    lines.write.text(path("alpaca_lines"))
    valid = go("validate", "--input", path("augmented"), "--alpaca", path("alpaca_lines"), "--messages", path("final/chats.jsonl"))["validation"]
    assert valid["overall_valid"] and valid["formats"]["messages"]["n_rows"] == n
    assert go("tokenize", "--input", path("augmented"))["tokens"]["n_rows"] == n
    sizes = go("split", "--input", path("augmented"), "--output", path("splits"))["split"]
    assert sum(sizes.values()) == n and io.read_test(spark, path("splits/split=test")).count() == sizes["test"]
    go("reports")
    with open(path("reports/consolidated.json"), encoding="utf-8") as f:
        out = json.load(f)
    assert (out["raw_records"], out["cleaned_records"], out["augmented_records"], out["train_records"]) == (total, cleaned["final_rows"], n, sizes["train"])
    with open(path("reports/metrics.csv"), encoding="utf-8") as f:
        assert len(f.read().splitlines()) == 16
    assert os.path.exists(path("reports/eda.md"))


def test_missing_test_split(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        io.read_test(spark, f"{tmp_path}/nothing")


def test_untyped_json(spark):
    good = {"alpaca": '{"instruction":"a","input":"","output":null}', "chatml": '[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]', "messages": '{"messages":[{"role":"system","content":"a"},{"role":"user","content":"b"}],"metadata":{}}'}
    bad = {
        "alpaca": ['{"instruction":"a","output":"b"}', "[]", "no json", "", None, '"text"'],
        "chatml": ['[{"role":"user","content":"a"}]', '[{"role":"assistant","content":"a"},{"role":"user","content":"b"}]', '[{"role":"user"},{"role":"assistant","content":"b"}]', "{}", "3", None, "[1,2]"],
        "messages": ['{"messages":[{"role":"a","content":"b"}],"metadata":{}}', '{"messages":"x","metadata":{}}', '{"messages":[{"role":"a"},{"content":"b"}],"metadata":{}}', '{"messages":[1,2],"metadata":{}}', "[]", None],
    }
    for kind, rule in validate.JSON_RULES.items():
        df = spark.createDataFrame([(good[kind],), *[(x,) for x in bad[kind]]], "value string")
        assert [r[0] for r in df.select(rule(F.col("value"))).collect()] == [True] + [False] * len(bad[kind])
        r = validate.validate_json(df, kind).first()
        assert (r.n_rows, r.errors, r.is_valid) == (1 + len(bad[kind]), len(bad[kind]), False)
    fine = validate.validate_json(spark.createDataFrame([(good["alpaca"],)], "value string"), "alpaca")
    assert {r.part: r.is_valid for r in validate.overall(fine, {"alpaca": fine, "chatml": df.agg(F.lit(False).alias("is_valid"))}).collect()} == {"rows": True, "alpaca": True, "chatml": False, "overall": False}


def test_bad_encoding(spark):
    rows = spark.sql("select 1L row_id, cast(x'ff41' as string) instruction, 'ok' response union all select 2L, 'fine', 'ok'")
    r = validate.validate_rows(rows).first()
    assert (r.encoding_errors, r.is_valid) == (1, False)


def test_tokenizer_with_fallback(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([("Some words, counted.",), ("",), (None,)], "t string")
    own = Tokenizer.from_file(path)
    assert [r[0] for r in df.select(tokens.tokenizer_count(path)("t")).collect()] == [len(own.encode("Some words, counted.").ids), 0, 0]
    assert [r[0] for r in df.select(tokens.tokenizer_count("/nowhere.json")("t")).collect()] == [r[0] for r in df.select(tokens.estimate("t")).collect()]


def test_ranks_with_an_outlier(spark):
    rng = random.Random(1)
    ids = [*rng.sample(range(10_000), 500), 10**17, -(10**15)]
    got = {r.k: r.rank for r in ranks.with_rank(spark.createDataFrame([(i,) for i in ids], "k long").repartition(5), ["k"], "rank").collect()}
    assert got == {k: i for i, k in enumerate(sorted(ids))}
    assert ranks.with_rank(spark.createDataFrame([], "k long"), ["k"], "rank").count() == 0


def test_row_numbers(spark, tmp_path):
    spark.range(0, 1000, 1, 7).write.parquet(f"{tmp_path}/t")
    got = [r.row_id for r in io.with_row_id(spark.read.parquet(f"{tmp_path}/t")).collect()]
    assert sorted(got) == list(range(1000))


def test_cleaning_of_hot_pairs(spark):
    rows = [(k, "same question?", "the answer", "c", "i", "f") for k in range(300, 0, -1)] + [(k, " ", "", "c", "i", "f") for k in range(400, 500)] + [(1000, "Caf&eacute; ﬁne &amp now", "x Ⅳ", "c", "i", "f"), (1001, "a", None, "c", "i", "f"), (1002, "??", "a", "c", "i", "f")]
    df = spark.createDataFrame(rows, RAW)
    assert [(r.row_id, r.instruction, r.response) for r in clean.clean(df).orderBy("row_id").collect()] == [(1, "Same question?", "The answer"), (1000, "Café fine & now", "X IV")]
    r = clean.removal_report(df).first()
    assert (r.null_removed, r.empty_removed, r.duplicate_removed, r.malformed_removed, r.final_rows) == (1, 100, 299, 1, 2)


def test_headline_against_stages(spark, sf):
    rows = io.interactions(spark, sf)
    cleaned = clean.clean(rows)
    r = report.headline(rows, 7.0).first()
    passed = score.passing(cleaned, 7.0).count()
    assert (r.raw_records, r.cleaned_records, r.quality_passed_records, r.augmented_records) == (rows.count(), cleaned.count(), passed, 4 * passed)
    assert r.train_records + r.val_records + r.test_records == 4 * passed
    assert [(x.stage, x.n_rows) for x in report.stages(rows, 7.0).orderBy("stage_no").collect()] == [("raw", rows.count()), ("cleaned", cleaned.count()), ("filtered", passed), ("augmented", 4 * passed)]
    assert len(report.metrics({})) == 15


def test_pipeline_command(spark, sf, tmp_path, monkeypatch):
    import logging
    import sys

    from parley.plans import pipeline

    rows = io.interactions(spark, sf).limit(12)
    io.write_csv(rows.drop("row_id"), f"{tmp_path}/raw.csv")
    monkeypatch.setattr(sys, "argv", ["pipeline", "--raw_path", f"{tmp_path}/raw.csv", "--base_dir", f"{tmp_path}/out", "--quality_threshold", "1"])
    pipeline.main()
    logging.getLogger().handlers.clear()
    with open(f"{tmp_path}/out/reports/consolidated.json", encoding="utf-8") as f:
        out = json.load(f)
    assert out["raw_records"] == 12 and out["augmented_records"] == 4 * out["quality_passed_records"] == out["train_records"] + out["val_records"] + out["test_records"]
    assert os.path.exists(f"{tmp_path}/out/reports/pipeline.log") and os.path.exists(f"{tmp_path}/out/reports/metrics.csv")
