"""Golden vectors of each rule, and every query against its SQL."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from parley import queries as Q
from parley.operators import augment, clean, enrich, report, score, split, tokens, validate
from parley.plans import pipeline
from parley.sources import io

ENRICHED = [
    ("where is my parcel?", "track_order", "ORDER", "B", "negative", "medium", False, "low"),
    ("where is my parcel", "place_order", "ORDER", "B", "neutral", "low", False, "low"),
    ("thanks for the help!", "review", "FEEDBACK", None, "positive", "low", False, "medium"),
    ("thanks, is it fixed?", "review", "FEEDBACK", "BL", "positive", "low", False, "low"),
    ("good but wrong!", "review", "FEEDBACK", "", "negative", "low", False, "low"),
    ("i want it", "get_refund", "REFUND", "B", "neutral", "high", False, "low"),
    ("please help asap", "place_order", "ORDER", "B", "neutral", "high", False, "low"),
    ("i have an issue", "place_order", "ORDER", "B", "negative", "medium", True, "low"),
    ("illegal charge", "pay", "PAYMENT", "B", "neutral", "low", True, "low"),
    ("unauthorized login", "x", "SECURITY", "BCEL", "negative", "high", True, "medium"),
    ("a b c d e f g h i j k l m n o button", "x", "ORDER", "B", "neutral", "low", False, "high"),
    ("a b c d e f g h i j k l m n o p q r s t u", "x", "ORDER", "BCE", "neutral", "low", False, "medium"),
]
RAW = "row_id long, instruction string, response string, category string, intent string, flags string"


def test_enrichment(spark):
    rows = [(i, r[0], "ok", r[2], r[1], r[3]) for i, r in enumerate(ENRICHED)]
    got = enrich.enrich(spark.createDataFrame(rows, RAW)).orderBy("row_id").collect()
    assert [(g.sentiment, g.urgency, g.escalation, g.complexity) for g in got] == [r[4:] for r in ENRICHED]


@pytest.mark.parametrize("full", [False, True])
def test_cleaning(spark, full):
    cases = [(None, ""), ("  A&amp;B  ", "A&B"), ("&amp;lt;", "&lt;"), ("“hi” — ok", '"hi" - ok'), ("!?!?", "!?!?"), ("a,,,b....c...d", "a,b...c...d"), ("x\n  \n \ny", "x\n\ny"), ("a\r\nb", "a\nb")]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(clean.clean_text(F.col("t"), full)).collect()] == [b for _, b in cases]
    one = lambda f, t: spark.createDataFrame([(t,)], "t string").select(f(F.col("t"))).first()[0]
    assert one(lambda c: clean.clean_text(c, True), "……") == "..."
    assert one(clean.clean_instruction, "what???  now!!!") == "What? now!"
    assert one(clean.clean_response, "ok. yes! no?\nmaybe") == "Ok. Yes! No?\nMaybe"
    assert one(clean.clean_response, "see e.g. this") == "See e.g. This"
    assert one(clean.clean_response, "é. été") == "É. été"
    assert one(clean.clean_response, "a. b\x01. c") == "A. B\x01. C"


def test_scoring(spark):
    row = lambda flags: (1, "cancel my order please", "Please contact support.", "ORDER", "cancel_order", flags)
    r = score.with_scores(spark.createDataFrame([row("B")], RAW)).first()
    assert (r.grammar_score, r.completeness_score, r.length_score, r.relevance_score, r.readability_score, r.quality_score) == (10, 6, 6, 7.5, 9, 7.7)
    assert score.with_scores(spark.createDataFrame([row("BZ")], RAW)).first().quality_score == 7.3


def test_augmentation(spark):
    df = spark.createDataFrame([(i, t, "r", "ORDER", "track_order", "B") for i, t in enumerate(["Cancel my purchase", "difficulties here", "hello there", "cancelled", "hey", "see {{Order Number}} now please"])], RAW)
    got = augment.augment(df).orderBy("row_id", "variant_no").collect()
    assert len(got) == 24 and [g.augmentation_type for g in got[:8]] == ["original", "typos", "short_form", "paraphrase_rewrite", "original", "typos", "long_form", "paraphrase_rewrite"]
    assert [g.instruction for g in got if g.variant_no == 3][:4] == ["stop my order", "problems here", "Please, hello there", "Please, cancelled"]
    assert got[17].instruction == "hey" and "{{Order Number}}" in got[21].instruction


def test_tokens_split_validate(spark):
    est = lambda t: spark.createDataFrame([(t,)], "t string").select(tokens.estimate("t")).first()[0]
    assert [est(t) for t in ("", "a b c", "a b c d e f g h i", None)] == [4, 7, 15, 0]
    for n, sizes in ((9, {"train": 7, "test": 2}), (0, {}), (107, {"train": 85, "validation": 10, "test": 12})):
        assert {r.split: r.n for r in split.split_sizes(spark.range(n).withColumnRenamed("id", "row_id")).collect()} == sizes
    a, b = ({r.row_id: r.split for r in split.split(spark.range(0, 500, 1, p).withColumnRenamed("id", "row_id")).collect()} for p in (1, 7))
    assert a == b
    rows = [(1, None, "x", "c", "i", "f"), (2, "  ", "x", "c", "i", "f"), (3, "q" * 1001, "x", "c", "i", "f")]
    r = validate.validate_rows(spark.createDataFrame(rows, RAW)).first()
    assert (r.missing_fields, r.empty_fields, r.long_queries, r.is_valid) == (1, 1, 1, False)


def test_empty_table(spark):
    empty = spark.createDataFrame([], RAW)
    assert clean.clean(empty).count() == 0 and augment.augment(empty).count() == 0
    assert score.report(empty).first().n_rows == 0 and clean.removal_report(empty).first().total_removed == 0


def test_sources_and_pipeline(spark, sf, tmp_path):
    rows = io.interactions(spark, sf)
    path = str(tmp_path / "csv")
    io.write_csv(rows.drop("row_id"), path)
    back = io.with_row_id(io.read_csv(spark, path))
    assert back.count() == rows.count() and back.select("row_id").distinct().count() == rows.count()
    out = pipeline.run(spark, rows, str(tmp_path / "out"), reports_dir=str(tmp_path / "reports"))
    assert out["progression"][-1]["n_rows"] == 4 * out["progression"][-2]["n_rows"]
    assert os.path.exists(tmp_path / "reports" / "metrics.csv")
    assert io.read_splits(spark, {"train": f"{tmp_path}/out/data/final/splits/split=train"}).count() == out["split"]["train"]
    assert "| a | 1 |" in report.markdown("t", {"a": 1})


def test_streaming(spark, sf, tmp_path):
    from parley.streaming.stages import prepared

    rows = io.interactions(spark, sf)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = prepared(stream).select("row_id", "sentiment").writeStream.format("memory").queryName("prepared_rows").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("prepared_rows").count() > 0


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _rows(df):
    say = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 6) if isinstance(v, float) else str(v)
    return sorted(([say(v) for v in r] for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_against_sql(spark, sf, duck, name):
    got, want = Q.queries()[name](spark, sf).toPandas(), duck.execute(Q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
