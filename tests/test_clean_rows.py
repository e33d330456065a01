"""Rows through cleaning: shared and null ids, ties, counters of one run."""

import unicodedata

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from parley import queries
from parley.operators import clean, report
from parley.plans import pipeline
from parley.sources import io

RAW = "row_id long, instruction string, response string, category string, intent string, flags string"


def table(spark, rows):
    return spark.createDataFrame(rows, RAW).repartition(3)


def test_rows_that_share_an_id(spark):
    """Rows in are rows out where nothing is to go, whatever their ids."""
    rows = [(5, "first one", "an answer", "c", "i", "f"), (5, "second one", "an answer", "c", "i", "f"), (6, "third", "an answer", "c", "i", "f"), (None, "no id", "an answer", "c", "i", "f"), (None, "none either", "yes", "c", "i", "f")]
    df = table(spark, rows)
    assert sorted((str(r.row_id), r.instruction) for r in clean.clean(df).collect()) == [("5", "First one"), ("5", "Second one"), ("6", "Third"), ("None", "No id"), ("None", "None either")]
    r = clean.removal_report(df).first()
    assert (r.initial_rows, r.duplicate_removed, r.final_rows, r.total_removed) == (5, 0, 5, 0)


def test_first_of_equal_pairs(spark):
    """By id, null ids last; of one id the same row at every layout; equal rows are one."""
    rows = [(None, "q a", "x", "n", "i", "f"), (9, "q a", "x", "z", "i", "f"), (3, "q  a", "x", "a", "i", "f"), (3, "q a", " x", "b", "i", "f"), (3, "q a", "x", "a", "i", "f")]
    kept = {tuple(clean.clean(spark.createDataFrame(rows, RAW).repartition(n)).first()) for n in (1, 2, 5)}
    assert len(kept) == 1
    ((row_id, instruction, response, *_),) = kept
    assert (row_id, instruction, response) == (3, "Q a", "X")
    assert clean.removal_report(table(spark, rows)).first().duplicate_removed == 4


def test_counters_of_the_run(spark, tmp_path):
    """What the write observes is what the report counts."""
    rows = [(k, "same?? question", "the answer", "c", "i", "f") for k in range(50)] + [(k, None, "x", "c", "i", "f") for k in range(50, 57)] + [(k, " ", "x", "c", "i", "f") for k in range(57, 60)]
    rows += [(60, "??", "!!", "c", "i", "f"), (61, "Same", "same", "c", "i", "f"), (62, "same", "Same", "c", "i", "f")]
    df = table(spark, rows)
    kept, counters = clean.clean_counted(df)
    kept.write.parquet(f"{tmp_path}/out")
    expected = report.as_dict(clean.removal_report(df))
    assert counters.get == expected
    # rows 61 and 62 are one pair once capitals are set, and then question and answer are the same
    assert [expected[k] for k in ("initial_rows", "null_removed", "empty_removed", "duplicate_removed", "malformed_removed", "final_rows", "total_removed")] == [63, 7, 3, 50, 2, 1, 62]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_counters_of_an_empty_table(spark, tmp_path):
    kept, counters = clean.clean_counted(table(spark, []).where("row_id > 0"))
    kept.write.parquet(f"{tmp_path}/out")
    assert counters.get == dict.fromkeys(counters.get, 0) and len(counters.get) == 7


def test_pipeline_counts_what_it_writes(spark, sf, tmp_path):
    raw = io.interactions(spark, sf)
    out = pipeline.run(spark, raw, f"{tmp_path}/out", 1.0)
    assert out["cleaning"] == report.as_dict(clean.removal_report(raw))
    assert out["cleaning"]["final_rows"] == spark.read.parquet(f"{tmp_path}/out/data/cleaned").count()


def test_capitals_are_those_of_the_sql(spark):
    """Every small letter with a capital that NFKC leaves alone and Java knows, also those of which it makes two capitals."""
    letters = [x for n in range(0x110000) if unicodedata.category(x := chr(n)) == "Ll" and unicodedata.normalize("NFKC", x) == x != x.upper()]
    rows = [(x, f"{x}a") for x in letters]
    got = {r.x: r.t for r in spark.createDataFrame(rows, "x string, t string").where(r"x rlike '^\\p{Ll}'").select("x", clean.capital(F.col("t")).alias("t")).collect()}
    letters_in = pa.table({"x": letters, "t": [f"{x}a" for x in letters]})
    assert got == {x: t for x, t in duckdb.sql(f"SELECT x, {queries._capital('t')} FROM letters_in").fetchall() if x in got}
    assert got["ß"] == "ẞa" and len(got) > 1000
