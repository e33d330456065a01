"""The rebuilt pipeline cleans with every entity and Unicode NFKC."""


def test_pipeline_cleans_fully(spark):
    from parley.plans import pipeline

    rows = [(1, "what is a &amp b &eacute; ﬁne", "the answer &hellip; is Ⅳ", "c", "i")]
    raw = spark.createDataFrame(rows, "row_id long, instruction string, response string, category string, intent string")
    got = pipeline.tables(raw, 0.0)["cleaned"].first()
    assert (got.instruction, got.response) == ("What is a & b é fine", "The answer ... Is IV")
