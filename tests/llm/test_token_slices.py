"""The pipeline's tokens leave a task in small pieces, and tasks of whole texts give memory back."""

import pyarrow as pa
import pytest

import corpus_pipeline
from parley.llm import bpe_codec, common


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.codec(bpe_codec.default_path())


def test_results_leave_by_slices(codec):
    texts = [None, "", "The quick brown fox. " * 20_000, *(f"Line {i} of some text; " * 100 for i in range(500)), None]
    parts = list(bpe_codec._round_trips(codec, iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert 3 * max(p.nbytes for p in parts) < 2 * sum(p.nbytes for p in parts)  # a batch left as one
    got = [x for p in parts for x in p.to_pylist()]
    assert [x["ids"] for x in got] == [codec.encode(t) for t in texts]
    assert [x["decoded"] for x in got] == [codec.decode(codec.encode(t)) for t in texts]


def test_tokens_of_the_pipeline(spark, codec):
    rows = [(i, f"Line {i} of some text; " * (i % 7 * 40) if i % 5 else None) for i in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text, r.n_tokens, r.token_ids, r.decoded_text) for r in corpus_pipeline.tokens(spark, docs, "").collect()}
    for i, t in rows:
        ids = codec.encode(t)
        assert got[i] == (t, len(ids), ids, codec.decode(ids))


def test_memory_goes_back_after_a_stage(spark, monkeypatch, tmp_path):
    # in this process: what the stages' functions do at the end of a task
    back = []
    monkeypatch.setattr(common, "_give_back", lambda: back.append(1))
    for column in (bpe_codec.round_trip, lambda c: corpus_pipeline.line_dedup.without_lines(c, c)):
        made = []
        with monkeypatch.context() as m:
            for module in (bpe_codec, corpus_pipeline.line_dedup):
                m.setattr(module.F, "arrow_udf", lambda kind: lambda f: made.append(f) or (lambda *c: None))
            column(None)
        list(made[0](iter([])))
    assert len(back) == 2
