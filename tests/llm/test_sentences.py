"""SentencePiece encoding against the library: ids, spans, normalisation under compiled maps, decoding."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece

from parley.llm import sentence_codec

SF = "/root/testdata/sf0.001"
ODD = [" ", "  ", "\n", "\t", "▁", "a", "b", "the", " of", "é", "é", "ﬁ", "Å", "㌔", "…", "　", "日本", "🙂", "​", "\x00", "�", "¨", "½", "0", "...", "<0x0A>", "<s>", "<unk>", "x̂"]


def odd_texts(n=1000):
    rng = random.Random(3)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(n)] + [" ", "   ", "a" * 3000, " " * 500, "\n" * 40, "é" * 700, "▁" * 9, " a "]


def _message(number: int, raw: bytes) -> bytes:
    def varint(n):
        return bytes([n | 128 if n > 127 else n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    return varint(number << 3 | 2) + varint(len(raw)) + raw


def with_rules(rule: str) -> bytes:
    """The public model with another character map; the last of two specifications in a file counts."""
    with open(sentence_codec.default_path(), "rb") as f:
        model = f.read()
    return model + _message(3, sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())


def spans_of(lib, text):
    """(ids, first byte, byte behind the last) by the library."""
    pieces = lib.encode(text, return_type="proto").pieces
    return [p.id for p in pieces], [p.begin for p in pieces], [p.end for p in pieces]


@pytest.mark.parametrize("rule", [None, "nmt_nfkc", "nmt_nfkc_cf", "nfkc"])
def test_like_library(rule):
    model = None if rule is None else with_rules(rule)
    lib = sentencepiece.SentencePieceProcessor(model_file=sentence_codec.default_path()) if rule is None else sentencepiece.SentencePieceProcessor(model_proto=model)
    own = sentence_codec.SentenceCodec(model=model)
    for text in odd_texts() + pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()[:100]:
        ids, start, stop = own.encode_parts(text)
        expected = spans_of(lib, text)
        assert ids.tolist() == expected[0] == lib.encode(text), text
        assert (start.tolist(), stop.tolist()) == expected[1:], text
        assert own.decode(ids) == lib.decode(expected[0])


def test_any_ids_decode_like_library():
    lib, own = sentencepiece.SentencePieceProcessor(model_file=sentence_codec.default_path()), sentence_codec.codec(None)
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000), 28705]) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == lib.decode(ids), ids
    with pytest.raises(IndexError):
        own.decode([32000])


def test_rows(spark, edge_docs, no_docs):
    """Null, empty, blank, repeated, very long rows by value."""
    lib = sentencepiece.SentencePieceProcessor(model_file=sentence_codec.default_path())
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    found = [tuple(r) for r in sentence_codec.encode_decode(edge_docs).collect()]
    expected = []
    for r in edge_docs.collect():
        ids, *spans = spans_of(lib, r.text or "")
        raw = np.array(spans, "<i8").T.tobytes()
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(lib.decode(ids).encode()), sha(raw)))
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert sentence_codec.encode_decode(no_docs).count() == 0


def test_columns(spark):
    rows = spark.createDataFrame([(1, "a  b\nc é 日"), (2, None), (3, "")], "id int, text string")
    found = {r.id: r for r in rows.select("id", "text", sentence_codec.encoded(rows.text).alias("p")).select("*", sentence_codec.decoded("p.ids").alias("back")).collect()}
    assert found[1].back == "a  b\nc é 日" and found[2].back == found[3].back == "" and found[2].p.ids == []
    raw = found[1].text.encode()
    assert b"".join(raw[a:b] for a, b in zip(found[1].p.starts, found[1].p.stops)) == raw


def test_other_models_are_refused(tmp_path):
    with open(sentence_codec.default_path(), "rb") as f:
        model = f.read()
    with pytest.raises(ValueError):
        sentence_codec.SentenceCodec(model=model + _message(1, _message(1, b"own") + bytes([3 << 3, 4])))
