"""Untyped records and raw bytes against Python's own parser and decoder."""

import json
import random

import pytest
from pyspark.sql import functions as F

from parley.operators import validate
from parley.queries import _RECORDS


def first_error(kind, text):
    """The rules over what Python's parser gives."""
    try:
        item = json.loads(text)
    except (ValueError, TypeError):
        return "json", None
    if kind == "alpaca":
        if not isinstance(item, dict):
            return "object", None
        return next(((k, None) for k in ("instruction", "input", "output") if k not in item), None)
    if kind == "chatml":
        turns, least = item, 2
        if not isinstance(item, list):
            return "array", None
        if len(item) != 2:
            return "size", None
    else:
        if not isinstance(item, dict):
            return "object", None
        if "messages" not in item:
            return "messages", None
        turns, least = item["messages"], 2
        if not isinstance(turns, list):
            return "array", None
        if len(turns) < least:
            return "size", None
    for i, m in enumerate(turns):
        if not isinstance(m, dict):
            return "object", i
        if kind == "chatml" and m.get("role") != ("user", "assistant")[i]:
            return "role", i
        for k in ("role", "content"):
            if k not in m:
                return k, i
    return None


def random_records(n):
    rng = random.Random(5)

    def message():
        m = {k: v for k, v in (("role", rng.choice(["user", "assistant", None, 1, "tool"])), ("content", rng.choice(["x", None, [], {}]))) if rng.random() < 0.85}
        return rng.choice([m, m, m, m, m, 5, [], "m", None])

    for _ in range(n):
        turns = [message() for _ in range(rng.choice([0, 1, 2, 2, 2, 3]))]
        yield json.dumps(rng.choice([turns, turns, {"messages": turns}, {"messages": turns, "metadata": {}}, {"messages": rng.choice([{}, "x", None])}, {"instruction": None, "input": 1, "output": []}, {"input": 1}]))


@pytest.mark.parametrize("kind", validate.JSON_ERRORS)
def test_first_error_of_records(spark, kind):
    texts = [*_RECORDS, None, "", " [ ] ", '{"a": 1', '{"messages": [{"role": "a", "content": "b"}, {"role": "c", "content": "d"}]} x', *random_records(800)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    found = [r.e and tuple(r.e) for r in rows.select("i", validate.json_error(F.col("value"), kind).alias("e")).orderBy("i").collect()]
    assert found == [first_error(kind, t) for t in texts]
    errors = sum(e is not None for e in found)
    r = validate.validate_json(rows, kind).first()
    assert (r.n_rows, r.errors, r.is_valid) == (len(texts), errors, False)
    assert sum(x.n for x in validate.json_errors(rows, kind).collect()) == errors


def test_a_record_without_metadata_is_valid(spark):
    """The rule asks for messages only."""
    text = '{"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "y"}]}'
    assert validate.validate_json(spark.createDataFrame([(text,)], "value string"), "messages").first().is_valid


def decoded(data):
    try:
        data.decode("utf-8")
    except UnicodeDecodeError as e:
        return e.start
    return None


def test_first_bad_byte(spark):
    rng = random.Random(6)
    parts = ["a", "é", "日", "🙂", "\n", "￿", "\U0010ffff"]
    bad = [b"\x80", b"\xc0\x80", b"\xed\xa0\x80", b"\xe0\x80\x80", b"\xf4\x90\x80\x80", b"\xe2\x82", b"\xff", b"\xf0\x9f\x99", b"\xc3", b"\xf5", b"\xbf\xbf"]
    rows = [b"", b"plain", None]
    for _ in range(3000):
        rows.append(b"".join(rng.choice(parts).encode() if rng.random() < 0.9 else rng.choice(bad) for _ in range(rng.randint(0, 12))))
    rows += [bytes(rng.randrange(256) for _ in range(rng.randint(1, 6))) for _ in range(2000)] + ["日".encode() * 50_000 + b"\xe6\x97"]
    df = spark.createDataFrame([(i, None if x is None else bytearray(x)) for i, x in enumerate(rows)], "i int, x binary")
    found = [r.e and r.e.place for r in df.select("i", validate.encoding_error(F.col("x")).alias("e")).orderBy("i").collect()]
    assert found == [None if x is None else decoded(x) for x in rows]


def test_reasons_and_lines_of_a_file(spark, tmp_path):
    lines = [b"fine", "café".encode(), b"caf\xe9 ole", b"\x80", b"x\xed\xa0\x80", b"\xe0\x80\x80", b"\xf4\x90\x80\x80", b"end\xe2\x82", b"\xffx"]
    (tmp_path / "t.txt").write_bytes(b"\n".join(lines))
    found = sorted((r.reason, r.place, bytes(r.line)) for r in validate.badly_encoded_lines(spark, f"{tmp_path}/t.txt").collect())
    expected = [("truncated", 3, lines[2]), ("stray", 0, lines[3]), ("surrogate", 1, lines[4]), ("overlong", 0, lines[5]), ("beyond", 0, lines[6]), ("truncated", 3, lines[7]), ("impossible", 0, lines[8])]
    assert found == sorted(expected)
    counts = {r.reason: r.n for r in validate.encoding_counts(spark.createDataFrame([(bytearray(x),) for x in lines], "x binary"), "x").collect()}
    assert counts == {"truncated": 2, "stray": 1, "surrogate": 1, "overlong": 1, "beyond": 1, "impossible": 1}
