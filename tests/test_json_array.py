"""JSON arrays by many tasks: ranges against Python's parser, round trips, faults."""

import io
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.sources import io as tables
from parley.sources import json_array as J


def made(rng, deep=0):
    kind = rng.randrange(8 if deep < 3 else 5)
    if kind == 0:
        return rng.choice([None, True, False, 0, -1.5, 1e10, 12345678901])
    if kind < 5:
        return "".join(rng.choice(['"', "\\", "\\\\", "[", "]", "{", "}", ",", ":", "a", "é", "🙂", "\n", " ", '\\"', " "]) for _ in range(rng.randint(0, 12)))
    if kind == 5:
        return [made(rng, deep + 1) for _ in range(rng.randint(0, 4))]
    return {made_key(rng): made(rng, deep + 1) for _ in range(rng.randint(0, 4))}


def made_key(rng):
    return "".join(rng.choice('ab"\\,{}[]') for _ in range(rng.randint(1, 4)))


def ranges(data, most, bare=False):
    """Ranges with states from the sums, as the driver makes them."""
    out, state = [], (False, 1 if bare else 0)
    for a in range(0, max(len(data), 1), most):
        out.append(J.Range("x", a, min(a + most, len(data)), *state, bare))
        n, outside, inside = J.summed(np.frombuffer(data[a : a + most], np.uint8), J._before(io.BytesIO(data), a))
        state = (bool((state[0] + n) % 2), state[1] + (inside if state[0] else outside))
    return out


@pytest.mark.parametrize("indent", [None, 4])
def test_ranges_of_any_size(indent, monkeypatch):
    """Whatever the cuts, inside strings, escapes and characters of several bytes: all elements once, in order."""
    monkeypatch.setattr(J, "MORE_BYTES", 5)
    rng = random.Random(1)
    for _ in range(20):
        rows = [made(rng) for _ in range(rng.randint(0, 12))]
        data = json.dumps(rows, ensure_ascii=rng.random() < 0.3, indent=indent).encode()
        for most in (1, 3, 7, 50, 10_000):
            found = [json.loads(t) for r in ranges(data, most) for t in J.elements(io.BytesIO(data), r)]
            assert found == rows, (data, most)
        bare = ",\n".join(json.dumps(r, indent=indent) for r in rows).encode()
        for most in (4, 1000):
            assert [json.loads(t) for r in ranges(bare, most, True) for t in J.elements(io.BytesIO(bare), r)] == rows


def test_what_is_no_array():
    whole = lambda data: [*J.elements(io.BytesIO(data), J.Range("x", 0, len(data)))]
    assert whole(b" [ ] \n") == [] and whole(b"[1, [2, 3], {}]") == [b"1", b"[2, 3]", b"{}"]
    for data in (b'{"a": 1}', b"[1, 2", b"x"):
        with pytest.raises(ValueError):
            whole(data)


def nested(spark, n):
    return spark.range(0, n, 1, 5).select(
        "id", F.struct(F.concat(F.lit('q"\\\n[é'), F.col("id")).alias("s"), F.array(F.struct(F.lit(None).cast("string").alias("x"), (F.col("id") / 4).alias("y"))).alias("list")).alias("inner"),
        F.when(F.col("id") % 3 == 0, F.lit("🙂 ]},")).alias("text"),
    )


@pytest.mark.parametrize("indent", [None, 4])
def test_round_trip_of_nested_rows(spark, tmp_path, monkeypatch, indent):
    """Written by five tasks to one file that Python reads as well, read by many ranges, with a schema and without."""
    monkeypatch.setattr(J, "RANGE_BYTES", 1_000)
    rows = nested(spark, 200)
    path = f"{tmp_path}/t.json"
    assert J.write_array(rows, path, indent) == 200
    with open(path, encoding="utf-8") as f:
        text = f.read()
    assert [r["id"] for r in json.loads(text)] == [*range(200)] and (indent is None or text.startswith('[\n    {\n        "id": 0,'))
    expected = sorted(rows.collect(), key=lambda r: r.id)
    typed = J.read_array(spark, path, rows.schema)
    assert sorted(typed.collect(), key=lambda r: r.id) == expected
    assert typed.select(F.spark_partition_id()).distinct().count() > 10
    guessed = J.read_array(spark, path)
    assert guessed.schema["inner"].dataType.simpleString() == "struct<list:array<struct<x:string,y:double>>,s:string>"
    assert sorted(r.id for r in guessed.collect()) == [*range(200)]
    # over an older file, and nothing else is left behind
    assert J.write_array(rows.limit(3), path, indent) == 3 and J.read_array(spark, path, rows.schema).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t.json"]


def test_empty_tables(spark, tmp_path):
    rows = nested(spark, 0)
    assert J.write_array(rows, f"{tmp_path}/t.json") == 0
    with open(f"{tmp_path}/t.json", encoding="utf-8") as f:
        assert json.load(f) == []
    assert J.read_array(spark, f"{tmp_path}/t.json", rows.schema).count() == 0
    assert tables.read_json(spark, f"{tmp_path}/t.json").count() == 0


def test_a_folder_of_parts(spark, tmp_path):
    """The source by itself: parts, a list of them, left-over parts of lost tasks do not count."""
    spark.dataSource.register(J.JsonArraySource)
    texts = spark.range(0, 100, 1, 4).select(F.format_string('{"id": %d}', "id").alias("value"))
    texts.write.format("json_array").mode("append").save(f"{tmp_path}/parts")
    with open(f"{tmp_path}/parts/part-000001-lost-7.json", "w") as f:
        f.write('{"id": -1}')
    back = spark.read.format("json_array").load(f"{tmp_path}/parts")
    assert sorted(json.loads(r.value)["id"] for r in back.collect()) == [*range(100)]
    with pytest.raises(Exception, match="one column"):
        spark.range(3).selectExpr("id", "id x").write.format("json_array").mode("append").save(f"{tmp_path}/other")


def test_no_row_on_the_driver(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    rows = nested(spark, 50)

    def fail(*_):
        raise AssertionError("rows on the driver")

    monkeypatch.setattr(DataFrame, "toLocalIterator", fail)
    monkeypatch.setattr(DataFrame, "toPandas", fail)
    assert tables.write_json(rows, f"{tmp_path}/t.json") == 50
