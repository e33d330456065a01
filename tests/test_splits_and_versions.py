"""Splits that keep siblings together, versions by content, density against a direct sum."""

import random
from hashlib import md5
from math import exp, floor, pi, sqrt
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from parley.operators import profile, split
from parley.sources import io


def by_brute_force(groups, train, validation):
    """Row by row: a group's split is the one that most of its places fall in."""
    n = sum(groups.values())
    a = floor(n * train)
    b = a + floor(n * validation)
    out, at = {}, 0
    for g in sorted(groups, key=lambda g: md5(("" if g is None else f"={g}").encode() + b"|42").hexdigest() if g is not None else md5(b"|42").hexdigest()):
        places = range(at, at + groups[g])
        counts = [sum(p < a for p in places), sum(a <= p < b for p in places), sum(p >= b for p in places)]
        out[g] = ("train", "validation", "test")[counts.index(max(counts))]
        at += groups[g]
    return out


@pytest.mark.parametrize("train,validation", [(0.8, 0.1), (0.5, 0.5), (1.0, 0.0), (0.0, 0.0), (0.3, 0.4)])
def test_siblings_stay_together(spark, train, validation):
    rng = random.Random(3)
    for sizes in ([rng.randint(1, 9) for _ in range(200)], [1] * 50, [300, 5, 5, 200, 1], [7], [60] + [1] * 30):
        groups = {(None if i == 3 else f"g{i}"): n for i, n in enumerate(sizes)}
        rows = spark.createDataFrame([(k, g) for g, n in groups.items() for k in range(n)], "k int, g string").repartition(3)
        found = split.split_groups(rows, "g", train, validation).groupBy("g", "split").agg(F.count("*").alias("n")).collect()
        assert {r.g: (r.split, r.n) for r in found} == {g: (s, groups[g]) for g, s in by_brute_force(groups, train, validation).items()}
        assert len(found) == len(groups)


def test_sizes_of_small_groups_are_near_exact(spark):
    rows = spark.range(0, 20_000, 1, 6).select("id", (F.col("id") / 3).cast("int").alias("g"))
    sizes = {r.split: r["count"] for r in split.split_groups(rows, "g").groupBy("split").count().collect()}
    assert all(abs(sizes[k] - n) <= 3 for k, n in (("train", 16_000), ("validation", 2_000), ("test", 2_000)))


def test_splitting_moves_no_row(spark):
    """Only the groups' sizes are shuffled; rows meet one row of borders."""
    rows = spark.range(0, 100).select("id", (F.col("id") % 7).alias("g"), F.lit("text").alias("text"))
    plan = split.split_groups(rows, "g")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text" in line or "id#" in line for line in exchanges) and "SortMergeJoin" not in plan
    assert split.split_groups(rows.where("id < 0"), "g").count() == 0


def test_versions(spark, tmp_path):
    """Any order of rows and columns is the same version; one cell, a null or one more equal row is another."""
    rows = [(1, "a", None, [1, None]), (2, None, "b", None), (2, None, "b", None), (3, "", "x|y=1:z", [])]
    df = spark.createDataFrame(rows, "k int, x string, y string, l array<int>")
    version = lambda d: tuple(io.digest(d).first())
    first = version(df)
    assert first[0] == 4 and first == version(df.repartition(4)) == version(df.orderBy(F.desc("k")).select("l", "y", "x", "k"))
    changed = [df.replace({1: 4}, subset=["k"]), df.union(df.limit(1)), df.fillna(""), df.distinct(), df.withColumnRenamed("x", "z"), df.withColumn("l", F.lit(None).cast("array<int>"))]
    assert len({first, *map(version, changed)}) == 1 + len(changed)
    assert version(df.where("k > 9"))[0] == 0
    where, new = io.versioned(df, f"{tmp_path}/raw")
    again, newer = io.versioned(df.repartition(3), f"{tmp_path}/raw")
    other, newest = io.versioned(changed[0], f"{tmp_path}/raw")
    assert (new, newer, newest) == (True, False, True) and where == again != other
    assert spark.read.parquet(where).count() == 4 and len([*(tmp_path / "raw").iterdir()]) == 2


def test_density_against_a_direct_sum(spark):
    rng = random.Random(4)
    counts = [rng.choice([3, 4, 5, 5, 9, 40]) + rng.randint(0, 12) for _ in range(500)]
    rows = spark.createDataFrame([(" ".join("w" * c), "one word each") for c in counts] + [(None, None)], "instruction string, response string").repartition(3)
    found = {r.point: r for r in profile.density(rows).collect()}
    assert {r.field for r in found.values()} == {"instruction"} and len(found) == 200
    width, low, high = stdev(counts) * len(counts) ** -0.2, min(counts), max(counts)
    for i, r in found.items():
        x = low + i * (high - low) / 199
        direct = sum(exp(-0.5 * ((x - c) / width) ** 2) for c in counts) / (width * sqrt(2 * pi))
        assert abs(r.x - x) < 1e-5 and abs(r.expected - direct) < 2e-4 * max(direct, 1) and abs(r.density - direct / len(counts)) < 1e-5
