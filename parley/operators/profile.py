"""Profiling of a raw table."""

from __future__ import annotations

from functools import reduce

from math import pi

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.text import word_count


def profile(df: DataFrame, text_cols=("instruction", "response")) -> DataFrame:
    """One row: size, nulls per column, repeated rows, noise counters. One pass, and one aggregate for repeated rows."""
    columns = df.columns
    placeholder = lambda c: F.count_if(F.col(c).rlike(r"\{\{.*?\}\}"))
    short = lambda c, n: F.count_if(F.length(F.coalesce(F.col(c), F.lit(""))) < n)
    a, b = text_cols
    once = df.agg(
        F.count("*").alias("n_rows"), F.lit(len(columns)).cast("long").alias("n_columns"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        F.count_if(reduce(lambda x, y: x | y, (F.col(c).isNull() for c in columns))).alias("rows_with_null"), short(a, 10).alias(f"short_{a}"), short(b, 20).alias(f"short_{b}"),
        placeholder(a).alias(f"placeholder_{a}"), placeholder(b).alias(f"placeholder_{b}"),
    )
    digest = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))  # the rows themselves are not shuffled
    kinds = df.groupBy(digest.alias("_row")).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
    return once.crossJoin(F.broadcast(kinds))  # one row each


def length_stats(df: DataFrame, text_cols=("instruction", "response")) -> DataFrame:
    """Average, greatest, least and exact median of characters and words of both texts."""
    sizes = {f"{c}_{k}": f(c) for c in text_cols for k, f in (("chars", F.length), ("words", word_count))}
    df = df.select(*[v.alias(k) for k, v in sizes.items()])
    return df.agg(*[e for k in sizes for e in (
        F.round(F.avg(k), 6).alias(f"avg_{k}"), F.max(k).cast("long").alias(f"max_{k}"), F.min(k).cast("long").alias(f"min_{k}"), F.median(k).alias(f"median_{k}"),
    )])


def length_histogram(df: DataFrame, text_cols=("instruction", "response"), bins: int = 30) -> DataFrame:
    """Counts of equal-width bins of the word counts; the last bin is closed on the right."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), word_count(c).cast("double").alias("v")) for c in text_cols])).alias("x")).select("x.*").where("v is not null")
    limits = rows.groupBy("field").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    at = F.when(F.col("high") == F.col("low"), 0).otherwise(F.least(F.floor((F.col("v") - F.col("low")) * bins / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))), F.lit(bins - 1)))
    return rows.join(F.broadcast(limits), "field").groupBy("field", at.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def density(df: DataFrame, text_cols=("instruction", "response"), points: int = 200, cells: int = 1024) -> DataFrame:
    """field, point, x, density, expected: a Gaussian estimate of the word counts at equal steps from the least to the greatest.
    The bandwidth is Scott's, the deviation times n to the power of -1/5; ``expected`` is the count that a histogram bin of
    width one would have. Fields with fewer than two different values have no rows.

    Each value is shared between the two nearest of ``cells`` + 1 places, in proportion to its distance; these sums merge
    like counts, and only they meet the points: the work beside one pass is the same for any table."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), word_count(c).cast("double").alias("v")) for c in text_cols])).alias("x")).select("x.*").where("v is not null")
    limits = rows.groupBy("field").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"), F.stddev_samp("v").alias("deviation")).where("high > low")
    limits = limits.withColumn("width", F.col("deviation") * F.pow("n", F.lit(-0.2)))
    place = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * cells
    cell = F.least(F.floor(place), F.lit(cells - 1))
    shared = F.explode(F.array(F.struct(cell.alias("cell"), (1 - (place - cell)).alias("share")), F.struct((cell + 1).alias("cell"), (place - cell).alias("share"))))
    weights = rows.join(F.broadcast(limits), "field").select("field", shared.alias("x")).groupBy("field", "x.cell").agg(F.sum("x.share").alias("share")).where("share > 0")
    step = (F.col("high") - F.col("low")) / (points - 1)
    grid = limits.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")).withColumn("x", F.col("low") + F.col("point") * step)
    at = F.col("low") + F.col("cell") * (F.col("high") - F.col("low")) / cells
    bell = F.exp(-0.5 * F.pow((F.col("x") - at) / F.col("width"), F.lit(2.0)))
    sums = weights.join(F.broadcast(grid), "field").groupBy("field", "point").agg(F.first("x").alias("x"), F.first("n").alias("n"), F.first("width").alias("width"), F.sum(F.col("share") * bell).alias("sum"))
    expected = F.col("sum") / (F.col("width") * F.sqrt(F.lit(2 * pi)))
    return sums.select("field", F.col("point").cast("long"), F.round("x", 6).alias("x"), F.round(expected / F.col("n"), 9).alias("density"), F.round(expected, 6).alias("expected"))


def distinct_counts(df: DataFrame, columns=("category", "intent")) -> DataFrame:
    """One row: the number of different values of each column, nulls aside."""
    return df.agg(*[F.count_distinct(c).alias(f"distinct_{c}") for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(k)


def distributions(df: DataFrame, columns) -> DataFrame:
    """Counts and shares of the values of several columns in one pass: field, value, n, percent."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*").where("value is not null")
    counts = rows.groupBy("field", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("field").agg(F.sum("n").alias("_all"))
    return counts.join(F.broadcast(totals), "field").select("field", "value", "n", F.round(F.col("n") * 100.0 / F.col("_all"), 2).alias("percent"))
