"""Quality scores of instruction and response pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.lexicons import HELP_MARKERS, STOP_WORDS
from parley.functions.text import contains_any, sentence_count, word_count, words

WEIGHTS = {"grammar_score": 0.20, "completeness_score": 0.25, "length_score": 0.15, "relevance_score": 0.20, "readability_score": 0.20}


def _less(*steps: tuple[Column, float]) -> Column:
    """The first step that holds takes off its points."""
    out = F.lit(0.0)
    for condition, points in reversed(steps):
        out = F.when(condition, F.lit(points)).otherwise(out)
    return out


def _floor(x: Column) -> Column:
    return F.greatest(F.lit(1.0), x)


def grammar(flags: Column) -> Column:
    both = lambda s: F.contains("instruction", F.lit(s)) | F.contains("response", F.lit(s))
    parts = (F.contains(flags, F.lit("Z")), 2.0), (both("  "), 2.0), (both(",,"), 1.0), (both("??"), 0.5), (both("!!"), 0.5)
    out = F.lit(10.0)
    for p in parts:
        out = out - _less(p)
    return _floor(out)


def completeness() -> Column:
    r, n = F.col("response"), word_count("response")
    return _floor(F.lit(10.0) - _less((~r.rlike(r"""[.!?"']\z"""), 3.0)) - _less((n < 10, 4.0), (n < 20, 2.0)) - _less((~contains_any(F.lower(r), HELP_MARKERS), 1.0)))


def length() -> Column:
    i, r = F.length("instruction"), F.length("response")
    return _floor(F.lit(10.0) - _less((i < 10, 4.0), (i < 20, 2.0), (i > 300, 1.0)) - _less((r < 50, 4.0), (r < 100, 2.0), (r > 2000, 2.0), (r > 1500, 1.0)))


def relevance() -> Column:
    asked = F.array_except(words("instruction"), F.array(*map(F.lit, STOP_WORDS)))
    answer = words("response")
    share = F.size(F.array_intersect(asked, answer)) / F.nullif(F.size(asked), F.lit(0))
    intent = F.filter(F.split(F.translate(F.lower(F.coalesce(F.col("intent"), F.lit("nan"))), "_", " "), " "), lambda w: w != "")
    return _floor(F.lit(10.0) - _less((share < 0.1, 4.0), (share < 0.25, 2.0), (share < 0.5, 0.5)) - _less(((F.size(intent) > 0) & ~F.arrays_overlap(intent, answer), 2.0)))


def readability() -> Column:
    n, s = word_count("response"), sentence_count("response")
    per, mean = n / F.nullif(s, F.lit(0)), F.length(F.regexp_replace("response", r"(?U)[\s\x1c-\x1f]", "")) / F.nullif(n, F.lit(0))
    return F.when((s == 0) | (n == 0), 1.0).otherwise(_floor(F.lit(10.0) - _less((per > 30, 2.0), (per > 20, 1.0)) - _less((mean > 7, 2.0), (mean > 6, 1.0))))


def flags_text(df: DataFrame, pandas_compat: bool = True) -> Column:
    """A missing value reads 'nan' under ``pandas_compat``; a missing column is empty."""
    if "flags" not in df.columns:
        return F.lit("")
    return F.coalesce(F.col("flags"), F.lit("nan" if pandas_compat else ""))


def with_scores(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "grammar_score": grammar(flags_text(df)), "completeness_score": completeness(), "length_score": length(), "relevance_score": relevance(), "readability_score": readability(),
    })
    total = sum((F.col(c) * w for c, w in WEIGHTS.items()), F.lit(0.0))
    return df.withColumn("quality_score", F.round(total, 2))


def passing(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    return with_scores(df).where(F.col("quality_score") >= threshold)


def report(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    """One row over all rows, before the threshold."""
    q = F.col("quality_score")
    mean = lambda c: F.round(F.avg(c), 6)
    return with_scores(df).agg(
        F.count("*").alias("n_rows"), F.count_if(q >= threshold).alias("passed"), F.count_if(q < threshold).alias("filtered"), mean("quality_score").alias("mean_quality"),
        F.min(q).alias("min_quality"), F.max(q).alias("max_quality"), *[mean(c).alias(f"mean_{c}") for c in WEIGHTS],
    )
