"""Token-length estimates and statistics."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import word_count
from parley.operators.chat import rendered


def estimate(c: Column | str) -> Column:
    """1.3 tokens a word, rounded down, and 4; 0 for a null."""
    return F.coalesce(F.floor(word_count(c) * F.lit(1.3)).cast("long") + 4, F.lit(0).cast("long"))


def tokenizer_count(path: str) -> Callable[[Column], Column]:
    """Counts by a tokenizer file, to be given as ``count``; the estimate for a text that it fails on, and for all texts
    where the ``tokenizers`` library or the file is missing. 0 for a null."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        own = _tokenizer(path)
        out = []
        for t in texts.to_pylist():
            try:
                out.append(None if own is None else 0 if t is None else len(own.encode(t).ids))
            except Exception:  # whatever the library raises: the estimate stands in
                out.append(None)
        return pa.array(out, pa.int64())

    return lambda c: F.coalesce(count(F.col(c) if isinstance(c, str) else c), estimate(c))


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    try:
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)
    except Exception:  # the library raises its own kinds
        return None


def token_counts(df: DataFrame, count: Callable[[Column], Column] = estimate) -> DataFrame:
    """full, query and response tokens of rows with ``messages``; ``count`` may be any tokenizer's column function."""
    m = F.col("messages")
    keys = [c for c in ("row_id", "variant_no") if c in df.columns]
    return df.select(*keys, count(rendered(m)).alias("full_tokens"), count(F.get(m, 1)["content"]).alias("query_tokens"), count(F.get(m, 2)["content"]).alias("response_tokens"))


def recommended(p99: Column) -> Column:
    return F.greatest(F.ceil(p99 / 128) * 128, F.lit(512)).cast("long")


def token_stats(df: DataFrame, count: Callable[[Column], Column] = estimate) -> DataFrame:
    """One row: averages, extremes, linear-interpolated percentiles, recommended length."""
    rows = token_counts(df, count)
    each = [e for c in ("full_tokens", "query_tokens", "response_tokens") for e in (F.round(F.avg(c), 6).alias(f"avg_{c}"), F.max(c).alias(f"max_{c}"), F.min(c).alias(f"min_{c}"))]
    out = rows.agg(F.count("*").alias("n_rows"), *each, F.percentile("full_tokens", F.array(*map(F.lit, (0.5, 0.9, 0.95, 0.99)))).alias("_p"))
    p = {f"p{n}": F.round(F.get("_p", i), 6) for i, n in enumerate((50, 90, 95, 99))}
    return out.withColumns(p).withColumn("recommended_length", recommended(F.get("_p", 3))).drop("_p")
