"""Chat-training formats and template rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.lexicons import SYSTEM_PROMPT


def _message(role: str, content: Column | str) -> Column:
    return F.struct(F.lit(role).alias("role"), (F.col(content) if isinstance(content, str) else content).alias("content"))


def alpaca() -> Column:
    return F.struct("instruction", F.lit("").alias("input"), F.col("response").alias("output"))


def chatml() -> Column:
    return F.array(_message("user", "instruction"), _message("assistant", "response"))


def messages(system_prompt: str = SYSTEM_PROMPT) -> Column:
    return F.array(_message("system", F.lit(system_prompt)), _message("user", "instruction"), _message("assistant", "response"))


def metadata() -> Column:
    return F.struct("intent", "category", "sentiment", "urgency", "escalation", "complexity")


def formatted(df: DataFrame, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """row_id (and variant_no), alpaca, chatml, messages, metadata."""
    keys = [c for c in ("row_id", "variant_no") if c in df.columns]
    return df.select(*keys, alpaca().alias("alpaca"), chatml().alias("chatml"), messages(system_prompt).alias("messages"), metadata().alias("metadata"))


def rendered(m: Column) -> Column:
    return F.array_join(F.transform(m, lambda x: F.concat(F.lit("<|im_start|>"), x["role"], F.lit("\n"), x["content"], F.lit("<|im_end|>\n"))), "")


def prompt(m: Column) -> Column:
    """Without the answer, open for generation."""
    return F.concat(rendered(F.slice(m, 1, 2)), F.lit("<|im_start|>assistant\n"))


def json_of(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})
