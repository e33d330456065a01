"""Sentiment, urgency, escalation and complexity labels; all terms are looked for as substrings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import lexicons as L
from parley.functions.text import contains_any, count_hits, word_count
from parley.operators.score import flags_text


def sentiment(query: Column) -> Column:
    negative = count_hits(query, L.NEGATIVE) + F.when(F.contains(query, F.lit("?")), 0.2).otherwise(0.0)
    negative = negative + F.when(F.contains(query, F.lit("!")) & (negative > 0), 1.0).otherwise(0.0)
    positive = count_hits(query, L.POSITIVE)
    return F.when(negative > positive, "negative").when(positive > negative, "positive").otherwise("neutral")


def urgency(query: Column, intent: Column, category: Column) -> Column:
    high = contains_any(intent, L.HIGH_INTENTS) | F.contains(category, F.lit("security")) | (contains_any(query, L.URGENT) & F.contains(query, F.lit("help")))
    medium = contains_any(intent, L.MEDIUM_INTENTS) | contains_any(category, ("billing", "account")) | contains_any(query, ("problem", "issue"))
    return F.when(high, "high").when(medium, "medium").otherwise("low")


def escalation(query: Column, urgency: Column, sentiment: Column) -> Column:
    return contains_any(query, L.ESCALATION) | ((urgency == "high") & (sentiment == "negative")) | contains_any(query, L.ILLEGAL)


def complexity(query: Column, flags: Column) -> Column:
    n, f = word_count(query), F.length(flags)
    high = ((n > 20) & (f >= 4)) | ((n > 15) & contains_any(query, L.CONDITIONS))
    return F.when(high, "high").when((n < 8) & (f <= 2), "low").otherwise("medium")


def enrich(df: DataFrame) -> DataFrame:
    lower = lambda c: F.lower(F.coalesce(F.col(c), F.lit("nan")))
    df = df.withColumn("_q", F.lower("instruction"))
    df = df.withColumns({"sentiment": sentiment(F.col("_q")), "urgency": urgency(F.col("_q"), lower("intent"), lower("category"))})
    return df.withColumns({"escalation": escalation(F.col("_q"), F.col("urgency"), F.col("sentiment")), "complexity": complexity(F.col("_q"), flags_text(df))}).drop("_q")


LABELS = ("sentiment", "urgency", "escalation", "complexity")
