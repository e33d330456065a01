"""The stateless stages over a stream: cleaning, scoring, labels and formats need no state and run as they are.

First-of-equal de-duplication, exact splits and percentiles look at the whole table and stay with batches; a stream gets
``dropDuplicatesWithinWatermark`` on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators import chat, clean, enrich, score


def prepared(stream: DataFrame, threshold: float = 5.0, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Cleaned, scored, filtered and labelled rows with ``messages`` and ``metadata``; ``watermark``: (time column, delay)."""
    df = stream.where("instruction is not null and response is not null")
    df = df.withColumns({"instruction": clean.clean_instruction(F.col("instruction")), "response": clean.clean_response(F.col("response"))})
    letters = F.col("instruction").rlike(r"\p{L}") & F.col("response").rlike(r"\p{L}")
    df = df.where((F.col("instruction") != F.col("response")) & letters)
    if watermark:
        df = df.withWatermark(*watermark).dropDuplicatesWithinWatermark(["instruction", "response"])
    df = enrich.enrich(score.passing(df, threshold))
    return df.withColumns({"messages": chat.messages(), "metadata": chat.metadata()})
