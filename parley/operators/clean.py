"""Text cleaning and row rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parley.functions.text import WS
from parley.functions.unicode import capital_letter, nfkc, unescape

QUOTES = ("‘’‚‛“”„‟‹›–—", "''''\"\"\"\"<>--")


def tidy(c: Column) -> Column:
    """Quotes and dashes, repeated marks, white space by line."""
    c = F.translate(c, *QUOTES)
    for pattern, to in (
        (r"\?+", "?"), (r"!+", "!"), (",+", ","), (r"\.{4,}", "..."), (r"[ \t]+", " "), (rf"(?U)[{WS}&&[^\n]]*\n[{WS}&&[^\n]]*", "\n"), (r"\n{3,}", "\n\n"),
        (rf"(?U)^[{WS}]+|[{WS}]+\z", ""),
    ):
        c = F.regexp_replace(c, pattern, to)
    return c


def clean_text(c: Column, full: bool = True) -> Column:
    """Null gives the empty text. HTML references are resolved, Unicode is brought to NFKC (if ``full``), then the text is
    tidied."""
    c = unescape(F.coalesce(c, F.lit("")))
    return tidy(nfkc(c) if full else c)


def bound(c: Column, f) -> Column:
    """f(c) with ``c`` computed once, however often f names it."""
    return F.get(F.transform(F.array(c), f), 0)


def capital(c: Column) -> Column:
    """A small letter at the beginning becomes its capital."""
    return bound(c, lambda x: F.when(x.rlike(r"^\p{IsLowercase}"), F.concat(capital_letter(F.substring(x, 1, 1)), F.substring(x, 2, 2**31 - 1))).otherwise(x))


def clean_instruction(c: Column) -> Column:
    return capital(clean_text(c))


def sentence_capitals(c: Column) -> Column:
    """ASCII letters after a sentence end and white space become capitals. The text is cut where a mark is put before
    them; a text that holds the mark itself is cut by looking behind each letter, which is slow."""
    mark = "\x01"

    def raised(x: Column) -> Column:
        marked = F.split(F.regexp_replace(x, r"([.!?]\s+)(?=[a-z])", "$1" + mark), mark)
        parts = F.when(F.contains(x, F.lit(mark)), F.split(x, r"(?<=[.!?]\s{1,64})(?=[a-z])")).otherwise(marked)
        return F.array_join(F.transform(parts, lambda p, i: F.when(i > 0, F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**31 - 1))).otherwise(p)), "")

    return bound(c, raised)


def clean_response(c: Column) -> Column:
    return sentence_capitals(capital(clean_text(c)))


def _cleaned(df: DataFrame) -> DataFrame:
    """``df`` with cleaned texts, and in ``_early`` why a row goes before pairs are compared."""
    missing = F.col("instruction").isNull() | F.col("response").isNull()
    early = F.when(F.col("_null"), "null").when((F.length("instruction") == 0) | (F.length("response") == 0), "empty")
    # one expression for both texts, however long it is
    df = df.withColumns({"_null": missing, "_texts": F.transform(F.array("instruction", "response"), lambda c: clean_text(c))})
    df = df.withColumns({"instruction": capital(F.get("_texts", 0)), "response": sentence_capitals(capital(F.get("_texts", 1)))})
    return df.withColumn("_early", early).drop("_null", "_texts")


def grouped(df: DataFrame) -> DataFrame:
    """reason ('null', 'empty', 'malformed' or 'kept'), n, row: one row for each different cleaned pair, and one each for all
    rows with a null and all with an empty text. ``row`` is the group's first row by row_id (null ids last, then by a hash
    of the row), ``n`` counts the group.

    The first rows are found by an aggregate over a digest of the pair that combines before the shuffle, so a very common
    pair meets in no task, and rows that share a row_id are rows of their own: nothing is joined by it."""
    rows = _cleaned(df)
    pair = F.sha2(F.concat(F.length("instruction").cast("string"), F.lit(" "), "instruction", "response"), 256)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = F.struct(F.col("row_id").isNull(), F.col("row_id"), F.xxhash64(row))
    groups = rows.groupBy("_early", F.when(F.col("_early").isNull(), pair).alias("_pair")).agg(F.count("*").alias("n"), F.min_by(row, first).alias("row"))
    letters = F.col("row.instruction").rlike(r"\p{L}") & F.col("row.response").rlike(r"\p{L}")
    malformed = (F.col("row.instruction") == F.col("row.response")) | ~letters
    return groups.select(F.when(F.col("_early").isNotNull(), F.col("_early")).when(malformed, "malformed").otherwise("kept").alias("reason"), "n", "row")


def _kept(groups: DataFrame) -> DataFrame:
    return groups.where("reason = 'kept'").select("row.*")


def clean(df: DataFrame) -> DataFrame:
    """The rows that stay, with cleaned texts: the first of each pair that has letters on both sides and is not a question
    answered by itself."""
    return _kept(grouped(df))


def _counters() -> list[Column]:
    n = lambda *reasons: F.coalesce(F.sum(F.when(F.col("reason").isin(*reasons), F.col("n"))), F.lit(0))
    groups = lambda *reasons: F.count_if(F.col("reason").isin(*reasons))
    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias("initial_rows"), n("null").alias("null_removed"), n("empty").alias("empty_removed"),
        (n("malformed", "kept") - groups("malformed", "kept")).alias("duplicate_removed"), groups("malformed").alias("malformed_removed"), groups("kept").alias("final_rows"),
        (F.coalesce(F.sum("n"), F.lit(0)) - groups("kept")).alias("total_removed"),
    ]


def removal_report(df: DataFrame) -> DataFrame:
    """One row: how many rows there were, went by each rule in its order, and stay."""
    return grouped(df).agg(*_counters())


def clean_counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``clean``, and the counters of ``removal_report`` as an observation that the first action on the rows fills: the
    table is cleaned once for both. Its ``get`` waits for that action."""
    counters = Observation(f"cleaning-{id(df)}")
    return _kept(grouped(df).observe(counters, *_counters())), counters
