"""Validation of rows and of chat formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANK = r"(?U)^[\s\x1c-\x1f]*\z"


def row_problem() -> Column:
    """The first rule that a row breaks, or null."""
    i, r = F.col("instruction"), F.col("response")
    return F.when(i.isNull() | r.isNull(), "missing").when(i.rlike(BLANK) | r.rlike(BLANK), "empty").when(~(F.is_valid_utf8(i) & F.is_valid_utf8(r)), "encoding")


def validate_rows(df: DataFrame, most_query: int = 1000, most_response: int = 3000) -> DataFrame:
    """One row of counters. Length is counted among rows that pass and does not make the table invalid."""
    p = row_problem()
    n = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    return df.agg(
        F.count("*").alias("n_rows"), n(p == "missing").alias("missing_fields"), n(p == "empty").alias("empty_fields"), n(p == "encoding").alias("encoding_errors"),
        n(p.isNull() & (F.length("instruction") > most_query)).alias("long_queries"), n(p.isNull() & (F.length("response") > most_response)).alias("long_responses"),
        (F.count_if(p.isNotNull()) == 0).alias("is_valid"),
    )


def invalid_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("problem", row_problem()).where("problem is not null").select("row_id", "problem")


def alpaca_valid(c: Column) -> Column:
    return F.coalesce(c["instruction"].isNotNull() & c["input"].isNotNull() & c["output"].isNotNull(), F.lit(False))


def _map(v: Column) -> Column:
    """The members of a variant object; null if it is anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _first(*steps: tuple[str, Column], place: Column | None = None) -> Column:
    """The first rule that is broken, as struct<rule, place>; null if none is. Conditions that are null do not hold."""
    at = F.lit(None).cast("int") if place is None else place
    return F.coalesce(*[F.when(broken, F.struct(F.lit(rule).alias("rule"), at.alias("place"))) for rule, broken in steps])


def _lacks(members: Column, *keys: str) -> list[tuple[str, Column]]:
    return [(k, ~F.map_contains_key(members, k)) for k in keys]


def _in_order(elements: Column, rules) -> Column:
    """The first element that breaks a rule, with its place; ``rules`` takes an element's members, the element and the place."""
    return F.get(F.filter(F.transform(elements, lambda v, i: _first(*rules(_map(v), v, i), place=i)), lambda e: e.isNotNull()), 0)


def alpaca_error(v: Column) -> Column:
    """An object with the three keys, whatever their values."""
    return _first(("json", v.isNull()), ("object", _map(v).isNull()), *_lacks(_map(v), "instruction", "input", "output"))


def chatml_error(v: Column) -> Column:
    """An array of a user's and an assistant's message, each with content."""
    turns = F.try_variant_get(v, "$", "array<variant>")
    expected = lambda i: F.when(i == 0, "user").otherwise("assistant")
    role = lambda m: F.coalesce(F.try_variant_get(m, "$.role", "string"), F.lit(""))
    each = _in_order(turns, lambda held, m, i: [("object", held.isNull()), ("role", role(m) != expected(i)), *_lacks(held, "content")])
    return F.coalesce(_first(("json", v.isNull()), ("array", turns.isNull()), ("size", F.size(turns) != 2)), each)


def messages_error(v: Column) -> Column:
    """An object with at least two messages, each with role and content; other keys are free."""
    turns = F.try_variant_get(v, "$.messages", "array<variant>")
    each = _in_order(turns, lambda held, m, i: [("object", held.isNull()), *_lacks(held, "role", "content")])
    return F.coalesce(_first(("json", v.isNull()), ("object", _map(v).isNull()), *_lacks(_map(v), "messages"), ("array", turns.isNull()), ("size", F.size(turns) < 2)), each)


JSON_ERRORS = {"alpaca": alpaca_error, "chatml": chatml_error, "messages": messages_error}


def json_error(text: Column, kind: str) -> Column:
    """The first rule of a format that a JSON text of any shape breaks: struct<rule, place>, null for a valid one. ``rule`` is
    json (null, no JSON, or a key twice in one object), object, array, size, or the key that is missing or wrong;
    ``place`` is the message's number from 0, null where the record as a whole is at fault. A text is parsed once."""
    # the parser stops behind a value: only as an array's first element, before a mark that the text cannot hold, is it all of the text
    mark = F.md5(text)
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    whole = (F.size(F.try_variant_get(both, "$", "array<variant>")) == 2) & (F.try_variant_get(both, "$[1]", "string") == mark)
    parsed = F.when(whole, F.try_variant_get(both, "$[0]", "variant"))
    return F.get(F.transform(F.array(parsed), JSON_ERRORS[kind]), 0)


#: Of JSON texts, whether they keep a format.
JSON_RULES = {kind: (lambda text, kind=kind: json_error(text, kind).isNull()) for kind in JSON_ERRORS}


def json_errors(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """rule, place, n: how often each rule is the first that a text breaks."""
    return lines.select(json_error(F.col(column), kind).alias("e")).where("e is not null").groupBy("e.rule", "e.place").agg(F.count("*").alias("n"))


# The byte sequences of UTF-8 beside ASCII, longest first, as Latin-1 characters.
SEQUENCES = (
    (4, r"\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2}"),
    (3, r"\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"),
    (2, r"[\xC2-\xDF][\x80-\xBF]"),
)


def encoding_error(data: Column) -> Column:
    """Of bytes, the first that is no UTF-8: struct<place, reason>, null if all are. ``place`` counts bytes from 0; ``reason`` is
    stray (a byte that goes on without a beginning), impossible (a byte that UTF-8 has not), surrogate, overlong, beyond
    (the last character) or truncated.

    Leading bytes and those that go on are different, so a whole sequence is one wherever it stands: what is left when
    these are blanked out is wrong, and its first byte is where a decoder stops."""

    def located(latin: Column) -> Column:
        blank = reduce(lambda c, x: F.regexp_replace(c, x[1], "x" * x[0]), SEQUENCES, latin)
        return F.get(F.transform(F.array(F.regexp_instr(blank, F.lit(r"[\x80-\xFF]"))), lambda at: reason(latin, at)), 0)

    def reason(latin: Column, at: Column) -> Column:
        byte, after = F.ascii(F.substr(latin, at, F.lit(1))), F.ascii(F.substr(latin, at + 1, F.lit(1)))
        why = (
            F.when(byte < 0xC0, "stray").when((byte < 0xC2) | (byte > 0xF4), "impossible").when((byte == 0xED) & after.between(0xA0, 0xBF), "surrogate")
            .when(((byte == 0xE0) & after.between(0x80, 0x9F)) | ((byte == 0xF0) & after.between(0x80, 0x8F)), "overlong").when((byte == 0xF4) & after.between(0x90, 0xBF), "beyond")
            .otherwise("truncated")
        )
        return F.when(at > 0, F.struct((at - 1).alias("place"), why.alias("reason")))

    return F.get(F.transform(F.array(F.decode(data, "ISO-8859-1")), located), 0)


def badly_encoded_lines(spark: SparkSession, path: str) -> DataFrame:
    """place, reason, line of the lines of text files that are no UTF-8; ``line`` has the bytes. Files are cut at line breaks and
    read by several tasks."""
    lines = spark.read.text(path).select(F.col("value").cast("binary").alias("line"))
    return lines.select(encoding_error(F.col("line")).alias("e"), "line").where("e is not null").select("e.place", "e.reason", "line")


def encoding_counts(df: DataFrame, column: str) -> DataFrame:
    """reason, n of the rows whose bytes are no UTF-8."""
    return df.select(encoding_error(F.col(column)).alias("e")).where("e is not null").groupBy("e.reason").agg(F.count("*").alias("n"))


def validate_json(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """One row for a table of JSON texts of one format: n_rows, errors, is_valid."""
    bad = F.count_if(~JSON_RULES[kind](F.col(column)))
    return lines.agg(F.count("*").alias("n_rows"), bad.alias("errors"), (bad == 0).alias("is_valid"))


def overall(rows: DataFrame, formats: dict[str, DataFrame]) -> DataFrame:
    """The four verdicts, of the rows and of each format, and whether all hold: part, is_valid."""
    out = rows.select(F.lit("rows").alias("part"), "is_valid")
    for kind, df in formats.items():
        out = out.union(df.select(F.lit(kind), "is_valid"))
    return out.union(out.agg(F.lit("overall"), F.bool_and("is_valid")))


def chatml_valid(c: Column) -> Column:
    two = (F.size(c) == 2) & (F.get(c, 0)["role"] == "user") & (F.get(c, 1)["role"] == "assistant")
    return F.coalesce(two & F.forall(c, lambda m: m["content"].isNotNull()), F.lit(False))


def messages_valid(c: Column) -> Column:
    return F.coalesce((F.size(c) >= 2) & F.forall(c, lambda m: m["role"].isNotNull() & m["content"].isNotNull()), F.lit(False))


def validate_formats(df: DataFrame) -> DataFrame:
    """One row: errors of each format over columns alpaca, chatml, messages, and the verdict."""
    bad = {k: F.count_if(~f(F.col(c))) for k, c, f in (("alpaca_errors", "alpaca", alpaca_valid), ("chatml_errors", "chatml", chatml_valid), ("messages_errors", "messages", messages_valid))}
    return df.agg(F.count("*").alias("n_rows"), *[v.alias(k) for k, v in bad.items()], (sum(bad.values(), F.lit(0)) == 0).alias("is_valid"))
