"""Augmentation: one row becomes four. All choices depend on the row id alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import lexicons as L
from parley.functions.text import first_lower, first_upper, one_of, pick

TYPO_PER_10000 = 800


def short_form() -> Column:
    """One of four templates over the intent, then the query's placeholders."""
    intent = F.translate(F.coalesce(F.col("intent"), F.lit("nan")), "_", " ")
    forms = [F.concat(F.lit(a), intent, F.lit(b)) for a, b in (t.split("{}") for t in L.SHORT_TEMPLATES)]
    marks = F.regexp_extract_all("instruction", F.lit(r"(\{\{.*?\}\})"), 1)
    return first_upper(F.concat(one_of(forms, pick("row_id", "short", len(forms))), F.when(F.size(marks) > 0, F.concat(F.lit(" "), F.array_join(marks, " "))).otherwise("")))


def long_form() -> Column:
    return F.concat(one_of(L.LONG_PREFIXES, pick("row_id", "prefix", len(L.LONG_PREFIXES))), first_lower("instruction"), one_of(L.LONG_SUFFIXES, pick("row_id", "suffix", len(L.LONG_SUFFIXES))))


def paraphrase() -> Column:
    """Whole words are replaced one rule after the other; an unchanged query gets a polite word."""
    c = F.col("instruction")
    for word, by in L.SYNONYMS:
        c = F.regexp_replace(c, rf"(?iuU)\b{word}\b", by)
    return F.when(c == F.col("instruction"), F.concat(F.lit("Please, "), first_lower("instruction"))).otherwise(c)


def rewritten_response() -> Column:
    """The first known opening that the response starts with gives way to a new one."""
    new = one_of(L.NEW_OPENINGS, pick("row_id", "opening", len(L.NEW_OPENINGS)))
    out = F.col("response")
    for opening in reversed(L.OPENINGS):
        out = F.when(F.startswith("response", F.lit(opening)), F.concat(new, F.substring("response", len(opening) + 1, 2**31 - 1))).otherwise(out)
    return out


def typos() -> Column:
    """Each character of a word without braces is changed with a small chance: replaced by a neighbouring key, doubled,
    swapped with the next one, or left out. Texts under five characters stay. A character after an effective swap is
    part of it; a swap right behind a drawn swap has no effect. Draws belong to the original positions."""
    keys = F.create_map(*[F.lit(x) for kv in L.ADJACENT_KEYS.items() for x in kv])
    parts = F.filter(F.split("instruction", r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")

    def changed(w: Column, j: Column) -> Column:
        chars = F.split(w, "")
        salt = lambda kind, i: F.concat_ws("|", F.lit(kind), j.cast("string"), i.cast("string"))
        drawn = lambda i: pick("row_id", salt("typo", i), 10_000) < TYPO_PER_10000
        kind = lambda i: pick("row_id", salt("kind", i), 4)
        swap = lambda i: drawn(i) & (kind(i) == 2)

        def char(c: Column, i: Column) -> Column:
            near = F.element_at(keys, F.lower(c))
            key = F.substr(near, (pick("row_id", salt("key", i), F.length(near)) + 1).cast("int"), F.lit(1))
            other = F.when(near.isNull(), c).when(c == F.lower(c), key).otherwise(F.upper(key))
            real = lambda k: swap(k) & ~((k > 0) & swap(k - 1))
            after = F.get(chars, i + 1)
            mine = F.when(kind(i) == 0, other).when(kind(i) == 1, F.concat(c, c)).when(kind(i) == 3, "")
            mine = mine.otherwise(F.when(real(i) & after.isNotNull(), F.concat(after, c)).otherwise(c))
            return F.when((i > 0) & real(i - 1), "").when(drawn(i), mine).otherwise(c)

        return F.when(w.rlike("[{}]"), w).otherwise(F.array_join(F.transform(chars, char), ""))

    text = F.array_join(F.filter(F.transform(parts, changed), lambda w: w != ""), " ")
    return F.when(F.length("instruction") < 5, F.col("instruction")).otherwise(text)


def augment(df: DataFrame, position: str = "_position", fraction: float = 1.0) -> DataFrame:
    """Originals and three variants of each row, by one explode: variant_no, is_augmented, augmentation_type are added.

    Even positions get a short form, odd ones a long form. Give a 0-based ``position`` column; without one it is the
    number of the row in row_id order, counted in ranges (see ``plans.ranks``). ``fraction`` takes that share of the rows
    as parents of variants. The rows' scores and labels go along unchanged.
    """
    if position not in df.columns:
        from parley.plans.ranks import with_rank

        df = with_rank(df, ["row_id"], position)
    even = F.col(position) % 2 == 0
    variant = lambda n, kind, i, r: F.struct(F.lit(n).alias("no"), (kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"), i.alias("i"), r.alias("r"))
    i, r = F.col("instruction"), F.col("response")
    original = variant(0, "original", i, r)
    all_four = F.array(
        original, variant(1, "typos", typos(), r), variant(2, F.when(even, "short_form").otherwise("long_form"), F.when(even, short_form()).otherwise(long_form()), r),
        variant(3, "paraphrase_rewrite", paraphrase(), rewritten_response()),
    )
    rows = all_four if fraction >= 1 else F.when(pick("row_id", "sample", 1_000_000) < int(fraction * 1_000_000), all_four).otherwise(F.array(original))
    out = df.withColumn("_v", F.explode(rows)).withColumns({
        "instruction": F.col("_v.i"), "response": F.col("_v.r"), "variant_no": F.col("_v.no"), "is_augmented": F.col("_v.no") > 0, "augmentation_type": F.col("_v.kind"),
    })
    return out.drop("_v", position)
