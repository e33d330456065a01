"""References and NFKC as column expressions, against Python's own."""

import html
import html.entities
import random
import sys
import unicodedata

from pyspark.sql import functions as F

from parley.functions import unicode as U


def both(spark, texts, f):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    return [r.x for r in rows.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def test_every_name(spark):
    """All names, with and without their semicolon, alone and before other text."""
    names = sorted({n.rstrip(";") for n in html.entities.html5})
    texts = [f"a&{n}{tail}" for n in names for tail in (";", "", "x;", " b")]
    assert both(spark, texts, U.unescape) == [html.unescape(t) for t in texts]


def test_numbers_and_odd_references(spark):
    rng = random.Random(7)
    numbers = [*range(0, 0x200), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 10**30, *(rng.randrange(0x110000) for _ in range(300))]
    texts = [f(n) for n in numbers for f in ("&#{};".format, "&#{}z".format, "&#x{:x};".format, "x&#X{:X}&amp".format, "&#x000{:x}.".format)]
    texts += ["&", "&&", "&;", "&#;", "&#x;", "&#xg;", "&amp;lt;", "&ampamp;", "&notit;", "&notin;", "&" + "a" * 40 + ";", "&\t;", "a & b", "&#38;#38;", None, "", "&é;", "&lt\n&gt", "&#٣;"]
    alphabet = ["&", "#", "x", ";", "amp", "lt", "not", "in", "1", "f", " ", "é", "🙂", "\n", "copy"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    assert both(spark, texts, U.unescape) == [t and html.unescape(t) for t in texts]


def test_every_character(spark):
    """NFKC of every code point, alone and behind a letter that marks may join."""
    every = [chr(n) for n in range(1, sys.maxunicode + 1) if not 0xD800 <= n < 0xE000]
    odd = U.joiners() | U.mapped().keys()
    assert all(unicodedata.normalize("NFKC", f"a{c}b") == f"a{c}b" for c in every if c not in odd)
    texts = [c for c in every if c in odd] + ["e" + c for c in every if c in odd] + [c + "\u0301" for c in every if c in odd or ord(c) < 0x250] + ["".join(every[i : i + 5000]) for i in range(0, 60_000, 5000)]
    assert both(spark, texts, U.nfkc) == [unicodedata.normalize("NFKC", t) for t in texts]


def test_random_strings(spark):
    """Marks in any order, Hangul jamo and syllables, ligatures, squared words, letters with several marks."""
    rng = random.Random(8)
    marks = [chr(n) for n in range(0x300, 0x370)] + list("़়゙゚ֱ᪽")
    jamo = [chr(n) for n in (*range(0x1100, 0x1113), *range(0x1161, 0x1176), *range(0x11A7, 0x11C3), 0xAC00, 0xAC01, 0xD788)]
    other = list("aeouAEOUsd ΑαΩ\n1") + ["ﬁ", "㌔", "…", "½", "Å", "ǖ", "ḗ", "ệ", "か", "ハ", "ｶ", "ﾞ", "क", "ে", "া", "ﷺ", "①", "豈", "丽", "🙂", "­", "ཱི"]
    pick = lambda: rng.choice(rng.choice((marks, marks, jamo, other, other)))
    texts = ["".join(pick() for _ in range(rng.randint(0, 16))) for _ in range(4000)] + [None, "", "plain", "e" + "́̂" * 150]
    assert both(spark, texts, U.nfkc) == [t and unicodedata.normalize("NFKC", t) for t in texts]
