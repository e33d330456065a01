"""HTML references and the Unicode compatibility form (NFKC) as column expressions; nothing leaves the JVM.

The tables are made on the driver from Python's public ones (``html``, ``unicodedata``) and travel as one literal string each;
the optimiser folds their parsing. Look-ups are by place in an array, or in a map of a few entries by first letter."""

from __future__ import annotations

import html
import html.entities
import sys
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Between the entries of a table.
SEP, PAIR = "\x01", "\x02"
LOST = "�"

# --- HTML references -------------------------------------------------------------------------------------------------

#: A reference, as far as it may reach; what is in between; an ampersand that begins none.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@lru_cache(maxsize=1)
def closed_names() -> dict[str, dict[str, str]]:
    """Names that end in a semicolon, without it, by their first letter."""
    out: dict[str, dict[str, str]] = {}
    for name, text in sorted(html.entities.html5.items()):
        if name.endswith(";"):
            out.setdefault(name[0], {})[name[:-1]] = text
    return out


@lru_cache(maxsize=1)
def open_names() -> dict[str, str]:
    """Names that need no semicolon, longest first: they also count as the beginning of a longer word."""
    return {n: html.entities.html5[n] for n in sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))}


@lru_cache(maxsize=1)
def odd_numbers() -> dict[int, str]:
    """Numbers that stand for something else than the character of that number: controls and what is no character."""
    candidates = [*range(0xA0), *range(0xFDD0, 0xFDF0), *(p << 16 | e for p in range(17) for e in (0xFFFE, 0xFFFF))]
    return {n: t for n in candidates if (t := html.unescape(f"&#{n};")) != chr(n)}


def _table(entries: dict) -> Column:
    """A map literal."""
    return F.str_to_map(F.lit(SEP.join(f"{k}{PAIR}{v}" for k, v in entries.items())), F.lit(SEP), F.lit(PAIR))


def character(number: Column) -> Column:
    """The character of a number below 0x110000."""
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _numbered(number: Column) -> Column:
    lost = number.isNull() | number.between(0xD800, 0xDFFF) | (number > sys.maxunicode)
    return F.when(lost, LOST).otherwise(F.coalesce(F.element_at(_table(odd_numbers()), number.cast("string")), character(number)))


def _named(token: Column) -> Column:
    name, letter = F.substring(token, 2, F.length(token) - 2), F.substring(token, 2, 1)
    closed = reduce(lambda c, x: c.when(letter == x[0], F.element_at(_table(x[1]), name)), closed_names().items(), F.when(letter == "", F.lit(None).cast("string")))
    begins = "&(" + "|".join(open_names()) + ")"
    start = F.regexp_extract(token, begins, 1)
    rest = F.substring(token, F.length(start) + 2, 2**31 - 1)
    opened = F.when(start != "", F.concat(F.element_at(_table(open_names()), start), rest)).otherwise(token)
    return F.coalesce(F.when(F.endswith(token, F.lit(";")), closed), opened)


def _resolved(token: Column) -> Column:
    digits = F.regexp_extract(token, r"^&#([0-9]+);?$", 1)
    hexadecimal = F.regexp_extract(token, r"^&#[xX]0*([0-9a-fA-F]*);?$", 1)
    # more than six digits are beyond the last character: null, like a decimal number that is no bigint
    by_hex = F.when(hexadecimal == "", F.lit(0).cast("bigint")).when(F.length(hexadecimal) <= 6, F.conv(hexadecimal, 16, 10).cast("bigint"))
    number = F.when(digits != "", digits.try_cast("bigint")).otherwise(by_hex)
    numeric = token.rlike("^&#([0-9]|[xX][0-9a-fA-F])")
    return F.when(~F.startswith(token, F.lit("&")) | (token == "&"), token).when(numeric, _numbered(number)).otherwise(_named(token))


def unescape(c: Column) -> Column:
    """Every HTML reference resolved in one pass, from the left: all names, the longest first, those that need none also
    without a semicolon, and numbers. Texts without an ampersand are left alone; null stays null."""
    tokens = F.regexp_extract_all(c, F.lit(rf"{REFERENCE}|[^&]+|&"), F.lit(0))
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(tokens, _resolved), "")).otherwise(c)


# --- capitals --------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def lone_capitals() -> dict[str, str]:
    """Letters that Java and Python write as several capitals, with the one that stands for each, or themselves: as in
    SQL, one letter stays one letter."""
    several = [x for n in range(0x80, sys.maxunicode + 1) if not 0xD800 <= n < 0xE000 and len((x := chr(n)).upper()) > 1]
    return {x: x.title() if len(x.title()) == 1 else x for x in several} | {"ß": "ẞ"}


def capital_letter(letter: Column) -> Column:
    """The capital of one letter, always one letter."""
    return F.coalesce(F.element_at(_table(lone_capitals()), letter), F.upper(letter))


# --- NFKC ------------------------------------------------------------------------------------------------------------

#: Fixed values of the Hangul arithmetic: first syllable, first L, V and T jamo, how many V and T.
S0, L0, V0, T0, NV, NT = 0xAC00, 0x1100, 0x1161, 0x11A7, 21, 28
PAGE = 256


@lru_cache(maxsize=1)
def joiners() -> frozenset[str]:
    """Characters that NFKC may move, or join to one before them, and those that turn into such."""
    every = (chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    second = {b for _, b in compositions()} | {chr(c) for c in (*range(V0, V0 + NV), *range(T0 + 1, T0 + NT))}
    marks = lambda c: unicodedata.combining(c) or c in second
    return frozenset(c for c in every if marks(c) or marks(unicodedata.normalize("NFKD", c)[0]))


@lru_cache(maxsize=1)
def mapped() -> dict[str, str]:
    """Characters that become something else wherever no joiner follows."""
    every = (chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    return {c: t for c in every if c not in joiners() and (t := unicodedata.normalize("NFKC", c)) != c}


@lru_cache(maxsize=1)
def compositions() -> dict[tuple[str, str], str]:
    """(first, second) -> the character that they make, beside Hangul."""
    out = {}
    for n in range(0xC0, sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(n)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            a, b = (chr(int(p, 16)) for p in parts)
            if unicodedata.normalize("NFC", a + b) == chr(n):
                out[a, b] = chr(n)
    return out


def _class(characters) -> str:
    """The characters as ranges of a regular expression."""
    points, ranges = sorted(map(ord, characters)), []
    for p in points:
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


def _either(characters) -> tuple[str, str]:
    """A class of these characters and one of all others. Both look at ASCII first, as the ranges are many."""
    ranges = _class(characters)
    return rf"[[^\x00-\x7F]&&[{ranges}]]", rf"[\x00-\x7F[^{ranges}]]"


@lru_cache(maxsize=1)
def _classes_of_characters() -> tuple[str, str, str, str, str]:
    """Joiners, all others; mapped ones; either of both, neither."""
    return *_either(joiners()), _either(mapped())[0], *_either(joiners() | mapped().keys())


class _Pages:
    """A table by code point in two arrays: the page of each block of 256, and the pages one behind the other; page 0 is
    empty. Places beyond both have no entry."""

    def __init__(self, entries: dict[int, str]):
        used = sorted({c // PAGE for c in entries})
        number = {p: i + 1 for i, p in enumerate(used)}
        self.pages = [number.get(p, 0) for p in range(used[-1] + 1)]
        self.cells = [""] * PAGE + [entries.get(p * PAGE + i, "") for p in used for i in range(PAGE)]

    def get(self, point: Column) -> Column:
        """The entry of a code point; the empty text where there is none."""
        pages, cells = (F.split(F.lit(SEP.join(map(str, x))), SEP) for x in (self.pages, self.cells))
        page = F.coalesce(F.get(pages, (point / PAGE).cast("int")).cast("int"), F.lit(0))
        return F.get(cells, page * PAGE + point % PAGE)


@lru_cache(maxsize=1)
def _decompositions() -> _Pages:
    entries = {}
    for c in joiners() | mapped().keys():
        whole = unicodedata.normalize("NFKD", c)
        if whole != c:
            entries[ord(c)] = whole
    # a safe character keeps its own parts until a mark behind it may join one of them
    for n in range(0xC0, 0x3100):
        if unicodedata.decomposition(chr(n)) and n not in entries:
            entries[n] = unicodedata.normalize("NFKD", chr(n))
    for first in {a for a, _ in compositions()}:
        if unicodedata.normalize("NFKD", first) != first:
            entries[ord(first)] = unicodedata.normalize("NFKD", first)
    return _Pages(entries)


@lru_cache(maxsize=1)
def _replacements() -> _Pages:
    return _Pages({ord(c): t for c, t in mapped().items()})


@lru_cache(maxsize=1)
def _classes() -> _Pages:
    return _Pages({n: str(k) for n in range(sys.maxunicode + 1) if (k := unicodedata.combining(chr(n)))})


def _let(value: Column, body) -> Column:
    """body(value) with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _joined(first: Column, second: Column) -> Column:
    """The character that two make, or null."""
    a, b = F.ascii(first), F.ascii(second)
    hangul = (
        F.when(a.between(L0, L0 + 18) & b.between(V0, V0 + NV - 1), character(F.lit(S0) + ((a - L0) * NV + (b - V0)) * NT))
        .when(a.between(S0, S0 + 11_171) & ((a - S0) % NT == 0) & b.between(T0 + 1, T0 + NT - 1), character(a + b - T0))
    )
    # by the second character, of which there are few: the firsts and, place by place, what they make
    by_second: dict[str, list[tuple[str, str]]] = {}
    for (x, y), made in compositions().items():
        by_second.setdefault(y, []).append((x, made))
    firsts = F.element_at(_table({y: "".join(x for x, _ in v) for y, v in by_second.items()}), second)
    made = F.element_at(_table({y: "".join(m for _, m in v) for y, v in by_second.items()}), second)
    place = F.call_function("locate", first, firsts)
    return F.when(b < 0x300, F.lit(None).cast("string")).otherwise(F.coalesce(hangul, F.when((first != "") & (place > 0), F.call_function("substring", made, place, F.lit(1)))))


def _normal_pair(pair: Column) -> Column:
    """Of a character of class 0 and a joiner, neither of which has parts: what they make, or both. Null for other pairs."""
    first, second = F.substring(pair, 1, 1), F.substring(pair, 2, 1)
    whole = lambda ch: F.coalesce(_decompositions().get(F.ascii(ch)), F.lit("")) == ""
    starter = F.coalesce(_classes().get(F.ascii(first)), F.lit("")) == ""
    return F.when((F.length(pair) == 2) & starter & whole(first) & whole(second), F.coalesce(_joined(first, second), pair))


def _normal_segment(segment: Column) -> Column:
    """Decomposed, put in order, composed."""
    whole = lambda ch: _let(_decompositions().get(F.ascii(ch)), lambda d: F.when(F.coalesce(d, F.lit("")) == "", ch).otherwise(d))
    spread = F.split(F.array_join(F.transform(F.split(segment, ""), whole), ""), "")
    rank = lambda ch: F.coalesce(F.nullif(_classes().get(F.ascii(ch)), F.lit("")).cast("int"), F.lit(0))
    # (run, class, place, character): a run begins with each character of class 0
    start = F.struct(F.lit(0).alias("run"), F.expr("CAST(array() AS array<struct<run:int,rank:int,place:int,ch:string>>)").alias("out"))

    def step(acc: Column, ch: Column) -> Column:
        def with_rank(k: Column) -> Column:
            run = acc["run"] + F.when(k == 0, 1).otherwise(0)
            item = F.struct(run.alias("run"), k.alias("rank"), F.size(acc["out"]).alias("place"), ch.alias("ch"))
            return F.struct(run.alias("run"), F.concat(acc["out"], F.array(item)).alias("out"))

        return _let(rank(ch), with_rank)

    ordered = F.array_sort(F.aggregate(spread, start, step)["out"])
    empty = F.lit("")
    begin = F.struct(empty.alias("done"), empty.alias("starter"), empty.alias("tail"), F.lit(0).alias("last"))

    def compose(acc: Column, x: Column) -> Column:
        ch, k = x["ch"], x["rank"]
        free = (acc["starter"] != "") & ((acc["tail"] == "") | ((acc["last"] < k) & (acc["last"] > 0)))
        state = lambda done, starter, tail, last: F.struct(done.alias("done"), starter.alias("starter"), tail.alias("tail"), last.alias("last"))

        def with_pair(pair: Column) -> Column:
            return (
                F.when(pair.isNotNull(), state(acc["done"], pair, acc["tail"], acc["last"]))
                .when(k == 0, state(F.concat(acc["done"], acc["starter"], acc["tail"]), ch, empty, F.lit(0)))
                .when(acc["starter"] == "", state(F.concat(acc["done"], ch), empty, empty, F.lit(0)))
                .otherwise(state(acc["done"], acc["starter"], F.concat(acc["tail"], ch), k))
            )

        return _let(F.when(free, _joined(acc["starter"], ch)), with_pair)

    return F.aggregate(ordered, begin, compose, lambda acc: F.concat(acc["done"], acc["starter"], acc["tail"]))


def nfkc(c: Column) -> Column:
    """The Unicode compatibility form; null stays null.

    A text is cut into segments: a character with the joiners behind it, which is decomposed, put in order and composed; a
    mapped character, which is looked up; and stretches of all others, which stay."""
    joiner, no_joiner, one_mapped, odd, safe = _classes_of_characters()
    replaced = _replacements().get
    # no joiner stands below U+0300, and a mapped character without one is a token of its own
    plain = lambda t: (F.length(t) > 1) & (F.ascii(t) < 0x300) & (F.ascii(F.substring(t, 2, 1)) < 0x300)
    lone = lambda t: F.when(F.length(t) == 1, F.nullif(replaced(F.ascii(t)), F.lit("")))
    worked = lambda t: F.when(plain(t) | ~t.rlike(rf"(?s)^{odd}|^.{joiner}"), t).otherwise(F.coalesce(lone(t), _normal_pair(t), _normal_segment(t)))

    def normal(text: Column) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(rf"(?s){no_joiner}?{joiner}+|{one_mapped}|{safe}+(?!{joiner})"), F.lit(0))
        return F.when(text.rlike(odd), F.array_join(F.transform(tokens, worked), "")).otherwise(text)

    return _let(c, normal)
