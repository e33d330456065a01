"""Periodic runs of words, found by bit-parallel lags: bit planes of word numbers as big integers."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import frugal, slices

#: A run has at least so many words, and so many periods.
SHORTEST, PERIODS = 6, 4
#: Texts of a batch are searched for lags together, up to about so many bytes.
GROUP_BYTES = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, cut at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words, from 0 on."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _ranked(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def lags(texts: list[np.ndarray], shortest: int = SHORTEST, periods: int = PERIODS) -> list[list[int]]:
    """Of each sequence of word numbers the lags that a run may have as its smallest period, ascending.

    A run of smallest period q holds every stretch of m >= q of its words again q words on, and not sooner, so its stretches
    of the least power of two m >= q have their next occurrence at the distance q, at least max(shortest, periods * q) - m
    - q + 1 times. Stretches of doubled length are named by the names of their halves; one that stands once in its
    sequence is followed no further. A lag may be here without a run, never the other way round.
    """
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    found: list[list[int]] = [[] for _ in texts]
    total = int(size.sum())
    if not total:
        return found
    owner = np.repeat(np.arange(len(texts)), size)
    # a name for each place, of (sequence, word)
    place = np.arange(total)
    name = _ranked(owner << 32 | np.concatenate(texts))
    m = 1
    while len(place):
        # places of one name stand together, in order
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        gap = np.where(same, place[order][1:] - place[order][:-1], 0)
        near = (gap > m // 2) & (gap <= m) if m > 1 else gap == 1
        if near.any():
            q, doc = gap[near], owner[place[order][1:][near]]
            key, n = np.unique(doc << 32 | q, return_counts=True)
            doc, q = key >> 32, key & 0xFFFFFFFF
            enough = n >= np.maximum(shortest, periods * q) - m - q + 1
            for d, lag in zip(doc[enough].tolist(), q[enough].tolist()):
                found[d].append(lag)
        # doubled stretches: both halves stand more than once
        often = np.zeros(len(name), bool)
        often[order[1:]] |= same
        often[order[:-1]] |= same
        place, name = place[often], name[often]
        at = np.searchsorted(place, place + m)
        at[at == len(place)] = 0
        both = (place[at] == place + m) & (owner[place[at]] == owner[place]) if len(place) else np.zeros(0, bool)
        place, name = place[both], _ranked(name[both] << 32 | name[at[both]])
        m *= 2
    return found


def _bits(flags: np.ndarray) -> int:
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _places(bits: int, n: int) -> list[int]:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")).tolist()


def runs(ids: np.ndarray, candidates: list[int], shortest: int = SHORTEST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period, of a sequence of word numbers whose smallest periods are
    among the candidates (ascending).

    A bit plane holds one bit of every word's number. The planes, XORed with themselves shifted by a lag and ORed, have a zero
    where words so far apart are equal; ANDs of shifts that double keep the places where enough equal ones follow.
    """
    n = len(ids)
    planes = [_bits(ids >> b & 1) for b in range(int(ids.max()).bit_length())] if n else []
    found, seen = [], set()
    for q in candidates:
        need = max(shortest, periods * q) - q
        width = n - q
        if need > width:
            continue
        differ = 0
        for plane in planes:
            differ |= plane ^ plane >> q
        stretch = ~differ & (1 << width) - 1
        done = 1
        while done * 2 <= need:
            stretch &= stretch >> done
            done *= 2
        stretch &= stretch >> need - done
        if not stretch:
            continue
        for a, b in zip(_places(stretch & ~(stretch << 1), n), _places(stretch & ~(stretch >> 1), n)):
            whole = a, b - a + need + q
            # the same stretch under a smaller period is that period's run
            if whole not in seen:
                seen.add(whole)
                found.append((*whole, q))
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words stays: no run holds it behind that run's first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in found:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a tail made periodic where the checksum of the id says so."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def longest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)


def _searched(texts: list[list[bytes]]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    ids = [numbered(w) for w in texts]
    for words, numbers, candidates in zip(texts, ids, lags(ids)):
        yield words, runs(numbers, candidates) if candidates else []


def periodic(text: Column) -> Column:
    """struct<runs array<struct<start, length, period>>, collapsed string> of each whole text: its runs, and its words, one
    space between two, without those that a run holds behind its first period. A null text has no runs and collapses to
    the empty text."""

    @F.arrow_udf("runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    @frugal
    def search(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
        for part in parts:
            lists, collapsed = [], []
            for s in slices(part, GROUP_BYTES):
                for words, found in _searched([words_of(t) for t in s]):
                    lists.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    collapsed.append(_collapsed(words, found).decode("utf-8", "surrogatepass"))
            yield pa.StructArray.from_arrays([pa.array(lists, kind), pa.array(collapsed, pa.string())], names=["runs", "collapsed"])

    return search(text)


def _collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    return b" ".join([w for w, k in zip(words, kept(len(words), found).tolist()) if k] if found else words)


LONGS = ("n_runs", "start", "length", "period", "exponent_milli")
DIGEST = pa.struct([(k, pa.int64()) for k in LONGS] + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document, after a tenth of them had their tail made periodic (``repeated``): its id, n_runs, start, length, period
    and exponent_milli of the longest run, runs_sha256, collapsed_sha256.

    Null, empty and blank texts have no words, no runs and four nulls (the digests are those of no bytes). A null id
    leaves the text as it is. Rows are independent: repeated rows give repeated results; other columns are not looked at; an
    empty table gives an empty result. A narrow map: no shuffle; memory is bounded by a group of texts, or one longer text.
    """

    @F.arrow_udf("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
    @frugal
    def digest(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for ids, texts in parts:
            rows, keys = [], iter(ids.to_pylist())
            for s in slices(texts, GROUP_BYTES):
                for words, found in _searched([repeated(words_of(t), next(keys)) for t in s]):
                    lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
                    best = longest(found)
                    rows.append((len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines.encode()), sha(_collapsed(words, found))))
            columns = [*zip(*rows)] or [()] * len(DIGEST)
            yield pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(columns, DIGEST)], fields=list(DIGEST))

    rows = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(id_col), F.col(text_col)).alias("d"))
    return rows.select("doc_id", *[f"d.{f.name}" for f in DIGEST])
