"""Benchmark decontamination: CGK embeddings of item-sized windows, bit-sampling LSH, exact edit verification."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import frugal, slices, stored

_WORD = re.compile(r"\w+")
#: Least word-edit similarity of a leak; embedding steps that are sampled from; sampled steps a table; tables; seed.
SIMILARITY, STEPS, BITS, TABLES, SEED = 0.8, 20, 10, 12, 7
#: Items of fewer words are searched by their words in common with every stretch, without the walk.
SHORT_WORDS = 22
#: Benchmark words that one pass over the documents looks for; more items are looked for in further passes. The index of
#: a block, which is broadcast, takes about 400 bytes a word.
BLOCK_WORDS = 200_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def edit_span(item: np.ndarray, words: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, start, stop) of the stretch of ``words`` with the least edit distance to ``item``, if that is at most
    ``most``: all of the item is used, the stretch begins and ends anywhere. Of equal ones, the leftmost end."""
    n = len(words)
    at = np.arange(n + 1)
    row, begin = np.zeros(n + 1, np.int64), at.copy()
    for i, w in enumerate(item):
        down = np.append(i + 1, np.minimum(row[1:] + 1, row[:-1] + (words != w)))
        source = np.append(0, np.where(row[:-1] + (words != w) <= row[1:] + 1, begin[:-1], begin[1:]))
        # a word that the item lacks costs one: least of down[k] + (j - k) over k up to j
        slope = down - at
        low = np.minimum.accumulate(slope)
        k = np.maximum.accumulate(np.where(slope == low, at, 0)) if n else at
        k = np.where(slope == low, at, k)
        row, begin = low + at, source[k]
    end = int(row.argmin())
    return (int(row[end]), int(begin[end]), end) if row[end] <= most else None


class LeakIndex:
    """LSH tables of the windows of a block of benchmark items.

    Words are symbols: those of the items have numbers from 1, all others are 0 (they match no item word either way).
    The CGK walk reads a window from its first word: step j gives the symbol under the pointer, and a random bit of
    (j, symbol) says whether the pointer moves on. Equal stretches give equal walks, and a walk that meets an edit may
    fall into step again. Each table samples a few of the steps. An item enters with every window start in it, so a
    clean stretch anywhere in a copy can be hit; document windows start at every word.
    """

    def __init__(self, items: list[tuple[int, list[str]]], similarity: float = SIMILARITY, tables: int = TABLES, bits: int = BITS, steps: int = STEPS, seed: int = SEED):
        self.similarity, self.steps = similarity, steps
        self.ids = [i for i, _ in items]
        self.symbol: dict[str, int] = {}
        for _, ws in items:
            for w in ws:
                self.symbol.setdefault(w, len(self.symbol) + 1)
        self.items = [np.array([self.symbol[w] for w in ws], np.int32) for _, ws in items]
        self.most = [int(round((1 - similarity) * len(ws) * 1_000)) // 1_000 for _, ws in items]
        counts = [np.unique(x, return_counts=True) for x in self.items]
        self.distinct, self.repeats = [c[0] for c in counts], [c[1] for c in counts]
        self.size = len(self.symbol) + 1
        rng = np.random.default_rng(seed)
        # the bit of (step, symbol), from the word itself, so that it is the same for any set of items
        self.bit = np.zeros((steps, len(self.symbol) + 1), np.int32)
        for w, k in self.symbol.items():
            h = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), seed=seed)
            self.bit[:, k] = [h >> j & 1 for j in range(steps)]
        self.bit[:, 0] = np.arange(steps) & 1
        self.samples = self._samples(rng, tables, min(bits, steps), steps)
        #: short items: a stretch with at most the item's edits keeps one of any edits + 1 words unchanged, so those
        #: words of the item that are rarest among the items, and where they stand, lead to every copy
        self.short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        often = np.bincount(np.concatenate([np.zeros(0, np.int64), *self.items]), minlength=self.size)
        places: list[tuple[int, int]] = []
        walks: list[np.ndarray] = [np.zeros((0, steps), np.int32)]
        for k, x in enumerate(self.items):
            if len(x) < max(SHORT_WORDS, steps // 2):
                for at in np.argsort(often[x], kind="stable")[: self.most[k] + 1].tolist():
                    self.short[int(x[at])].append((k, at))
                continue
            starts = np.arange(max(1, len(x) - steps // 2))
            places += [(k, s) for s in starts.tolist()]
            walks.append(self._walk(x, starts))
        self.leads = np.zeros(self.size, bool)
        self.leads[list(self.short)] = True
        self.places = np.array(places, np.int64).reshape(-1, 2)
        walk = np.concatenate(walks)
        #: per table: sorted keys and the windows that have them; per sampled step, which symbols occur there, so that
        #: document windows without one are dropped before the next step
        self.tables, self.seen = [], []
        for sample in self.samples:
            keys = self._keys(walk[:, sample])
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], order))
            flags = np.zeros((len(sample), len(self.symbol) + 1), bool)
            for b, j in enumerate(sample):
                flags[b, walk[:, j]] = True
            self.seen.append(flags)

    @staticmethod
    def _keys(sampled: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sampled), np.uint64)
        for b in range(sampled.shape[1]):
            out = (out ^ sampled[:, b].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return out

    @staticmethod
    def _samples(rng, tables: int, bits: int, steps: int) -> list[np.ndarray]:
        """The first table takes the first steps; the others sample."""
        out = {tuple(range(bits))}
        tried = 0
        while len(out) < tables and tried < 50 * tables:
            out.add(tuple(sorted(rng.choice(steps, bits, replace=False).tolist())))
            tried += 1
        return [np.array(s) for s in sorted(out)]

    def _walk(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        padded = np.append(x, np.zeros(self.steps, np.int32))
        at, out = starts.copy(), np.zeros((len(starts), self.steps), np.int32)
        for j in range(self.steps):
            out[:, j] = padded[at]
            at += self.bit[j, out[:, j]]
        return out

    def _likely(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Those rows (short item, start) whose surroundings hold enough of the item's words, by counts over sums."""
        keep = np.zeros(len(rows), bool)
        for k in np.unique(rows[:, 0]).tolist():
            own = np.flatnonzero(rows[:, 0] == k)
            low = np.clip(rows[own, 1] - 2 * self.most[k], 0, len(x))
            high = np.clip(rows[own, 1] + len(self.items[k]) + 3 * self.most[k], 0, len(x))
            width = int((high - low).max())
            at = low[:, None] + np.arange(width)
            near = np.where(at < high[:, None], x[np.minimum(at, len(x) - 1)], 0)
            shared = sum(np.minimum((near == w).sum(1), n) for w, n in zip(self.distinct[k].tolist(), self.repeats[k].tolist()))
            keep[own] = shared >= len(self.items[k]) - self.most[k]
        return rows[keep]

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Rows (item, where the item would begin in ``x``) of windows that meet an item's window in some table; sorted."""
        found = [np.zeros((0, 2), np.int64)]
        if self.short:
            at = np.flatnonzero(self.leads[x])
            rows = [(k, p - i) for p, w in zip(at.tolist(), x[at].tolist()) for k, i in self.short[w]]
            found.append(self._likely(x, np.unique(np.array(rows, np.int64).reshape(-1, 2), axis=0)))
        walk = self._walk(x, np.arange(len(x)))
        for sample, (keys, order), seen in zip(self.samples, self.tables, self.seen):
            live = np.flatnonzero(seen[0][walk[:, sample[0]]])
            for b, j in enumerate(sample[1:], 1):
                live = live[seen[b][walk[live, j]]]
            if not len(live) or not len(keys):
                continue
            own = self._keys(walk[np.ix_(live, sample)])
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            n = high - low
            which = np.repeat(np.arange(len(live)), n)
            at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
            found.append(np.column_stack([self.places[at, 0], live[which] - self.places[at, 1]]))
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, docs: list[list[str]]) -> list[list[tuple[int, int, int, int, int]]]:
        """Per document: (item id, start, stop, distance, item words), one per item with a verified stretch, the best one."""
        out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in docs]
        sizes = np.array([len(ws) + self.steps for ws in docs], np.int64)
        begins = np.cumsum(sizes) - sizes
        if not len(docs):
            return out
        get, x = self.symbol.get, np.zeros(sizes.sum(), np.int32)
        for b, ws in zip(begins.tolist(), docs):
            x[b : b + len(ws)] = [get(w, 0) for w in ws]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        rows = self.candidates(x)
        # the item would begin at most all its edits before the document does
        of = np.searchsorted(begins, rows[:, 1] + np.array([len(i) // 2 for i in self.items] or [0], np.int64)[rows[:, 0]], "right") - 1
        last: tuple[int, int, int] | None = None
        for (k, start), d in zip(rows.tolist(), of.tolist()):
            item, most = self.items[k], self.most[k]
            first, stop = int(begins[d]), int(begins[d]) + len(docs[d])
            if (d, k) in best and best[d, k][0] == 0:
                continue
            # starts closer than the slack share a window; one of a short item's starts is always within its edits
            if len(item) >= SHORT_WORDS and last is not None and last[:2] == (d, k) and start - last[2] <= most:
                continue
            last = (d, k, start)
            low, high = max(first, start - 2 * most), min(stop, start + len(item) + 3 * most)
            window = x[low:high]
            # words in common, repeats counted, are at least the item's words less the edits
            if int(np.minimum((window[:, None] == self.distinct[k]).sum(0), self.repeats[k]).sum()) < len(item) - most:
                continue
            if (hit := edit_span(item, window, most)) is not None:
                hit = (hit[0], low - first + hit[1], low - first + hit[2])
                if (d, k) not in best or hit < best[d, k]:
                    best[d, k] = hit
        for (d, k), (distance, s, e) in sorted(best.items()):
            out[d].append((self.ids[k], s, e, distance, len(self.items[k])))
        return out


LEAK = "array<struct<item_id: {item}, start: int, stop: int, distance: int, similarity: double>>"


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The items in blocks of bounded size, read one partition after the other."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("i is not null").orderBy("i", "t").toLocalIterator():
        if ws := words_of(r["t"]):
            block.append((r["i"], ws))
            size += len(ws)
            if size >= block_words:
                yield block
                block, size = [], 0
    if block:
        yield block


def _finder(held, kind: str, made: pa.DataType):
    @F.arrow_udf(LEAK.format(item=kind))
    @frugal
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        for part in parts:
            rows = [
                [{"item_id": i, "start": s, "stop": e, "distance": d, "similarity": 1 - d / n} for i, s, e, d, n in found]
                for texts in slices(part, 1 << 20)
                for found in own.leaks([words_of(t) for t in texts])
            ]
            yield pa.array(rows, made)

    # else a filter on the array's size would run it a second time
    return find.asNondeterministic()


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "leaks", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, **index) -> DataFrame:
    """``docs`` with an array of the benchmark items that each whole text holds a copy of.

    A copy is a stretch of words (case and punctuation aside) whose edit distance to the item is at most 1 - similarity
    of the item's words; the best stretch per item is reported. Null and empty texts and items leak nothing; items
    of fewer than SHORT_WORDS words are searched exactly, longer ones by walks of STEPS steps whatever their length; repeated items are reported as often as they occur
    with different ids; repeated documents give repeated results. With one block of items (bounded by ``block_words``)
    this is one map over the documents. With more, each block is a pass of its own over the texts, so that a worker
    holds one index at a time, and the documents are joined with what was found in their text.
    """
    kind = benchmark.schema[item_id].dataType.simpleString()
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    made = pa.list_(pa.struct([("item_id", arrow_kind), ("start", pa.int32()), ("stop", pa.int32()), ("distance", pa.int32()), ("similarity", pa.float64())]))
    sc = docs.sparkSession.sparkContext
    text, none = F.col(text_col), F.array().cast(LEAK.format(item=kind))
    blocks = item_blocks(benchmark, item_id, item_text, block_words)
    block, following = next(blocks, None), next(blocks, None)
    if block is None:
        return docs.withColumn(out_col, none)
    if following is None:
        return docs.withColumn(out_col, _finder(sc.broadcast(LeakIndex(block, **index)), kind, made)(text))
    found = None
    while block is not None:
        held = sc.broadcast(LeakIndex(block, **index))
        one = docs.where(text.isNotNull()).select(F.sha2(text, 256).alias("_text_key"), _finder(held, kind, made)(text).alias("_found")).where("size(_found) > 0")
        # equal texts have equal leaks; one of them stays, so that copies are not hot
        one = stored(one.groupBy("_text_key").agg(F.first("_found").alias("_found")), "leak-block")
        held.destroy()
        found = one if found is None else found.union(one)
        block, following = following, next(blocks, None)
    found = found.groupBy("_text_key").agg(F.flatten(F.collect_list("_found")).alias("_found"))
    # the row travels as one struct, so that its columns may have any names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.sha2(text, 256).alias("key"))
    both = rows.join(found, F.col("key") == F.col("_text_key"), "left")
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != out_col], F.coalesce("_found", none).alias(out_col))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document and item of which it holds a copy: doc_id, item_id, start, stop (in words), distance, similarity."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = with_leaks(rows, benchmark, **options).select("doc_id", F.explode("leaks").alias("l"))
    return found.select("doc_id", "l.item_id", "l.start", "l.stop", "l.distance", "l.similarity")
