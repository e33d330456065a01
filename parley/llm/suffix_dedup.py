"""Repeated passages by sparse suffix arrays: suffixes at minimiser positions, sorted, compared with their neighbours, and
extended left and right."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import frugal, slices, stored
from parley.llm.ngram_join import _mixed, _powers, word_hashes

#: Least words of a passage. Each stretch of so many words holds a whole seed at a selected position. Suffixes of one seed
#: that are compared in one task, which takes about 1 KB each; stretches around more frequent seeds are counted by an aggregate instead.
PASSAGE_WORDS, HOT_ROWS = 50, 200_000
#: Parts that the stretches around frequent seeds are dealt to when they are looked up.
SALTS = 32


def _sliding(x: np.ndarray, w: int, least) -> np.ndarray:
    """least(x[i : i + w]) for each i with a whole window, by doubling."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = least(out[: len(out) - step], out[step:])
        have += step
    return out


def _hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, sizes = word_hashes([t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts])
    return hashes, sizes


def _least_seeds(hashes: np.ndarray, sizes: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the seed at each word, least of the seeds in the stretch of a passage's words that begins there; 0 for a
    stretch that reaches into the next text)."""
    seed = passage // 2
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n = len(hashes) - seed + 1
    if n < passage - seed + 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    up, down = _powers.upto(len(hashes) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)])])
    grams = _mixed((total[seed:] - total[:-seed]) * down[:n])
    low = _sliding(grams, passage - seed + 1, np.minimum)
    return grams, np.where(owner[: len(low)] == owner[np.arange(len(low)) + passage - 1], low, 0)


def minimisers(hashes: np.ndarray, sizes: np.ndarray, passage: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed hash, text number, position) of the selected positions: those whose seed, half a passage long, has the
    least hash in some window of neighbouring seeds. The choice depends on content alone."""
    window = passage - passage // 2 + 1
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    grams, low = _least_seeds(hashes, sizes, passage)
    if not len(low):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate([np.zeros(window - 1, np.uint64), low, np.zeros(window - 1, np.uint64)])
    highest = _sliding(padded, window, np.maximum)  # over the windows that hold a position
    at = np.flatnonzero((highest == grams) & (grams > 0))
    return grams[at], owner[at], at - begins[owner[at]]


def _seeds(passage: int):
    @frugal
    def seeds(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, at = part.column(0), 0
            for texts in slices(part.column(1), 1 << 20):
                key, owner, position = minimisers(*_hashed(texts), passage)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids.slice(at, len(texts)).take(pa.array(owner)), pa.array(position.astype(np.int32))], names=["key", "doc_id", "pos"])
                at += len(texts)

    return seeds


def _contexts(passage: int):
    """From rows (doc_id, text, at array<int>): (key, doc_id, pos, right, left): 31-bit word hashes around a position,
    to the right as far as the next selected position can be, to the left likewise, nearest first; 0 beyond the text."""
    seed = passage // 2
    left, right = passage - seed, passage + 1

    @frugal
    def contexts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            at = 0
            for texts in slices(part.column(1), 1 << 20):
                piece = part.slice(at, len(texts))
                at += len(texts)
                hashes, sizes = _hashed(texts)
                short = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                up, down = _powers.upto(len(hashes) + 1)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)])])
                begin = np.cumsum(sizes) - sizes
                wanted = piece.column(2).to_pylist()
                owner = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
                pos = np.array([p for w in wanted for p in w], np.int64)
                ok = pos + seed <= sizes[owner]  # a repeated id with another text may be shorter
                owner, pos = owner[ok], pos[ok]
                for k in range(0, len(pos), 20_000):
                    o, p = owner[k : k + 20_000], pos[k : k + 20_000]
                    where = begin[o] + p
                    key = _mixed((total[where + seed] - total[where]) * down[where])

                    def around(steps, o=o, where=where):
                        x = where[:, None] + steps
                        inside = (x >= begin[o][:, None]) & (x < (begin[o] + sizes[o])[:, None])
                        return np.where(inside, short[np.clip(x, 0, len(short) - 1)], 0).astype(">u4")

                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)), piece.column(0).take(pa.array(o)), pa.array(p.astype(np.int32)),
                        pa.array([x.tobytes() for x in around(np.arange(right))], pa.binary()), pa.array([x.tobytes() for x in around(-1 - np.arange(left))], pa.binary()),
                    ], names=["key", "doc_id", "pos", "right", "left"])

    return contexts


def _common(x: np.ndarray) -> np.ndarray:
    """How many leading columns each row shares with the row before; 0 for the first."""
    out = np.zeros(len(x), np.int64)
    if len(x) > 1:
        same = np.column_stack([x[1:] == x[:-1], np.zeros(len(x) - 1, bool)])
        out[1:] = same.argmin(1)
    return out


def shared_windows(key: np.ndarray, doc: np.ndarray, right: np.ndarray, left: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last, other): rows with a stretch of ``passage`` words around their seed that another document has,
    the least and greatest number of words that such a stretch extends to the left, and the least ``other`` of them.

    The rows are sorted by (key, right). Neighbours' common lengths cut that order into the runs that share any number of
    words to the right, and the order by what stands to the left likewise; the rows that share both a run to the right
    and one to the left have the stretch in common."""
    ahead = _common(right)
    ahead[np.append(True, key[1:] != key[:-1])] = 0
    back = np.lexsort(left.T[::-1])
    back_common = _common(left[back])
    place = np.empty(len(key), np.int64)
    place[back] = np.arange(len(key))
    first, last, other = np.full(len(key), passage), np.full(len(key), -1), np.full(len(key), 2**63 - 1)
    for o in range(left.shape[1] + 1):
        need = passage - o
        own = np.flatnonzero((right[:, need - 1] > 0) & (left[:, o - 1] > 0 if o else True))
        if len(own) < 2:
            continue
        run, run_back = np.cumsum(ahead < need), np.cumsum(back_common < o)[place]
        code = run[own] * (len(key) + 1) + run_back[own]
        order = np.argsort(code, kind="stable")
        own, code = own[order], code[order]
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        size = np.diff(np.append(start, len(code)))
        low, high = np.repeat(np.minimum.reduceat(doc[own], start), size), np.repeat(np.maximum.reduceat(doc[own], start), size)
        hit = low != high
        own, low, high = own[hit], low[hit], high[hit]
        first[own], last[own] = np.minimum(first[own], o), o
        other[own] = np.minimum(other[own], np.where(low == doc[own], high, low))
    row = np.flatnonzero(last >= 0)
    return row, first[row], last[row], other[row]


def _neighbours(passage: int, chunk: int = 20_000):
    """From suffix rows sorted by (key, right context): spans (doc_id, start, stop, other) that another document has. Whole
    keys are taken together, several of them up to ``chunk`` rows."""
    seed = passage // 2
    wide, narrow = passage + 1, passage - seed

    def matrix(column: pa.Array, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.uint32).reshape(-1, width)

    def spans(rows: list[np.ndarray]) -> pa.RecordBatch:
        key, doc, pos, right, left = rows
        row, first, last, other = shared_windows(key, doc, right, left, passage)
        return pa.RecordBatch.from_arrays([
            pa.array(doc[row]), pa.array((pos[row] - last).astype(np.int32)), pa.array((pos[row] + passage - first).astype(np.int32)), pa.array(other),
        ], names=["doc_id", "start", "stop", "other"])

    @frugal
    def neighbours(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for part in parts:
            for at in range(0, part.num_rows, chunk):
                piece = part.slice(at, chunk)
                rows = [piece.column(k).to_numpy(zero_copy_only=False) for k in range(3)] + [matrix(piece.column(3), wide), matrix(piece.column(4), narrow)]
                held.append(rows)
                size += len(rows[0])
                if size >= chunk and held[0][0][0] != rows[0][-1]:
                    rows = [np.concatenate(c) for c in zip(*held)]
                    cut = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1  # the last key may go on
                    yield spans([r[:cut] for r in rows])
                    held, size = [[r[cut:] for r in rows]], len(rows[0]) - cut
        if held:
            yield spans([np.concatenate(c) for c in zip(*held)])

    return neighbours


def _stretches(passage: int):
    """From rows (doc_id, text, at array<int>): (hash, doc_id, start) of the stretches whose least seed is at one of these
    positions."""
    seed = passage // 2

    @frugal
    def stretches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            at = 0
            for texts in slices(part.column(1), 1 << 20):
                piece = part.slice(at, len(texts))
                at += len(texts)
                hashes, sizes = _hashed(texts)
                up, down = _powers.upto(len(hashes) + 1)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)])])
                begin = np.cumsum(sizes) - sizes
                wanted = piece.column(2).to_pylist()
                owner = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
                pos = np.array([p for w in wanted for p in w], np.int64)
                grams, low = _least_seeds(hashes, sizes, passage)
                starts = (pos[:, None] - np.arange(passage - seed + 1)).ravel()
                owner, pos = np.repeat(owner, passage - seed + 1), np.repeat(pos, passage - seed + 1)
                ok = np.flatnonzero((starts >= 0) & (starts + passage <= sizes[owner]))
                ok = ok[low[(begin[owner] + starts)[ok]] == grams[(begin[owner] + pos)[ok]]]
                both = np.unique(np.column_stack([owner[ok], starts[ok]]), axis=0)
                where = begin[both[:, 0]] + both[:, 1]
                own = _mixed(_mixed((total[where + passage] - total[where]) * down[where]))
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), piece.column(0).take(pa.array(both[:, 0])), pa.array(both[:, 1].astype(np.int32))], names=["hash", "doc_id", "start"])

    return stretches


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (doc_id, spans array<struct<start, stop, other>>): joined spans."""
    for part in parts:
        rows = []
        for d, spans in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            now = None
            for s in sorted((s["start"], s["stop"], s["other"]) for s in spans):
                if now and s[0] <= now[1]:
                    now = (now[0], max(now[1], s[1]), min(now[2], s[2]))
                    continue
                if now:
                    rows.append((d, *now, now[1] - now[0]))
                now = s
            if now:
                rows.append((d, *now, now[1] - now[0]))
        columns = zip(*rows) if rows else [()] * 5
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "start", "stop", "other", "n_words"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE_WORDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per stretch of at least ``passage`` words that another document has as well: doc_id, start, stop (in
    words), other, n_words. Overlapping stretches are joined. ``other`` is a document that shares part of it: of all its
    stretches of ``passage`` words the least of their least holder (of their greatest one where the document itself is the
    least).

    Words are runs of other than ASCII white space, A-Z in lower case. Seeds at minimiser positions are counted by a
    map-side aggregate; only those that two documents have go on. Their suffixes are sorted by what follows, and
    neighbours are compared, to the right and to the left, key by key. A seed of more than ``hot_rows`` suffixes would be
    too much for a task: the stretches around it are counted by an aggregate and looked up in salted parts, with the
    same result. Seeds have 64 bits, the words around them 31 bits each.

    Null, empty and shorter texts have no row; rows with one doc_id are one document; null ids, and ids that are no
    integers, are left out; other columns are not looked at; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    seeds = stored(docs.mapInArrow(_seeds(passage), "key long, doc_id long, pos int"), "suffix-seeds")
    keys = stored(seeds.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a <> b").select("key", "n"), "suffix-keys")

    def at(own: DataFrame) -> DataFrame:
        wanted = seeds.join(own, "key").groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("at"))
        return docs.join(wanted, "doc_id").select("doc_id", "text", "at")

    suffixes = at(keys.where(F.col("n") <= hot_rows).select("key")).mapInArrow(_contexts(passage), "key long, doc_id long, pos int, right binary, left binary")
    spans = suffixes.repartition("key").sortWithinPartitions("key", "right").mapInArrow(_neighbours(passage), "doc_id long, start int, stop int, other long")
    hot = keys.where(F.col("n") > hot_rows).select("key")
    if n := hot.count():
        windows = stored(at(F.broadcast(hot) if n <= 100_000 else hot).mapInArrow(_stretches(passage), "hash long, doc_id long, start int"), "suffix-windows")
        shared = windows.groupBy("hash").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b")
        shared = shared.select("hash", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        found = windows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(shared, ["hash", "salt"])
        spans = spans.union(found.select("doc_id", "start", (F.col("start") + passage).alias("stop"), F.when(F.col("a") == F.col("doc_id"), F.col("b")).otherwise(F.col("a")).alias("other")))
    spans = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop", "other")).alias("spans"))
    return spans.mapInArrow(_merged, "doc_id long, start int, stop int, other long, n_words int")
