"""Ranked lexical search over shards of dual-sorted postings: lists ordered by impact, navigable by document.

The lists of a shard stand one behind the other, each by falling impact. A wavelet tree over their document numbers (laid
out level by level, zeros before ones, so a node is a range of each list) keeps that order inside every node, so the first
posting of a list in a node carries the greatest impact that the list has in the node's documents. A search opens nodes by
falling sum of those bounds, and ends once the best node left cannot reach the documents already found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import bounded_batches, discard, frugal, slices, stored

#: Documents and postings of a shard at most; a document of more postings is in a shard of its own.
SHARD_DOCS, SHARD_POSTINGS = 8_192, 1_000_000
#: Bytes of query texts that are searched together; more are searched in blocks, each with an index of its own terms.
BLOCK_BYTES = 4 << 20
#: Nodes opened together.
OPENED = 64
#: Bytes of an Arrow batch of shards, which are large rows.
SHARD_BYTES = 32 << 20
#: Everything but digits, letters and what is no ASCII becomes a space, A-Z become small.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: digits, ASCII letters in lower case, and whatever is no ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What an occurrence count gives, before the term's weight, in a document of so many words."""
    m = 100 - 75 + 75 * length * n_docs // n_words
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


# --- building --------------------------------------------------------------------------------------------------------

POSTINGS = "n_docs bigint, n_words bigint, lengths binary, terms array<string>, df array<int>, docs binary, tfs binary"
SHARD = "terms array<string>, starts binary, bits binary, impacts binary"


def _order(ids: pa.Array) -> np.ndarray:
    return pc.sort_indices(ids, null_placement="at_end").to_numpy()


class _Gatherer:
    """Counts the terms of documents until a shard is full."""

    def __init__(self, only: dict[bytes, int] | None, kind: pa.DataType):
        self.only, self.kind = only, kind
        self.clear()

    def clear(self) -> None:
        self.number = {} if self.only is None else self.only
        self.ids, self.lengths, self.keys, self.counts = [], [], [], []
        self.n_docs = self.n_words = self.postings = 0

    def add(self, doc_id, text: str | None) -> None:
        terms = terms_of(text)
        if not terms:
            return
        self.n_docs += 1
        self.n_words += len(terms)
        if self.only is None:
            new = self.number
            found = [new.setdefault(t, len(new)) for t in terms]
        else:
            found = [x for x in map(self.only.get, terms) if x is not None]
        if not found:
            return
        numbers, counts = np.unique(np.array(found, np.int32), return_counts=True)
        self.keys.append(numbers)
        self.counts.append(counts)
        self.ids.append(doc_id)
        self.lengths.append(len(terms))
        self.postings += len(numbers)

    @property
    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.postings >= SHARD_POSTINGS

    def shard(self, schema: pa.Schema) -> pa.RecordBatch:
        ids = pa.array(self.ids, self.kind)
        order = _order(ids)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        if self.keys:
            size = [len(k) for k in self.keys]
            term, tf = np.concatenate(self.keys).astype(np.int64), np.concatenate(self.counts)
            doc = np.repeat(rank, size)
            by = np.argsort(term, kind="stable")
            term, tf, doc = term[by], tf[by], doc[by]
            numbers, df = np.unique(term, return_counts=True)
        else:
            tf = doc = numbers = df = np.zeros(0, np.int64)
        spelt = {x: t for t, x in self.number.items()} if len(numbers) else {}
        lengths = np.array(self.lengths, "<i8")[order] if len(order) else np.zeros(0, "<i8")
        row = [
            ids.take(pa.array(order)), self.n_docs, self.n_words, lengths.tobytes(), [spelt[x].decode("utf-8", "surrogatepass") for x in numbers.tolist()],
            df.tolist(), doc.astype("<i4").tobytes(), tf.astype("<i8").tobytes(),
        ]
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array([v.to_pylist() if isinstance(v, pa.Array) else v], f.type) for v, f in zip(row, schema)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _schema(kind: T.DataType, fields: str) -> T.StructType:
    return T.StructType([T.StructField("ids", T.ArrayType(kind)), *T.StructType.fromDDL(fields).fields])


def _gathered(only: list[bytes] | None, schema: T.StructType):
    @frugal
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow(schema)
        g = _Gatherer(None if only is None else {t: i for i, t in enumerate(only)}, arrow.field("ids").type.value_type)
        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for s in slices(batch.column(1)):
                for text in s:
                    g.add(next(ids), text)
                    if g.full:
                        yield g.shard(arrow)
        if g.n_docs:
            yield g.shard(arrow)

    return gather


def levels(doc: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level by level from the root: the bits, and the order in which the next level has the postings."""
    at = np.arange(len(doc))
    for level in range(depth):
        bit = (doc[at] >> (depth - 1 - level) & 1).astype(np.uint8)
        step = np.argsort(bit, kind="stable")
        yield bit, step
        at = at[step]


def _depth(n: int) -> int:
    return max(0, (n - 1).bit_length())


def _planted(n_docs: int, n_words: int, schema: T.StructType):
    """Shards of postings to shards of trees: lists by falling impact, the bits of the levels, the impacts."""

    @frugal
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                length = np.frombuffer(row["lengths"].as_py(), "<i8")
                doc, tf = np.frombuffer(row["docs"].as_py(), "<i4").astype(np.int64), np.frombuffer(row["tfs"].as_py(), "<i8")
                df = np.array(row["df"].as_py(), np.int64)
                if not len(df):
                    continue
                impact = impacts(tf, length[doc], n_docs, n_words)
                by = np.lexsort((doc, -impact, np.repeat(np.arange(len(df)), df)))
                bits = [np.packbits(bit).tobytes() for bit, _ in levels(doc[by], _depth(len(length)))]
                values = [row["ids"].as_py(), row["terms"].as_py(), np.append(0, np.cumsum(df)).astype("<i4").tobytes(), b"".join(bits), impact[by].astype("<i4").tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

    return plant


@dataclass
class Index:
    """``shards``: a table of trees; ``df``: a table (term, df); the number of documents with a term, and of their terms."""

    shards: DataFrame
    df: DataFrame
    n_docs: int
    n_words: int

    def discard(self) -> None:
        discard(self.shards)
        discard(self.df)


def build_index(docs: DataFrame, only: list[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """An index of all documents, of all terms or of those in ``only``, as tables in the shared folder.

    The texts are read once. Counts of all terms are added up over shards, a map-side aggregate; nothing but two sums reaches
    the driver. A shard is one row of some megabytes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType
    schema = _schema(kind, POSTINGS)
    postings = stored(docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(_gathered(only, schema), schema), "search-postings")
    n_docs, n_words = postings.agg(F.sum("n_docs"), F.sum("n_words")).first()
    counts = postings.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df"))
    df = stored(counts, "search-df")
    schema = _schema(kind, SHARD)
    shards = stored(_few(postings).mapInArrow(_planted(n_docs or 0, n_words or 0, schema), schema), "search-shards")
    discard(postings)
    return Index(shards, df, n_docs or 0, n_words or 0)


def _few(shards: DataFrame) -> DataFrame:
    """Set the session's bytes of an Arrow batch to ``SHARD_BYTES``, so that few shards go in one."""
    shards.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SHARD_BYTES))
    return shards


# --- searching -------------------------------------------------------------------------------------------------------


class Shard:
    """A shard's trees in memory: of each level the ones before each place, and the impacts in the level's order."""

    def __init__(self, ids: list, terms: list[str], starts: bytes, bits: bytes, impact: bytes):
        self.ids = ids
        self.number = {t.encode("utf-8", "surrogatepass"): i for i, t in enumerate(terms)}
        self.starts = np.frombuffer(starts, "<i4").astype(np.int64)
        self.depth = _depth(len(ids))
        n = int(self.starts[-1])
        self.width = n + 1
        ones = np.zeros((self.depth, n + 1), np.int32)
        value = np.zeros((self.depth + 1, n + 1), np.int32)
        value[0, :n] = np.frombuffer(impact, "<i4")
        packed, each = np.frombuffer(bits, np.uint8), (n + 7) // 8
        for level in range(self.depth):
            bit = np.unpackbits(packed[level * each : (level + 1) * each], count=n)
            np.cumsum(bit, out=ones[level, 1:])
            value[level + 1, :n] = value[level, :n][np.argsort(bit, kind="stable")]
        self.zeros = n - ones[:, -1].astype(np.int64)
        self.ones, self.value = ones.ravel(), value.ravel()

    def search(self, terms: dict[bytes, int], k: int, floor: int) -> list[tuple[int, object]]:
        """(score, id) of the k best documents, equal scores by id, that score at least ``floor`` and more than 0;
        ``terms`` gives each term's weight."""
        held = [(self.number[t], w) for t, w in terms.items() if t in self.number and w > 0]
        if not held:
            return []
        number, w = (np.array(x, np.int64) for x in zip(*held))
        low, high = self.starts[number], self.starts[number + 1]
        floor = max(floor, 1)
        best: list[tuple[int, int]] = []
        heap = [(-int((self.value[low] * w).sum()), 0, 0, low, high)]
        while heap and -heap[0][0] >= floor:
            nodes = []
            while heap and len(nodes) < OPENED and -heap[0][0] >= floor:
                bound, doc, level, a, b = heappop(heap)
                if level == self.depth:
                    best.append((bound, doc))
                else:
                    nodes.append((doc, level, a, b))
            if len(best) >= k:
                best = sorted(best)[:k]
                floor = max(floor, -best[-1][0])
            if not nodes:
                continue
            doc, level = (np.array([x[i] for x in nodes], np.int64) for i in (0, 1))
            a, b = np.stack([x[2] for x in nodes]), np.stack([x[3] for x in nodes])
            base = (level * self.width)[:, None]
            ones_a, ones_b = self.ones[base + a], self.ones[base + b]
            zeros = self.zeros[level][:, None]
            a, b = np.concatenate([a - ones_a, zeros + ones_a]), np.concatenate([b - ones_b, zeros + ones_b])
            doc = np.concatenate([doc * 2, doc * 2 + 1])
            level = np.concatenate([level, level]) + 1
            bound = (np.where(b > a, self.value[(level * self.width)[:, None] + a], 0) * w).sum(axis=1)
            for i in np.flatnonzero(bound >= floor).tolist():
                heappush(heap, (-int(bound[i]), int(doc[i]), int(level[i]), a[i], b[i]))
        return [(-bound, self.ids[doc]) for bound, doc in sorted(best)[:k]]


def _best(found: list[tuple[int, object]], k: int) -> list[tuple[int, object]]:
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]


def _searched(queries: list[dict[bytes, int]], k: int, schema: T.StructType):
    @frugal
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow(schema)
        found: list[list[tuple[int, object]]] = [[] for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(*(c[i].as_py() for c in batch.columns))
                for q, terms in enumerate(queries):
                    held = found[q]
                    new = shard.search(terms, k, held[-1][0] if len(held) == k else 0)
                    if new:
                        found[q] = _best(held + new, k)
        rows = [(q, doc_id, score) for q, best in enumerate(found) for score, doc_id in best]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), arrow)], schema=arrow)

    return search


def search_index(index: Index, items: list[tuple[object, str | None]], item_type: T.DataType, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each item (id, text); items have to fit in memory."""
    spark = index.shards.sparkSession
    counted: list[dict[bytes, int]] = []
    for _, text in items:
        counts: dict[bytes, int] = {}
        for t in terms_of(text):
            counts[t] = counts.get(t, 0) + 1
        counted.append(counts)
    asked = sorted({t for c in counted for t in c})
    frame = spark.createDataFrame([(t.decode("utf-8", "surrogatepass"),) for t in asked], "term string")
    df = {r.term.encode("utf-8", "surrogatepass"): r.df for r in index.df.join(F.broadcast(frame), "term").collect()}
    weighted = [{t: c * weight(index.n_docs, df[t]) for t, c in counts.items() if t in df} for counts in counted]
    id_type = index.shards.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    found = _few(index.shards).mapInArrow(_searched(weighted, k, schema), schema)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", item_type)])
    ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(items)], names)
    return ranked.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k best of all documents for each row of ``items``.

    Rows of ``docs`` are documents of their own, repeated or null ids included (null ids come last among equal scores); rows of
    ``items`` are queries of their own. Null, empty and blank texts have no terms and neither find nor are found; so an
    empty table on either side gives an empty result. Other columns are not looked at. Items are searched in blocks of
    about ``BLOCK_BYTES`` of their texts, each over an index of that block's terms, so the driver and a task hold one
    block (or one longer item); every block reads the texts once. A task keeps k documents an item over its shards.
    """
    rows = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where(F.length("text") > 0)
    blocks = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES)
    kind = rows.schema["item_id"].dataType
    out = docs.sparkSession.createDataFrame([], T.StructType([
        T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType()),
    ]))
    for block in range(blocks):
        held = [(r.item_id, r.text) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()]
        only = sorted({t for _, text in held for t in terms_of(text)})
        if only:
            found = search_index(build_index(docs, only, id_col, text_col), held, kind, k)
            out = found if blocks == 1 else out.union(stored(found, "search-found"))
    return out
