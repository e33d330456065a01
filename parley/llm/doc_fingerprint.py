"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraph digests."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of the sketch that is the fingerprint, and how many times larger each retry is.
CELLS, GROW = 18, 6
#: A paragraph is a line; long lines are cut behind sentence ends, so that one edit spoils one sentence.
_CUT = re.compile(r"\n+|(?<=[.!?])[ \t]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_CHECK = np.uint64(0xD6E8FEB86659FD93)


def digests(text: str | None) -> np.ndarray:
    """64-bit digests of the paragraphs; the n-th repeat of one has a digest of its own, so this is a set."""
    if not text:
        return np.zeros(0, np.uint64)
    pieces = [p for p in _CUT.split(text) if p]
    raw = [xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) for p in pieces]
    if len(set(raw)) < len(raw):
        seen: Counter = Counter()
        for i, h in enumerate(raw):
            if seen[h]:
                raw[i] = xxhash.xxh3_64_intdigest(h.to_bytes(8, "little"), seed=seen[h])
            seen[h] += 1
    return np.array(raw, np.uint64)


def _places(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each key in each of three equal sections."""
    x = keys[:, None] * _MIX
    x ^= x >> np.uint64(29)
    return ((x >> np.uint64(16)) % np.uint64(cells // 3)).astype(np.int64) + np.arange(3) * (cells // 3)


def _check(keys: np.ndarray) -> np.ndarray:
    x = (keys ^ (keys >> np.uint64(31))) * _CHECK
    return x ^ (x >> np.uint64(33))


class Sketch:
    """count, sum of keys and sum of check values (both modulo 2**64) of the keys in each cell."""

    def __init__(self, cells: int, keys: np.ndarray | None = None):
        self.count, self.key, self.check = np.zeros(cells, np.int64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)
        if keys is not None and len(keys):
            at = _places(keys, cells).ravel()
            self.count += np.bincount(at, minlength=cells)
            np.add.at(self.key, at, np.repeat(keys, 3))
            np.add.at(self.check, at, np.repeat(_check(keys), 3))

    def _remove(self, keys: np.ndarray, checks: np.ndarray, signs: np.ndarray) -> None:
        """Take keys out of their cells; ``signs`` says which side they are on."""
        at = _places(keys, len(self.count)).ravel()
        weight = signs.astype(np.uint64)  # -1 wraps around, as sums do
        np.subtract.at(self.count, at, np.repeat(signs, 3))
        np.subtract.at(self.key, at, np.repeat(keys * weight, 3))
        np.subtract.at(self.check, at, np.repeat(checks * weight, 3))

    def __sub__(self, other: Sketch) -> Sketch:
        out = Sketch(len(self.count))
        out.count, out.key, out.check = self.count - other.count, self.key - other.key, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """(keys only on the left, keys only on the right), or None if cells remain that hold no single key."""
        found: list[np.ndarray] = []
        signs: list[np.ndarray] = []
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            if not len(at):
                break
            sign = self.count[at]
            weight = sign.astype(np.uint64)
            keys = self.key[at] * weight
            checks = _check(keys)
            good = np.flatnonzero(checks * weight == self.check[at])
            if not len(good):
                break
            good = good[np.argsort(keys[good])]
            good = good[np.append(True, keys[good[1:]] != keys[good[:-1]])]  # a key alone in several cells counts once
            found.append(keys[good])
            signs.append(sign[good])
            self._remove(keys[good], checks[good], sign[good])
        if self.count.any() or self.key.any() or self.check.any():
            return None
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        keys, sign = np.concatenate(found), np.concatenate(signs)
        return keys[sign > 0], keys[sign < 0]

    def text(self) -> str:
        cells = np.rec.fromarrays([self.count.astype("<i4"), self.key.astype("<u8"), self.check.astype("<u4")])
        return base64.b64encode(cells.tobytes()).decode()


class Fingerprint:
    """The sketches of one text, made as needed in growing sizes."""

    def __init__(self, text: str | None):
        self.keys = digests(text)
        self._sketches: dict[int, Sketch] = {}

    def sketch(self, cells: int = CELLS) -> Sketch:
        if cells not in self._sketches:
            self._sketches[cells] = Sketch(cells, self.keys)
        return self._sketches[cells]

    def text(self) -> str:
        return self.sketch().text()

    def difference(self, other: Fingerprint) -> tuple[np.ndarray, np.ndarray]:
        """Digests of paragraphs only here and only there: subtract, peel, and retry larger on failure."""
        cells = CELLS
        while True:
            if (d := (self.sketch(cells) - other.sketch(cells)).peel()) is not None:
                return d
            cells *= GROW

    def likeness(self, other: Fingerprint) -> float:
        """Twice the shared paragraphs over all paragraphs of both; 1 if neither has any."""
        total = len(self.keys) + len(other.keys)
        if not total:
            return 1.0
        here, there = self.difference(other)
        return (total - len(here) - len(there)) / total


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint(text: Column) -> Column:
    """string: the fingerprint of each whole text; that of the empty text for a null."""

    @F.arrow_udf("string")
    def make(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([Fingerprint(t).text() for t in part.to_pylist()], pa.string())

    return make(text)


RESULT = "doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 500, most_ranges: int = 100_000) -> DataFrame:
    """Per document: n_chars, the sha256 of its edited text, both fingerprints, and the likeness of its fingerprint to
    the edited text's and to that of the next document (ascending id; after the last comes the first).

    Texts move once: rows are cut into ranges of (id, hash of the text), each range is one bucket, and the least document
    of a range goes to the range before it as well. An id of very many rows, or null, is cut into ranges by the hash. A
    task reads its buckets in order and holds two documents at a time. Beyond ``most_ranges`` ranges, which bounds what
    the driver holds, ranges grow instead. Null texts count as empty; null ids come first; rows of one id are ordered by
    a hash of their text, and equal rows follow each other (in one range); a single row follows itself; other columns are
    not looked at; an empty table gives an empty result; an id that is no integer raises TypeError.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType
    if kind.typeName() not in ("long", "integer", "short", "byte"):
        raise TypeError(f"{id_col} has to be of an integer type")
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    rows = max(rows_per_range, -(-n // most_ranges))
    tie = F.xxhash64("text")
    cuts = -(-(n - nulls) // rows)
    found = docs.approxQuantile("doc_id", [k / cuts for k in range(1, cuts)], max(1 / (8 * cuts + 8), 1e-5)) if cuts > 1 else []
    limits = _limits([None] * (nulls // rows) + sorted(int(x) for x in found))
    ranged = docs.withColumn("_range", _range_of(limits)(F.col("doc_id").cast("long"), tie))
    # one row per range: its least (id, tie)
    leasts = sorted(ranged.groupBy("_range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("a"), "doc_id", tie.alias("t"))).alias("m")).collect(), key=lambda r: r[0])
    if not leasts:
        return docs.sparkSession.createDataFrame([], RESULT.format(id=kind.simpleString()))
    order = [r[0] for r in leasts]
    before = {(r["m"]["doc_id"], r["m"]["t"]): order[i - 1] for i, r in enumerate(leasts)}
    ahead = _ahead(before)
    sent = ranged.withColumn("_to", F.explode(F.array_append(F.transform(ahead(F.col("doc_id"), tie), lambda x: F.struct(x.alias("r"), F.lit(1).alias("late"))), F.struct(F.col("_range").alias("r"), F.lit(0).alias("late")))))
    sent = sent.select(F.col("_to.r").alias("r"), F.col("_to.late").alias("late"), "doc_id", "text")
    parts = max(1, min(len(order), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4))
    return (
        sent.repartition(parts, "r")
        .sortWithinPartitions("r", "late", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
        .mapInArrow(_pairs, RESULT.format(id=kind.simpleString()))
    )


def _limits(cuts: list[int | None]) -> list[tuple[int, int]]:
    """Lower limits (id, hash) of all ranges but the first. Where an id is cut k times its hashes are cut into k ranges; null ids
    count as the least."""
    out = []
    for i, k in Counter(cuts).items():
        first = [] if i is None else [(i, -(2**63))]
        out += first + [(NULL_ID if i is None else i, -(2**63) + (j << 64) // (k + (i is None))) for j in range(1, k + (i is None))]
    return sorted(out)


NULL_ID = -(2**63)


def _range_of(limits: list[tuple[int, int]]):
    """The number of limits that a row reaches."""
    ids, ties = (np.array([x[k] for x in limits], np.int64) for k in range(2))

    @F.arrow_udf("int")
    def find(own: pa.Array, hashes: pa.Array) -> pa.Array:
        i, t = own.fill_null(NULL_ID).to_numpy(zero_copy_only=False), hashes.to_numpy(zero_copy_only=False)
        # that least id itself comes after all nulls
        t = np.where((i == NULL_ID) & own.is_valid().to_numpy(zero_copy_only=False), 2**63 - 1, t)
        low, high = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
        at = low.copy()
        for k in np.unique(low[high > low]).tolist():  # the ids that are limits themselves
            rows = np.flatnonzero((low == k) & (high > low))
            at[rows] = k + np.searchsorted(ties[k : high[rows[0]]], t[rows], "right")
        return pa.array(at.astype(np.int32))

    return find


def _ahead(before: dict):
    """The range before, for the least document of a range; else no range."""

    @F.arrow_udf("array<int>")
    def find(ids: pa.Array, ties: pa.Array) -> pa.Array:
        out = [[b] if (b := before.get((i, t))) is not None else [] for i, t in zip(ids.to_pylist(), ties.to_pylist())]
        return pa.array(out, pa.list_(pa.int32()))

    return find


def _pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # (range, id, text, fingerprint) of the document whose next one has not been seen

    def result(text: str, print_: Fingerprint, following: str, following_print: Fingerprint) -> tuple:
        changed = edited(text, following)
        changed_print = Fingerprint(changed)
        sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return len(text), sha, print_.text(), changed_print.text(), print_.likeness(changed_print), print_.likeness(following_print)

    for part in parts:
        rows: list[tuple] = []
        for at in range(0, part.num_rows, 256):
            piece = part.slice(at, 256)
            for r, late, i, text in zip(*(c.to_pylist() for c in piece.columns)):
                own = Fingerprint(text)
                if held is not None and held[0] == r and not held[4]:
                    rows.append((held[1], *result(held[2], held[3], text, own)))
                held = (r, i, text, own, late)
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        types = (part.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        columns = zip(*rows) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))
