"""Language ID: nearest of several centroids per language over normalised TF-IDF n-gram vectors, with rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import frugal, slices

#: Hashed buckets of the character 1-, 2- and 3-grams; centroids per language; bound of the labelled sample.
BUCKETS, CENTROIDS, SAMPLE_ROWS = 4096, 4, 2_000
#: A text is rejected if it is further from its centroid than this many times the distance within which all but OUTER
#: of the label's sample lie. Cosines of texts with fewer distinct n-grams than FULL are raised first: a short text of
#: the language lies further out, about as the root of its n-grams. Where that levels off depends on how varied a corpus
#: is, so it is judged at two such numbers, and a text has to be too far under both.
SLACK, OUTER, FULL = 1.1, 0.001, (150, 800)
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of the whole text; None if it is null or has no letter. Case is folded and each run
    of other characters is one boundary."""
    if not text:
        return None
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return None
    chars = np.where(letter, chars, 0)
    chars = chars[np.append(True, letter[1:] | letter[:-1])]
    chars = np.concatenate([np.zeros(1, np.uint32), chars, np.zeros(1, np.uint32)])
    one = chars * np.uint32(2654435761)
    two = (one[:-1] ^ (one[1:] >> np.uint32(7))) * np.uint32(2246822519)
    three = (two[:-1] ^ (one[2:] >> np.uint32(11))) * np.uint32(3266489917)
    return np.bincount(np.concatenate([one, two, three]) >> np.uint32(20), minlength=BUCKETS)


def _fullness(counts: np.ndarray) -> np.ndarray:
    """One row per text, one column per number of FULL."""
    return np.sqrt(np.minimum(1, (counts > 0).sum(1)[:, None] / np.array(FULL)))


@dataclass
class CentroidModel:
    """labels[k] and least[k] (the least cosines of a full text that is accepted, one per number of FULL) belong to the
    k-th row of centroids."""

    idf: np.ndarray
    centroids: np.ndarray
    labels: list[str]
    least: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(label, cosine, rejected) of each text."""
        out: list[tuple[str, float, bool]] = [(UNDETERMINED, 0.0, True)] * len(texts)
        rows = [(i, c) for i, t in enumerate(texts) if (c := ngram_counts(t)) is not None]
        if rows and len(self.labels):
            counts = np.stack([c for _, c in rows])
            cosine = self.vectors(counts) @ self.centroids.T
            best = cosine.argmax(1)
            for (i, _), k, row, full in zip(rows, best.tolist(), cosine, _fullness(counts)):
                out[i] = (self.labels[k], float(min(1.0, max(0.0, row[k]))), bool((row[k] < self.least[k] * full).all()))
        return out


def _cluster(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means: the first centre is the mean, each further one the row furthest from all so far."""
    centres = [x.mean(0)]
    while len(centres) < min(k, len(x)):
        c = np.stack(centres)
        near = (x @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T).max(1)
        centres.append(x[near.argmin()])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        of = (x @ c.T).argmax(1)
        c = np.stack([x[of == j].mean(0) if (of == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


def fit(rows: list[tuple[str, np.ndarray]], per_label: int = CENTROIDS, slack: float = SLACK) -> CentroidModel:
    """From (label, n-gram counts) pairs."""
    if not rows:
        return CentroidModel(np.zeros(BUCKETS, np.float32), np.zeros((0, BUCKETS), np.float32), [], np.zeros((0, len(FULL))))
    counts = np.stack([c for _, c in rows])
    model = CentroidModel((np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 0.05).astype(np.float32), np.zeros((0, BUCKETS)), [], np.zeros((0, len(FULL))))
    x, full, names = model.vectors(counts), _fullness(counts), np.array([n for n, _ in rows])
    centroids, labels, least = [], [], []
    for name in sorted(set(names)):
        own = x[names == name]
        c = _cluster(own, per_label)
        cosine = own @ c.T
        furthest = np.quantile(cosine.max(1)[:, None] / full[names == name], OUTER, axis=0)
        centroids += list(c)
        labels += [str(name)] * len(c)
        least += [1 - slack * (1 - furthest)] * len(c)
    model.centroids, model.labels, model.least = np.stack(centroids).astype(np.float32), labels, np.array(least)
    return model


SPARSE = "label string, buckets binary, counts binary"


@frugal
def _sparse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        labels, buckets, counts = [], [], []
        for label, text in zip(part.column(0).to_pylist(), (t for s in slices(part.column(1)) for t in s)):
            if (c := ngram_counts(text)) is not None:
                at = np.flatnonzero(c)
                labels.append(label)
                buckets.append(at.astype("<u2").tobytes())
                counts.append(c[at].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], names=["label", "buckets", "counts"])


def train(docs: DataFrame, label_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, per_label: int = CENTROIDS) -> CentroidModel:
    """Fit on a sample of the labelled rows, at most ``sample_rows`` (or one per label) in all and equally many per label.

    The sample is the rows whose hashed id and text lie below a bound, equal rows once and of each label those of least
    hash, so it is the same in every run. Every label is learned, however many there are; the model takes some 64 KB a
    label. Only the labels' counts and sparse n-gram counts of the sample reach the driver. Rows with a null label, or with
    a text that is null or has no letter, are neither counted nor sampled; without rows nothing is learned.
    """
    rows = docs.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"), F.col(id_col).alias("id")).where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = rows.groupBy("label").count().collect()
    if not sizes:
        return fit([])
    each = max(1, sample_rows // len(sizes))
    # somewhat more than needed, so that no label is left out by chance; the surplus goes below
    shares = {r["label"]: min(1.0, (1.5 * each + 30) / r["count"]) for r in sizes}

    @F.arrow_udf("double")
    def share(labels: pa.Array) -> pa.Array:
        return pa.array([shares[x] for x in labels.to_pylist()], pa.float64())

    rows = rows.withColumn("hash", F.xxhash64("id", "text"))
    kept = rows.where(F.pmod("hash", F.lit(1 << 30)) < share("label") * float(1 << 30))
    kept = kept.dropDuplicates(["label", "hash"]).withColumn("nth", F.row_number().over(Window.partitionBy("label").orderBy(F.pmod("hash", F.lit(1 << 30)), "hash"))).where(F.col("nth") <= each)
    sample = kept.select("label", "text").mapInArrow(_sparse, SPARSE).toArrow()
    out = []
    for label, at, n in zip(*(sample.column(i).to_pylist() for i in range(3))):
        c = np.zeros(BUCKETS, np.float32)
        c[np.frombuffer(at, "<u2")] = np.frombuffer(n, "<u4")
        out.append((label, at, c))
    out.sort(key=lambda x: (x[0], x[1]))
    return fit([(label, c) for label, _, c in out], per_label)


PREDICTION = pa.struct([("label", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def predict(text: Column, model: CentroidModel) -> Column:
    """struct<label, score, rejected> of each whole text. A null text or one without a letter: und, 0, rejected."""

    @F.arrow_udf("label string, score double, rejected boolean")
    @frugal
    def nearest(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = [p for texts in slices(part, 1 << 19) for p in model.predict(texts)]
            labels, scores, rejected = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], fields=list(PREDICTION))

    return nearest(text)


def identify(docs: DataFrame, model: CentroidModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, lang_pred, score (the cosine), rejected (too far from every centroid).

    Repeated rows give repeated results; other columns are not looked at; an empty table gives an empty result; a model
    without centroids answers und, 0, rejected. A narrow map: no shuffle; the model is a few hundred KB.
    """
    return docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col), model).alias("p")).select("doc_id", F.col("p.label").alias("lang_pred"), "p.score", "p.rejected")
