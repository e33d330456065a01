"""BPE encoding and decoding with a priority queue of merge ranks over a doubly linked symbol list."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import frugal, slices

#: Words whose ids are remembered; the memory is emptied when full, so it stays bounded. A worker that only encodes has
#: room for more of them than one that also serves other stages.
MEMORY, MORE_MEMORY = 60_000, 400_000
#: Texts that are encoded and decoded again before their results leave: results are some five times as large.
ROUND_TRIP_BYTES = 1 << 19
#: Characters of a word that is remembered at most.
REMEMBERED = 100
#: Unicode white space as the vocabulary's patterns take it.
SPACE = r"\p{White_Space}"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(hidden)) for b in range(256)]


def require(spec: dict, normalizers: list[str], pre_tokenizers: list[str], path: str) -> None:
    """Raise ValueError if a tokenizer file cuts or changes texts in another way than the code at hand does."""

    def kinds(part: dict | None, inner: str) -> list[str]:
        return [] if part is None else [x["type"] for x in part[inner]] if part["type"] == "Sequence" else [part["type"]]

    model = spec["model"]
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    if not plain or kinds(spec.get("normalizer"), "normalizers") != normalizers or kinds(spec.get("pre_tokenizer"), "pretokenizers") != pre_tokenizers:
        raise ValueError(f"{path}: a model, normalizer or pre-tokenizer of another kind than {normalizers} and {pre_tokenizers}")


class BpeCodec:
    """A byte-level BPE vocabulary with an end-of-word mark, read from a tokenizer JSON file.

    ``encode`` gives the ids of a text without added tokens; strings of special tokens inside a text become those
    tokens. ``decode`` puts the vocabulary strings of ids together, one space between two: the file names no decoder.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        self.memory = memory
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        require(spec, ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], path)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = dict(model["vocab"])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: (left id, right id) -> (rank, id of the merged symbol)
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        self.byte = [vocab.get(c) for c in byte_symbols()]
        self.last = [vocab.get(c + self.end) for c in byte_symbols()]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.string = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._word = regex.compile(WORD)
        self._known: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges: the queue holds (rank, position); an entry is stale once either symbol has changed."""
        n = len(symbols)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        merges = self.merges
        queue = [(m[0], i, m[1], symbols[i], symbols[i + 1]) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
        heapify(queue)
        while queue:
            _, i, merged, left, right = heappop(queue)
            j = after[i]
            if j < 0 or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if m := merges.get((merged, symbols[k])):
                    heappush(queue, (m[0], i, m[1], merged, symbols[k]))
            if (h := before[i]) >= 0 and (m := merges.get((symbols[h], merged))):
                heappush(queue, (m[0], h, m[1], symbols[h], merged))
        return [s for s in symbols if s >= 0]

    def _new_word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        symbols = [self.byte[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        ids = np.array(self.merge([s for s in symbols if s is not None]), "<u4").tobytes()
        if len(word) <= REMEMBERED:
            if len(self._known) >= self.memory:
                self._known.clear()
            self._known[word] = ids
        return ids

    def _plain(self, text: str) -> Iterator[bytes]:
        if not text.isascii():
            # lower case letter by letter: a final sigma gets no form of its own
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        known, new = self._known.get, self._new_word
        for word in self._word.findall(text.lower()):
            yield known(word) or new(word)

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; of a null text, none."""
        if not text:
            return b""
        if self._special is None or not self._special.search(text):
            return b"".join(self._plain(text))
        parts, at = [], 0
        for m in self._special.finditer(text):
            parts += self._plain(text[at : m.start()])
            parts.append(np.array([self.special[m[0]]], "<u4").tobytes())
            at = m.end()
        return b"".join([*parts, *self._plain(text[at:])])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Ids that the vocabulary lacks are left out."""
        try:
            return " ".join(map(self.string.__getitem__, ids))
        except KeyError:
            return " ".join(s for i in ids if (s := self.string.get(i)) is not None)


@lru_cache(maxsize=4)
def codec(path: str, memory: int = MEMORY) -> BpeCodec:
    return BpeCodec(path, memory)


def _id_lists(rows: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(r) >> 2 for r in rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(rows), "<i4")))


def encoded(text: Column, path: str | None = None) -> Column:
    """array<int> of the ids of each whole text. A null text has no ids."""

    @F.arrow_udf("array<int>")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path or default_path())
        for part in parts:
            yield _id_lists([c.encode_bytes(t) for s in slices(part) for t in s])

    return ids(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of each array of ids; of a null array, the empty text."""

    @F.arrow_udf("string")
    def texts(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path or default_path())
        for part in parts:
            rows = part.to_pylist() if len(part) < 64 else (x.as_py() for x in part)
            yield pa.array([c.decode(x or []) for x in rows], pa.string())

    return texts(ids)


def round_trip(text: Column, path: str | None = None) -> Column:
    """struct<ids array<int>, decoded string> of each whole text: encoded, then decoded from those ids."""

    @F.arrow_udf("ids array<int>, decoded string")
    @frugal
    def both(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _round_trips(codec(path or default_path()), parts)

    return both(text)


def _round_trips(c: BpeCodec, parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """An array for each slice of ``ROUND_TRIP_BYTES``, so that results take as little room as texts, here and in the JVM."""
    for part in parts:
        if not len(part):
            yield pa.StructArray.from_arrays([_id_lists([]), pa.array([], pa.string())], names=["ids", "decoded"])
        for s in slices(part, ROUND_TRIP_BYTES):
            rows, texts = [], []
            for t in s:
                rows.append(c.encode_bytes(t))
                texts.append(c.decode(np.frombuffer(rows[-1], "<u4").tolist()))
            yield pa.StructArray.from_arrays([_id_lists(rows), pa.array(texts, pa.string())], names=["ids", "decoded"])


DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip_digest(text: Column, path: str | None = None, memory: int = MORE_MEMORY) -> Column:
    """struct<n_tokens, ids_sha256, decoded_sha256> of each whole text: encoded, then decoded from those ids."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c, sha = codec(path or default_path(), memory), hashlib.sha256
        for part in parts:
            n, ids_sha, text_sha = [], [], []
            for s in slices(part):
                for t in s:
                    ids = c.encode_bytes(t)
                    n.append(len(ids) >> 2)
                    ids_sha.append(sha(ids).hexdigest())
                    text_sha.append(sha(c.decode(np.frombuffer(ids, "<u4").tolist()).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], fields=list(DIGEST))

    return digest(text)


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no tokens (the digests are those of no bytes); repeated rows give repeated results; other
    columns are not looked at; an empty table gives an empty result. The work is a narrow map: no shuffle, and memory
    bounded by a slice of texts and the word memory.
    """
    return docs.select(F.col(id_col).alias("doc_id"), round_trip_digest(F.col(text_col), path).alias("d")).select(
        "doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256"
    )
