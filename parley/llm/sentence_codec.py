"""SentencePiece encoding and decoding with source offsets: every piece knows the bytes of the text that it stands for."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import frugal, slices

#: Segments whose pieces are remembered, and the characters of one at most; the memory is emptied when full.
MEMORY, REMEMBERED = 1_500_000, 60
#: Up to so many symbols the next merge is looked for by a scan; beyond, by a queue.
SCANNED = 40
#: The mark of a space in normalised text.
MARK = "▁"
#: Fixed values of the model file: kinds of pieces, the kind of model, what stands for a byte that is no text.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
LOST = "�"
#: Marks before which a segment of letters may end, where the vocabulary allows it.
CUTS, LETTERS = ".,;:!?", "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at, value, shift = at + 1, value | (b & 127) << shift, shift + 7
            if b < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, message[at : at + size]
        at += size


class CharMap:
    """A compiled character map: a double array over the bytes of the sources, and the targets. ``longest`` gives the
    target of the longest source that a text has at a place."""

    def __init__(self, compiled: bytes):
        size = struct.unpack("<I", compiled[:4])[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.targets = compiled[4 + size :]
        #: whether a source goes on behind, or into, a space: then words cannot be normalised one by one
        self.over_spaces = bool(self.units) and self._over_spaces()
        self._words: dict[bytes, tuple[bytes, bytes]] = {}

    @staticmethod
    def _base(unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    def _over_spaces(self) -> bool:
        units = np.array(self.units, np.int64)
        nodes, depth = self._base(units[:1]), 0
        while len(nodes):
            found = []
            for b in range(256):
                child = nodes ^ b
                child = child[child < len(units)]
                child = child[(units[child] & 0x800000FF) == b]
                if b == 32 and depth and len(child):
                    return True
                if b == 32 and not depth and any(self._child(int(c), x) is not None for c in child for x in range(1, 256)):
                    return True
                found.append(child ^ self._base(units[child]))
            nodes, depth = np.unique(np.concatenate(found)), depth + 1
        return False

    def _child(self, at: int, b: int) -> int | None:
        child = at ^ self._base(self.units[at]) ^ b
        return child if child < len(self.units) and self.units[child] & 0x800000FF == b else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes of the source, target), or None."""
        units, found = self.units, None
        node = self._base(units[0])
        for i in range(at, len(text)):
            b = text[i]
            node ^= b
            if node >= len(units) or units[node] & 0x800000FF != b:
                break
            unit = units[node]
            node ^= self._base(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.targets[found[1] : self.targets.index(0, found[1])]

    def _walked(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(bytes taken, bytes given) from the beginning to the end of a text."""
        at = 0
        while at < len(text):
            step = self.longest(text, at) if self.units else None
            if step is None:
                n = 1 + (text[at] >= 0xC0) + (text[at] >= 0xE0) + (text[at] >= 0xF0)
                step = n, text[at : at + n]
            yield step
            at += step[0]

    def steps(self, text: bytes) -> tuple[np.ndarray, bytes]:
        """Two columns (bytes taken, bytes given) of the steps over a text, and what is given."""
        if not self.units or self.over_spaces:
            walked = [*self._walked(text)]
            return np.array([(n, len(x)) for n, x in walked], np.int64).reshape(-1, 2), b"".join(x for _, x in walked)
        rows, given = [], []
        for word in re.findall(rb" |[^ ]+", text):
            known = self._words.get(word)
            if known is None:
                walked = [*self._walked(word)]
                known = np.array([(n, len(x)) for n, x in walked], "<i8").tobytes(), b"".join(x for _, x in walked)
                if len(word) <= REMEMBERED:
                    if len(self._words) >= MEMORY:
                        self._words.clear()
                    self._words[word] = known
            rows.append(known[0])
            given.append(known[1])
        return np.frombuffer(b"".join(rows), "<i8").reshape(-1, 2), b"".join(given)


class SentenceCodec:
    """A BPE model file with byte fallback. ``encode`` gives the ids of a text and the bytes of the text that each stands
    for, without begin or end; ``decode`` gives the text of ids. Texts are valid Unicode without lone surrogates.

    Pieces never go on from a character into a space mark, so segments (marks and what follows) are merged one by one
    and remembered."""

    def __init__(self, path: str | None = None, model: bytes | None = None, memory: int = MEMORY):
        if model is None:
            with open(path or default_path(), "rb") as f:
                model = f.read()
        pieces, trained, rules, undone = [], {}, {}, {}
        for number, value in _fields(model):
            if number == 1:
                p = dict(_fields(value))
                pieces.append((p[1].decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, NORMAL)))
            elif number in (2, 3, 5):
                {2: trained, 3: rules, 5: undone}[number].update(_fields(value))
        kinds = {k for _, _, k in pieces}
        if trained.get(3, 1) != BPE or not trained.get(35) or sum(k == BYTE for _, _, k in pieces) != 256 or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or undone.get(2) or trained.get(24) or not rules.get(5, 1):
            raise ValueError(f"{path}: not a BPE model of normal, control and all byte pieces with leading space marks")
        #: text -> id, and text -> order: the piece of the highest score is merged first
        self.pieces = {t: i for i, (t, _, k) in enumerate(pieces) if k == NORMAL}
        self.order = {t: -s for t, s, k in pieces if k == NORMAL}
        self.kind = [k for _, _, k in pieces]
        self.text = [t for t, _, _ in pieces]
        self.unknown = self.kind.index(UNKNOWN)
        self.unknown_surface = trained.get(44, b" \xe2\x81\x87 ").decode()
        named = {t: i for i, (t, _, k) in enumerate(pieces) if k == BYTE}
        self.byte = [named.get(f"<0x{b:02X}>") for b in range(256)]
        self.of_byte = {i: b for b, i in enumerate(self.byte) if i is not None}
        self.map = CharMap(rules.get(2, b""))
        self.prefix, self.squeezed = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        normal = [*self.pieces]
        crossing = any(MARK in t.lstrip(MARK) for t in normal)
        #: behind a letter and before these, no piece goes on: segments end there
        apart = "".join(m for m in CUTS if not any(re.search(f"[{LETTERS}]{re.escape(m)}", t) for t in normal))
        inner = f"[{LETTERS}]+(?=[{apart}])" if apart else r"(?!)"
        #: a line break without a piece stands alone
        alone = "" if any("\n" in t for t in normal) else "\n"
        self._word = re.compile(r"(?s:.+)" if crossing else f"{MARK}*[^{MARK}]+|{MARK}+")
        self._segment = re.compile(r"(?s:.+)" if crossing else f"{MARK}*{inner}|{MARK}*[^{MARK}{alone}]+|{MARK}+" + (r"|\n" if alone else ""))
        self._memory = memory
        self._known: dict[str, bytes] = {}
        self.decimal = [*map(str, range(len(pieces)))]
        self._size = np.array([len(t.encode()) if k == NORMAL else k == BYTE and self.of_byte[i] < 128 for i, (t, _, k) in enumerate(pieces)], np.int64)
        self._value = np.array([self.of_byte.get(i, 0) for i in range(len(pieces))], np.uint8)
        # what an id gives where it stands: an ASCII byte is a character of its own
        self._plain = [t.replace(MARK, " ") for t in self.text]
        for i, k in enumerate(self.kind):
            if k == CONTROL:
                self._plain[i] = ""
            elif k == UNKNOWN:
                self._plain[i] = self.unknown_surface
            elif k == BYTE and self.of_byte[i] < 128:
                self._plain[i] = chr(self.of_byte[i])
        self._high = np.array([k == BYTE and self.of_byte[i] >= 128 for i, k in enumerate(self.kind)])

    # --- normalisation -----------------------------------------------------------------------------------------------

    def normalised(self, text: str) -> tuple[str, np.ndarray | None]:
        """The text under the character map with marks for spaces, and for each of its bytes, and for its end, the byte of
        the source; None where that follows from lengths: all characters as they are, only spaces replaced."""
        if not self.map.units and not self.squeezed and MARK not in text:
            return ((MARK if self.prefix else "") + text.replace(" ", MARK), None) if text else ("", None)
        return self._aligned(text)

    def _aligned(self, text: str) -> tuple[str, np.ndarray]:
        source = text.encode("utf-8")
        steps, given = self.map.steps(source)
        starts = np.append(0, np.cumsum(steps[:, 0]))
        # the source place of each byte given
        at = np.repeat(starts[:-1], steps[:, 1])
        data = np.frombuffer(given, np.uint8)
        if self.squeezed:
            space = data == 32
            first = np.append(True, space[:-1])
            keep = ~(space & first)
            if (~space).any():
                stop = np.flatnonzero(~space)[-1] + 1
                end = int(at[stop]) if stop < len(at) else int(starts[-1])
                keep[stop:] = False
            else:
                return "", np.zeros(1, np.int64)
            data, at = data[keep], at[keep]
        else:
            end = int(starts[-1])
        if not len(data):
            return "", np.zeros(1, np.int64)
        size = np.where(data == 32, 3, 1)
        at = np.repeat(at, size)
        out = data.tobytes().decode("utf-8").replace(" ", MARK)
        if self.prefix:
            out, at = MARK + out, np.append(np.repeat(at[:1], 3), at)
        return out, np.append(at, end)

    # --- encoding ----------------------------------------------------------------------------------------------------

    def _merged(self, symbols: list[str]) -> list[str]:
        """The pair of the highest score is merged first, of equal ones the first."""
        order, never = self.order.get, float("inf")
        scores = [order(a + b, never) for a, b in zip(symbols, symbols[1:])]
        while scores and (best := min(scores)) < never:
            i = scores.index(best)
            symbols[i] += symbols.pop(i + 1)
            del scores[i]
            if i < len(scores):
                scores[i] = order(symbols[i] + symbols[i + 1], never)
            if i:
                scores[i - 1] = order(symbols[i - 1] + symbols[i], never)
        return symbols

    def _merged_by_queue(self, symbols: list[str]) -> list[str]:
        """The same for many symbols. The queue holds (order, position); an entry is stale once either of its symbols has
        changed."""
        n, order = len(symbols), self.order
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(p, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (p := order.get(symbols[i] + symbols[i + 1])) is not None]
        heapify(queue)
        while queue:
            _, i, left, right = heappop(queue)
            j = after[i]
            if j < 0 or symbols[i] != left or symbols[j] != right:
                continue
            both = left + right
            symbols[i], symbols[j] = both, ""
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (p := order.get(both + symbols[k])) is not None:
                    heappush(queue, (p, i, both, symbols[k]))
            if (h := before[i]) >= 0 and (p := order.get(symbols[h] + both)) is not None:
                heappush(queue, (p, h, symbols[h], both))
        return [s for s in symbols if s]

    def _remembered(self, text: str, ids: bytes) -> bytes:
        if len(text) <= REMEMBERED:
            if len(self._known) >= self._memory:
                self._known.clear()
            self._known[text] = ids
        return ids

    def _new_segment(self, segment: str) -> bytes:
        ids = []
        for s in (self._merged if len(segment) <= SCANNED else self._merged_by_queue)([*segment]):
            p = self.pieces.get(s)
            if p is not None:
                ids.append(p)
            else:
                ids += [self.byte[x] for x in s.encode("utf-8")]
        return self._remembered(segment, struct.pack(f"<{len(ids)}I", *ids))

    def _new_word(self, word: str) -> bytes:
        """The ids of a word, with the marks before it, by its segments."""
        segments = self._segment.findall(word)
        if len(segments) == 1:
            return self._new_segment(word)
        return self._remembered(word, b"".join([self._known.get(s) or self._new_segment(s) for s in segments]))

    def _sizes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of normalised text by id; of a character written in bytes, the last stands for all."""
        size = self._size[ids]
        if (high := self._high[ids]).any():
            place = np.flatnonzero(high & (self._value[ids] >= 0xC0))
            n = 2 + (self._value[ids[place]] >= 0xE0) + (self._value[ids[place]] >= 0xF0)
            size[place + n - 1] = n
        return size

    def _words(self, text: str) -> list[bytes]:
        known, new = self._known.get, self._new_word
        return [known(w) or new(w) for w in self._word.findall(text)]

    def encode_parts(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first byte, byte behind the last) of the pieces; of a null text, none."""
        z, at = self.normalised(text) if text else ("", None)
        ids = np.frombuffer(b"".join(self._words(z)), "<u4")
        size = self._sizes(ids)
        stop = np.cumsum(size)
        start = stop - size
        if at is not None:
            start, stop = at[start], at[stop]
        elif len(ids):
            stop = self._by_marks(z, stop)
            # without a character map a piece begins where the one before it ends, or, in a character's bytes, with it
            start = np.append(0, stop[:-1])
        return ids, start, stop

    def _by_marks(self, z: str, place: np.ndarray) -> np.ndarray:
        """Places of the source: a mark is three bytes for one of the source, the one before the text three for none."""
        raw = np.frombuffer(z.encode("utf-8"), np.uint8)
        mark = np.flatnonzero(raw[:-2] == 0xE2) if len(raw) > 2 else np.zeros(0, np.int64)
        mark = mark[(raw[mark + 1] == 0x96) & (raw[mark + 2] == 0x81)]
        n = np.searchsorted(mark, place, "left")
        return place - 2 * n - ((n > 0) & self.prefix)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_parts(text)[0].tolist()

    # --- decoding ----------------------------------------------------------------------------------------------------

    def _spread(self, ids: list[int]) -> str:
        """The text of ids among which are bytes from 128 on: those in a row are read as UTF-8, a wrong byte by itself."""
        out, held = [], bytearray()

        def flush() -> None:
            rest = bytes(held)
            while rest:
                n = 1 + (rest[0] >= 0xC0) + (rest[0] >= 0xE0) + (rest[0] >= 0xF0)
                try:
                    out.append(rest[:n].decode("utf-8"))
                except UnicodeDecodeError:
                    n = 1
                    out.append(LOST)
                rest = rest[n:]
            held.clear()

        for i in ids:
            b = self.of_byte.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                flush()
            out.append(self._plain[i])
        if held:
            flush()
        return "".join(out)

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """Ids outside the vocabulary raise IndexError. The mark that stands before a text is left out."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.text)):
            raise IndexError("an id outside the vocabulary")
        first = cut = 0
        if self.prefix or self.squeezed:
            # the mark goes from the first pieces, up to one that gave text or had it
            while first < len(ids):
                i = int(ids[first])
                if self.kind[i] == CONTROL:
                    first += 1
                    continue
                if self.kind[i] not in (BYTE, UNKNOWN) and self.text[i].startswith(MARK):
                    if self.squeezed and self.text[i] == MARK:
                        first += 1
                        continue
                    cut = 1
                break
        high = self._high[ids].any()
        listed = ids.tolist()
        text = self._spread(listed[first:]) if high else "".join(map(self._plain.__getitem__, listed[first:]))
        return text[cut:]


@lru_cache(maxsize=4)
def codec(path: str | None, memory: int = MEMORY) -> SentenceCodec:
    return SentenceCodec(path, memory=memory)


def _lists(rows: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rows).astype(kind) if rows else np.zeros(0, kind)))


def encoded(text: Column, path: str | None = None) -> Column:
    """struct<ids array<int>, starts array<bigint>, stops array<bigint>> of each whole text: piece ids and the bytes of the
    text, in UTF-8, that each stands for. A null text has none."""

    @F.arrow_udf("ids array<int>, starts array<bigint>, stops array<bigint>")
    @frugal
    def pieces(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path)
        for part in parts:
            rows = [c.encode_parts(t) for s in slices(part) for t in s]
            columns = [_lists([r[k] for r in rows], kind) for k, kind in enumerate((np.int32, np.int64, np.int64))]
            yield pa.StructArray.from_arrays(columns, names=["ids", "starts", "stops"])

    return pieces(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of each array of ids; of a null array, the empty text. An id that the vocabulary lacks is an error."""

    @F.arrow_udf("string")
    @frugal
    def texts(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path)
        for part in parts:
            yield pa.array([c.decode(x.as_py() or []) for x in part], pa.string())

    return texts(ids)


DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("spans_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip_digest(text: Column, path: str | None = None) -> Column:
    """struct<n_tokens, ids_sha256, spans_sha256, decoded_sha256> of each whole text: encoded, then decoded from those ids."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, spans_sha256 string, decoded_sha256 string")
    @frugal
    def digest(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c, sha = codec(path), lambda raw: hashlib.sha256(raw).hexdigest()
        for part in parts:
            rows = []
            for s in slices(part):
                for t in s:
                    ids, start, stop = c.encode_parts(t)
                    decimals = ",".join(map(c.decimal.__getitem__, ids.tolist()))
                    spans = np.stack([start, stop], 1).astype("<i8").tobytes()
                    rows.append((len(ids), sha(decimals.encode()), sha(spans), sha(c.decode(ids).encode("utf-8"))))
            columns = [*zip(*rows)] or [()] * 4
            yield pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(columns, DIGEST)], fields=list(DIGEST))

    return digest(text)


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_tokens, ids_sha256, decoded_sha256, spans_sha256 (first byte and byte behind the last of each
    piece, as little-endian 64-bit integers).

    Null and empty texts have no tokens (the digests are those of no bytes); repeated rows give repeated results; ids may be
    null or of any type; other columns are not looked at; an empty table gives an empty result. The work is a narrow
    map: no shuffle, and memory bounded by a slice of texts and the memory of segments.
    """
    return docs.select(F.col(id_col).alias("doc_id"), round_trip_digest(F.col(text_col), path).alias("d")).select(
        "doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256", "d.spans_sha256"
    )
