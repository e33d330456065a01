"""Token counts by rank-synchronous array merging over ragged numpy arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.bpe_codec import SPACE, byte_symbols, require
from parley.llm.common import slices

#: Pre-tokens whose counts are remembered, and the characters of one at most; the memory is emptied when full, so it stays
#: bounded.
MEMORY, REMEMBERED = 600_000, 100
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
NO_RANK = np.int64(1 << 40)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TokenCounter:
    """Counts the tokens of texts under a byte-level BPE vocabulary read from a tokenizer JSON file.

    Pre-tokens of many texts are merged together: in each round every sequence finds its lowest-rank pair and merges
    all places of it, left to right; the number of rounds is that of the sequence with most merges.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        require(spec, [], ["ByteLevel"], path)
        vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        keys, first = np.unique(keys, return_index=True)
        self.keys, self.ranks = keys, first.astype(np.int64)
        self.made = np.array([vocab["".join(pairs[i])] for i in first], np.int64)
        self.byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._piece = regex.compile(PIECE)
        self._known: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, made symbol) of pairs; NO_RANK where they do not merge."""
        pair = left << 32 | right
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == pair, self.ranks[at], NO_RANK), self.made[at]

    def merged_counts(self, pieces: list[bytes]) -> np.ndarray:
        """The number of symbols that each byte sequence has in the end. A round looks up only the pairs that the one
        before changed, so a long sequence with many rounds costs little more than its symbols a round."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = size.copy()
        symbols = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), size)
        keep = size[owner] > 1
        symbols, owner = symbols[keep], owner[keep]
        if not len(symbols):
            return out
        # of each place: the pair with the next symbol, the last one of a sequence has none
        rank, made = self._ranks(symbols, np.append(symbols[1:], 0))
        rank[np.append(owner[1:] != owner[:-1], True)] = NO_RANK
        while len(symbols):
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, start)
            lowest_at = np.repeat(lowest, np.diff(np.append(start, len(symbols))))
            place = np.flatnonzero((rank == lowest_at) & (rank < NO_RANK))
            # in a run of overlapping places (one symbol repeated) every second one is merged, from the left
            if len(place) > 1 and (near := np.diff(place) == 1).any():
                head = np.maximum.accumulate(np.where(np.append(True, ~near), np.arange(len(place)), 0))
                place = place[(np.arange(len(place)) - head) % 2 == 0]
            symbols[place] = made[place]
            out -= np.bincount(owner[place], minlength=len(out))
            merged = np.zeros(len(symbols), bool)
            merged[place] = True
            # a sequence with no pair left is done
            keep = lowest_at < NO_RANK
            keep[place + 1] = False
            symbols, owner, rank, made, merged = symbols[keep], owner[keep], rank[keep], made[keep], merged[keep]
            new = np.flatnonzero(merged)
            new = np.union1d(new, new[new > 0] - 1)
            follows = np.minimum(new + 1, len(symbols) - 1)
            rank[new], made[new] = self._ranks(symbols[new], symbols[follows])
            rank[new[(follows == new) | (owner[follows] != owner[new])]] = NO_RANK
        return out

    def count_all(self, texts: list[str | None]) -> list[int]:
        """Token counts of texts; a null text has none. Special strings inside a text are one token each."""
        known, find, special = self._known, self._piece.findall, self._special
        if len(known) >= MEMORY:
            known.clear()
        plain: list[list[str]] = []
        extra: list[int] = []
        for t in texts:
            if t and special is not None and special.search(t):
                parts = special.split(t)
                plain.append([p for part in parts for p in find(part)])
                extra.append(len(parts) - 1)
            else:
                plain.append(find(t) if t else [])
                extra.append(0)
        new = list({p for pieces in plain for p in pieces if p not in known})
        if new:
            counts = dict(zip(new, self.merged_counts([p.encode("utf-8", "surrogatepass") for p in new]).tolist()))
            long = {p: n for p, n in counts.items() if len(p) > REMEMBERED}
            known.update(counts)
        out = [sum(map(known.__getitem__, pieces)) + more for pieces, more in zip(plain, extra)]
        for p in long if new else ():
            del known[p]
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_count(text: Column, path: str | None = None) -> Column:
    """long: the number of tokens of each whole text."""

    @F.arrow_udf("long")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = counter(path or default_path())
        for part in parts:
            yield pa.array([n for s in slices(part, 1 << 20) for n in c.count_all(s)], pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, limit: int = 1024, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts count 0 and 0; repeated rows give repeated results; other columns are not looked at; an empty
    table gives an empty result. A narrow map: no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), token_count(F.col(text_col), path).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
