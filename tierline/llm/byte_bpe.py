"""Byte-level BPE over rank files, merged in length-bucketed numpy matrices.

The pieces of the pre-tokenisation pattern that a part of the texts holds are
made distinct, and those not met lately are laid into padded matrices of
tokens, one row a piece, one matrix a bucket of lengths. In each round every row
merges its leftmost pair of least rank: the ranks of neighbouring tokens lie in
a second matrix, the merged pair's column is deleted from each row (which
compacts both matrices by one column), the two ranks beside it are looked up
anew, and rows without a pair left retire. Pairs are looked up in an
open-addressed hash table of numpy arrays, all at once.

A row of one long piece (a run of letters may fill a whole text) would cost its
length squared, so pieces of over ``LONG`` bytes make the same merges in the
same order over a heap of (rank, place).

Ranks decide as in the rank-file libraries: a piece that is a token itself is
that token, and two neighbours merge if their bytes together are a token,
whose rank is its id. The file and the pattern are parameters; each Python
worker reads the file once. Ids of pieces met lately are kept up to
``CACHE_BYTES``; texts are split and encoded in parts of about ``PART``
characters, longer texts piece by piece, so that memory stays bounded.

Layout over the cluster: one pass, no exchange; ids of documents never pass
through Python. Defined results: a null text is empty and has no tokens; there
are no special tokens, their strings are ordinary text; any Unicode text
round-trips; rows are independent, so repeats and null ids change nothing; an
empty table gives an empty result; other columns are ignored. Decoding gives
bytes; null ids are no tokens, an id that isn't in the file raises.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 256
BUCKETS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, LONG)
CELLS = 1 << 19          # tokens of a matrix
PART = 1 << 19           # characters of the texts that are split together
CACHE_BYTES = 48 << 20
_OVERHEAD = 160          # bytes of two small objects and their place in a dictionary
_NONE = np.int32((1 << 31) - 1)


class Pairs:
    """Rank of a pair of tokens: open addressing over numpy arrays, linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        size = 1 << max(4, int(np.ceil(np.log2(max(1, 4 * len(rank))))))
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ranks = np.full(size, _NONE, dtype=np.int32)
        key = self._key(left, right)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = key[free]       # the last of those that share a slot stays
            self.ranks[slot[free]] = rank[free]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & int(self.mask)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        x = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) & self.mask).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` for pairs that don't merge and for padding (-1)."""
        out = np.full(left.shape, _NONE, dtype=np.int32)
        at = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        key = self._key(left.ravel()[at], right.ravel()[at])
        slot, flat = self._slot(key), out.ravel()
        while len(at):
            held = self.keys[slot]
            found = held == key
            flat[at[found]] = self.ranks[slot[found]]
            on = ~found & (held != -1)
            at, key, slot = at[on], key[on], (slot[on] + 1) & int(self.mask)
        return out


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"{path} lacks the bytes {missing}")
        self.ranks = ranks
        self.bytes: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        split = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.pairs = Pairs(*np.array(split, dtype=np.int64).reshape(-1, 3).T)
        self.piece = regex.compile(pattern)
        self.known: dict[str, bytes] = {}   # ids of a piece as little-endian 32-bit numbers
        self.held = 0

    def merge_matrix(self, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yield (row numbers, tokens) of the rows of a matrix padded by -1, as they come to have no pair left."""
        rows, ranks = np.arange(len(tokens)), self.pairs.rank(tokens[:, :-1], tokens[:, 1:])
        while len(rows):
            if not ranks.shape[1]:
                yield rows, tokens
                return
            best = ranks.argmin(axis=1)     # the leftmost of least rank
            least = ranks[np.arange(len(rows)), best]
            on = least != _NONE
            if not on.all():
                yield rows[~on], tokens[~on]
                rows, tokens, ranks, best, least = rows[on], tokens[on], ranks[on], best[on], least[on]
            n, width = tokens.shape
            each = np.arange(n)
            tokens[each, best] = least      # a token's rank is its id
            keep = np.ones((n, width), dtype=bool)
            keep[each, best + 1] = False
            tokens = tokens[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), dtype=bool)
            keep[each, best] = False
            ranks = ranks[keep].reshape(n, width - 2)
            for place in (best - 1, best):  # the ranks left and right of the merged token
                ok = (place >= 0) & (place < width - 2)
                i, p = each[ok], place[ok]
                ranks[i, p] = self.pairs.rank(tokens[i, p], tokens[i, p + 1])

    def merge_long(self, data: bytes) -> list[int]:
        """The same merges of one long piece, with a heap of (rank, place)."""
        ranks, parts = self.ranks, [bytes([b]) for b in data]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or ranks.get(parts[i] + parts[j]) != r:
                continue                    # one of its parts has been merged meanwhile
            parts[i], parts[j] = parts[i] + parts[j], b""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n and (x := ranks.get(parts[left] + parts[after[left]])) is not None:
                    heapq.heappush(heap, (x, left))
        return [ranks[p] for p in parts if p]

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids of ``pieces`` into ``known``."""
        known, buckets = self.known, {w: [] for w in BUCKETS}
        for piece in pieces:
            data = piece.encode("utf-8")
            whole = self.ranks.get(data)
            if whole is not None:
                known[piece] = whole.to_bytes(4, "little")
            elif len(data) > LONG:
                known[piece] = np.array(self.merge_long(data), dtype="<u4").tobytes()
            else:
                buckets[next(w for w in BUCKETS if len(data) <= w)].append((piece, data))
        for width, held in buckets.items():
            for start in range(0, len(held), max(1, CELLS // width)):
                part = held[start:start + max(1, CELLS // width)]
                raw = np.frombuffer(b"".join(d.ljust(width, b"\0") for _, d in part), dtype=np.uint8).reshape(-1, width)
                inside = np.arange(width) < np.array([len(d) for _, d in part])[:, None]
                for rows, tokens in self.merge_matrix(np.where(inside, self.single[raw], np.int32(-1))):
                    count, flat = (tokens >= 0).sum(axis=1), tokens.astype("<u4")
                    for row, n, ids in zip(rows.tolist(), count.tolist(), flat):
                        known[part[row][0]] = ids[:n].tobytes()
        self.held += sum(len(p) + len(known[p]) + _OVERHEAD for p in pieces)

    def _ids(self, pieces: list[str]) -> bytes:
        if self.held > CACHE_BYTES:
            self.known, self.held = {}, 0
        if new := set(pieces).difference(self.known):
            self._learn(new)
        return b"".join(map(self.known.__getitem__, pieces))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out, k = [], 0
        while k < len(texts):
            if len(texts[k]) > PART:        # a long text by itself, some pieces at a time
                found, ids = (m.group() for m in self.piece.finditer(texts[k])), []
                while pieces := list(islice(found, PART // 8)):
                    ids.append(self._ids(pieces))
                out.append(b"".join(ids))
                k += 1
                continue
            end, size = k, 0
            while end < len(texts) and len(texts[end]) <= PART and size <= PART:
                size += len(texts[end])
                end += 1
            split = [self.piece.findall(t) for t in texts[k:end]]
            if self.held > CACHE_BYTES:
                self.known, self.held = {}, 0
            if new := set().union(*split).difference(self.known):
                self._learn(new)            # the new pieces of all these texts in the same matrices
            out += [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]
            k = end
        return out

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes
        try:
            return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
        except KeyError as unknown:
            raise ValueError(f"id {unknown} isn't in the rank file") from None


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _over(rows: DataFrame, run, id_col: str, in_col: str, kind: str) -> DataFrame:
    """id_col and the fields of ``kind`` that ``run`` (a list of values to a list of tuples) makes of ``in_col``."""
    names = [field.split()[0] for field in kind.split(", ")]

    @F.pandas_udf(f"struct<{', '.join(f.replace(' ', ':', 1) for f in kind.split(', '))}>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in batches:
            made = run(values.tolist())
            yield pd.DataFrame({c: [m[i] for m in made] for i, c in enumerate(names)})

    made = rows.select(rows[id_col].alias("id"), udf(rows[in_col]).alias("made"))
    return made.select(F.col("id").alias(id_col), *[F.col("made").getField(c).alias(c) for c in names])


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) of every text."""
    def run(texts: list) -> list[tuple]:
        return [(np.frombuffer(x, dtype="<u4").astype(np.int32),) for x in load(path, pattern).encode([t or "" for t in texts])]
    return _over(docs, run, id_col, text_col, "ids array<int>")


def decoded(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, data binary): the bytes of every row of ids."""
    def run(ids: list) -> list[tuple]:
        bpe = load(path, pattern)
        return [(bpe.decode(b"" if x is None else np.asarray(x).astype("<u4").tobytes()),) for x in ids]
    return _over(tokens, run, id_col, ids_col, "data binary")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): each text is encoded and its ids decoded in one pass."""
    def run(texts: list) -> list[tuple]:
        bpe, out = load(path, pattern), []
        for start in range(0, len(texts), 500):     # the ids of some texts at a time
            for ids in bpe.encode([t or "" for t in texts[start:start + 500]]):
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
        return out
    return _over(docs, run, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string")
