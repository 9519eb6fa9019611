"""Byte-level BPE encoding and decoding over a contiguous rank array.

A word (a piece of the pre-tokenisation pattern) is held as its part
boundaries and, beside them, the rank of each pair of neighbouring parts. The
least rank is found by scanning the array, its boundary is deleted, and the
two neighbouring ranks are looked up anew, until no pair has a rank. For short
words scanning a small contiguous array beats any linked structure. Pieces of
over ``LONG`` bytes (one run of letters or blanks may fill a whole text) use a
heap of (rank, place) instead, which makes the same merges in the same order.

The vocabulary is read from a tokenizer file whose path is a parameter; each
Python worker reads it once. Pieces met lately are kept in a bounded cache.

Defined results: a null text is empty and has no tokens; the strings of added
tokens inside a text are those tokens, as the file says; any Unicode text
round-trips; rows are independent; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pre-tokenisation pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 256
CACHE = 200_000
_NONE = 1 << 60


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file: printable ones themselves, the rest 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] \
                or spec["normalizer"] or model["dropout"] or model.get("ignore_merges") or model["byte_fallback"]:
            raise ValueError(f"{path} isn't a plain byte-level BPE file")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens with conditions")
        vocab, byte = model["vocab"], byte_characters()
        self.size = max([*vocab.values(), *added.values()]) + 1
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        for token, i in added.items():
            self.bytes[i] = token.encode()
        self.single = [vocab[c] for c, _ in sorted(byte.items(), key=lambda x: x[1])]
        # rank of a pair of neighbouring parts, and the part they become
        self.ranks: dict[int, int] = {}
        self.becomes: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] * self.size + vocab[b]] = rank
            self.becomes.append(vocab[a + b])
        self.added = added
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.piece = regex.compile(PATTERN)
        self.known: dict[str, list[int]] = {}

    def merge_short(self, data: bytes) -> list[int]:
        """Scan the rank array for the minimum, delete that boundary, refresh the neighbours."""
        ranks, size, becomes = self.ranks, self.size, self.becomes
        bounds = list(range(len(data) + 1))
        parts = [self.single[b] for b in data]
        rank = [ranks.get(a * size + b, _NONE) for a, b in zip(parts, parts[1:])]
        while rank:
            least = min(rank)
            if least == _NONE:
                break
            i = rank.index(least)
            parts[i] = becomes[least]
            del bounds[i + 1], parts[i + 1], rank[i]
            if i < len(rank):
                rank[i] = ranks.get(parts[i] * size + parts[i + 1], _NONE)
            if i:
                rank[i - 1] = ranks.get(parts[i - 1] * size + parts[i], _NONE)
        assert len(bounds) == len(parts) + 1
        return parts

    def merge_long(self, data: bytes) -> list[int]:
        """The same merges in the same order with a heap of (rank, place)."""
        ranks, size = self.ranks, self.size
        parts = [self.single[b] for b in data]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(parts[i] * size + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else n
            if j >= n or ranks.get(parts[i] * size + parts[j]) != r:
                continue  # one of its parts has been merged meanwhile
            parts[i], parts[j] = self.becomes[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := ranks.get(parts[i] * size + parts[after[j]])) is not None:
                    heapq.heappush(heap, (x, i))
            if before[i] >= 0 and (x := ranks.get(parts[before[i]] * size + parts[i])) is not None:
                heapq.heappush(heap, (x, before[i]))
        return [p for p in parts if p >= 0]

    def _plain(self, text: str, out: list[int]) -> None:
        known = self.known
        for piece in self.piece.findall(text):
            ids = known.get(piece)
            if ids is None:
                data = piece.encode("utf-8")
                ids = self.merge_short(data) if len(data) <= LONG else self.merge_long(data)
                if len(data) <= LONG:
                    if len(known) >= CACHE:
                        known.clear()
                    known[piece] = ids
            out += ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        if self.special is None:
            self._plain(text, out)
            return out
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                out.append(self.added[part])
            elif part:
                self._plain(part, out)
        return out

    def decode(self, ids: list[int]) -> str:
        table = self.bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def _over(rows: DataFrame, run, id_col: str, in_col: str, out: str) -> DataFrame:
    """``run`` over (id, in_col); ids pass through Python as strings, which keeps nulls and large numbers."""
    kind = rows.schema[id_col].dataType
    return (rows.select(rows[id_col].cast("string").alias("id"), rows[in_col].alias("x")).mapInPandas(run, f"id string, {out}")
            .withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col))


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        try:
            for pdf in batches:
                yield pd.DataFrame({"id": pdf["id"], "ids": [bpe.encode(t or "") for t in pdf["x"]]})
        finally:
            bpe.known.clear()  # as in ``digests``
    return _over(docs, run, id_col, text_col, "ids array<int>")


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of every row of ids; null ids are no tokens."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "text": ["" if x is None else bpe.decode(x) for x in pdf["x"]]})
    return _over(tokens, run, id_col, ids_col, "text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): each text is encoded and its ids decoded in one pass; ``keep_ids`` adds ids array<int>."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        decimal = [str(i) for i in range(bpe.size)]
        try:
            for pdf in batches:
                for k in range(0, len(pdf), 500):  # bounded output batches
                    part = pdf.iloc[k:k + 500]
                    made = []
                    for text in part["x"]:
                        ids = bpe.encode(text or "")
                        made.append((len(ids), hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest(),
                                     hashlib.sha256(bpe.decode(ids).encode()).hexdigest(), np.array(ids, dtype=np.int32) if keep_ids else None))
                    out = pd.DataFrame({"id": part["id"].to_list(), **{c: [m[i] for m in made] for i, c in enumerate(columns)}})
                    yield out if keep_ids else out.drop(columns="ids")
        finally:
            bpe.known.clear()  # a worker lives on, and with it its pieces, through tasks that need the memory
    columns = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")
    return _over(docs, run, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)
