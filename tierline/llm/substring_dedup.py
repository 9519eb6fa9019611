"""Substring dedup: repeated paragraphs are found by MinHash bands, verified, clustered, and cut out of all documents but the first.

Three kinds of paragraphs (words compare with A-Z in lower case; ``MIN_WORDS`` words at least):

* Every stretch of ``MIN_WORDS`` words, wherever it starts: a passage may stand
  in the middle of a line. Its band is one MinHash value, the least hash of its five-word
  shingles. Neighbouring stretches mostly share that value, so a document lists
  about one run of stretches per 23 words, yet equal stretches always collide.
  Collisions are verified by whole content (128-bit hashes of the words), first run by run: runs
  of equal words are one cluster. Only where a value has runs that differ, the
  stretches of one run of each kind are compared one by one.
* Every line, to find those that are alike but not equal: MinHash in ``BANDS``
  bands of ``ROWS`` values (two lines of similarity 0.75 miss each other with a chance of
  (1 - 0.75 ** 2) ** 16 = 2e-6), colliding lines verified by exact Jaccard on
  their shingle sets, clusters by connected components (``linking``).
* Every stretch that is alike but not equal, wherever it starts and however it is broken into lines.
  Stretches of similarity 0.75 differ in one place at most, so they share about half their words in a row. Of each such half
  one run of ``GRAM`` words is listed (the least hash, about one per 7 words). What shares a run with the
  least document that lists it is laid along that document, and a stretch counts if its first and last
  five words are there (up to ``DRIFT`` words off) and its shingles are similar enough.

A cluster stays in the document of least id that holds it; in all other
documents its words are cut. Whatever is cut thus stands somewhere in a document
that comes before. Stretches repeated only inside one document stay.

  A run may be common, and the document that lists it first hold no more than the run. So what is
  still uncut then is tried again, by the runs left over and by pairs of close ones: a
  pair stands in few documents besides those that share the passage.

Texts are read again only for documents that hold runs that differ, lines to be verified, or parts
alike that are not cut yet. A part stays if, of all its runs and pairs, each is held first by
a document that is not alike (recall on random edits and splits: see the tests).

Defined results: a null text is empty; ids stand for documents, rows with a
null id are left as they are; rows that repeat an id are cut alike (a document does not repeat itself); texts of
fewer than ``MIN_WORDS`` words are never cut; a copy loses its whole text; an
empty table gives an empty one; other columns are ignored
(``cuts``, ``trimmed``) or kept (``dedup``) whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.linking import similar
from tierline.llm.shared import SHINGLE, SIMILAR_PCT, as_long, by_hash, cut, cut_by, lowered, mix64, seeds, settled, shingles, word_hashes, word_places

MIN_WORDS = 50
BANDS, ROWS = 16, 2
GRAM = 12  # words of a run that parts alike are found by, at most
PAIRED = 4  # next runs that a run left over is paired with
PART_BYTES = 500_000  # of texts that are worked on together
DRIFT = 2  # words inserted or left out within a stretch
_HASHES = seeds(BANDS * ROWS, 2001)
_BAND_SEEDS = seeds(ROWS, 2101)
_STRETCH_SEEDS = seeds(2 * 256, 3001).reshape(2, 256)


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by windows of doubling width."""
    have = 1
    while 2 * have <= width:
        x, have = np.minimum(x[:-have], x[have:]), 2 * have
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:])


def joined_texts(texts) -> tuple[bytes, np.ndarray]:
    """Texts as one, a line break between them, and where each begins and the one after the last would."""
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    return b"\n".join(texts), at


def ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``sizes`` numbers from each of ``begin`` on."""
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Paragraphs:
    """The paragraphs of some texts, whose words lie in one array, so that each step is one operation over all of them."""

    def __init__(self, texts, min_words: int = MIN_WORDS):
        self.min_words = min_words
        data, bytes_at = joined_texts([lowered(t) for t in texts])
        self.hashes, starts = word_hashes(data)
        self.at = np.searchsorted(starts, bytes_at)  # the first word of each text, and the end
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.at))
        breaks = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == ord("\n"))
        self.ends = np.append(np.searchsorted(starts, breaks), len(starts))
        self.shingles = shingles(self.hashes) if len(self.hashes) >= SHINGLE else self.hashes[:0]

    def _within(self, size: int) -> np.ndarray:
        """Whether the ``size`` words from each word on are of one text."""
        return self.owner[:max(len(self.owner) - size + 1, 0)] == self.owner[size - 1:]

    def _split(self, at: np.ndarray) -> np.ndarray:
        """Where the places of each text begin in ``at``."""
        return np.searchsorted(at, self.at)

    def _sums(self, at: np.ndarray, size: int) -> np.ndarray:
        """Two hashes (2 x n) of the ``size`` words from each of ``at`` on."""
        sums = np.zeros((2, len(at)), dtype=np.uint64)
        for k, o in enumerate([*range(0, size - SHINGLE, SHINGLE), size - SHINGLE]):
            sums += self.shingles[at + o][None, :] * _STRETCH_SEEDS[:, k % 256, None] + np.uint64(k)
        return as_long(mix64(sums))

    def runs(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(least shingle, first start, last start, 128-bit digest of the words as two longs) of each run of stretches with one least shingle, by text."""
        if len(self.hashes) < self.min_words:
            return [(self.hashes[:0], self.hashes[:0], self.hashes[:0], np.zeros((0, 2), dtype=np.int64))] * (len(self.at) - 1)
        least, here = window_min(self.shingles, self.min_words - SHINGLE + 1), self._within(self.min_words)
        on = np.concatenate(([False], here[1:] & here[:-1] & (least[1:] == least[:-1]), [False]))  # a start goes on with the run of the one before
        first, last = np.flatnonzero(here & ~on[:-1]), np.flatnonzero(here & ~on[1:])
        data = self.hashes.tobytes()
        digests = b"".join(xxhash.xxh3_128_digest(data[8 * b:8 * (e + self.min_words)]) for b, e in zip(first.tolist(), last.tolist()))
        digests, cut_at = np.frombuffer(digests, dtype="<i8").reshape(-1, 2), self._split(first)
        return [(least[first[b:e]], first[b:e] - w, last[b:e] - w, digests[b:e]) for b, e, w in zip(cut_at, cut_at[1:], self.at)]

    def stretches(self, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, hash, other hash) of the stretches of some runs (text, first, last start), in order."""
        sizes = np.maximum(np.minimum(last, np.diff(self.at)[text] - self.min_words) - first + 1, 0)
        at = np.unique(ranges(self.at[text] + first, sizes))
        sums, text = self._sums(at, self.min_words), self.owner[at]
        return text, at - self.at[text], sums[0], sums[1]

    def lines(self, wanted: list[set[str]] | None = None) -> list[list[tuple[str, int, int, np.ndarray]]]:
        """(digest, first word, word after the last, shingle set) of the lines that are long enough, or of the ``wanted`` ones of these, by text."""
        out, data = [[] for _ in self.at[1:]], self.hashes.tobytes()
        begins = np.concatenate(([0], self.ends[:-1]))
        for k in np.flatnonzero(self.ends - begins >= self.min_words).tolist():
            begin, end = int(begins[k]), int(self.ends[k])
            text = int(self.owner[begin])
            digest = xxhash.xxh3_128_hexdigest(data[8 * begin:8 * end])
            if wanted is None or digest in wanted[text]:
                held = np.sort(self.shingles[begin:end - SHINGLE + 1])
                out[text].append((digest, begin - int(self.at[text]), end - int(self.at[text]), held[np.concatenate(([True], held[1:] != held[:-1]))]))
        return out

    def grams(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(hash, first word) of the least run of words in every half stretch, by text."""
        half = max(self.min_words // 2 - 1, 1)
        size = min(GRAM, half)
        width = half - size + 1
        if len(self.hashes) < self.min_words:
            return [(self.hashes[:0], np.zeros(0, dtype=np.int64))] * (len(self.at) - 1)
        grams = shingles(self.hashes, size)
        pad = np.zeros(width - 1, dtype=np.uint64)
        least = np.where(self._within(half), window_min(grams, width), np.uint64(0))
        long = np.diff(self.at) >= self.min_words
        at = np.flatnonzero((grams == ~window_min(~np.concatenate((pad, least, pad)), width)) & self._within(size) & long[self.owner[:len(grams)]])
        cut_at = self._split(at)
        owner = self.owner[at]
        order = np.lexsort((grams[at], owner))
        again = (grams[at][order][1:] == grams[at][order][:-1]) & (owner[order][1:] == owner[order][:-1])
        again = set(owner[order][1:][again].tolist())
        out = []
        for k, (b, e, w) in enumerate(zip(cut_at, cut_at[1:], self.at)):
            places = at[b:e]
            if k in again:  # what comes again at once is listed once per half stretch
                last, keep = {}, []
                for p, g in zip(places.tolist(), grams[places].tolist()):
                    if p - last.get(g, -half) >= half:
                        last[g] = p
                        keep.append(p)
                places = np.array(keep, dtype=np.int64)
            out.append((grams[places], places - w))
        return out


def alike_spans(a: np.ndarray, b: np.ndarray, lead: int, pct: int, min_words: int) -> list[tuple[int, int]]:
    """(begin, end) of words of ``a`` in stretches alike to ``b``, whose word k - lead lies beside word k."""
    if min(len(a), len(b)) < max(SHINGLE, min_words - DRIFT) or len(a) < min_words or min_words < SHINGLE:
        return []
    x, y = shingles(a), shingles(b)
    same = np.zeros(len(x), dtype=bool)
    for drift in range(-DRIFT, DRIFT + 1):
        off = drift - lead
        lo, hi = max(0, -off), min(len(x), len(y) - off)
        if lo < hi:
            same[lo:hi] |= x[lo:hi] == y[lo + off:hi + off]
    size = min_words - SHINGLE + 1
    sums = np.concatenate(([0], np.cumsum(same)))
    common = sums[size:] - sums[:-size]
    starts = np.flatnonzero((100 * common >= pct * (2 * size - common)) & same[:len(common)] & same[size - 1:])
    out: list[tuple[int, int]] = []
    for k in starts.tolist():
        if out and k <= out[-1][1]:
            out[-1] = (out[-1][0], k + min_words)
        else:
            out.append((k, k + min_words))
    return out


def line_bands(sets: list[np.ndarray]) -> np.ndarray:
    """The band keys of each set: (sets, BANDS), all sets hashed together."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.zeros((BANDS, len(sets)), dtype=np.uint64)
    for k in range(BANDS * ROWS):
        out[k // ROWS] += mix64(np.minimum.reduceat(flat * _HASHES[k], starts)) * _BAND_SEEDS[k % ROWS]
    return mix64(out).T


def _run(docs: DataFrame, columns: list[Column], make, out: str, kind) -> DataFrame:
    """``make(part)`` over parts of Arrow batches of some 500 KB of text; ids (``doc``) pass through Python as strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = _numpy(pc.fill_null(pc.binary_length(batch.column("text")), 0)).astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // PART_BYTES
            edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for begin, end in zip(edges, edges[1:]):
                if begin < end:
                    yield pa.RecordBatch.from_pydict(make(batch.slice(begin, end - begin)))
    return docs.select(F.col("doc").cast("string").alias("doc"), *columns).mapInArrow(run, f"doc string, {out}").withColumn("doc", F.col("doc").cast(kind))


def _numpy(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]


def _inside(column: pa.ListArray) -> tuple[np.ndarray, list[pa.Array]]:
    """The row that each struct of a column of lists stands in, and the fields of all structs."""
    sizes = _numpy(pc.fill_null(pc.list_value_length(column), 0))
    return np.repeat(np.arange(len(column)), sizes), column.flatten().flatten()


def _lists(sizes, values: pa.Array) -> pa.ListArray:
    """Lists of ``sizes`` values each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def _structs(**fields) -> pa.StructArray:
    return pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in fields.values()], names=list(fields))


def listed(docs: DataFrame, kind, min_words: int) -> DataFrame:
    """(doc, runs, grams, lines) of (doc, text)."""
    def make(part):
        made = Paragraphs(_texts(part), min_words)
        runs, lines, grams = made.runs(), made.lines(), made.grams()
        least, first, last, digests = (np.concatenate(x) for x in zip(*runs))
        gram, place = (np.concatenate(x) for x in zip(*grams))
        found = [x for row in lines for x in row]
        bands = as_long(np.ascontiguousarray(line_bands([x[3] for x in found]))).ravel() if found else np.zeros(0, dtype=np.int64)
        return {
            "doc": part.column("doc"),
            "runs": _lists([len(r[0]) for r in runs], _structs(least=as_long(least), first=first.astype(np.int32), last=last.astype(np.int32),
                                                               run=digests[:, 0].copy(), check=digests[:, 1].copy())),
            "grams": _lists([len(g[0]) for g in grams], _structs(gram=as_long(gram), place=place.astype(np.int32))),
            "lines": _lists([len(row) for row in lines], _structs(
                line=pa.array([x[0] for x in found], pa.string()), begin=pa.array([x[1] for x in found], pa.int32()), end=pa.array([x[2] for x in found], pa.int32()),
                n=pa.array([len(x[3]) for x in found], pa.int64()), bands=_lists([BANDS] * len(found), pa.array(bands))))}
    return _run(docs, [F.col("text")], make, "runs array<struct<least: long, first: int, last: int, run: long, check: long>>, grams array<struct<gram: long, place: int>>, "
                "lines array<struct<line: string, begin: int, end: int, n: long, bands: array<long>>>", kind)


def _joined(found: DataFrame, min_words: int, *keys: str) -> DataFrame:
    """Spans (begin, end) of equal ``keys`` that begin in the same ``min_words`` words as one: as none is shorter, they overlap."""
    return (found.groupBy(*keys, F.expr(f"begin div {min_words}").alias("block")).agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
            .select("doc", "begin", "end", *[k for k in keys if k != "doc"]))


def _equal_stretches(rows: DataFrame, docs: DataFrame, kind, min_words: int) -> DataFrame:
    """(doc, begin, end, keeper) of stretches that an earlier document holds."""
    runs = rows.select("doc", F.inline("runs"))
    differ = (F.min("run") != F.max("run")) | (F.min("check") != F.max("check"))
    shared = cut(runs.groupBy("least").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), differ.alias("differ"))
                 .where("lo <> hi").select("least", "differ"), "shared")
    runs = cut(by_hash(runs, shared, "least").select("doc", "first", "last", "run", "check", "differ"), "runs")
    keepers = runs.groupBy("run", "check").agg(F.min("doc").alias("keeper"))
    named = cut(by_hash(runs, keepers, ["run", "check"]).select("doc", "first", "last", "differ", "keeper"), "named-runs")
    whole = named.where("doc <> keeper").select("doc", F.col("first").alias("begin"), (F.col("last") + min_words).alias("end"), "keeper")
    # a run of each kind, where there is more than one kind: stretch by stretch
    wanted = cut(named.where("doc = keeper and differ").groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("wanted")), "wanted")

    def make(part):
        made = Paragraphs(_texts(part), min_words)
        text, runs = _inside(part.column("wanted"))
        text, at, h, g = made.stretches(text, *[_numpy(x).astype(np.int64) for x in runs])
        return {"doc": part.column("doc"), "found": _lists(np.bincount(text, minlength=part.num_rows), _structs(at=at.astype(np.int32), h=h, g=g))}
    found = _run(by_hash(docs, wanted, "doc"), [F.col("text"), F.col("wanted")], make, "found array<struct<at: int, h: long, g: long>>", kind)
    stretches = cut(found.select("doc", F.inline("found")), "stretches")
    clusters = cut(stretches.groupBy("h", "g").agg(F.min("doc").alias("keeper"), F.max("doc").alias("hi")).where("keeper <> hi")
                   .select("h", "g", "keeper"), "clusters")
    single = (by_hash(stretches, clusters, ["h", "g"]).where("doc <> keeper")
              .select("doc", F.col("at").alias("begin"), (F.col("at") + min_words).alias("end"), "keeper"))
    return _joined(whole.unionByName(single), min_words, "doc", "keeper")


def _similar_lines(rows: DataFrame, docs: DataFrame, kind, pct: int, min_words: int) -> DataFrame:
    """(doc, begin, end, keeper) of lines that are alike to a line of an earlier document."""
    lines = rows.select("doc", F.inline("lines"))
    nodes = cut(lines.groupBy(F.col("line").alias("id")).agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("bands").alias("bands")), "lines")

    def fetch(ids: DataFrame) -> DataFrame:
        asked = nodes.select("id", "doc").join(ids, "id").groupBy("doc").agg(F.collect_set("id").alias("wanted"))

        def make(part):
            wanted = [set(w) for w in part.column("wanted").to_pylist()]
            found = [x for row in Paragraphs(_texts(part), min_words).lines(wanted) for x in row]
            elements = np.concatenate([np.zeros(0, dtype=np.uint64), *[x[3] for x in found]])
            return {"doc": pa.nulls(len(found), pa.string()), "id": pa.array([x[0] for x in found], pa.string()),
                    "elements": _lists([len(x[3]) for x in found], pa.array(as_long(elements)))}
        return (_run(by_hash(docs, asked, "doc"), [F.col("text"), F.col("wanted")], make, "id string, elements array<long>", kind)
                .select("id", "elements").distinct())
    member = cut(similar(nodes.select("id", "n", "bands"), fetch, pct), "alike")
    held = nodes.select("id", "doc").join(member, "id")
    keepers = cut(held.groupBy("component").agg(F.min("doc").alias("keeper")), "keepers")
    keeper = cut(member.join(keepers, "component").select(F.col("id").alias("line"), "keeper"), "kept-lines")
    return lines.select("doc", "line", "begin", "end").join(keeper, "line").where("doc <> keeper").select("doc", "begin", "end", "keeper")


def _beside_first(keyed: DataFrame, key: str, name: str) -> DataFrame:
    """``keyed`` rows of keys of several documents, with the first document that holds the key (``keeper``) and where (``there``).

    The least of plain values is found by hashing; the least (document, place) would need sorted rows.
    """
    several = keyed.groupBy(key).agg(F.min("doc").alias("keeper"), F.max("doc").alias("hi")).where("keeper <> hi").select(key, "keeper")
    rows = cut(by_hash(keyed, cut(several, f"several-{name}"), key), f"keyed-{name}")
    first = cut(rows.where("doc = keeper").groupBy(key).agg(F.min("place").alias("there")), f"first-{name}")
    return by_hash(rows, first, key)


def _left_over(near: DataFrame, gone: DataFrame, min_words: int) -> DataFrame:
    """(doc, key, place): single runs of words and pairs of close ones, of those that are still uncut in several documents besides their first."""
    rest = near.where("doc <> keeper or place <> there").groupBy("doc").agg(F.collect_list(F.struct("place", "gram")).alias("left")).join(gone, "doc", "left")
    inside = F.filter("left", lambda x: ~F.coalesce(F.exists("gone", lambda g: (g["begin"] <= x["place"]) & (x["place"] + GRAM <= g["end"])), F.lit(False)))
    rest = cut(rest.select("doc", inside.alias("left")).where(F.size("left") > 0), "left-over")
    rows = rest.select("doc", F.inline("left"))
    several = rows.groupBy("gram").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo <> hi").select("gram")
    rest = rows.join(several, "gram").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("left"))
    # the run itself, and with each that follows within a stretch
    pairs = F.flatten(F.transform("left", lambda x, k: F.transform(
        F.filter(F.slice("left", k + 1, PAIRED + 1), lambda y: y["place"] - x["place"] < min_words),
        lambda y: F.struct(F.xxhash64(x["gram"], y["gram"]).alias("key"), x["place"].alias("place")))))
    return cut(rest.select("doc", F.inline(pairs)), "left-keys")


def _spans(found: DataFrame, min_words: int, name: str = "gone") -> DataFrame:
    return _joined(found, min_words, "doc").groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias(name))


def _laid_along(keyed: DataFrame, docs: DataFrame, gone: DataFrame, kind, pct: int, min_words: int) -> DataFrame:
    """(doc, begin, end, keeper) of stretches of documents that are alike to one of their keepers; ``keyed``: (doc, place, keeper, there)."""
    beside = (keyed.where("doc <> keeper").groupBy("doc", "keeper", (F.col("place") - F.col("there")).alias("shift"))
              .agg(F.min("place").alias("lo"), F.max("place").alias("hi")))
    wanted = beside.groupBy("doc").agg(F.collect_list(F.struct(F.col("keeper").cast("string").alias("keeper"), "shift", "lo", "hi")).alias("wanted"))
    wanted = cut(wanted.join(gone, "doc", "left"), "wanted-alike")

    def make(part):
        data, bytes_at = joined_texts([lowered(t) for t in _texts(part)])
        hashes, starts = word_hashes(data)
        at = np.searchsorted(starts, bytes_at)
        n = np.diff(at)
        text, spans = _inside(part.column("gone"))
        begin, end = (at[text] + np.minimum(_numpy(x), n[text]) for x in spans)
        closed = np.cumsum(np.bincount(begin, minlength=len(hashes) + 1) - np.bincount(end, minlength=len(hashes) + 1))[:len(hashes)] > 0
        left = np.concatenate(([0], np.cumsum(~closed)))
        text, (keeper, shift, lo, hi) = _inside(part.column("wanted"))
        begin = np.minimum(np.maximum(0, _numpy(lo).astype(np.int64) - min_words), n[text])
        end = np.maximum(np.minimum(n[text], _numpy(hi).astype(np.int64) + min_words + GRAM), begin)
        keep = left[at[text] + end] > left[at[text] + begin]
        text, begin, end, there = text[keep], begin[keep], end[keep], (begin - _numpy(shift))[keep]
        return {"doc": part.column("doc").take(pa.array(text)), "keeper": keeper.filter(pa.array(keep)), "begin": pa.array(begin, pa.int32()),
                "there": pa.array(there, pa.int32()), "words": _lists(end - begin, pa.array(as_long(hashes[ranges(at[text] + begin, end - begin)])))}
    parts = _run(by_hash(docs, wanted, "doc"), [F.col("text"), F.col("wanted"), F.col("gone")], make, "keeper string, begin int, there int, words array<long>", kind)
    parts = cut(parts.withColumn("keeper", F.col("keeper").cast(kind)), "parts")

    def whole(part):
        data, bytes_at = joined_texts([lowered(t) for t in _texts(part)])
        hashes, starts = word_hashes(data)
        return {"doc": part.column("doc"), "held": _lists(np.diff(np.searchsorted(starts, bytes_at)), pa.array(as_long(hashes)))}
    asked = cut(parts.select(F.col("keeper").alias("doc")).distinct(), "asked")
    # a keeper's id may be repeated: any of its rows may hold the part
    held = _run(by_hash(docs, asked, "doc", "left_semi").distinct(), [F.col("text")], whole, "held array<long>", kind).withColumnRenamed("doc", "keeper")
    begin = F.greatest(F.col("there") - DRIFT, F.lit(0))
    size = F.greatest(F.size("words") + DRIFT + F.col("there") - begin, F.lit(0))
    both = parts.join(held, "keeper").select("doc", "keeper", "begin", "words", F.slice("held", begin + 1, size).alias("held"), (begin - F.col("there")).alias("lead"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(doc, at + b, at + e, keeper) for doc, keeper, at, words, held, lead in pdf.itertuples(index=False)
                   for b, e in alike_spans(np.asarray(words).view(np.uint64), np.asarray(held).view(np.uint64), lead, pct, min_words)]
            yield pd.DataFrame(out, columns=["doc", "begin", "end", "keeper"], dtype=object)
    both = both.withColumns({c: F.col(c).cast("string") for c in ("doc", "keeper")})
    found = both.mapInPandas(search, "doc string, begin int, end int, keeper string")
    return found.withColumns({c: F.col(c).cast(kind) for c in ("doc", "keeper")})


def _alike_stretches(rows: DataFrame, docs: DataFrame, equal: DataFrame, kind, pct: int, min_words: int) -> DataFrame:
    """(doc, begin, end, keeper) of stretches that are alike to one of an earlier document: first along the first
    document of each run, then, for what is still uncut, along the first document of each run and pair of runs that is left."""
    grams = rows.select("doc", F.inline("grams"))
    near = cut(_beside_first(grams, "gram", "grams"), "near")
    found = cut(_laid_along(near, docs, _spans(equal, min_words), kind, pct, min_words), "laid-along")
    gone = cut(_spans(equal.unionByName(found), min_words), "gone")
    keys = _left_over(near, gone, min_words)
    again = _beside_first(keys, "key", "keys")
    return found.unionByName(_laid_along(again, docs, gone, kind, pct, min_words))


def cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, pct: int = SIMILAR_PCT) -> DataFrame:
    """(doc, spans, keepers): the word ranges to cut out of each document that loses any, and the documents that hold them."""
    kind = docs.schema[id_col].dataType
    texts = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).where("doc is not null")
    rows = cut(listed(texts, kind, min_words), "listed")
    texts = cut_by(texts, "texts", "doc")
    equal = settled(docs.sparkSession, lambda: _equal_stretches(rows, texts, kind, min_words), "equal")
    alike = equal.unionByName(settled(docs.sparkSession, lambda: _similar_lines(rows, texts, kind, pct, min_words), "alike-lines"))
    if pct < 100:
        alike = alike.unionByName(settled(docs.sparkSession, lambda: _alike_stretches(rows, texts, alike, kind, pct, min_words), "alike-stretches"))
    return alike.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"), F.collect_set("keeper").alias("keepers"))


def _trim(texts: list[bytes], text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts without the words of some spans (text, begin, end), the number of words of each, and of those cut.

    A run of cut words goes from the start of its first word to the start of the next word that stays.
    """
    data, bytes_at = joined_texts(texts)
    starts = word_places(data)[0]
    at = np.searchsorted(starts, bytes_at)
    n = np.diff(at)
    steps = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(steps, at[text] + np.minimum(begin, n[text]), 1)
    np.subtract.at(steps, at[text] + np.minimum(end, n[text]), 1)
    gone = np.cumsum(steps)[:-1] > 0
    removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[at])
    out = list(texts)
    for k in np.flatnonzero(removed).tolist():
        flags = np.concatenate(([False], gone[at[k]:at[k + 1]], [False]))
        turns = np.flatnonzero(flags[1:] != flags[:-1]) + at[k]
        last = bytes_at[k + 1] - 1
        pieces, done = [], bytes_at[k]
        for b, e in zip(turns[::2].tolist(), turns[1::2].tolist()):
            pieces.append(data[done:starts[b]])
            done = starts[e] if e < at[k + 1] else last
        out[k] = b"".join([*pieces, data[done:last]])
    return out, n, removed


_TRIMMED = "struct<text: string, n_words: long, removed_words: long>"


def _trim_column(text: Column, spans: Column) -> Column:
    def of_part(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        before = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        lists = [(k, b, e) for k, (b, e) in enumerate(zip(begins, ends)) if b is not None]
        none = [np.zeros(0, dtype=np.int64)]
        owner = np.repeat([k for k, _, _ in lists], [len(b) for _, b, _ in lists]).astype(np.int64)
        after, n, removed = _trim(before, owner, np.concatenate(none + [b for _, b, _ in lists]).astype(np.int64), np.concatenate(none + [e for _, _, e in lists]).astype(np.int64))
        return pd.DataFrame({"text": [a.decode("utf-8", "surrogatepass") if r else t for t, a, r in zip(texts, after, removed)],
                             "n_words": n, "removed_words": removed})

    @F.pandas_udf(_TRIMMED)
    def trim(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        # some 500 KB of text at a time, to bound memory
        part = texts.str.len().fillna(0).cumsum().shift(fill_value=0) // PART_BYTES
        edges = [0, *(np.flatnonzero(part.to_numpy()[1:] != part.to_numpy()[:-1]) + 1).tolist(), len(texts)]
        return pd.concat([of_part(texts.iloc[b:e], begins.iloc[b:e], ends.iloc[b:e]) for b, e in zip(edges, edges[1:])], ignore_index=True)
    return trim(text, spans.getField("begin"), spans.getField("end"))


def trimmed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, pct: int = SIMILAR_PCT) -> DataFrame:
    """One row per document: (id_col, n_words, removed_words, first_doc_ids, text without what is cut)."""
    found = settled(docs.sparkSession, lambda: cuts(docs, id_col, text_col, min_words, pct), "cuts")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(found.hint("shuffle_hash"), F.col("id") == F.col("doc"), "left")
    rows = rows.withColumn("new", _trim_column(F.col("text"), F.col("spans")))
    return rows.select(F.col("id").alias(id_col), "new.n_words", "new.removed_words",
                       F.array_sort(F.coalesce("keepers", F.array().cast(rows.schema["keepers"].dataType))).alias("first_doc_ids"), F.col("new.text").alias("text"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, pct: int = SIMILAR_PCT,
          chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut out of ``text_col``; documents that lose all their words go.

    A column ``chars_col``, if there is one, is set to the new length of texts that were cut.
    """
    found = settled(docs.sparkSession, lambda: cuts(docs, id_col, text_col, min_words, pct), "cuts")
    row = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.select(row.alias("row"), docs[id_col].alias("id"), docs[text_col].alias("text")).join(found.hint("shuffle_hash"), F.col("id") == F.col("doc"), "left")
    rows = rows.withColumn("new", _trim_column(F.col("text"), F.col("spans"))).where("new.removed_words = 0 or new.removed_words < new.n_words")
    out = {c: F.col("row").getField(c) for c in docs.columns}
    out[text_col] = F.col("new.text")
    if chars_col in out:
        out[chars_col] = F.when(F.col("new.removed_words") > 0, F.length("new.text")).otherwise(out[chars_col]).cast(docs.schema[chars_col].dataType)
    return rows.select(*[c.alias(name) for name, c in out.items()])
