"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document's set is its distinct five-word shingles (ASCII letters in lower
case), as 64-bit hashes. The sketch has ``COORDINATES`` coordinates, filled in
rounds: in each of the first rounds every element falls into one hashed bin
with a hashed value, in the second half round i throws every element into bin
i; a value of round i lies in [i, i + 1), and a bin keeps its least value. Rounds go on until every bin is
full, which the second half guarantees at the latest; all coordinates are then
min-hash samples, of lower variance than independent ones for large sets, at
one hash per element for most sets instead of one per coordinate. Small sets
take more rounds, together about t log t hashes.

``BANDS`` bands of ``ROWS`` coordinates are the candidate keys: two sets of
similarity 0.75 share no band with a chance of (1 - 0.75 ** 4) ** 32 = 5e-6.
Candidates are verified on full sets and grouped by ``linking``.

Documents with equal sets are one class from the start (by a 128-bit digest of
the set), so copies are never paired.

Defined results: a null, empty or blank text has the empty set, which is
linked with nothing (its own component, kept); a text of one to four words has
one shingle, all its words; a null id never is a component's id or linked (component null, kept);
rows that repeat an id are one document, linked by any of their texts, with one verdict; columns beyond id and text are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.linking import similar
from tierline.llm.shared import SIMILAR_PCT, as_long, cut, lowered, mix64, seeds, settled, shingles, word_hashes

BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
_SEEDS = seeds(2 * COORDINATES, 1001)
_BAND_SEEDS = seeds(ROWS, 5001)
_VALUE = (1 << 48) - 1  # the upper 16 bits of a hash choose the bin, the lower 48 are the value


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(shingles(word_hashes(lowered(text))[0]))


def sketch(elements: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The fast similarity sketch of a non-empty set: (round << 48 | value) of each of t bins."""
    empty = np.uint64((1 << 64) - 1)
    bins = np.full(t, empty, dtype=np.uint64)
    done = 0
    while done < 2 * t:
        # As many rounds at a time as make about 8 t hashes; rounds after the filling one can't lower a bin.
        rounds = min(2 * t - done, max(1, 8 * t // len(elements)))
        if done < t:
            rounds = min(rounds, t - done)
        number = np.arange(done, done + rounds, dtype=np.uint64)
        h = mix64(elements[None, :] ^ _SEEDS[done:done + rounds, None])
        value = (h & np.uint64(_VALUE)) | (number[:, None] << np.uint64(48))
        if done < t:
            at = (h >> np.uint64(48)) % np.uint64(t)
            np.minimum.at(bins, at.ravel().astype(np.intp), value.ravel())
        else:
            at = np.arange(done - t, done - t + rounds)
            bins[at] = np.minimum(bins[at], value.min(axis=1))
        done += rounds
        if done <= t and (bins != empty).all():
            break
    return bins


def bands(coordinates: np.ndarray) -> np.ndarray:
    """The hash of each band's coordinates."""
    rows = coordinates.reshape(BANDS, ROWS)
    return mix64((mix64(rows) * _BAND_SEEDS[None, :]).sum(axis=1, dtype=np.uint64))


def _over(docs: DataFrame, id_col: str, text_col: str, make, out: str) -> DataFrame:
    """(id, what ``make`` returns for lists of texts); ids pass through Python as strings, which keeps nulls and large numbers."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 500):  # bounded output batches
                part = pdf.iloc[k:k + 500]
                yield pd.DataFrame({"id": part["id"].to_list()} | make([shingle_set(t) for t in part["text"]]))
    return (docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].alias("text"))
            .mapInPandas(run, f"id string, {out}").withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)))


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, digest, bands) of every document."""
    def make(sets: list[np.ndarray]) -> dict:
        return {"n": [len(s) for s in sets], "digest": [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets],
                "bands": [as_long(bands(sketch(s))) if len(s) else as_long(s) for s in sets]}
    return _over(docs, id_col, text_col, make, "n long, digest string, bands array<long>")


def shingled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, elements) of every document."""
    return _over(docs, id_col, text_col, lambda sets: {"elements": [as_long(s) for s in sets]}, "elements array<long>")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pct: int = SIMILAR_PCT) -> DataFrame:
    """One row per document: (id_col, n_shingles, component_id, kept)."""
    rows = cut(sketched(docs, id_col, text_col), "sketched")

    def fetch(ids: DataFrame) -> DataFrame:
        texts = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).join(ids, F.col("doc") == F.col("id"), "left_semi")
        return shingled(texts, "doc", "text").distinct()

    def by_class() -> DataFrame:
        # one class per set, named by the least id of its documents
        named = rows.where(F.col("id").isNotNull() & (F.col("n") > 0))
        classes = cut(named.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
        found = similar(classes.select(F.col("rep").alias("id"), "n", "bands"), fetch, pct)
        return (classes.select("digest", "rep").join(found, F.col("rep") == F.col("id"), "left")
                .select("digest", F.coalesce("component", "rep").alias("component")))
    least = settled(docs.sparkSession, by_class, "verdicts")
    verdict = rows.select("id", "n", "digest").join(least, "digest", "left")
    component = F.when(F.col("id").isNull(), None).when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return verdict.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                          F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pct: int = SIMILAR_PCT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component (the one of least id)."""
    gone = settled(docs.sparkSession, lambda: components(docs, id_col, text_col, pct).where("not kept").select(F.col(id_col).alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
