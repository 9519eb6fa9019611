"""Helpers that several operators of this subpackage use: words, 64-bit hashing in numpy, and tables cut out of a lineage."""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import ensure_checkpoint_dir

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
SPACES = " \t\n\x0b\x0c\r"

# Words a shingle holds, and the least similarity (in percent) of near duplicates.
SHINGLE = 5
SIMILAR_PCT = 75


def words(text: Column) -> Column:
    """The words of a text as an array (null text: empty)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


_made: list[str] = []


def _path(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    What follows then depends on files that every executor can read, not on
    the plan (or the executors) that made them. The folder goes when the
    application ends, or with ``settled``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, hpath = _path(spark, path)
    fs.deleteOnExit(hpath)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``cut`` with the rows of a key in one bucket: joins by the key read them as they lie, without another exchange.

    Buckets need a catalog table. Its entry goes at once; the frame goes on reading the files.
    """
    spark = df.sparkSession
    n, made = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{made}"
    df.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(made)
    out = spark.table(made)
    spark.sql(f"DROP TABLE {made}")
    fs, hpath = _path(spark, path)
    fs.deleteOnExit(hpath)
    _made.append(path)
    release(spark, len(_made), keep=0)  # the exchange has served
    return out


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``cut(make(), name)``; the tables that ``make`` cut on its way are deleted then, as nothing needs them any more."""
    before = len(_made)
    out = cut(make(), name)
    release(spark, before, keep=1)
    return out


def release(spark: SparkSession, before: int, keep: int = 0) -> None:
    """Delete the tables cut since there were ``before``, but for the last ``keep``; Spark's cleaner then drops the shuffles only they used."""
    done = _made[before:len(_made) - keep]
    del _made[before:len(_made) - keep]
    for path in done:
        fs, hpath = _path(spark, path)
        fs.delete(hpath, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def by_hash(rows: DataFrame, keys: DataFrame, on, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keys``, which has one row per key: these are hashed, partition by partition, and ``rows`` need not be sorted."""
    return rows.join(keys.hint("shuffle_hash"), on, how)


def cuts_made() -> int:
    return len(_made)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 64-bit hashing over numpy arrays (all arithmetic modulo 2**64) ---------

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    raw = np.array([((start + i) * _GOLDEN) & _MASK for i in range(n)], dtype=np.uint64)
    return mix64(raw) | np.uint64(1)


def lowered(text: str | bytes | None) -> bytes:
    """A text in UTF-8 with A-Z in lower case, everything else as it is; ``split()`` of it gives its words."""
    return (text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")).lower()


_PIECE = 1 << 20  # bytes of a word that are hashed at a time, to bound memory
_INSIDE = np.array([chr(b) not in SPACES for b in range(256)])


def _place_seeds(place: np.ndarray) -> np.ndarray:
    """A fixed odd 64-bit constant for each place in a word."""
    return mix64((place.astype(np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN)) | np.uint64(1)


_SHORT = 32  # bytes of words that are hashed place by place, all words at once
_TIMES = (np.arange(256, dtype=np.uint64) + np.uint64(1))[None, :] * _place_seeds(np.arange(_SHORT))[:, None]


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The byte each word of a text in UTF-8 starts at, and the byte after its last."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _INSIDE[np.frombuffer(data, dtype=np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of a text in UTF-8, and the byte it starts at.

    A hash is the mixed sum of the word's bytes (plus one), each times a constant of its place.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    starts, ends = word_places(data)
    sizes = ends - starts
    # the longest first, so that the words that have a place are always the first ones
    short = np.minimum(sizes, _SHORT).astype(np.uint8)
    order = np.argsort(np.uint8(_SHORT) - short, kind="stable")
    having = len(starts) - np.searchsorted(short[order][::-1], np.arange(_SHORT), "right")
    at, ordered = starts[order], np.zeros(len(starts), dtype=np.uint64)
    for place, n in enumerate(having.tolist()):
        if not n:
            break
        ordered[:n] += _TIMES[place][raw[at[:n] + place]]
    sums = np.empty_like(ordered)
    sums[order] = ordered
    for w in np.flatnonzero(sizes > _SHORT).tolist():
        for k in range(_SHORT, int(sizes[w]), _PIECE):
            chars = raw[starts[w] + k:min(starts[w] + k + _PIECE, ends[w])]
            sums[w:w + 1] += np.sum((chars.astype(np.uint64) + np.uint64(1)) * _place_seeds(np.arange(k, k + len(chars))))
    return mix64(sums), starts


_SHINGLE_SEEDS = seeds(SHINGLE, 101)


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The hash of every run of ``size`` words; a shorter, non-empty text is one shingle of all its words."""
    n = len(hashes)
    if n == 0:
        return hashes
    take = min(size, n)
    mult = _SHINGLE_SEEDS if take <= SHINGLE else seeds(take, 101)
    out = np.full(n - take + 1, np.uint64(take), dtype=np.uint64)
    for k in range(take):
        out += hashes[k:n - take + 1 + k] * mult[k]
    return mix64(out)


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones Spark stores."""
    return x.view(np.int64)
