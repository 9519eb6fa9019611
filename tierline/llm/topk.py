"""Exact top-k search by inner product: columnar branch and bound.

Vectors are laid out vertically: one contiguous array per dimension block.
For a query, partial products are added up block by block. Before the next
block is read, the Cauchy-Schwarz bound on the mass that remains (the norm of
what is left of the query times the norm of what is left of the candidate)
shows which candidates can no longer reach the k-th best score known so far;
the survivors are compacted, and only their columns are read further on.
Dimensions are visited in descending order of the query block's mass, so that
bounds get tight early. A candidate that ties with the k-th best survives, so
results are exact, ties included. Columns are compacted when less than half of them survive.

Layout over the cluster: candidates are dealt by hash of their id into groups
of at most about ``GROUP`` rows (rows are prepared once, in the shared folder; ``LEAST`` groups at least, so that small tables use
all cores) and queries into groups of about ``QUERIES`` rows; each pair of groups is one bounded unit of work that returns at most k rows
per query. A window then keeps the best k of those. Nothing is broadcast.

Defined results: vectors that are null, or hold a null or non-finite
component, take no part; each row is itself only: rows that share an id are
candidates and queries each, and only a query's own row isn't its candidate; a row without an id is a candidate (last in ties, with a null id) and no query; a query meets
candidates of its own dimension only; other columns are ignored; an empty table gives an
empty result; a score beyond 64 bits raises.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.shared import cut

K = 5
GROUP = 16_384
LEAST = 32
QUERIES = 1_024
BLOCK = 8  # dimensions per block
_EXACT = float(1 << 53)


def _remaining(x: np.ndarray) -> np.ndarray:
    """For each block boundary, the norm of the rows of ``x`` (dimensions x n) from there on, rounded up."""
    energy = np.add.reduceat(x.astype(np.float64) ** 2, np.arange(0, len(x), BLOCK), axis=0)
    rest = np.cumsum(energy[::-1], axis=0)[::-1]
    return np.sqrt(rest) * (1 + 1e-9)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= kth)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = K):
    """Yield (query id, candidate ids, scores) with the k best of ``vectors`` (n x d) for each of ``queries`` (m x d), which aren't their own candidates."""
    for n, at, score in places(ids, ids, vectors, query_ids, queries, k):
        yield query_ids[n], ids[at], score


def places(rows: np.ndarray, order: np.ndarray, vectors: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int = K):
    """Yield (number of the query, places of its k best candidates, scores); a candidate whose row is the query's is left out, ties go by ``order``.

    Components are whole numbers. While all sums stay below 2**53 they are
    exact doubles; beyond that the scores are Python integers without pruning.
    """
    d = vectors.shape[1]
    largest = max(np.abs(vectors).max(initial=0), np.abs(queries).max(initial=0))
    if largest * largest * max(d, 1) >= _EXACT:
        big, bigq = vectors.astype(object), queries.astype(object)
        big, bigq = (np.vectorize(int, otypes=[object])(x) if x.size else x for x in (big, bigq))
        for n, q in enumerate(bigq):
            score = [int(sum(a * b for a, b in zip(q, c))) for c in big]
            best = sorted((i for i in range(len(rows)) if rows[i] != query_rows[n]), key=lambda i: (-score[i], order[i]))[:k]
            yield n, np.array(best, dtype=np.int64), [score[i] for i in best]
        return
    dims = np.argsort(-np.abs(queries).sum(axis=0), kind="stable") if len(queries) else np.arange(d)
    columns = np.ascontiguousarray(vectors.T[dims])  # vertical: one row per dimension
    asked = queries[:, dims]
    left, left_q = (_remaining(columns), _remaining(np.ascontiguousarray(asked.T))) if d else (None, None)
    # Exact scores of a slice of candidates give a first k-th best to prune against.
    probe = slice(0, min(len(rows), max(256, 8 * k)))
    known_scores = asked @ columns[:, probe]
    for n, q in enumerate(asked):
        own = rows == query_rows[n]
        known = known_scores[n][~own[probe]]
        kth = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else -np.inf
        alive, partial, held, rest, first = np.arange(len(rows)), np.where(own, -np.inf, 0.0), columns, left, 0
        for b, at in enumerate(range(0, d, BLOCK)):
            keep = partial + left_q[b, n] * rest[b - first // BLOCK] + 0.5 >= kth  # scores are whole numbers, bounds are doubles
            if 2 * np.count_nonzero(keep) < len(keep):  # compact: what follows reads only the survivors' columns
                some = np.flatnonzero(keep)
                alive, partial, held, rest, first = alive[some], partial[some], held[at - first:, some], rest[b - first // BLOCK:, some], at
            partial = partial + q[at:at + BLOCK] @ held[at - first:at - first + BLOCK]
            if len(partial) > k:  # the lower ends of what is possible raise the k-th best as well
                after = b + 1 - first // BLOCK
                low = partial - (left_q[b + 1, n] * rest[after] if after < len(rest) else 0)
                kth = max(kth, np.floor(np.partition(low, len(low) - k)[len(low) - k]))
        some = np.flatnonzero(partial > -np.inf)
        alive, partial = alive[some], partial[some]
        best = _best(partial, order[alive], k)
        yield n, alive[best], partial[best].astype(np.int64)


def _units(rows: DataFrame, groups: int, blocks: int) -> DataFrame:
    group = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int")
    block = F.pmod(F.xxhash64("row", F.lit(2)), F.lit(blocks)).cast("int")
    columns = ["row", "id", "anon", "vector"]
    candidates = rows.select(F.lit(False).alias("asks"), *columns, group.alias("g"),
                             F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    queries = rows.where("is_query").select(F.lit(True).alias("asks"), *columns,
                                            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), block.alias("b"))
    return candidates.unionByName(queries)


def top_k(table: DataFrame, is_query: Column, id_col: str, vector: Column, k: int = K) -> DataFrame:
    """(query_id, rank, id_col, score): the k highest integer inner products of each query row with all other rows.

    ``vector`` is an array of doubles that hold whole numbers.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (table.select(table[id_col].cast("long").alias("id"), vector.cast("array<double>").alias("vector"), is_query.alias("is_query"))
            .where(F.col("vector").isNotNull()).where(finite)
            .select(F.monotonically_increasing_id().alias("row"), F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("anon"), "vector",
                    (F.coalesce("is_query", F.lit(False)) & F.col("id").isNotNull()).alias("is_query")))
    rows = cut(rows, "top-k")
    n, m = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    groups, blocks = max(LEAST, -(-n // GROUP)), max(1, -(-m // QUERIES))

    def unit(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, same in pdf.groupby(pdf["vector"].map(len)):  # by dimension
            asks = same["asks"].to_numpy(dtype=bool)
            if asks.any() and not asks.all():
                held, asking = same[~asks], same[asks]
                ids, anon = held["id"].to_numpy(), held["anon"].to_numpy(dtype=bool)
                order = np.empty(len(ids), dtype=np.int64)
                order[np.lexsort((ids, anon))] = np.arange(len(ids))
                names, query_ids = asking["row"].to_numpy(), asking["id"].to_numpy()
                for q, at, score in places(held["row"].to_numpy(), order, np.stack(held["vector"].to_numpy()), names, np.stack(asking["vector"].to_numpy()), k):
                    out += [(names[q], query_ids[q], ids[i], anon[i], s) for i, s in zip(at, score)]
        return pd.DataFrame(out, columns=["row", "query_id", "id", "anon", "score"])

    best = _units(rows, groups, blocks).groupBy("g", "b").applyInPandas(unit, "row long, query_id long, id long, anon boolean, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "anon", "id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(~F.col("anon"), F.col("id")).alias(id_col), "score"))


def scaled(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component, computed in doubles."""
    return F.transform(vector, lambda x: _floor(x.cast("double") * factor))


def _floor(x: Column) -> Column:
    # floor() returns a 64-bit integer; a component beyond that is a whole number as it is
    return F.when(F.abs(x) < float(1 << 62), F.floor(F.when(F.abs(x) < float(1 << 62), x)).cast("double")).otherwise(x)
