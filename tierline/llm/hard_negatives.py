"""Hard-negative mining: score bounds along a spanning tree of the anchors.

An anchor's positives are its best rows of the same label; its hard negatives
are the best rows of other labels whose score lies in a window below a
positive's. For a parent anchor p, a child anchor a and a candidate c,
|<a,c> - <p,c>| <= |a - p| |c|, so the scores at a parent, give or take the
length of the edge times the candidate's norm, bound those at the child. Each block of
anchors is spanned by its minimum spanning tree; from the root, whose scores
are all computed, bounds are handed down the edges, and at each anchor only
candidates whose bounds overlap a window are scored. Exact scores
are handed on as such, bounds otherwise grow by the next edge (and never beyond the
product of the norms). The window of the first search, for positives, is
everything from the k-th best lower bound on. Copies of an anchor have an edge
of length zero and score nothing twice.

Layout over the cluster: rows are prepared once and written to the shared
folder. Candidates are dealt by hash into groups of about ``GROUP`` rows, anchors
into blocks of about ``ANCHORS``; a pair of both is one bounded unit of
work that returns a few rows per anchor, of which windows keep the best. For
positives, groups and blocks are of one label, and a label of many rows
has many of both; for negatives, a block holds anchors of alike directions (signs of
projections; directions that many share take several blocks), which shortens the edges. No id, label, bucket
or vector brings more than that to a task, and nothing is broadcast by hint.
Every anchor meets every candidate in some unit: rows that no bound excludes are all scored.

Defined results: rows with a null label, a null vector, or a null or
non-finite component take no part. A row without an id is a candidate (last in
ties, with a null id in the result), and no anchor. Each row is itself only: rows that repeat are rows
of their own, also as anchors, and a row isn't its own positive. An anchor
meets vectors of its own length only. Without positives or without
negatives in the window an anchor has no rows. An empty table gives an
empty result; other columns are ignored; a score beyond 64 bits raises. While sums may pass 2**50 scores are Python
integers without bounds (the same results, slower).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.shared import cut

POSITIVES, NEGATIVES = 5, 5
LOW_PCT, HIGH_PCT = 80, 100     # of a positive's score
GROUP = 16_384
ANCHORS = 1_024
LEAST = 32                      # groups, so that small tables use all cores
_EXACT = float(1 << 50)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge length) of each row in a minimum spanning tree (Prim); the root is row 0, its own parent."""
    n = len(points)
    squares = (points ** 2).sum(axis=1)
    parent, near = np.zeros(n, dtype=np.int64), np.full(n, np.inf)
    edge, open_ = np.zeros(n), np.ones(n, dtype=bool)
    here = 0
    for _ in range(n - 1):
        open_[here] = False
        far = np.maximum(squares + squares[here] - 2 * (points @ points[here]), 0.0)
        closer = open_ & (far < near)
        near[closer], parent[closer] = far[closer], here
        here = int(np.where(open_, near, np.inf).argmin())
        edge[here] = np.sqrt(near[here])
    return parent, edge


def _children(parent: np.ndarray) -> list[list[int]]:
    """The children of each node, those of the largest subtree first."""
    n = len(parent)
    kids: list[list[int]] = [[] for _ in range(n)]
    for child in range(1, n):
        kids[parent[child]].append(child)
    order, k = [0], 0
    while k < len(order):
        order += kids[order[k]]
        k += 1
    size = np.ones(n, dtype=np.int64)
    for node in reversed(order[1:]):
        size[parent[node]] += size[node]
    return [sorted(c, key=lambda x: -size[x]) for c in kids]


def walk(vectors: np.ndarray, anchors: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
         counts: dict[str, int] | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (anchor, candidates, exact scores) of the candidates (n x d) whose bounds ``wanted(anchor, low, high)`` picks, for each of ``anchors`` (m x d).

    Components are whole numbers. The subtree of most anchors comes last, so
    that bounds of at most log2(m) anchors are held. ``counts`` gets how many pairs there were and how many were scored.
    """
    if not len(anchors) or not len(vectors):
        return
    largest = max(np.abs(vectors).max(initial=0), np.abs(anchors).max(initial=0))
    if largest * largest * max(vectors.shape[1], 1) >= _EXACT:
        whole = np.vectorize(int, otypes=[object])
        big = whole(vectors) if vectors.size else vectors.astype(object)
        for a, row in enumerate(anchors):
            scores = np.array([sum((int(x) * y for x, y in zip(row, c)), 0) for c in big], dtype=object)
            at = np.flatnonzero(wanted(a, scores, scores))
            yield a, at, scores[at]
        return
    parent, edge = spanning_tree(anchors)
    children = _children(parent)
    norms, own = np.sqrt((vectors ** 2).sum(axis=1)), np.sqrt((anchors ** 2).sum(axis=1))
    stack: list[tuple[int, np.ndarray | None, np.ndarray | None]] = [(0, None, None)]
    while stack:
        a, low, high = stack.pop()
        if low is None:
            low = high = vectors @ anchors[a]
            scored = len(vectors)
            at = np.flatnonzero(wanted(a, low, high))
        else:
            if edge[a] > 0:     # half a unit for rounding: scores are whole numbers
                slack, most = edge[a] * norms * (1 + 1e-9) + 0.5, own[a] * norms * (1 + 1e-9) + 0.5
                low, high = np.maximum(low - slack, -most), np.minimum(high + slack, most)
            at = np.flatnonzero(wanted(a, low, high))
            open_ = at[low[at] < high[at]]
            scored = len(open_)
            if 2 * scored > len(vectors):       # most of them: in place is cheaper than picking them out
                low = high = vectors @ anchors[a]
            elif scored:
                low, high = low.copy(), high.copy()
                low[open_] = high[open_] = vectors[open_] @ anchors[a]
        if counts is not None:
            counts["pairs"] = counts.get("pairs", 0) + len(vectors)
            counts["scored"] = counts.get("scored", 0) + scored
        yield a, at, low[at]
        stack += [(child, low, high) for child in children[a]]


def _best(scores: np.ndarray, anon: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, rows without an id last."""
    if len(scores) > k and scores.dtype != object:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
    else:
        at = np.arange(len(scores))
    return np.array(sorted(at.tolist(), key=lambda i: (-scores[i], anon[i], ids[i]))[:k], dtype=np.int64)


def positives_of(vectors: np.ndarray, rows: np.ndarray, anchors: np.ndarray, anchor_rows: np.ndarray, anon: np.ndarray, ids: np.ndarray, k: int):
    """Yield (anchor, places of its k best candidates but itself, scores)."""
    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        other = rows != anchor_rows[a]
        known = low[other]
        if len(known) < k:
            return other
        kth = sorted(known)[-k] if known.dtype == object else np.partition(known, len(known) - k)[len(known) - k]
        return other & (high >= kth)
    for a, at, scores in walk(vectors, anchors, wanted):
        best = _best(scores, anon[at], ids[at], k)
        yield a, at[best], scores[best]


def windows(scores: list[int], low_pct: int, high_pct: int) -> list[tuple[int, int]]:
    """The whole scores s with low_pct * p <= 100 * s <= high_pct * p, for each positive's score p."""
    return [(-(-low_pct * p // 100), high_pct * p // 100) for p in scores]


def negatives_of(vectors: np.ndarray, labels: np.ndarray, anchors: np.ndarray, anchor_labels: np.ndarray, ranges: list[list[tuple[int, int]]],
                 anon: np.ndarray, ids: np.ndarray, k: int, counts: dict[str, int] | None = None):
    """Yield (anchor, number of the window, places of its k best candidates of another label inside it, scores)."""
    reach = [(min(lo for lo, hi in r if lo <= hi), max(hi for lo, hi in r if lo <= hi)) if any(lo <= hi for lo, hi in r) else (1, 0) for r in ranges]

    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (labels != anchor_labels[a]) & (high >= reach[a][0]) & (low <= reach[a][1])
    for a, at, scores in walk(vectors, anchors, wanted, counts):
        for w, (lo, hi) in enumerate(ranges[a]):
            inside = np.flatnonzero((scores >= lo) & (scores <= hi)) if lo <= hi else np.zeros(0, dtype=np.int64)
            if len(inside):
                best = inside[_best(scores[inside], anon[at[inside]], ids[at[inside]], k)]
                yield a, w, at[best], scores[best]


# --- on the cluster ------------------------------------------------------------------------------------------

def _dealt(salt: int, parts: Column) -> Column:
    return F.pmod(F.xxhash64("row", F.lit(salt)), parts).cast("int")


def _spread(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts.cast("int") - 1))


def _parts(rows: Column, size: int, least: int = 1) -> Column:
    return F.greatest(F.lit(least), F.ceil(rows / size)).cast("int")


def _prepared(table: DataFrame, id_col: str, label: Column, vector: Column, is_anchor: Column) -> DataFrame:
    rows = table.select(table[id_col].cast("long").alias("id"), label.alias("label"), vector.cast("array<double>").alias("vector"),
                        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).where(finite)
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("anon"),
                           "label", "vector", (F.col("is_anchor") & F.col("id").isNotNull()).alias("is_anchor")), "hard-negatives")


def _by_length(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, pd.DataFrame, np.ndarray]]:
    """(candidates, their vectors, anchors, their vectors) of a unit, for each length of vectors that both have."""
    for _, same in pdf.groupby(pdf["vector"].map(len)):
        asks = same["asks"].to_numpy(dtype=bool)
        if asks.any() and not asks.all():
            anchors, candidates = same[asks], same[~asks]
            yield candidates, np.stack(candidates["vector"].to_numpy()), anchors, np.stack(anchors["vector"].to_numpy())


def _positives(rows: DataFrame, k: int) -> DataFrame:
    """(row, place, id, anon, score): the k best rows of the same label of each anchor."""
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("m")).where("m > 0")
    dealt = rows.join(sizes.select("label", _parts(F.col("n"), GROUP).alias("groups"), _parts(F.col("m"), ANCHORS).alias("blocks")), "label")
    group, block = _dealt(1, F.col("groups")), _dealt(2, F.col("blocks"))
    columns = ["label", "row", "id", "anon", "vector"]
    units = dealt.select(F.lit(False).alias("asks"), *columns, group.alias("g"), _spread(F.col("blocks")).alias("b")).unionByName(
        dealt.where("is_anchor").select(F.lit(True).alias("asks"), *columns, _spread(F.col("groups")).alias("g"), block.alias("b")))

    def unit(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for candidates, vectors, anchors, asked in _by_length(pdf):
            ids, anon, asking = candidates["id"].to_numpy(), candidates["anon"].to_numpy(dtype=bool), anchors["row"].to_numpy()
            for a, at, scores in positives_of(vectors, candidates["row"].to_numpy(), asked, asking, anon, ids, k):
                out += [(asking[a], ids[i], anon[i], int(s)) for i, s in zip(at, scores)]
        return pd.DataFrame(out, columns=["row", "id", "anon", "score"])

    found = units.groupBy("label", "g", "b").applyInPandas(unit, "row long, id long, anon boolean, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "anon", "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _blocks(anchors: DataFrame, blocks: int) -> DataFrame:
    """``anchors`` with a block ``b``: those of alike directions share one, where many agree they take several."""
    if blocks == 1:
        return anchors.withColumn("b", F.lit(0))

    def projection(s: int) -> Column:   # on a fixed random direction
        turned = F.transform("vector", lambda x, i: x * F.when(F.pmod(F.xxhash64(i, F.lit(s)), F.lit(2)) == 0, 1.0).otherwise(-1.0))
        return F.aggregate(turned, F.lit(0.0), lambda total, x: total + x)

    cell = F.lit(0)
    for s in range(int(np.ceil(np.log2(blocks)))):
        cell = cell + F.when(projection(s) > 0, 1 << s).otherwise(0)
    marked = anchors.withColumn("cell", cell)
    sizes = marked.groupBy("cell").agg(_parts(F.count(F.lit(1)), ANCHORS).alias("salts"))
    return marked.join(sizes, "cell").withColumn("b", F.pmod(F.col("cell") + _dealt(3, F.col("salts")), F.lit(blocks)).cast("int")).drop("cell", "salts")


def mine(table: DataFrame, id_col: str, label: Column, vector: Column, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low_pct: int = LOW_PCT, high_pct: int = HIGH_PCT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hard negatives of each anchor and positive.

    ``vector`` is an array of doubles that hold whole numbers; scores are inner products.
    """
    rows = _prepared(table, id_col, label, vector, is_anchor)
    known = cut(_positives(rows, positives), "hard-negatives-positives")
    n, m = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    groups, blocks = max(LEAST, -(-n // GROUP)), max(1, -(-m // ANCHORS))
    asked = known.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("scores"))
    columns = ["row", "id", "anon", "label", "vector"]
    units = rows.select(F.lit(False).alias("asks"), *columns, F.array().cast("array<long>").alias("scores"), _dealt(1, F.lit(groups)).alias("g"),
                        _spread(F.lit(blocks)).alias("b")).unionByName(
        _blocks(rows.where("is_anchor").join(asked, "row"), blocks).select(F.lit(True).alias("asks"), *columns, "scores", _spread(F.lit(groups)).alias("g"), "b"))

    def unit(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for candidates, vectors, asking, points in _by_length(pdf):
            ids, anon, names = candidates["id"].to_numpy(), candidates["anon"].to_numpy(dtype=bool), asking["row"].to_numpy()
            codes, _ = pd.factorize(pd.concat([candidates["label"], asking["label"]]))
            ranges = [windows([int(s) for s in scores], low_pct, high_pct) for scores in asking["scores"]]
            for a, w, at, scores in negatives_of(vectors, codes[:len(ids)], points, codes[len(ids):], ranges, anon, ids, negatives):
                out += [(names[a], w + 1, ids[i], anon[i], int(s)) for i, s in zip(at, scores)]
        return pd.DataFrame(out, columns=["row", "place", "id", "anon", "score"])

    found = units.groupBy("g", "b").applyInPandas(unit, "row long, place int, id long, anon boolean, score long")
    order = Window.partitionBy("row", "place").orderBy(F.desc("score"), "anon", "id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = known.select("row", "place", F.when(~F.col("anon"), F.col("id")).alias("positive_id"), F.col("score").alias("positive_score"))
    anchor = rows.where("is_anchor").select("row", F.col("id").alias("anchor_id"))
    return (best.select("row", "place", "rank", F.when(~F.col("anon"), F.col("id")).alias("negative_id"), F.col("score").alias("negative_score"))
            .join(named, ["row", "place"]).join(anchor, "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
