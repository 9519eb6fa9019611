"""Classes of similar sets: candidates by bands, exact Jaccard verification, connected components.

Input is one row per distinct set: an id, the number of elements and its band
keys. Sets that share a band key are candidates; two sets are linked if
``100 * |intersection| >= pct * |union|`` on their full sets. What is returned
is the component of each set, which needs enough links to connect it, not all
pairs. That allows large buckets without all their pairs:

1. Stars. In each bucket one pivot is compared with the other members. A
   member's score is the number of rows in all its buckets; the pivot is the
   member of highest score. In a group of near copies that is the text the
   copies were made from: it shares most bands with most of the others.
2. Components of the links found so far.
3. The rest, exactly. In a bucket whose members other than the pivot are still
   in several components, pairs across components have not been compared. The
   members are dealt into blocks of bounded total size and every pair of
   blocks is searched by an inverted index from elements to members, in which
   a set of a component meets only sets of others. Buckets with the same members are searched
   once. What is found joins the links, and components are computed anew.

So every pair of sets that share a band is either compared, or both are
already known to be in one component.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import SIMILAR_PCT, by_hash, cut, settled

# Elements of all sets of a block together, on average: 4 MB of 64-bit hashes.
BLOCK_ELEMENTS = 500_000
# Cells of the matrix of members and elements up to which a block is compared as one product: 4 MB.
DENSE = 1_000_000
MAX_ROUNDS = 60


def _components(edges: DataFrame) -> DataFrame:
    """Rounds of large-star and small-star linking: every node is linked to the
    least of its neighbourhood, first from its greater neighbours, then from
    its smaller ones, until nothing moves. Each round is written to the shared
    folder; the driver sees a checksum of the edges only.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: the neighbours greater than a node go to the least of the node and its neighbours
        lowest = cut(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "lowest")
        large = cut(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        # small star: a node and its smaller neighbours go to the least of them
        lowest = cut(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of an edge (a, b): the least id reachable."""
    return settled(edges.sparkSession, lambda: _components(edges), "components")


def _verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left, right = sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(100 * common >= pct * (F.size("x") + F.size("y") - common)).select("a", "b")


def find_links(ids: list, labels: list, sets: list[np.ndarray], side: np.ndarray, pct: int) -> list[tuple]:
    """Links between sets of different labels, enough to connect what is connected; ``side``: the block (0 or 1) of each, 0 and 1 meet.

    If all have side 0, all meet. Members of the most common label are not
    looked up: every pair across labels has a member of another label.
    """
    counts = Counter(labels)
    common = counts.most_common(1)[0][0]
    if len(counts) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    both = bool(side.any()) and not bool(side.all())
    asked = [i for i, label in enumerate(labels) if label != common]
    parent = {label: label for label in counts}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    number = np.concatenate(([0], np.cumsum(flat[1:] != flat[:-1])))  # of each element
    width = int(number[-1]) + 1
    if len(sets) * width <= DENSE:
        # few and small sets: what they share, all at once, as a product of 0/1 matrices (below 2 ** 24, so exact)
        held = np.zeros((len(sets), width), dtype=np.float32)
        held[owner, number] = 1
        counted = (held[asked] @ held.T).astype(np.int64)
    out = []
    for k, i in enumerate(asked):
        s = sets[i]
        if len(sets) * width <= DENSE:
            shared = counted[k]
        else:
            begin, end = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
            n = end - begin
            at = np.repeat(begin - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            shared = np.bincount(owner[at], minlength=len(sets))
        hits = np.flatnonzero((shared > 0) & (100 * shared >= pct * (sizes + len(s) - shared)))
        for j in hits.tolist():
            if j != i and not (both and side[i] == side[j]) and (a := root(labels[i])) != (b := root(labels[j])):
                parent[a] = b
                out.append((ids[i], ids[j]))
    return out


def runs_of(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each run of equal (integer) ``keys`` in sorted rows, however they are dealt into batches."""
    held: list[pd.DataFrame] = []  # of the run that the next batch may go on with
    for pdf in batches:
        if not len(pdf):
            continue
        at = pdf[keys].to_numpy()
        edges = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(pdf)]
        if held and (at[0] != held[0][keys].iloc[0].to_numpy()).any():
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        for begin, end in zip(edges, edges[1:]):
            if held and begin:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(pdf.iloc[begin:end])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _rest(buckets: DataFrame, pivots: DataFrame, labels: DataFrame, nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], pct: int) -> DataFrame:
    """Links (a, b) among members that no star has compared."""
    kind = nodes.schema["id"].dataType.simpleString()
    members = (buckets.join(pivots, "bucket").where("id <> pivot").join(labels, "id", "left")
               .select("bucket", "id", F.coalesce("component", "id").alias("label")))
    members = cut(members, "members")
    open_ = (members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                           F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("digest"), F.count(F.lit(1)).alias("m"))
             .where("lo <> hi").groupBy("digest", "m").agg(F.min("bucket").alias("bucket")).select("bucket"))
    members = cut(members.join(cut(open_, "open"), "bucket").join(nodes.select("id", "n"), "id"), "rest")
    blocks = cut(members.groupBy("bucket").agg(F.ceil(F.sum("n") / F.lit(BLOCK_ELEMENTS)).alias("blocks")), "blocks")
    placed = members.join(blocks, "bucket").withColumn("k", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # a member of block k meets every block: the pair (i, j) with i <= j, of which k is one
    cells = (placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("bucket", "id", "label", F.least("k", "other").alias("i"), F.greatest("k", "other").alias("j"), "k"))
    sets = fetch(members.select("id").distinct())
    cells = cells.join(sets, "id")

    # Most cells hold a few members, so a batch of rows holds many cells: they are met in the order of sorted rows.
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in runs_of(batches, ["bucket", "i", "j"]):
            side = (cell["k"] != cell["i"]).to_numpy().astype(int)
            if found := find_links(list(cell["id"]), list(cell["label"]), [np.asarray(x) for x in cell["elements"]], side, pct):
                yield pd.DataFrame(found, columns=["a", "b"])
    cells = cells.select("bucket", "i", "j", "k", "id", "label", "elements").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return cells.mapInPandas(search, f"a {kind}, b {kind}")


def _similar(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], pct: int = SIMILAR_PCT) -> DataFrame:
    keyed = nodes.where("n > 0").select("id", F.posexplode("bands").alias("band", "key")).select("id", F.xxhash64("band", "key").alias("bucket"))
    shared = cut(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared")
    buckets = cut(by_hash(keyed, shared, "bucket"), "buckets")
    score = buckets.groupBy("id").agg(F.sum("m").alias("score"))
    scored = buckets.join(score, "id")
    pivots = cut(scored.groupBy("bucket").agg(F.max_by("id", F.struct("score", "id")).alias("pivot")), "pivots")
    pairs = cut(buckets.join(pivots, "bucket").where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")
    sets = cut(fetch(cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")), "sets")
    links = cut(_verified(pairs, sets, pct), "links")
    labels = components(links)
    more = cut(_rest(buckets.select("bucket", "id"), pivots, labels, nodes, lambda ids: sets.join(ids, "id"), pct), "more-links")
    if more.limit(1).count() == 0:
        return labels
    return components(links.unionByName(more))


def similar(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], pct: int = SIMILAR_PCT) -> DataFrame:
    """(id, component) of every set that is linked with another one.

    ``nodes``: (id, n, bands array<long>), one row per distinct set, written to
    storage. ``fetch`` returns (id, elements array<long>, sorted and distinct) for
    a table of ids; it is asked only for sets that share a band with another.
    """
    return settled(nodes.sparkSession, lambda: _similar(nodes, fetch, pct), "similar")
