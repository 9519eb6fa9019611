"""Mixing sources to target weights by entropy balancing (native: DataFrame operations only).

Each document gets a rate r (how often it is to be taken). Among all rates
with ``sum(r * size) = target`` for every source and ``0 <= r <= cap``, the
mix takes those of least relative entropy to "every document once". Their
form is known from the convex dual: ``r = min(cap, exp(lambda * size / scale))``
with one multiplier per source, an exponential tilt by size. The multipliers
are the roots of the dual's gradient; Newton iterations find them:

* the documents are counted once by (source, size), which is all that the
  gradient and its derivative need, so an iteration reads that table and not
  the documents;
* an iteration is one distributed aggregation over that table; Newton's step is taken on the
  logarithm of the gradient's moving part (a log-sum-exp, well scaled for
  long-tailed sizes) inside a bracket that always holds the root;
* each iteration's multipliers are written to the shared folder; the driver
  sees one number, the count of sources not yet converged.

Rates become whole copies by systematic rounding: the documents of a source
are dealt into buckets of about ``BUCKET`` rows by hash, a bucket adds its
rates up in order of size, and a document gets a copy for each whole number
passed. Neighbours have like sizes, so what one document is short of the next
one makes up. Of ``OFFSETS`` starting points each bucket uses the one whose
words come nearest to what its rates ask for, and one document whose size is
nearest to the rest gets a copy more or less, if that brings the words nearer.
No draw is random: reruns agree.

Defined results: a null text has size 0; a document of size 0 weighs nothing
(rate 1, one copy, no words); the null source is a source, ordered last; an empty table
gives an empty one; rows that are equal in id and text get copies of like
number but which of them gets which is arbitrary; other columns are ignored
(``mix``) or carried whatever their names are (``mixed_documents``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.shared import cut, settled, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKET = 4096
OFFSETS = 32
MAX_ITERATIONS = 80
TOLERANCE = 1e-9
_ONE = 1 << 32  # rates are rounded to whole copies in fixed point with 32 binary places


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, n, source_size, least, target) from (source, n, source_size, least), one row per source.

    Sources in code point order (null last) get the weights in turn and share
    the total by weight; a share stops at ``cap`` times the source and the
    excess is shared again. The fixed point is a water level: with the sources in the order in which
    they fill up, the level is known at the first that does not. The windows run over
    one row per source.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("pos") - 1) % len(weights) + 1)
    full = F.col("source_size") * F.lit(cap)
    filling = Window.orderBy(F.col("full") / F.col("weight"), "pos")
    everyone = Window.partitionBy()
    level = (F.col("total") - F.col("filled")) / F.col("thirsty")
    ranked = sizes.withColumn("pos", order).withColumn("weight", weight).withColumn("full", full)
    return (ranked
            .withColumn("total", F.sum("source_size").over(everyone))
            .withColumn("filled", F.coalesce(F.sum("full").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("thirsty", F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("first", F.row_number().over(filling))
            .withColumn("open", F.when(level * F.col("weight") <= F.col("full"), F.struct("first", level.alias("level"))))
            .withColumn("level", F.min("open").over(everyone)["level"])
            .withColumn("target", F.coalesce(F.least(F.col("full").cast("double"), F.col("level") * F.col("weight")), F.col("full").cast("double")))
            .select("source", "n", "source_size", "least", "target"))


def _rate(cap: int) -> Column:
    return F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.col("scale"))))


def multipliers(counts: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """The dual's solution: ``wanted`` with (scale, lam) for each source.

    ``counts``: (source, size, docs). All documents of a source are at the cap
    once lam reaches ln(cap) * scale / least, and all rates are below
    target / source_size once it falls to ln(target / source_size) * scale / least: the first bracket.
    """
    scale = F.col("source_size") / F.col("n")
    state = (wanted.where(F.col("source_size") > 0).withColumn("scale", scale)
             .withColumn("lo", F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) * F.col("scale") / F.col("least")))
             .withColumn("hi", F.lit(1.0 + 1e-9) * F.log(F.lit(float(cap))) * F.col("scale") / F.col("least"))
             .withColumn("lam", F.when(F.col("target") >= cap * F.col("source_size") * (1 - 1e-12), F.col("hi")).otherwise(F.lit(0.0)))
             .withColumn("open", F.lit(True)))
    state = cut(state, "mix-state")
    for _ in range(MAX_ITERATIONS):
        rate = _rate(cap)
        words = F.col("docs") * F.col("size")
        tilted = (counts.join(state.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                  .where("open")
                  .select("source", (words * rate).alias("f"),
                          F.when(rate < cap, words * rate * F.col("size") / F.col("scale")).otherwise(0.0).alias("g"))
                  .groupBy(F.col("source").alias("s")).agg(F.sum("f").alias("f"), F.sum("g").alias("g")))
        step = F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("g")
        over = F.col("f") > F.col("target")
        near = F.abs(F.col("f") - F.col("target")) <= TOLERANCE * F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("hi"))
        moved = (state.join(tilted, F.col("source").eqNullSafe(F.col("s")), "left")
                 .withColumn("stay", ~F.col("open") | F.col("f").isNull() | near)
                 .withColumn("lo2", F.when(F.col("stay"), F.col("lo")).otherwise(lo))
                 .withColumn("hi2", F.when(F.col("stay"), F.col("hi")).otherwise(hi))
                 .withColumn("step", F.when(F.col("g") > 0, step))
                 .withColumn("lam2", F.when(F.col("stay"), F.col("lam"))
                             .when((F.col("step") > F.col("lo2")) & (F.col("step") < F.col("hi2")), F.col("step"))
                             .otherwise((F.col("lo2") + F.col("hi2")) / 2))
                 # a bracket that can't be halved any more holds the root as well as a double can
                 .withColumn("open2", ~F.col("stay") & (F.col("hi2") - F.col("lo2") > 1e-14 * F.greatest(F.abs("lo2"), F.abs("hi2")))))
        state = cut(moved.select("source", "n", "source_size", "least", "target", "scale", F.col("lo2").alias("lo"),
                                 F.col("hi2").alias("hi"), F.col("lam2").alias("lam"), F.col("open2").alias("open")), "mix-state")
        if state.where("open").limit(1).count() == 0:
            break
    return (wanted.join(state.select(F.col("source").alias("s"), "scale", "lam"), F.col("source").eqNullSafe(F.col("s")), "left")
            .drop("s").withColumns({"scale": F.coalesce("scale", F.lit(1.0)), "lam": F.coalesce("lam", F.lit(0.0))}))


def _rounded(sized: DataFrame, rates: DataFrame, cap: int, keep: list[str]) -> DataFrame:
    """``sized`` (source, size, order columns ``h`` and ``id``, and ``keep``) with rate and copies."""
    rates = rates.withColumnRenamed("source", "s").withColumn("buckets", F.ceil(F.col("n_all") / F.lit(BUCKET)))
    bucket = Window.partitionBy("source", "bucket")
    inside = bucket.orderBy("size", "h", "id").rowsBetween(Window.unboundedPreceding, 0)
    df = (sized.join(rates.select("s", "n", "source_size", "target", "scale", "lam", "buckets"), F.col("source").eqNullSafe(F.col("s")))
          .withColumn("rate", _rate(cap))
          .withColumn("fixed", F.least(F.lit(cap * _ONE), F.floor(F.col("rate") * F.lit(float(_ONE)) + 0.5)))
          .withColumn("bucket", F.pmod(F.col("h"), F.col("buckets")))
          .withColumn("upto", F.sum("fixed").over(inside)))

    def copies(offset: Column) -> Column:
        return F.shiftright(F.col("upto") + offset, 32) - F.shiftright(F.col("upto") - F.col("fixed") + offset, 32)

    offsets = [F.lit((2 * k + 1) * _ONE // (2 * OFFSETS)) for k in range(OFFSETS)]
    wanted = F.sum(F.col("size") * F.col("rate")).over(bucket)
    misses = [F.struct(F.abs(F.sum(F.col("size") * copies(o)).over(bucket) - wanted).alias("miss"), o.alias("offset")) for o in offsets]
    df = df.withColumn("copies", copies(F.array_min(F.array(*misses))["offset"]))
    # the mend: one copy of the document nearest in size to what is missing (rest > 0) or too much (rest < 0)
    step = F.signum("rest").cast("long")
    can = (F.col("copies") + step).between(0, cap) & (F.abs(F.abs("rest") - F.col("size")) < F.abs("rest"))
    gap = F.when(can, F.abs(F.abs("rest") - F.col("size")))
    df = (df.withColumn("rest", wanted - F.sum(F.col("size") * F.col("copies")).over(bucket))
          .withColumn("gap", gap)
          .withColumn("turn", F.row_number().over(bucket.orderBy(F.col("gap").asc_nulls_last(), "h", "id")))
          .withColumn("copies", F.col("copies") + F.when((F.col("turn") == 1) & F.col("gap").isNotNull(), step).otherwise(0)))
    return df.select(*keep, "source", "size", "source_size", "target", "rate", "copies")


def _plan(sized: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    counts = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "mix-counts")
    by_source = counts.groupBy("source").agg(
        F.sum("docs").alias("n_all"), F.sum(F.when(F.col("size") > 0, F.col("docs")).otherwise(0)).alias("n"),
        F.sum(F.col("docs") * F.col("size")).alias("source_size"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    by_source = cut(by_source, "mix-sources")
    wanted = cut(targets(by_source.drop("n_all"), weights, cap), "mix-targets")
    solved = multipliers(counts.where("size > 0"), wanted, cap)
    return solved.join(by_source.select(F.col("source").alias("s"), "n_all"), F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    return docs.select(docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"),
                       F.xxhash64(docs[id_col], docs[text_col]).alias("h"), docs[id_col].alias("id"), *more)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: (id_col, size, source_size, target, source, rate, copies, taken)."""
    sized = cut(_sized(docs, id_col, text_col, source_col), "mix-sized")
    rates = settled(docs.sparkSession, lambda: _plan(sized, weights, cap), "mix-rates")
    out = _rounded(sized, rates, cap, ["id"])
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "source", "rate", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken (not at all, if it isn't)."""
    rates = settled(docs.sparkSession, lambda: _plan(_sized(docs, id_col, text_col, source_col), weights, cap), "mix-rates")
    whole = _sized(docs, id_col, text_col, source_col, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    out = _rounded(whole, rates, cap, ["row"]).where("copies > 0")
    return (out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
