"""Type-2 slowly changing dimension merge, as pure DataFrame algebra.

Semantics are those of the two MERGE statements the reference runs per
table (expire, then insert), written in closed form:

1. ``active`` = target rows with ``is_active``; all other rows are history
   and are never touched.
2. ``closed`` = active rows with a batch row of the same key whose tracked
   columns differ (``t.c != s.c OR ...``; three-valued, so a change to or
   from NULL alone is *not* a change). They get ``is_active = false`` and
   ``effective_end_date = as_of``.
3. ``kept`` = the other active rows.
4. ``opened`` = batch rows whose key has no ``kept`` row. They open with
   ``effective_start_date = effective_end_date = as_of``, ``is_active``.
5. result = history + closed + kept + opened.

Physical shape: live versions and batch rows are one tagged union that is
exchanged by key once. Inside a key's rows, window aggregates classify every version:

* a live version whose key has one batch row changes if that row differs from it;
* of the few keys with several batch rows, an extra row of the union carries, for each
  tracked column, the two least and the two greatest values with the rows they
  are from (made from the batch alone). A live version changes if the least or greatest value differs from
  its own (both ignore NULLs, as the comparison does), which is so exactly when any does. Two batch rows change the same version if two
  different rows are among those that differ. That finds every conflict: rows that differ in one
  column are on one side of the version's value (then its two least or two greatest do) or on both
  (its least and greatest do), and a row that alone differs in its column is the least or greatest there;
* a batch row opens a version if no live version of its key is kept.

So the target is exchanged and sorted once, however large the batch; no list of a
key's rows is ever built, and windows spill. Rows with a NULL key can never
match, so they skip the exchange; millions of them would otherwise all hash
into one shuffle partition.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tierline.operators.quality import with_quarantine
from tierline.schemas import EFFECTIVE_END, EFFECTIVE_START, IS_ACTIVE, IS_QUARANTINED, TableSpec

FATE = "_fate"
CLOSED, KEPT, OPENED = "closed", "kept", "opened"
_KIND, _LIVE, _NEW, _ENDS = "_kind", "live", "new", "ends"
_N, _ONE, _KEPT, _CHANGED, _CONFLICT = "_n", "_one", "_n_kept", "_changed", "_conflict"


@dataclass
class Scd2Result:
    history: DataFrame   # inactive versions of the target, untouched
    merged: DataFrame    # the other versions after the batch, with their FATE
    columns: list[str]   # of the silver table

    def _of(self, fate: str) -> DataFrame:
        return self.merged.where(F.col(FATE) == fate).select(*self.columns)

    @property
    def closed(self) -> DataFrame:
        """Versions expired by this batch."""
        return self._of(CLOSED)

    @property
    def kept(self) -> DataFrame:
        """Live versions the batch did not change."""
        return self._of(KEPT)

    @property
    def opened(self) -> DataFrame:
        """New versions opened by this batch."""
        return self._of(OPENED)

    def all_versions(self) -> DataFrame:
        return self.history.unionByName(self.merged.select(*self.columns))


def payload_columns(spec: TableSpec) -> list[str]:
    cols = list(spec.columns)
    if spec.has_quarantine:
        cols.append(IS_QUARANTINED)
    return cols


def prepare_batch(batch: DataFrame, spec: TableSpec, dedup: bool = True) -> DataFrame:
    """Registry projection (by name), quarantine flag, whole-row DISTINCT where the spec has it (and ``dedup``)."""
    src = batch.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    if spec.has_quarantine:
        src = with_quarantine(src, spec.quarantine_if_null)
    if spec.dedup and dedup:
        src = src.distinct()
    return src


def empty_target(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.silver_schema())


def _keys_present(keys) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _versions(src: DataFrame, cols: list[str], as_of: Column, fate: str) -> DataFrame:
    return src.select(*cols, as_of.alias(EFFECTIVE_START), as_of.alias(EFFECTIVE_END), F.lit(True).alias(IS_ACTIVE), F.lit(fate).alias(FATE))


def scd2_merge(target: DataFrame | None, batch: DataFrame, spec: TableSpec, as_of: dt.datetime,
               strict: bool = True, null_safe: bool = False,
               prepared: bool = False, unique: bool = False, partitions: int | None = None,
               seen: Observation | None = None) -> Scd2Result:
    """Apply one batch to an SCD2 table; see the module docstring.

    ``target=None`` is the first load of a table that does not exist yet:
    every batch row opens a version, so nothing is exchanged and the batch
    is derived once (see ``initial_load``).

    ``strict``: fail the job (lazily, inside the plan) when two batch rows
    would both expire the same active version, which MERGE rejects; with
    ``strict=False`` that version is closed once and both rows open.
    ``null_safe``: count NULL <-> value as a change (not the reference's rule).
    ``partitions``: the batch is exchanged by its key to that many, where a target that is a table of as many
    buckets of the key meets it as it lies; a batch that lies so already isn't exchanged either.
    ``unique``: no key occurs twice in the batch, so nothing is made of such keys; ``seen`` gets, as ``batch_rows``, how
    often one does at most, by which a caller who took that for granted can tell.
    """
    keys, cols = list(spec.keys), payload_columns(spec)
    silver = spec.silver_schema().names
    stamp = F.lit(as_of).cast("timestamp")

    if target is None:
        return initial_load(batch, spec, as_of, prepared=prepared)
    src = batch if prepared else prepare_batch(batch, spec)
    target = target.select(*silver)
    is_active = F.col(IS_ACTIVE) == F.lit(True)
    active = target.where(is_active)
    history = target.where(~F.coalesce(is_active, F.lit(False))).select(*silver)
    present = _keys_present(keys)

    keyed, spread = src.where(present), src.where(present)
    if partitions:
        spread = spread.repartition(partitions, *keys)
    new = spread.select(F.lit(_NEW).alias(_KIND), *cols, stamp.alias(EFFECTIVE_START), stamp.alias(EFFECTIVE_END))
    live = active.where(present).select(F.lit(_LIVE).alias(_KIND), *cols, EFFECTIVE_START, EFFECTIVE_END)
    ends = _ends(keyed, keys, spec, null_safe)
    rows = new.unionByName(live)    # in this order a union of alike partitions is one of them to Spark, too, if the target is a bucketed table
    if unique:
        rows = rows.withColumn(_ENDS, F.lit(None).cast(ends.schema[_ENDS].dataType))
    else:
        rows = rows.unionByName(ends.repartition(partitions, *keys) if partitions else ends, allowMissingColumns=True)
    rows = _classified(rows, Window.partitionBy(*keys), spec, null_safe)
    if seen is not None:
        rows = rows.observe(seen, F.max(_N).alias("batch_rows"))
    rows = _fated(rows, spec, strict)
    merged = rows.where(F.col(FATE).isNotNull()).select(
        *cols, EFFECTIVE_START, F.when(F.col(FATE) == CLOSED, stamp).otherwise(F.col(EFFECTIVE_END)).alias(EFFECTIVE_END),
        (F.col(FATE) != CLOSED).alias(IS_ACTIVE), FATE)
    absent = src.where(~present)
    merged = merged.unionByName(active.where(~present).withColumn(FATE, F.lit(KEPT))).unionByName(
        _versions(absent.distinct() if spec.dedup else absent, cols, stamp, OPENED))
    return Scd2Result(history, merged, silver)


def initial_load(batch: DataFrame, spec: TableSpec, as_of: dt.datetime, prepared: bool = False) -> Scd2Result:
    """``scd2_merge`` into an absent table: every batch row opens a live version.

    This is what the closed form gives for an empty target (nothing to close
    or keep, and no active version two batch rows could both change), but it
    is one pass over the batch.
    """
    src = batch if prepared else prepare_batch(batch, spec)
    opened = _versions(src, payload_columns(spec), F.lit(as_of).cast("timestamp"), OPENED)
    return Scd2Result(empty_target(batch.sparkSession, spec), opened, spec.silver_schema().names)


def _ends(src: DataFrame, keys: list[str], spec: TableSpec, null_safe: bool) -> DataFrame:
    """One row for each key with several batch rows: of each tracked column the two least and greatest values, each with the row it is from.

    A column NULL in every batch row has none, unless NULL counts as a value.
    """
    several = src.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N)).where(F.col(_N) > 1).select(*keys)
    rows = src.join(several, keys, "left_semi").withColumn("_row", F.monotonically_increasing_id())
    key = Window.partitionBy(*keys)
    value = {c: F.when(F.lit(null_safe) | F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("_row").alias("row"))) for c in spec.tracked}

    def beside(c: str, end: str) -> Column:
        """The values but the one at that end."""
        return F.when(value[c] != F.col(f"_{end}_{c}"), value[c])

    rows = rows.withColumns({**{f"_min_{c}": F.min(v).over(key) for c, v in value.items()}, **{f"_max_{c}": F.max(v).over(key) for c, v in value.items()}})
    found = {c: [F.col(f"_min_{c}"), F.min(beside(c, "min")), F.col(f"_max_{c}"), F.max(beside(c, "max"))] for c in spec.tracked}
    ends = [F.struct(*[(e if k % 2 == 0 else e.over(key)).alias(n) for k, (n, e) in enumerate(zip(("min", "min2", "max", "max2"), found[c]))]).alias(c)
            for c in spec.tracked]
    return rows.select(F.lit(_ENDS).alias(_KIND), *keys, F.struct(*ends).alias(_ENDS), (F.col("_row") == F.min("_row").over(key)).alias("_one")) \
        .where("_one").drop("_one")


def _classified(rows: DataFrame, key: Window, spec: TableSpec, null_safe: bool) -> DataFrame:
    """``rows`` (live versions, batch rows, ends) with whether each version changes, is in conflict, and how many of its key are kept."""
    tracked, live, new = list(spec.tracked), F.col(_KIND) == _LIVE, F.col(_KIND) == _NEW
    rows = rows.withColumns({_N: F.count(F.when(new, 1)).over(key), _ENDS: F.first(_ENDS, ignorenulls=True).over(key),
                             _ONE: F.first(F.when(new, F.struct(*tracked)), ignorenulls=True).over(key)})

    def other(value: Column, c: str) -> Column:
        return ~value.eqNullSafe(F.col(c)) if null_safe else F.coalesce(value != F.col(c), F.lit(False))

    def end(c: str, which: str) -> Column:
        """Where a version differs from that value, the row the value is from."""
        seen = F.col(_ENDS)[c][which]
        return F.when(seen.isNotNull() & other(seen["v"], c), seen["row"])

    by_one = reduce(or_, [other(F.col(_ONE)[c], c) for c in tracked], F.lit(False))
    by_ends = reduce(or_, [end(c, "min").isNotNull() | end(c, "max").isNotNull() for c in tracked], F.lit(False))
    changed = F.when(F.col(_N) == 1, by_one).when(F.col(_N) > 1, by_ends).otherwise(F.lit(False))
    changing = F.array(*[end(c, which) for c in tracked for which in ("min", "min2", "max", "max2")])
    conflict = F.when((F.col(_N) > 1) & by_ends, F.size(F.array_distinct(F.array_compact(changing))) > 1).otherwise(F.lit(False))
    rows = rows.withColumns({_CHANGED: live & changed, _CONFLICT: live & conflict}).drop(_ENDS, _ONE)
    return rows.where(F.col(_KIND) != _ENDS).withColumn(_KEPT, F.count(F.when(live & ~F.col(_CHANGED), 1)).over(key))


def _fated(rows: DataFrame, spec: TableSpec, strict: bool) -> DataFrame:
    """``rows`` with their FATE, null for batch rows that open nothing; if ``strict``, a conflict fails the job."""
    fate = F.when(F.col(_KIND) == _NEW, F.when(F.col(_KEPT) == 0, OPENED)).when(F.col(_CHANGED), CLOSED).otherwise(KEPT)
    if strict:
        message = F.concat(F.lit(f"scd2_merge({spec.name}): several batch rows change one active version, key="), F.to_json(F.struct(*spec.keys)))
        fate = F.when(F.col(_CONFLICT), F.raise_error(message).cast("string")).otherwise(fate)
    return rows.withColumn(FATE, fate)
