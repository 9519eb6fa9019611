"""Publishing layer tables as plain Parquet folders (no MERGE-capable format needed).

* ``SilverTables``: the silver tables. An SCD2 table is one Parquet table
  partitioned by ``is_active`` and ``slot``. A live version lies in the slot of
  its key's hash bucket (``b<bucket>-h<buckets>``), a version that run <id> closed
  in ``r<id>``, and live rows without a key, which nothing can match again,
  in the slot ``n<id>`` of the run that brought them. The files of a slot are those of a
  table bucketed by the key (``bucketBy``), and a slot's bucket is Spark's: the live rows of a bucket are read in one task,
  where the batch comes to them by one exchange. A run reads the live rows
  of the buckets its batch touches, merges, and replaces those buckets only, each by
  a rename: all other files stay as they are. A query
  on live versions prunes the closed ones, and a run the buckets it doesn't touch, at planning time.
* Runs can be repeated. The merged buckets are written to ``_try/<run>``
  first, which also cuts the lineage; once that write has completed it becomes ``_merge/<run>``, and the buckets
  are moved from there into place, however often it is interrupted, before any other run is merged. A job that fails
  before leaves the table as it was. ``_runs/<id>`` lists the runs a table has
  taken in. While buckets are replaced a reader may see some of them
  before and some after the run, as with any overwrite of Parquet folders.
* ``create_if_absent`` / ``overwrite``: CTAS-if-absent (the reference's
  gold ``CREATE TABLE IF NOT EXISTS ... AS``) and refresh, both written to a
  staging folder and renamed. The folder that was there stays beside it until then, and is
  put back if a crash came in between: a failed job leaves what was there.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.scd2 import CLOSED, FATE, prepare_batch, scd2_merge
from tierline.schemas import IS_ACTIVE, TableSpec


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists (for a glob: when it matches anything)."""
    fs, hpath, _ = _jvm_fs(spark, path)
    if any(ch in path for ch in "*?["):
        found = fs.globStatus(hpath)
        return found is not None and len(found) > 0
    return bool(fs.exists(hpath))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata only; no data passes the driver)."""
    fs, hpath, _ = _jvm_fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory())


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath, _ = _jvm_fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, hpath, _ = _jvm_fs(spark, path)
    fs.mkdirs(hpath)


def move_dir(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename folder ``src`` to ``dst`` (replacing ``dst``); False when ``src`` is absent.

    A rename is a metadata operation on HDFS-like filesystems; no data is copied
    through the driver.
    """
    fs, hsrc, jvm = _jvm_fs(spark, src)
    if not fs.exists(hsrc):
        return False
    hdst = jvm.org.apache.hadoop.fs.Path(dst)
    if fs.exists(hdst):
        fs.delete(hdst, True)
    fs.mkdirs(hdst.getParent())
    if not fs.rename(hsrc, hdst):
        raise OSError(f"could not move {src} to {dst}")
    return True


def publish_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` a complete folder beside ``path``, then rename it into place; a failed write changes nothing."""
    parent, _, name = path.rstrip("/").rpartition("/")
    staging, before = f"{parent}/_staging-{name}", f"{parent}/_before-{name}"
    restore(spark, path)
    delete_path(spark, staging)
    write(staging)
    move_dir(spark, path, before)
    move_dir(spark, staging, path)
    delete_path(spark, before)


def restore(spark: SparkSession, path: str) -> None:
    """Put back the folder that ``publish_folder`` had moved aside when it crashed before the new one was in place."""
    parent, _, name = path.rstrip("/").rpartition("/")
    if not path_exists(spark, path):
        move_dir(spark, f"{parent}/_before-{name}", path)


def read_with_schema(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


SLOT = "slot"
BUCKETS = 16                # of a new table, at least
MOST_BUCKETS = 100_000      # that Spark takes unless told otherwise
BUCKET_BYTES = 256 << 20    # of landed rows a bucket of a new table is meant for
_RUNS, _BATCH, _MERGE, _TRY = "_runs", "_batch", "_merge", "_try"    # leading underscore: ignored by Parquet readers of the table
COMPRESSION = "zstd"        # of what is written here: a merge writes whole buckets


def buckets_for(total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of a new table from the size of its first batch."""
    return min(MOST_BUCKETS, max(BUCKETS, -(-total_bytes // bucket_bytes)))


def keys_present(keys) -> Column:
    return F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull()


def bucket_of(keys, buckets: int) -> Column:
    """The number of a key's bucket, which is that of a bucketed table and of an exchange by the key; null if a key column is."""
    return F.when(keys_present(keys), F.pmod(F.hash(*keys), F.lit(buckets)))


def slot_name(bucket: Column, buckets: int) -> Column:
    """The slot of the live versions of a bucket; null for rows without a key."""
    return F.concat(F.lit("b"), F.lpad(bucket.cast("string"), 5, "0"), F.lit(f"-h{buckets}"))    # a row's, so no format is read


@contextmanager
def setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """A session setting while the block runs."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class SilverTables:
    """Silver tables under ``root/<table>/`` (see the module docstring)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def runs(self, table: str) -> list[str]:
        """The runs the table has taken in, in the order of their ids."""
        return list_dirs(self.spark, f"{self.path(table)}/{_RUNS}")

    def record(self, table: str, run: str) -> None:
        make_dirs(self.spark, f"{self.path(table)}/{_RUNS}/{run}")

    def read(self, table: str, spec: TableSpec) -> DataFrame | None:
        """The table, or None before its first run."""
        rows = self._slots(table, spec)
        return None if rows is None else rows.select(*spec.silver_schema().names)

    def _slots(self, table: str, spec: TableSpec) -> DataFrame | None:
        base, schema = self.path(table), spec.silver_schema()
        if not self.runs(table):
            return None
        if IS_ACTIVE not in schema.names:
            restore(self.spark, f"{base}/current")
            return self.spark.read.schema(schema).parquet(f"{base}/current")
        return self.spark.read.schema(_stored(spec)).parquet(base)

    def refresh(self, table: str, df: DataFrame, run: str, spec: TableSpec) -> DataFrame:
        """Replace a full-refresh table by the rows of a run."""
        publish_folder(self.spark, f"{self.path(table)}/current", df.write.parquet)
        self.record(table, run)
        return self.read(table, spec)

    def merge(self, table: str, batch: DataFrame, run: str, spec: TableSpec, as_of: dt.datetime, buckets: int = BUCKETS,
              derive_once: bool = True, batch_keys: DataFrame | None = None, **kwargs) -> DataFrame:
        """Merge the batch of a run into an SCD2 table; a run already taken in changes nothing.

        ``buckets`` counts for a new table only. ``derive_once``: the batch is written to a folder of its own and read
        from there; False for one that gives the same rows whenever it is read and is cheap to derive. ``batch_keys``: rows
        with the batch's keys, each as often as it comes, if they are cheaper to have than the batch.
        """
        base = self.path(table)
        self.finish(table, spec)
        if run in self.runs(table):
            return self.read(table, spec)
        if not self.runs(table):
            delete_path(self.spark, base)       # what a crashed first load has left
            self._first(batch, run, spec, as_of, buckets, base, **kwargs)
            self.record(table, run)
            return self.read(table, spec)
        buckets = self.buckets(table) or buckets
        src = prepare_batch(batch, spec, dedup=False)
        if derive_once:
            src.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{base}/{_BATCH}/{run}")
            src, batch_keys = self.spark.read.schema(src.schema).parquet(f"{base}/{_BATCH}/{run}"), None
        numbers = (src if batch_keys is None else batch_keys).select(bucket_of(spec.keys, buckets).alias("bucket")).distinct()
        touched = [r[SLOT] for r in numbers.where("bucket IS NOT NULL").select(slot_name(F.col("bucket"), buckets).alias(SLOT)).collect()]    # one entry a bucket
        tried, written = f"{base}/{_TRY}/{run}", f"{base}/{_MERGE}/{run}"

        def write(rows: DataFrame, **more) -> None:
            target = self.spark.table(stored).where(F.col(IS_ACTIVE) & F.col(SLOT).isin(touched))
            merged = scd2_merge(target, rows, spec, as_of, prepared=True, partitions=buckets, **kwargs, **more).merged
            self._write(merged, run, spec, buckets, tried)

        # A key rarely has several batch rows: that is taken for granted, counted on the way, and if one has, the merge is
        # made again from distinct rows with what it takes to compare them.
        seen = Observation(f"merge_{table}_{run}")
        with self._bucketed(spec, buckets, base) as stored:
            write(src, unique=True, seen=seen)
            if (seen.get.get("batch_rows") or 0) > 1:
                write(src.distinct() if spec.dedup else src)
        move_dir(self.spark, tried, written)
        self.finish(table, spec)
        return self.read(table, spec)

    def _first(self, batch: DataFrame, run: str, spec: TableSpec, as_of: dt.datetime, buckets: int, base: str, **kwargs) -> None:
        """The first load: rows with a key go to their buckets, are made distinct there and written."""
        src = prepare_batch(batch, spec, dedup=False)
        keyed = src.where(keys_present(spec.keys)).repartition(buckets, *spec.keys)
        absent = src.where(~keys_present(spec.keys))
        if spec.dedup:
            keyed, absent = keyed.distinct(), absent.distinct()
        merged = scd2_merge(None, keyed.unionByName(absent), spec, as_of, prepared=True, **kwargs).merged
        self._write(merged, run, spec, buckets, base)

    def _write(self, merged: DataFrame, run: str, spec: TableSpec, buckets: int, path: str) -> None:
        """The rows of a merge by slot. A batch aggregated by its key is exchanged for that to the buckets, and not again."""
        slot = F.when(F.col(FATE) == CLOSED, f"r{run}").otherwise(F.coalesce(slot_name(bucket_of(spec.keys, buckets), buckets), F.lit(f"n{run}")))
        delete_path(self.spark, path)
        with self._bucketed(spec, buckets, path) as name, setting(self.spark, "spark.sql.shuffle.partitions", buckets):
            merged.withColumn(SLOT, slot).select(*_stored_columns(spec)).write.insertInto(name)

    @contextmanager
    def _bucketed(self, spec: TableSpec, buckets: int, path: str) -> Iterator[str]:
        """The name of the rows under ``path`` as a table of the catalog, which buckets need, while the block runs; its files stay."""
        name, place = f"silver_{uuid.uuid4().hex}", path.replace("'", "\\'")
        fields = {f.name: f.dataType.simpleString() for f in _stored(spec).fields}
        columns = ", ".join(f"`{c}` {fields[c]}" for c in _stored_columns(spec))
        keys = ", ".join(f"`{k}`" for k in spec.keys)
        try:
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression '{COMPRESSION}') PARTITIONED BY ({IS_ACTIVE}, {SLOT}) "
                           f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'")
            if path_exists(self.spark, path):
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            yield name
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def finish(self, table: str, spec: TableSpec) -> None:
        """Put the buckets of a merged run in place of the stored ones; whatever was interrupted before that is dropped.

        Each is a rename; one interrupted between has its other buckets still under ``_merge``.
        """
        base, done = self.path(table), set(self.runs(table))
        for run in list_dirs(self.spark, f"{base}/{_MERGE}"):
            written = f"{base}/{_MERGE}/{run}"
            if run not in done and path_exists(self.spark, f"{written}/_SUCCESS"):
                for active in list_dirs(self.spark, written):
                    for slot in list_dirs(self.spark, f"{written}/{active}"):
                        move_dir(self.spark, f"{written}/{active}/{slot}", f"{base}/{active}/{slot}")
                self.record(table, run)
            delete_path(self.spark, written)
        for left in (_BATCH, _TRY):
            delete_path(self.spark, f"{base}/{left}")

    def buckets(self, table: str) -> int | None:
        """How many buckets a stored table has, from the name of one."""
        named = [n for n in list_dirs(self.spark, f"{self.path(table)}/{IS_ACTIVE}=true") if n.startswith(f"{SLOT}=b")]
        if named and "-h" not in named[0]:
            raise ValueError(f"{self.path(table)} has buckets of an earlier version ({named[0]}), which hashed keys otherwise: load it again")
        return int(named[0].rpartition("-h")[2]) if named else None


def _stored(spec: TableSpec) -> T.StructType:
    return T.StructType([*spec.silver_schema().fields, T.StructField(SLOT, T.StringType())])


def _stored_columns(spec: TableSpec) -> list[str]:
    """The columns of a stored table, those it is partitioned by last."""
    return [*[c for c in spec.silver_schema().names if c != IS_ACTIVE], IS_ACTIVE, SLOT]


def create_if_absent(df: DataFrame, path: str) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS ... AS``: a no-op if a job has completed the table."""
    restore(df.sparkSession, path)
    if not path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return overwrite(df, path)
    return read_with_schema(df.sparkSession, path, df.schema)


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Refresh a table: written whole to a staging folder, then renamed over the old one."""
    publish_folder(df.sparkSession, path, df.write.parquet)
    return read_with_schema(df.sparkSession, path, df.schema)
