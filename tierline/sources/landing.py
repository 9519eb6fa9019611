"""Landing zone: raw extracts as JSON lines (or Parquet), one partition per run.

Layout: ``<root>/<table>/load_date=YYYY-MM-DD/run_id=<run>/part-*.json``.

* Writes happen on the executors (never through the driver) and overwrite
  only their own ``(load_date, run_id)`` partition (dynamic partition
  overwrite). A retried run replaces its own files instead of duplicating
  them, and the run becomes visible only when its job commits.
* Two encodings: ``"iso"`` is what Spark's JSON writer produces (ISO-8601
  instants with milliseconds, NULL fields omitted); ``"epoch_ms"`` is the
  encoding of a pandas-based extract (epoch milliseconds, money as float,
  explicit nulls). Bronze reads both (see ``tierline.sources.bronze``).
* Run bookkeeping (which runs exist, archiving consumed runs) is file
  *metadata* work through the Hadoop FileSystem API. No rows pass
  through the driver, and an archive is a directory rename, not a copy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.plans.publish import _jvm_fs, list_dirs, make_dirs, publish_folder

LOAD_DATE = "load_date"
RUN_ID = "run_id"
ISO = "iso"
EPOCH_MS = "epoch_ms"
# JSON lines repeat every column's name: they are compressed. A gzip file is read by one task, so it has this many rows at most.
COMPRESSION = "gzip"
MAX_FILE_ROWS = 1_000_000
# Fixed format: Spark's JSON instant encoding (UTC renders as 'Z').
ISO_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# Fixed formats of the older daily landing: one JSON-lines object per table
# and day named "<table>_<ddMMyyyy>.json", archived under
# "<archive>/<table>/<yyyy>/<MM>/<dd>/"; the day is read back from the name.
DAILY_NAME_FORMAT = "%d%m%Y"
DAILY_NAME_SPARK_FORMAT = "ddMMyyyy"
DAILY_NAME_PATTERN = r"_([0-9]{8})\.json(/|$)"
LANDING_DATE = "landing_date"


def encode(df: DataFrame, encoding: str = ISO, instants_as_text: bool = False) -> DataFrame:
    """Apply the landing encoding to typed source columns.

    JSON carries instants as text by nature; a Parquet landing file would keep
    them typed, so ``instants_as_text`` renders them in the encoding's text
    form there (bronze declares event times as STRING).
    """
    if encoding == ISO:
        if not instants_as_text:
            return df
        return df.select([
            (F.date_format(F.col(f.name).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
             if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)).alias(f.name)
            for f in df.schema.fields])
    if encoding != EPOCH_MS:
        raise ValueError(f"unknown encoding {encoding!r}")
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_millis(c.cast("timestamp"))
            if instants_as_text:
                c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(cols)


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_landing(df: DataFrame, root: str, table: str, run_id: str | None, load_date: str | dt.date,
                  encoding: str = ISO, fmt: str = "json") -> str:
    """Land one extract of ``table`` as run ``run_id``, or as the runs of its column ``run_id`` if that is None; returns the table's landing path."""
    out = encode(df, encoding, instants_as_text=(fmt == "parquet")) \
        .withColumn(LOAD_DATE, F.lit(str(load_date)).cast("date"))
    if run_id is not None:
        out = out.withColumn(RUN_ID, F.lit(run_id))
    path = table_path(root, table)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(LOAD_DATE, RUN_ID)
    if fmt == "json":
        writer.option("timestampFormat", ISO_TIMESTAMP_FORMAT) \
            .option("compression", COMPRESSION).option("maxRecordsPerFile", MAX_FILE_ROWS) \
            .option("ignoreNullFields", str(encoding == ISO).lower()).json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown landing format {fmt!r}")
    # a run without rows leaves its folder all the same: it took place
    if run_id is not None:
        make_run(df.sparkSession, root, table, run_id, load_date)
    return path


def make_run(spark: SparkSession, root: str, table: str, run_id: str, load_date: str | dt.date) -> None:
    """The folder of a run, also of one without rows."""
    make_dirs(spark, f"{table_path(root, table)}/{LOAD_DATE}={load_date}/{RUN_ID}={run_id}")


def landed_runs(spark: SparkSession, root: str, table: str) -> list[tuple[str, str]]:
    """Committed runs of ``table`` as (load_date, run_id), in run order."""
    base = table_path(root, table)
    runs = []
    for d in list_dirs(spark, base):
        if not d.startswith(f"{LOAD_DATE}="):
            continue
        for r in list_dirs(spark, f"{base}/{d}"):
            if r.startswith(f"{RUN_ID}="):
                runs.append((d.split("=", 1)[1], r.split("=", 1)[1]))
    return sorted(runs, key=lambda x: (x[1], x[0]))


def pending_runs(spark: SparkSession, root: str, table: str, published: set[str]) -> list[str]:
    """Landed run ids that are not among the ``published`` ones, in order."""
    return sorted({r for _, r in landed_runs(spark, root, table)} - set(published))


def discard_runs(spark: SparkSession, root: str, table: str, run_ids: set[str]) -> None:
    """Take the folders of runs out of landing (extracts that were never audited and will be made again)."""
    for load_date, run in landed_runs(spark, root, table) if run_ids else []:
        if run in run_ids:
            fs, path, _ = _jvm_fs(spark, f"{table_path(root, table)}/{LOAD_DATE}={load_date}/{RUN_ID}={run}")
            fs.delete(path, True)


def archive_runs(spark: SparkSession, root: str, archive_root: str, table: str,
                 keep: list[str] | None = None) -> list[str]:
    """Move every run of ``table`` except ``keep`` to the archive, preserving the layout.

    Rename, not copy: a metadata operation per run folder on HDFS-like
    stores. Returns the archived run ids.
    """
    keep = set(keep or [])
    moved = []
    for load_date, run in landed_runs(spark, root, table):
        if run in keep:
            continue
        rel = f"{LOAD_DATE}={load_date}/{RUN_ID}={run}"
        src = f"{table_path(root, table)}/{rel}"
        dst = f"{table_path(archive_root, table)}/{rel}"
        fs, src_path, jvm = _jvm_fs(spark, src)
        dst_path = jvm.org.apache.hadoop.fs.Path(dst)
        fs.mkdirs(dst_path.getParent())
        if not fs.rename(src_path, dst_path):
            raise OSError(f"could not archive {src} -> {dst}")
        moved.append(run)
    return moved


# --------------------------------------------------------------------------- daily landing

def daily_landing_path(root: str, table: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{table}_{day.strftime(DAILY_NAME_FORMAT)}.json"


def write_daily_landing(df: DataFrame, root: str, table: str, day: dt.date,
                        encoding: str = EPOCH_MS) -> str:
    """The older daily landing object ``<table>_<ddMMyyyy>.json``, replaced on a same-day rerun.

    Written by the executors as a folder of JSON-lines part files under that
    name, not through a driver-side pandas frame. ``epoch_ms`` (the default)
    is that extract's encoding, with explicit nulls.
    """
    path = daily_landing_path(root, table, day)
    writer = encode(df, encoding).write.option("timestampFormat", ISO_TIMESTAMP_FORMAT) \
        .option("ignoreNullFields", str(encoding == ISO).lower())
    publish_folder(df.sparkSession, path, writer.json)
    return path


def daily_objects(spark: SparkSession, root: str, table: str) -> list[tuple[dt.date, str]]:
    """(day, name) of every daily landing object of ``table`` under ``root``, by day (metadata only)."""
    fs, hpath, _ = _jvm_fs(spark, root)
    if not fs.exists(hpath):
        return []
    found = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        stem = name[len(table) + 1:-len(".json")] if name.startswith(f"{table}_") and name.endswith(".json") else ""
        if len(stem) == 8 and stem.isdigit():
            found.append((dt.datetime.strptime(stem, DAILY_NAME_FORMAT).date(), name))
    return sorted(found)


def archive_daily(spark: SparkSession, root: str, archive_root: str, table: str,
                  keep: dt.date | None = None) -> list[dt.date]:
    """Move daily objects of ``table`` (all but day ``keep``) to ``<archive>/<table>/<yyyy>/<MM>/<dd>/``.

    The day comes from the object's name. Each move is a rename of one
    folder (metadata work); a same-day object already in the archive is
    replaced, as a rerun of that day would.
    """
    moved = []
    for day, name in daily_objects(spark, root, table):
        if day == keep:
            continue
        src = f"{root.rstrip('/')}/{name}"
        dst = f"{table_path(archive_root, table)}/{day:%Y}/{day:%m}/{day:%d}/{name}"
        fs, src_path, jvm = _jvm_fs(spark, src)
        dst_path = jvm.org.apache.hadoop.fs.Path(dst)
        if fs.exists(dst_path):
            fs.delete(dst_path, True)
        fs.mkdirs(dst_path.getParent())
        if not fs.rename(src_path, dst_path):
            raise OSError(f"could not archive {src} -> {dst}")
        moved.append(day)
    return moved


def archived_daily_glob(archive_root: str, table: str) -> str:
    """Where ``archive_daily`` put a table's objects, as one glob over the dated folders."""
    return f"{table_path(archive_root, table)}/*/*/*"
