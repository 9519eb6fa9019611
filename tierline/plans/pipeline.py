"""The medallion pipeline as plain functions: ingest -> refine -> serve.

* ``ingest_table``: one extract of one table (full or incremental from the
  audited high-water mark) landed as run ``run_id``; row count and max
  watermark are observed during the landing write (one pass), then one
  audit row is appended. The mark only moves after the landing commit.
* ``ingest_pages``: an increment as pages of bounded size by (watermark, id),
  each a run with an audit row of its own, many landed by one job; a failed run goes on behind its last audited page.
* ``ingest_config``: ``ingest`` of the active tables of a CSV or JSON config.
* ``refine_table``: silver consumes *every* landed run that its ledger doesn't
  list, in run order, also one that landed late (never just "the latest files", which
  would lose an increment when two ingests run before one refine). Each
  run is merged by itself, so a crash resumes where it stopped.
  A full-refresh table takes its newest run and refuses an empty one.
* ``serve``: the five gold marts from the current silver tables,
  created once (``CREATE TABLE IF NOT EXISTS ... AS``) or refreshed.
* ``archive``: move runs already published to silver out of landing.

The clock is always an argument (``now`` / ``as_of``), never read inside.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.time import run_metadata
from tierline.operators import gold
from tierline.operators.audit import FAILED, SUCCESS, append, audit_row, audit_rows, log_rows, read_audit, status_row
from tierline.operators.refresh import full_refresh
from tierline.operators.scd2 import empty_target
from tierline.operators.watermark import last_id_value, latest_watermark_value, observed
from tierline.plans.publish import SilverTables, buckets_for, create_if_absent, overwrite
from tierline.schemas import INCREMENTAL, REGISTRY, SCD2, TableSpec
from tierline.session import input_bytes, scratch_root, size_shuffle_partitions
from tierline.sources.bronze import read_bronze_runs
from tierline.sources.config import configured, read_config
from tierline.sources.jdbc import extract
from tierline.sources.landing import RUN_ID, archive_runs, discard_runs, make_run, pending_runs, write_landing
from tierline.sources.paging import PAGE_NO, page_ends, stored_pages

# Where the next mark comes from: the greatest watermark extracted, or the clock of the run.
# With the latter, rows stamped before the run that become visible after it are missed.
DATA, LOAD_TIME = "data", "load_time"


@dataclass
class Layout:
    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self._p("landing")

    def landing_of(self, spec: TableSpec) -> str:
        """The folder under which ``spec`` lands: the parent of its config's target path, or the common landing folder."""
        target = (spec.extra.get("target_path") or "").strip("/")
        if not target:
            return self.landing
        parent, _, name = target.rpartition("/")
        if name != spec.name:
            raise ValueError(f"the target path of {spec.name!r} must end in the table's name: {target!r}")
        return self._p(parent)

    @property
    def archive(self) -> str:
        return self._p("archive")

    @property
    def silver(self) -> str:
        return self._p("silver")

    @property
    def gold(self) -> str:
        return self._p("gold")

    @property
    def audit(self) -> str:
        return self._p("meta/audit")

    @property
    def logs(self) -> str:
        return self._p("meta/logs")

    @property
    def log_files(self) -> str:
        return self._p("meta/log_files")

    @property
    def status(self) -> str:
        return self._p("meta/status")


@dataclass
class RunInfo:
    table: str
    run_id: str
    load_type: str
    rows_loaded: int = 0
    max_watermark: dt.datetime | None = None
    status: str = SUCCESS
    error: str | None = None
    events: list = field(default_factory=list)


def ingest_table(spark: SparkSession, source, spec: TableSpec, layout: Layout, now: dt.datetime,
                 encoding: str = "iso", keyset_id: str | None = None, num_partitions: int = 1,
                 partition_column: str | None = None, watermark_source: str = DATA, equal_depth: bool = False,
                 page_rows: int | None = None) -> RunInfo:
    """One extract of one table; with ``page_rows`` an increment is taken as pages (see ``ingest_pages``), which needs ``keyset_id``."""
    if watermark_source not in (DATA, LOAD_TIME):
        raise ValueError(f"unknown watermark source {watermark_source!r}")
    meta = run_metadata(now)
    if page_rows is not None and spec.load_type == INCREMENTAL:
        if not keyset_id or watermark_source != DATA:
            raise ValueError("pages follow the data's watermark and an id column")
        pages = ingest_pages(spark, source, spec, layout, now, keyset_id, page_rows, encoding,
                             num_partitions=num_partitions, partition_column=partition_column, equal_depth=equal_depth)
        return RunInfo(spec.name, meta["run_id"], spec.load_type, sum(p.rows_loaded for p in pages),
                       pages[-1].max_watermark if pages else None)
    mark = keyset = None
    if spec.load_type == INCREMENTAL:
        audit = read_audit(spark, layout.audit)
        mark = latest_watermark_value(audit, spec.name)
        if keyset_id:
            keyset = (keyset_id, last_id_value(audit, spec.name, mark, spec.schema[keyset_id].dataType))
    df = extract(spark, source, spec.name, spec.load_type, spec.watermark_col, mark, keyset=keyset,
                 columns=None, partition_column=partition_column, num_partitions=num_partitions, equal_depth=equal_depth)
    df, obs = observed(df, spec.watermark_col if spec.load_type == INCREMENTAL else None,
                       name=f"ingest_{spec.name}_{meta['run_id']}",
                       id_col=keyset_id if watermark_source == DATA else None)
    write_landing(df, layout.landing_of(spec), spec.name, meta["run_id"], meta["load_date"], encoding,
                  fmt=spec.landing_format)
    stats = obs.get
    info = RunInfo(spec.name, meta["run_id"], spec.load_type, int(stats.get("rows_loaded") or 0),
                   now if watermark_source == LOAD_TIME and spec.load_type == INCREMENTAL else stats.get("max_watermark"))
    append(audit_row(spark, meta["run_id"], meta["load_date"], spec.name, spec.load_type,
                     info.rows_loaded, spec.watermark_col, info.max_watermark, stats.get("last_id")), layout.audit)
    return info


LANDINGS = 16   # jobs in which the pages of an increment land, at most
PAGE = "P"      # between a run's id and the number of its page; sorts behind the run


def _page_run(run_id: str, number: int) -> str:
    return f"{run_id}{PAGE}{number:08d}"


def ingest_pages(spark: SparkSession, source, spec: TableSpec, layout: Layout, now: dt.datetime, keyset_id: str,
                 page_rows: int, encoding: str = "iso", **read_kwargs) -> list[RunInfo]:
    """The rows behind the audited position as pages of ``page_rows`` rows, one landed run and audit row each.

    At most ``LANDINGS`` jobs land them, each a like number of pages in a row, so that the source is read that
    many times at most however many pages there are. The audit rows of a job's pages are appended once all of them landed.
    If it fails, the next call, with the same clock or a later one, takes up behind the last
    audited page. A page that landed without its audit row is taken out first, unless silver has
    it already (merging its rows again changes nothing there, save for rows without a key).
    """
    if spec.load_type != INCREMENTAL:
        raise ValueError(f"{spec.name!r} isn't loaded by increments")
    meta, root = run_metadata(now), layout.landing_of(spec)
    audit = read_audit(spark, layout.audit)
    mark = latest_watermark_value(audit, spec.name)
    last = last_id_value(audit, spec.name, mark, spec.schema[keyset_id].dataType)
    audited = set() if audit is None else {
        r["run_id"] for r in audit.where((F.col("table_name") == spec.name) & F.col("run_id").contains(PAGE)).select("run_id").collect()}
    pending = pending_runs(spark, root, spec.name, set(SilverTables(spark, layout.silver).runs(spec.name)))
    discard_runs(spark, root, spec.name, {run for run in pending if PAGE in run and run not in audited})
    done = sum(run.startswith(meta["run_id"] + PAGE) for run in audited)
    ends = page_ends(spark, source, spec.name, spec.watermark_col, keyset_id, mark, last, page_rows, **read_kwargs)
    out, size = [], -(-len(ends) // LANDINGS) or 1
    for group in (ends[i:i + size] for i in range(0, len(ends), size)):
        run_ids = [_page_run(meta["run_id"], done + len(out) + k) for k in range(1, len(group) + 1)]
        df = extract(spark, source, spec.name, INCREMENTAL, spec.watermark_col, mark, keyset=(keyset_id, last), until=group[-1], **read_kwargs)
        # the rows are read once: counting a page and landing it both take them from here
        rows = stored_pages(df, spec.watermark_col, keyset_id, group, scratch_root(spark, f"landing-{spec.name}"))
        counts = {r[PAGE_NO]: r["count"] for r in rows.groupBy(PAGE_NO).count().collect()}      # one row a page
        names = F.element_at(F.lit(run_ids), F.col(PAGE_NO) + 1)
        write_landing(rows.withColumn(RUN_ID, names).drop(PAGE_NO), root, spec.name, None, meta["load_date"], encoding, fmt=spec.landing_format)
        infos = [RunInfo(spec.name, run, spec.load_type, int(counts.get(k, 0)), end[0]) for k, (run, end) in enumerate(zip(run_ids, group))]
        for k, run in enumerate(run_ids):
            if k not in counts:         # its rows went away since the ends were read: it took place all the same
                make_run(spark, root, spec.name, run, meta["load_date"])
        append(audit_rows(spark, [(i.run_id, meta["load_date"], spec.name, spec.load_type, i.rows_loaded, spec.watermark_col, end[0], str(end[1]))
                                  for i, end in zip(infos, group)]), layout.audit)
        out += infos
        mark, last = group[-1]
    return out


def ingest(spark: SparkSession, sources: dict, specs: list[TableSpec], layout: Layout,
           now: dt.datetime, on_error: str = "raise", **kwargs) -> list[RunInfo]:
    """Ingest tables one after another; ``on_error="log"`` records a failure and goes on.

    Each table gets a status row (SUCCESS or FAILED), and the run's events go to the log table
    and a dated JSON log, also when a failure is raised.
    """
    out, events = [], []

    def write_logs() -> None:
        rows = log_rows(spark, events)
        append(rows, layout.logs)
        append(rows, f"{layout.log_files}/pipeline_log_{now:%Y%m%d%H%M%S}.json", fmt="json")

    for spec in specs:
        try:
            info = ingest_table(spark, sources[spec.source], spec, layout, now, **kwargs)
            events.append({"timestamp": now.isoformat(), "event_type": "INFO",
                           "message": f"ingested {info.rows_loaded} rows", "table": spec.name})
        except Exception as exc:  # noqa: BLE001 - recorded and re-raised unless on_error="log"
            info = RunInfo(spec.name, run_metadata(now)["run_id"], spec.load_type, status=FAILED,
                           error=str(exc))
            events.append({"timestamp": now.isoformat(), "event_type": "ERROR",
                           "message": info.error, "table": spec.name})
            if on_error != "log":
                append(status_row(spark, spec.name, spec.load_type, 0, now, FAILED), layout.status)
                write_logs()
                raise
        append(status_row(spark, spec.name, spec.load_type, info.rows_loaded, now, info.status), layout.status)
        out.append(info)
    if events:
        write_logs()
    return out


def ingest_config(spark: SparkSession, sources: dict, config_path: str, layout: Layout,
                  now: dt.datetime, **kwargs) -> list[RunInfo]:
    """Ingest the active tables of a config with its load types and watermark columns, each into its target path."""
    return ingest(spark, sources, configured(read_config(spark, config_path)), layout, now, **kwargs)


def refine_table(spark: SparkSession, spec: TableSpec, layout: Layout, as_of: dt.datetime,
                 allow_empty: bool = False, **merge_kwargs) -> str | None:
    """Take every pending landed run of ``spec`` into silver; returns the latest run of the table."""
    store = SilverTables(spark, layout.silver)
    runs = _pending(spark, store, layout, spec)
    if spec.silver_policy == SCD2:
        for run in runs:
            batch = read_bronze_runs(spark, layout.landing_of(spec), spec, runs=[run])
            if batch.isEmpty():         # an increment without rows changes nothing
                store.record(spec.name, run)
                continue
            store.merge(spec.name, batch, run, spec, as_of, buckets_for(input_bytes(spark, [layout.landing_of(spec)])), **merge_kwargs)
    elif runs:
        newest, done = runs[-1], store.runs(spec.name)
        # late runs of a table that is replaced whole: a newer extract may be published already
        if not done or newest > done[-1]:
            batch = read_bronze_runs(spark, layout.landing_of(spec), spec, runs=[newest])
            if not allow_empty and batch.isEmpty():
                raise ValueError(f"refusing to replace silver {spec.name} with an empty batch (run {newest})")
            store.refresh(spec.name, full_refresh(batch, spec), newest, spec)
        for run in runs:                # the older ones are replaced by the newest
            store.record(spec.name, run)
    return next(reversed(store.runs(spec.name)), None)


def _pending(spark: SparkSession, store: SilverTables, layout: Layout, spec: TableSpec) -> list[str]:
    """Landed runs that silver hasn't taken in, in order, whenever they landed."""
    return pending_runs(spark, layout.landing_of(spec), spec.name, set(store.runs(spec.name)))


def _specs(tables) -> list[TableSpec]:
    return [REGISTRY[t] if isinstance(t, str) else t for t in (tables or REGISTRY)]


def refine(spark: SparkSession, layout: Layout, as_of: dt.datetime, tables=None, **kwargs) -> dict:
    """Refine tables given by name or spec (a config's specs know their target paths)."""
    specs = _specs(tables)
    # landing + silver bound what the merges shuffle; size the shuffle to it
    size_shuffle_partitions(spark, input_bytes(spark, {layout.silver, *map(layout.landing_of, specs)}))
    return {s.name: refine_table(spark, s, layout, as_of, **kwargs) for s in specs}


def silver(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    store = SilverTables(spark, layout.silver)
    out = {}
    for name, spec in REGISTRY.items():
        df = store.read(name, spec)
        out[name] = df if df is not None else (
            empty_target(spark, spec) if spec.silver_policy == SCD2 else spark.createDataFrame([], spec.silver_schema()))
    return out


def serve(spark: SparkSession, layout: Layout, as_of: dt.date, refresh: bool = False,
          mode: str = gold.FAITHFUL) -> dict[str, DataFrame]:
    size_shuffle_partitions(spark, input_bytes(spark, [layout.silver]))
    tables = silver(spark, layout)
    out = {}
    for name, fn in gold.MARTS.items():
        df = fn(tables, as_of, mode=mode) if name == "customer_engagement" else fn(tables, mode=mode)
        path = f"{layout.gold}/{name}"
        out[name] = overwrite(df, path) if refresh else create_if_absent(df, path)
    return out


def archive(spark: SparkSession, layout: Layout, tables=None) -> dict[str, list[str]]:
    """Move landed runs that silver has already published to the archive."""
    store = SilverTables(spark, layout.silver)
    moved = {}
    for spec in _specs(tables):
        keep = _pending(spark, store, layout, spec)
        moved[spec.name] = archive_runs(spark, layout.landing_of(spec), layout.archive, spec.name, keep=keep)
    return moved


def run_all(spark: SparkSession, sources: dict, layout: Layout, now: dt.datetime,
            specs: list[TableSpec] | None = None, refresh_gold: bool = True, **kwargs) -> dict:
    """One daily cycle: ingest every table, refine silver, serve gold, archive consumed runs."""
    specs = specs or list(REGISTRY.values())
    runs = ingest(spark, sources, specs, layout, now, **kwargs)
    published = refine(spark, layout, now, tables=specs)
    marts = serve(spark, layout, now.date(), refresh=refresh_gold)
    archived = archive(spark, layout, tables=specs)
    return {"runs": runs, "silver": published, "gold": marts, "archived": archived}
