"""Registered queries: one per implemented operator of SURVEY §2.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables found in ``sf_dir``; its DuckDB oracle is in ``oracles()``.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.predicates import DEFAULT_WATERMARK
from tierline.functions.time import epoch_ms_text, parse_event_ts, run_metadata, ts_text
from tierline.operators import gold, sketches
from tierline.operators.audit import append, audit_from_stats, read_audit
from tierline.operators.quality import quarantine_report
from tierline.operators.watermark import batch_stats, latest_watermark
from tierline.plans import catalog
from tierline.plans import oracle_sql as O
from tierline.plans.pipeline import Layout, ingest, ingest_config
from tierline.plans.retail import mart, silver_report, silver_table, silver_tables
from tierline.schemas import CONFIG_CSV_SCHEMA, LOG_SCHEMA
from tierline.session import scratch_root
from tierline.sources import retail
from tierline.sources.bronze import read_bronze_daily, read_bronze_json
from tierline.sources.jdbc import ParquetSource, extract
from tierline.sources.landing import (EPOCH_MS, ISO, archive_daily, archive_runs, archived_daily_glob, write_daily_landing,
                                     write_landing)
from tierline.sources.reviews import ingest_reviews, read_review_landing, write_review_landing


def _mart(name: str, spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    return mart(spark, sf_dir, name, **kwargs)


def _silver(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_report(silver_table(spark, sf_dir, table))


sales_summary = partial(_mart, "sales_summary")                                   # GD1
customer_engagement = partial(_mart, "customer_engagement")                       # GD2
product_performance = partial(_mart, "product_performance")                       # GD3 (eager)
product_performance_naive = partial(_mart, "product_performance", strategy="naive")
supplier_analysis = partial(_mart, "supplier_analysis")                           # GD4 (eager)
supplier_analysis_naive = partial(_mart, "supplier_analysis", strategy="naive")
customer_reviews_summary = partial(_mart, "customer_reviews_summary")             # GD5

QUERIES = {
    "sales_summary": sales_summary,
    "customer_engagement": customer_engagement,
    "product_performance": product_performance,
    "product_performance_naive": product_performance_naive,
    "supplier_analysis": supplier_analysis,
    "supplier_analysis_naive": supplier_analysis_naive,
    "customer_reviews_summary": customer_reviews_summary,
}
# SV1-SV8
for _table in retail.SPECS:
    QUERIES[f"silver_{_table}"] = partial(_silver, _table)


# --------------------------------------------------------------------------- ingest side

EXTRACT_MARK = dt.datetime(2000, 6, 1, tzinfo=dt.timezone.utc)
KEYSET_LAST_ID = 7000
STATS_TABLES = ["customers", "orders", "order_items", "product_suppliers"]
FULL_TABLES = ["products", "categories", "suppliers"]
QUARANTINE_TABLES = ["customers", "categories", "products", "suppliers"]


def _scratch(spark: SparkSession, label: str) -> str:
    return scratch_root(spark, label)


# The instants of each table that lands as JSON lines.
JSON_TABLES = {"orders": ("order_date", "updated_at"), "customers": ("updated_at",), "order_items": ("updated_at",),
               "product_suppliers": ("last_updated",), "categories": ("updated_at",), "products": ("updated_at",),
               "suppliers": ("created_at",)}


def bronze_roundtrip(spark: SparkSession, sf_dir: str, encoding: str, table: str = "orders") -> DataFrame:
    """SNK1 + SRC8: land a table's extract as JSON lines, read it back as bronze."""
    root = _scratch(spark, f"landing-{encoding}")
    src = retail.source(spark, sf_dir, table, 2)
    write_landing(src, root, table, "20020102T000000Z", "2002-01-02", encoding=encoding)
    bronze = read_bronze_json(spark, f"{root}/{table}", retail.SPECS[table])
    if encoding == ISO:
        # ISO-8601 text -> the epoch-ms encoding, through the shared parser
        for c in JSON_TABLES[table]:
            bronze = bronze.withColumn(c, epoch_ms_text(parse_event_ts(c)))
    return bronze


def bronze_roundtrip_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2 + SNK11 + FN10/FN11 + SRC8: the older daily landing over two days.

    Day 1's orders extract lands as ``orders_01012002.json`` and is archived
    to ``orders/2002/01/01/`` when day 2 lands, as that ingest does before
    each extract. Bronze over landing (day 2) and archive (day 1) gives every
    row with the landing day parsed from its object's name.
    """
    root = _scratch(spark, "landing-daily")
    landing, archive = f"{root}/landing", f"{root}/archive"
    day1, day2 = retail.AS_OF_1.date(), retail.AS_OF_2.date()
    write_daily_landing(retail.source(spark, sf_dir, "orders", 1), landing, "orders", day1)
    archive_daily(spark, landing, archive, "orders", keep=day2)
    write_daily_landing(retail.source(spark, sf_dir, "orders", 2), landing, "orders", day2)
    spec = retail.SPECS["orders"]
    return read_bronze_daily(spark, landing, spec).unionByName(
        read_bronze_daily(spark, archived_daily_glob(archive, "orders"), spec))


def bronze_roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3 + SRC9: the review extract as a dated Parquet file, read back as bronze."""
    root = _scratch(spark, "landing-reviews")
    write_review_landing(retail.batch(spark, sf_dir, "customer_reviews", 2), root, dt.date(2002, 1, 2))
    return read_review_landing(spark, root)


def review_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10 / IN3: a feed of JSON arrays, one file a day, landed as the day's Parquet and read back.

    Every text is wrapped in characters that mark records elsewhere, and unwrapped when it is back.
    """
    root = _scratch(spark, "review-feed")
    opening, closing = '{"[\\', '},\n{"'
    rows = retail.batch(spark, sf_dir, "customer_reviews", 2).withColumn("review_text", F.concat(F.lit(opening), "review_text", F.lit(closing)))
    page = F.to_date(F.timestamp_millis(F.col("review_date").cast("long")))
    own = Window.partitionBy("page")
    rows = (rows.select(page.alias("page"), F.to_json(F.struct(*rows.columns)).alias("json"))
            .withColumn("n", F.row_number().over(own.orderBy("json"))).withColumn("last", F.count(F.lit(1)).over(own)))
    rows = rows.select("page", "n", F.concat(F.when(F.col("n") == 1, "[").otherwise(","), "json", F.when(F.col("n") == F.col("last"), "]").otherwise("")).alias("value"))
    rows.sortWithinPartitions("page", "n").drop("n").write.partitionBy("page").text(f"{root}/feed")
    day = retail.AS_OF_2.date()
    ingest_reviews(spark, f"{root}/feed", root, day)
    back = read_review_landing(spark, root, day)
    return back.withColumn("review_text", F.expr(f"substring(review_text, {len(opening) + 1}, length(review_text) - {len(opening) + len(closing)})"))


def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3: customers with orders per month, from the sketches of two loads, beside the exact count; ``within`` five standard errors (one at least)."""
    path = _scratch(spark, "sketches")
    loads = [retail.source(spark, sf_dir, "orders", n).select("order_date", "customer_id") for n in (1, 2)]
    for df, now in zip(loads, (retail.AS_OF_1, retail.AS_OF_2)):
        sketches.store(sketches.daily(df, F.col("order_date"), F.col("customer_id")), path, now.date().isoformat())

    def month(c: str) -> Column:
        return F.date_format(c, "yyyy-MM")
    estimated = sketches.merged(spark.read.parquet(path), {"month": month("day")})
    exact = reduce(DataFrame.unionByName, loads).groupBy(month("order_date").alias("month")).agg(F.count_distinct("customer_id").alias("n_customers"))
    slack = F.greatest(F.lit(1.0), F.lit(5 * sketches.STANDARD_ERROR) * F.col("n_customers"))
    return exact.join(estimated, "month").select("month", "n_customers", (F.abs(F.col("estimate") - F.col("n_customers")) <= slack).alias("within"))


def mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK10: a mart as a managed table, created once (a second run is a no-op) and read by its name."""
    root = _scratch(spark, "gold-tables")
    database = root.rpartition("/")[2].replace("-", "_")
    catalog.create_database(spark, database, root)
    catalog.create_table_if_absent(customer_reviews_summary(spark, sf_dir), database, "customer_reviews_summary")
    made = spark.table(f"{database}.customer_reviews_summary")
    return catalog.create_table_if_absent(made.limit(0), database, "customer_reviews_summary")


def _orders_source(sf_dir: str) -> ParquetSource:
    return ParquetSource({"orders": lambda spark: retail.source(spark, sf_dir, "orders", 2)})


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3 / FLT3: rows strictly after the high-water mark."""
    df = extract(spark, _orders_source(sf_dir), "orders", "incremental", "updated_at", EXTRACT_MARK)
    return retail.to_bronze(df, "orders")


def keyset_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5: (wm > mark) OR (wm = mark AND order_id > last_id)."""
    df = extract(spark, _orders_source(sf_dir), "orders", "incremental", "updated_at", EXTRACT_MARK,
                 keyset=("order_id", KEYSET_LAST_ID))
    return retail.to_bronze(df, "orders")


def batch_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8 / AGG10: row count and max watermark of each incremental extract, one pass each."""
    parts = [batch_stats(retail.source(spark, sf_dir, t, 2), retail.SPECS[t].watermark_col, t)
             for t in STATS_TABLES]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("max_watermark", ts_text(F.col("max_watermark")))


def latest_watermark_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9 / SNK5 / SRC11: two runs append their audit rows, the second from the first's marks; the latest mark per table, read back.

    Each source is scanned once a run, and all rows of a run are one job.
    """
    path = _scratch(spark, "marks")
    marks: dict[str, dt.datetime] = {}
    for number, run in ((1, "run1"), (2, "run2")):
        tables = {t: lambda spark, t=t, n=number: retail.source(spark, sf_dir, t, n) for t in STATS_TABLES}
        rows = []
        for t in STATS_TABLES:
            wm = retail.SPECS[t].watermark_col
            df = extract(spark, ParquetSource(tables), t, "incremental", wm, marks.get(t, DEFAULT_WATERMARK))
            rows.append(audit_from_stats(batch_stats(df, wm, t), run, "2002-01-02", "incremental", wm))
        for t in FULL_TABLES:
            rows.append(audit_from_stats(batch_stats(retail.source(spark, sf_dir, t, 2), None, t), run, "2002-01-02", "full", None))
        append(reduce(DataFrame.unionByName, rows), path)
        latest = latest_watermark(read_audit(spark, path))
        marks = {r["table_name"]: r["latest_watermark"].replace(tzinfo=dt.timezone.utc) for r in latest.collect()} if number == 1 else marks
    return latest.withColumn("latest_watermark", ts_text(F.col("latest_watermark")))


def audit_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN2 / SRC3 / SNK1 / SNK5 / SRC11: two daily ingests of seven tables, the second from the audited marks; the audit rows, read back."""
    layout = Layout(_scratch(spark, "audit"))
    specs = [retail.SPECS[t] for t in STATS_TABLES + FULL_TABLES]
    for number, now in ((1, retail.AS_OF_1), (2, retail.AS_OF_2)):
        tables = {s.name: lambda spark, t=s.name, n=number: retail.source(spark, sf_dir, t, n) for s in specs}
        ingest(spark, {s.source: ParquetSource(tables) for s in specs}, specs, layout, now)
    return read_audit(spark, layout.audit).select(
        "run_id", F.col("load_date").cast("string").alias("load_date"), "table_name", "load_type", "rows_loaded",
        ts_text(F.col("watermark")).alias("watermark"))


PAGE_ROWS = 10_000


def paged_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5 / SNK1 / SNK5: orders of two days as keyset pages; each page's audit row beside what lies in its landed run."""
    layout, spec = Layout(_scratch(spark, "pages")), retail.SPECS["orders"]
    for number, now in ((1, retail.AS_OF_1), (2, retail.AS_OF_2)):
        source = ParquetSource({"orders": lambda spark, n=number: retail.source(spark, sf_dir, "orders", n)})
        ingest(spark, {spec.source: source}, [spec], layout, now, keyset_id="order_id", page_rows=PAGE_ROWS)
    landed = read_bronze_json(spark, f"{layout.landing}/orders", spec, keep_run=True).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_landed"), F.min("order_id").alias("least_id"), F.sum("order_id").alias("sum_ids"))
    audited = read_audit(spark, layout.audit).select("run_id", "rows_loaded", ts_text(F.col("watermark")).alias("watermark"), F.col("last_id").cast("long").alias("last_id"))
    return audited.join(landed, "run_id")


# Fixed values of the fixture: an ingest config (table, load type, watermark, active); products has no source, so its ingest fails.
CONFIG = [("products", "Full Load", "", "1"), ("categories", "full", "", "1"), ("customers", "Incremental", "updated_at", "1"),
          ("orders", "incremental load", "updated_at", "1"), ("order_items", "Incremental", "updated_at", "0")]


def config_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN1 / SRC6 / SRC7 / FLT5 / FN12 / SNK4 / SNK6 / SNK7 / SNK12: two ingests steered by a config, day 1 from its CSV and day 2 from its JSON form.

    Returns the status rows, the log table, the dated JSON logs, and what lies in
    the target paths and in the archive after the first run of orders was archived.
    """
    layout = Layout(_scratch(spark, "config"))
    rows = spark.createDataFrame([("retailer", "retailer_db", t, load, wm, on, f"landing/retailer-db/{t}") for t, load, wm, on in CONFIG], CONFIG_CSV_SCHEMA)
    rows.coalesce(1).write.option("header", True).csv(f"{layout.root}/config.csv")
    tables = [{"name": t, "load_type": load, "watermark": wm, "is_active": on == "1", "target_path": f"landing/retailer-db/{t}"} for t, load, wm, on in CONFIG]
    spark.createDataFrame([(json.dumps({"source_name": "retailer", "tables": tables}),)], "value string").coalesce(1).write.text(f"{layout.root}/config.json")
    days = (retail.AS_OF_1, retail.AS_OF_2)
    for number, (now, config) in enumerate(zip(days, ("config.csv", "config.json")), 1):
        sources = {t: lambda spark, t=t, n=number: retail.source(spark, sf_dir, t, n) for t in ("categories", "customers", "orders")}
        ingest_config(spark, {"retailer": ParquetSource(sources)}, f"{layout.root}/{config}", layout, now, on_error="log")
    landing = f"{layout.root}/landing/retailer-db"
    archive_runs(spark, landing, layout.archive, "orders", keep=[run_metadata(days[1])["run_id"]])

    def report(df: DataFrame, kind: str, run: Column, table: str, state: Column | None = None, load_type: Column | None = None, n: Column | None = None) -> DataFrame:
        none = F.lit(None).cast("string")
        return df.select(F.lit(kind).alias("kind"), run.alias("run"), F.col(table).alias("table_name"), (none if load_type is None else load_type).alias("load_type"),
                         (none if n is None else n).cast("long").alias("n_rows"), (none if state is None else state).alias("state"))

    def day(stamp: Column) -> Column:
        return F.date_format(stamp.cast("timestamp"), "yyyy-MM-dd")

    out = [report(spark.read.parquet(layout.status), "status", day(F.col("load_timestamp")), "tablename", F.col("status"), F.col("load_type"), F.col("record_count"))]
    logs = {"log": spark.read.schema(LOG_SCHEMA).parquet(layout.logs), "log_file": spark.read.schema(LOG_SCHEMA).json(f"{layout.log_files}/*.json")}
    out += [report(df, kind, day(F.col("timestamp")), "table", F.col("event_type")) for kind, df in logs.items()]
    for kind, root, names in (("landed", landing, ("categories", "customers", "orders")), ("archived", layout.archive, ("orders",))):
        for t in names:
            found = read_bronze_json(spark, f"{root}/{t}", retail.SPECS[t], keep_run=True)
            counted = found.groupBy(F.col("load_date").cast("string").alias("run")).agg(F.count(F.lit(1)).alias("n")).withColumn("t", F.lit(t))
            out.append(report(counted, kind, F.col("run"), "t", n=F.col("n")))
    return reduce(DataFrame.unionByName, out)


def quarantine_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT9 over the four flagged silver tables."""
    return quarantine_report(silver_tables(spark, sf_dir, tables=QUARANTINE_TABLES))


QUERIES.update({
    "bronze_roundtrip_json": partial(bronze_roundtrip, encoding=EPOCH_MS),
    "bronze_roundtrip_iso": partial(bronze_roundtrip, encoding=ISO),
    "bronze_roundtrip_parquet": bronze_roundtrip_parquet,
    "bronze_roundtrip_daily": bronze_roundtrip_daily,
    "review_feed": review_feed,
    "distinct_sketches": distinct_sketches,
    "mart_table": mart_table,
    "incremental_extract": incremental_extract,
    "keyset_extract": keyset_extract,
    "batch_stats": batch_stats_query,
    "latest_watermark": latest_watermark_query,
    "audit_roundtrip": audit_roundtrip,
    "paged_ingest": paged_ingest,
    "config_ingest": config_ingest,
    "quarantine_report": quarantine_report_query,
})


# the other tables that land as JSON lines, in the default encoding
ROUNDTRIPS = {f"bronze_roundtrip_{t}": t for t in JSON_TABLES if t != "orders"}
QUERIES.update({name: partial(bronze_roundtrip, encoding=ISO, table=t) for name, t in ROUNDTRIPS.items()})


def oracles() -> dict[str, str]:
    out = {name: O.gold_query(name) for name in
           ("sales_summary", "customer_engagement", "product_performance",
            "product_performance_naive", "supplier_analysis", "supplier_analysis_naive",
            "customer_reviews_summary")}
    for table in retail.SPECS:
        out[f"silver_{table}"] = O.silver_query(table)
    out["bronze_roundtrip_json"] = O.bronze_query("orders")
    out["bronze_roundtrip_iso"] = O.bronze_query("orders")
    out.update({name: O.bronze_query(t) for name, t in ROUNDTRIPS.items()})
    out["bronze_roundtrip_parquet"] = O.bronze_query("customer_reviews")
    out["bronze_roundtrip_daily"] = O.daily_landing_query("orders", [(1, retail.AS_OF_1.date()),
                                                                     (2, retail.AS_OF_2.date())])
    out["review_feed"] = O.bronze_query("customer_reviews")
    out["distinct_sketches"] = O.distinct_query()
    out["mart_table"] = O.gold_query("customer_reviews_summary")
    out["incremental_extract"] = O.extract_query("orders", "updated_at", EXTRACT_MARK)
    out["keyset_extract"] = O.extract_query("orders", "updated_at", EXTRACT_MARK,
                                            ("order_id", KEYSET_LAST_ID))
    out["batch_stats"] = O.batch_stats_query(STATS_TABLES)
    out["latest_watermark"] = O.latest_watermark_query(
        STATS_TABLES, FULL_TABLES, DEFAULT_WATERMARK.strftime("%Y-%m-%d %H:%M:%S"))
    out["audit_roundtrip"] = O.audit_query(STATS_TABLES, FULL_TABLES, [retail.AS_OF_1, retail.AS_OF_2])
    out["paged_ingest"] = O.pages_query("orders", "updated_at", "order_id", PAGE_ROWS, [retail.AS_OF_1, retail.AS_OF_2])
    out["config_ingest"] = O.config_query(["customers", "orders"], ["categories"], ["products"], [retail.AS_OF_1, retail.AS_OF_2])
    out["quarantine_report"] = O.quarantine_report_query(QUARANTINE_TABLES)
    return out


__all__ = ["QUERIES", "oracles", "gold"]
