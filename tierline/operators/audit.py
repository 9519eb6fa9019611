"""Audit and pipeline-log rows (append-only tables).

Rows are built with explicit schemas (an all-NULL column would defeat
inference) and appended with ``mode("append")``; the audit schema is the
seven-column one of the config-driven ingest, and the last id of keyset extracts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.time import to_utc
from tierline.schemas import AUDIT_SCHEMA, AUDIT_V1_SCHEMA, LOG_SCHEMA

SUCCESS = "SUCCESS"
FAILED = "FAILED"


def audit_row(spark: SparkSession, run_id: str, load_date: str | dt.date, table_name: str,
              load_type: str, rows_loaded: int, watermark_col_name: str | None,
              watermark: dt.datetime | None, last_id: str | None = None) -> DataFrame:
    return audit_rows(spark, [(run_id, load_date, table_name, load_type, rows_loaded, watermark_col_name, watermark, last_id)])


def audit_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Audit rows from the arguments of ``audit_row``, written as one file."""
    def typed(run_id, load_date, table_name, load_type, rows_loaded, watermark_col_name, watermark, last_id):
        ld = load_date if isinstance(load_date, dt.date) else dt.date.fromisoformat(str(load_date))
        return run_id, ld, table_name, load_type, int(rows_loaded), watermark_col_name, None if watermark is None else to_utc(watermark), last_id
    return spark.createDataFrame([typed(*r) for r in rows], AUDIT_SCHEMA).coalesce(1)


def audit_from_stats(stats: DataFrame, run_id: str, load_date: str | dt.date, load_type: str,
                     watermark_col_name: str | None) -> DataFrame:
    """Audit rows straight from ``batch_stats`` output (no driver round trip)."""
    return stats.select(
        F.lit(run_id).alias("run_id"), F.lit(str(load_date)).cast("date").alias("load_date"),
        F.col("table_name"), F.lit(load_type).alias("load_type"),
        F.col("rows_loaded").cast("bigint").alias("rows_loaded"),
        F.lit(watermark_col_name).cast("string").alias("watermark_col_name"),
        F.col("max_watermark").cast("timestamp").alias("watermark"), F.lit(None).cast("string").alias("last_id"))


def status_row(spark: SparkSession, table_name: str, load_type: str, record_count: int,
               load_timestamp: dt.datetime, status: str = SUCCESS) -> DataFrame:
    """The older five-column audit row (tablename, load_type, record_count, load_timestamp, status)."""
    return spark.createDataFrame(
        [(table_name, load_type, int(record_count), to_utc(load_timestamp), status)], AUDIT_V1_SCHEMA)


def log_rows(spark: SparkSession, events: list[dict]) -> DataFrame:
    """Pipeline-log rows: timestamp (ISO text), event_type, message, table."""
    rows = [(str(e.get("timestamp")), e.get("event_type"), e.get("message"), e.get("table"))
            for e in events]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("append")
    if fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame | None:
    from tierline.plans.publish import path_exists
    if not path_exists(spark, path):
        return None
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
