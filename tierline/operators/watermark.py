"""Batch statistics and high-water marks.

* ``batch_stats``: row count and max watermark of an extract in **one**
  global aggregate (the reference persists the batch and runs two jobs).
* ``observed``: the same statistics gathered *while* the batch is written
  (``DataFrame.observe``): no second pass, nothing cached.
* ``latest_watermark``: ``COALESCE(MAX(watermark), 1900-01-01)`` over the
  audit rows of a table, as a one-row DataFrame; ``latest_watermark_value``
  fetches that single value for the next extract's predicate.
* ``last_id_value``: the audited id at the mark, for tie-safe extracts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.predicates import DEFAULT_WATERMARK
from tierline.functions.time import parse_event_ts


def _wm(col: str, as_text: bool) -> Column:
    return parse_event_ts(col) if as_text else F.col(col)


def batch_stats(df: DataFrame, watermark_col: str | None, table_name: str | None = None,
                text_watermark: bool = False) -> DataFrame:
    """One row: (table_name,) rows_loaded, max_watermark (NULL when no rows or no column)."""
    wm = F.max(_wm(watermark_col, text_watermark)) if watermark_col else F.lit(None).cast("timestamp")
    out = df.agg(F.count(F.lit(1)).alias("rows_loaded"), wm.cast("timestamp").alias("max_watermark"))
    if table_name is not None:
        out = out.select(F.lit(table_name).alias("table_name"), "*")
    return out


def observed(df: DataFrame, watermark_col: str | None, name: str = "batch",
             text_watermark: bool = False, id_col: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach count/max-watermark metrics, filled in by the first action on the result.

    With ``id_col`` also ``last_id``: the greatest id (as text) at the greatest watermark.
    """
    obs = Observation(name)
    wm = F.max(_wm(watermark_col, text_watermark)) if watermark_col else F.lit(None).cast("timestamp")
    metrics = [F.count(F.lit(1)).alias("rows_loaded"), wm.cast("timestamp").alias("max_watermark")]
    if watermark_col and id_col:
        place = F.struct(_wm(watermark_col, text_watermark).alias("wm"), F.col(id_col).alias("id"))
        metrics.append(F.max_by(F.col(id_col), place).cast("string").alias("last_id"))
    return df.observe(obs, *metrics), obs


def latest_watermark(audit: DataFrame, table_name: str | None = None,
                     default: dt.datetime = DEFAULT_WATERMARK) -> DataFrame:
    """Latest mark per table (or for one table) with the 1900-01-01 default."""
    fallback = F.lit(default).cast("timestamp")
    if table_name is not None:
        return audit.where(F.col("table_name") == F.lit(table_name)) \
            .agg(F.coalesce(F.max("watermark"), fallback).alias("latest_watermark"))
    return audit.groupBy("table_name").agg(
        F.coalesce(F.max("watermark"), fallback).alias("latest_watermark"))


def latest_watermark_value(audit: DataFrame | None, table_name: str,
                           default: dt.datetime = DEFAULT_WATERMARK) -> dt.datetime:
    if audit is None:
        return default
    value = latest_watermark(audit, table_name, default).first()["latest_watermark"]
    if value.tzinfo is None:
        # Spark returns naive datetimes in the session zone (UTC here)
        value = value.replace(tzinfo=dt.timezone.utc)
    return value


def last_id_value(audit: DataFrame | None, table_name: str, mark: dt.datetime, id_type: T.DataType):
    """The greatest audited id at the mark; without one (its extract kept no id), a value before every id."""
    value = None
    if audit is not None:
        at_mark = audit.where((F.col("table_name") == F.lit(table_name)) & (F.col("watermark") == F.lit(mark)))
        value = at_mark.agg(F.max(F.col("last_id").cast(id_type)).alias("last_id")).first()["last_id"]
    if value is None:
        value = "" if isinstance(id_type, T.StringType) else -1
    return value
