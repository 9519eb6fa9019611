"""Data-quality quarantine: flag rows, never drop them.

``is_quarantined`` is TRUE when any of the table's required columns is
NULL and FALSE otherwise (never NULL). Consumers filter on it
(``is_quarantined = false``); silver keeps every row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.predicates import any_null
from tierline.schemas import IS_QUARANTINED, TableSpec


def with_quarantine(df: DataFrame, columns) -> DataFrame:
    """Append ``is_quarantined`` = any of ``columns`` is NULL."""
    if isinstance(columns, TableSpec):
        columns = columns.quarantine_if_null
    return df.withColumn(IS_QUARANTINED, any_null(columns))


def clean(df: DataFrame) -> DataFrame:
    """Rows whose flag is FALSE (a NULL flag is dropped, like ``= FALSE``)."""
    return df.where(F.col(IS_QUARANTINED) == F.lit(False))


def quarantine_counts(df: DataFrame, table_name: str) -> DataFrame:
    """One row: table_name, total_rows, quarantined_rows (a single global aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count(F.when(F.col(IS_QUARANTINED), 1)).alias("quarantined_rows")) \
        .select(F.lit(table_name).alias("table_name"), "total_rows", "quarantined_rows")


def quarantine_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Union of ``quarantine_counts`` over flagged tables."""
    parts = [quarantine_counts(df, name) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
