"""Silver layer: one plan per retail table (SV1-SV8).

SCD2 tables (customers, orders, order_items, product_suppliers,
customer_reviews) fold their batches into the target with ``scd2_merge``;
full-refresh tables (categories, products, suppliers) are the registry
projection of the latest batch plus the quarantine flag.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tierline.operators.refresh import full_refresh
from tierline.operators.scd2 import scd2_merge
from tierline.schemas import FULL_REFRESH_TABLES, REGISTRY, SCD2, SCD2_TABLES


def refine(spark: SparkSession, table: str, target: DataFrame | None, batch: DataFrame,
           as_of: dt.datetime, **kwargs) -> DataFrame:
    """One silver run of ``table``: the new full content of the silver table."""
    spec = REGISTRY[table]
    if spec.silver_policy == SCD2:
        return scd2_merge(target, batch, spec, as_of, **kwargs).all_versions()
    return full_refresh(batch, spec)


def replay(spark: SparkSession, table: str, runs: list[tuple[DataFrame, dt.datetime]],
           target: DataFrame | None = None, **kwargs) -> DataFrame:
    """Apply runs in order (SCD2), or take the last run (full refresh)."""
    spec = REGISTRY[table]
    if spec.silver_policy != SCD2:
        return full_refresh(runs[-1][0], spec)
    current = target
    for batch, as_of in runs:
        current = refine(spark, table, current, batch, as_of, **kwargs)
    return current


__all__ = ["refine", "replay", "SCD2_TABLES", "FULL_REFRESH_TABLES"]
