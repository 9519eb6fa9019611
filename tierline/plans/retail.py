"""End-to-end retail plans over the driver tables (bronze batches -> silver -> gold).

Two daily runs are replayed: run 1 at ``AS_OF_1`` with the day-1 extracts,
run 2 at ``AS_OF_2`` with the day-2 extracts. Silver is the state after
run 2; gold marts are computed from it as of ``GOLD_AS_OF``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.time import ts_text
from tierline.operators import gold
from tierline.operators.refresh import full_refresh
from tierline.plans.publish import SilverTables, buckets_for
from tierline.schemas import EFFECTIVE_END, EFFECTIVE_START, SCD2
from tierline.session import input_bytes, scratch_root
from tierline.sources import retail
from tierline.sources.retail import AS_OF_1, AS_OF_2, GOLD_AS_OF, SPECS


# Of the driver's Parquet files (columns packed, some tenfold smaller than landed rows), a silver bucket is meant for this much.
SOURCE_BUCKET_BYTES = 16 << 20


def publish_run(spark: SparkSession, sf_dir: str, store: SilverTables, table: str, number: int,
                **kwargs) -> DataFrame:
    """Run ``number`` (1 or 2) of silver ``table``: merge its extract and publish it."""
    spec = SPECS[table]
    batch = retail.batch(spark, sf_dir, table, number)
    run_id = f"run{number}"
    if spec.silver_policy != SCD2:
        return store.refresh(table, full_refresh(batch, spec), run_id, spec)
    buckets = buckets_for(input_bytes(spark, batch.inputFiles()), SOURCE_BUCKET_BYTES)
    # The sources are projections, as cheap to derive again as to read back, or aggregates whose keys are.
    kwargs = {"buckets": buckets, "derive_once": False, "batch_keys": retail.batch_keys(spark, sf_dir, table, number)} | kwargs
    return store.merge(table, batch, run_id, spec, AS_OF_1 if number == 1 else AS_OF_2, **kwargs)


def silver_table(spark: SparkSession, sf_dir: str, table: str, store: SilverTables | None = None,
                 **kwargs) -> DataFrame:
    """Silver ``table`` after runs 1 and 2, each published as a daily pipeline does."""
    store = store or SilverTables(spark, scratch_root(spark, "silver"))
    if SPECS[table].silver_policy == SCD2:
        publish_run(spark, sf_dir, store, table, 1, **kwargs)
    return publish_run(spark, sf_dir, store, table, 2, **kwargs)


def silver_tables(spark: SparkSession, sf_dir: str, tables=None) -> dict[str, DataFrame]:
    """All (or some) silver tables after run 2, published under one store."""
    store = SilverTables(spark, scratch_root(spark, "silver"))
    return {name: silver_table(spark, sf_dir, name, store) for name in (tables or SPECS)}


def silver_report(df: DataFrame) -> DataFrame:
    """Silver rows with the effective instants as canonical UTC text."""
    out = df
    for c in (EFFECTIVE_START, EFFECTIVE_END):
        if c in df.columns:
            out = out.withColumn(c, ts_text(F.col(c)))
    return out


MART_INPUTS = {
    "sales_summary": ["orders", "order_items", "products", "categories"],
    "customer_engagement": ["customers", "orders", "order_items"],
    "product_performance": ["products", "categories", "product_suppliers", "suppliers",
                            "order_items", "customer_reviews"],
    "supplier_analysis": ["suppliers", "product_suppliers", "order_items"],
    "customer_reviews_summary": ["products", "customer_reviews"],
}


def mart(spark: SparkSession, sf_dir: str, name: str, silver: dict[str, DataFrame] | None = None,
         as_of: dt.date = GOLD_AS_OF, **kwargs) -> DataFrame:
    silver = silver if silver is not None else silver_tables(spark, sf_dir, tables=MART_INPUTS[name])
    fn = gold.MARTS[name]
    if name == "customer_engagement":
        return fn(silver, as_of, **kwargs)
    return fn(silver, **kwargs)
