"""Retail source extracts derived from the driver's TPC-H-style tables.

The reference pipeline reads two OLTP databases (retailer, supplier) and a
review feed. Here those sources are modelled on the driver tables
(``customer orders lineitem part supplier nation events``), one function
per retail table, each returning the *bronze* shape of that table's batch:

* batch 1 is the extract of day 1: rows that existed before the day-1
  cutoff (order/ship/event time), with day-1 attribute values;
* batch 2 is the extract of day 2: every row, some of them changed
  (attribute altered and ``updated_at`` moved) and some attributes nulled
  without a timestamp change (the null-unsafe SCD2 case).

Everything is a projection/filter/aggregate over the full driver tables;
scans prune to the referenced columns and the cutoff filters reach the
Parquet reader. Every batch-2 table covers its whole source table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.time import epoch_ms_text
from tierline.schemas import ORDER_ITEMS, REGISTRY

# Fixed values of the fixture: the two run clocks, their epoch-ms texts,
# the day-1 cutoffs and the change rules (modulus of altered / nulled keys).
AS_OF_1 = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)
AS_OF_2 = dt.datetime(2002, 1, 2, tzinfo=dt.timezone.utc)
GOLD_AS_OF = dt.date(2002, 1, 2)
EPOCH_1 = "1009843200000"   # AS_OF_1 as epoch-ms text
EPOCH_2 = "1009929600000"   # AS_OF_2 as epoch-ms text
ORDER_CUTOFF = dt.datetime(2001, 1, 1)
REVIEW_CUTOFF = dt.datetime(2024, 1, 25)
ALTER_MOD = 7
NULL_MOD = 13
NULL_EMAIL_MOD = 50
NULL_CUSTOMER_KEY_MOD = 500
NULL_CATEGORY_MOD = 97
NULL_CATEGORY_NAME_MOD = 10
NULL_SUPPLIER_NAME_MOD = 17
NULL_REVIEW_TEXT_MOD = 11

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The driver tables have no unique integer line key, so the adapter builds a
# composite text key: its own spec of that table.
SPECS = REGISTRY | {"order_items": replace(ORDER_ITEMS, schema=T.StructType(
    [T.StructField("order_item_id", T.StringType()), *ORDER_ITEMS.schema.fields[1:]]))}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(value: dt.datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _flags(key: Column, batch: int) -> tuple[Column, Column]:
    if batch == 1:
        return F.lit(False), F.lit(False)
    return key % ALTER_MOD == 0, key % NULL_MOD == 0


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _ts(value: dt.datetime) -> Column:
    return F.lit(value).cast("timestamp")


def to_bronze(df: DataFrame, table: str) -> DataFrame:
    """Source shape -> bronze shape: instants as epoch-ms text, registry types, by name."""
    spec = SPECS[table]
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = []
    for f in spec.schema.fields:
        c = F.col(f.name)
        if isinstance(types[f.name], (T.TimestampType, T.TimestampNTZType)):
            c = epoch_ms_text(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(cols)


# Each function returns the *source* table of one extract day: the shape an
# OLTP database holds (instants as TIMESTAMP, money as DOUBLE).

def customers(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    alter, nulled = _flags(k, batch)
    df = c.select(
        _null_if(k % NULL_CUSTOMER_KEY_MOD == 0, k).alias("customer_id"),
        F.when(alter, F.concat(F.col("c_name"), F.lit(" (renamed)"))).otherwise(F.col("c_name")).alias("name"),
        _null_if((k % NULL_EMAIL_MOD == 0) | nulled,
                 F.concat(F.lit("c"), k.cast("string"), F.lit("@"), F.lower("c_mktsegment"),
                          F.lit(".example.com"))).alias("email"),
        F.when(alter, _ts(AS_OF_2)).otherwise(_ts(AS_OF_1)).alias("updated_at"))
    return df


def orders(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    if batch == 1:
        o = o.where(F.col("o_orderdate") < _ntz(ORDER_CUTOFF))
    k = F.col("o_orderkey")
    alter, nulled = _flags(k, batch)
    placed = F.col("o_orderdate").cast("timestamp")
    df = o.select(
        k.alias("order_id"),
        _null_if(nulled, F.col("o_custkey")).alias("customer_id"),
        placed.alias("order_date"),
        F.when(alter, F.col("o_totalprice") + F.lit(10.0)).otherwise(F.col("o_totalprice")).alias("total_amount"),
        F.when(alter, _ts(AS_OF_2)).otherwise(placed).alias("updated_at"))
    return df


def order_item_key() -> Column:
    """Composite text key of a line: the driver's (order, line number) pair is not unique."""
    parts = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
             F.round(F.col("l_extendedprice") * 100).cast("bigint"),
             F.date_format("l_shipdate", "yyyyMMdd")]
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def order_items(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    if batch == 1:
        li = li.where(F.col("l_shipdate") < _ntz(ORDER_CUTOFF))
    alter, nulled = _flags(F.col("l_orderkey"), batch)
    qty = F.col("l_quantity").cast("bigint")
    df = li.select(
        order_item_key().alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(alter, qty + 1).otherwise(qty).alias("quantity"),
        _null_if(nulled, F.col("l_extendedprice")).alias("price"),
        F.when(alter, _ts(AS_OF_2)).otherwise(F.col("l_shipdate").cast("timestamp")).alias("updated_at"))
    return df


def _brand_number() -> Column:
    return F.regexp_replace(F.col("p_brand"), "Brand#", "").cast("bigint")


def products(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    df = p.select(
        k.alias("product_id"),
        F.col("p_name").alias("name"),
        _null_if(k % NULL_CATEGORY_MOD == 0, _brand_number()).alias("category_id"),
        F.col("p_retailprice").alias("price"),
        _ts(AS_OF_1).alias("updated_at"))
    return df


def categories(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    # DISTINCT over part: a partial (map-side) aggregate, so only one row per
    # brand and map task crosses the shuffle.
    ids = read_table(spark, sf_dir, "part").select(_brand_number().alias("category_id")).distinct()
    cid = F.col("category_id")
    df = ids.select(
        cid,
        _null_if(cid % NULL_CATEGORY_NAME_MOD == 0,
                 F.concat(F.lit("Category "), cid.cast("string"))).alias("name"),
        _ts(AS_OF_1).alias("updated_at"))
    return df


def suppliers(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    df = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").select(
        k.alias("supplier_id"),
        _null_if(k % NULL_SUPPLIER_NAME_MOD == 0, F.col("s_name")).alias("supplier_name"),
        F.concat(F.lit("Contact "), k.cast("string")).alias("contact_name"),
        F.lit(None).cast("string").alias("phone"),
        F.concat(F.lit("s"), k.cast("string"), F.lit("@supplier.example.com")).alias("email"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("city"),
        F.col("n_name").alias("country"),
        _ts(AS_OF_1).alias("created_at"))
    return df


def _shipped(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.where(F.col("l_shipdate") < _ntz(ORDER_CUTOFF)) if batch == 1 else li


def product_suppliers(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    li = _shipped(spark, sf_dir, batch)
    pairs = li.groupBy("l_suppkey", "l_partkey").agg(
        F.min(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.max("l_shipdate").alias("last_ship"))
    _, nulled = _flags(F.col("l_partkey"), batch)
    df = pairs.select(
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("product_id"),
        _null_if(nulled, F.col("unit_price")).alias("supply_price"),
        F.col("last_ship").cast("timestamp").alias("last_updated"))
    return df


def customer_reviews(spark: SparkSession, sf_dir: str, batch: int = 2) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    if batch == 1:
        e = e.where(F.col("ts") < _ntz(REVIEW_CUTOFF))
    # Number of products, as an uncorrelated scalar subquery: evaluated once
    # and inlined as a literal, no join against part.
    n_products = read_table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    k = F.col("event_id")
    alter, nulled = _flags(k, batch)
    step = F.expr("event_id div 7")
    df = e.select(
        k.cast("string").alias("id"),
        F.col("user_id").alias("customer_id"),
        (k % n_products).alias("product_id"),
        (F.lit(1) + F.when(alter, step + 1).otherwise(step) % 5).alias("rating"),
        _null_if((k % NULL_REVIEW_TEXT_MOD == 0) | nulled, F.col("event_type")).alias("review_text"),
        F.col("ts").cast("timestamp").alias("review_date"))
    return df


ADAPTERS = {
    "customers": customers, "orders": orders, "order_items": order_items,
    "product_suppliers": product_suppliers, "customer_reviews": customer_reviews,
    "categories": categories, "products": products, "suppliers": suppliers,
}


def source(spark: SparkSession, sf_dir: str, table: str, day: int = 2) -> DataFrame:
    """The source table of ``table`` on extract day ``day`` (typed instants)."""
    return ADAPTERS[table](spark, sf_dir, day)


def batch(spark: SparkSession, sf_dir: str, table: str, number: int) -> DataFrame:
    """The bronze batch of ``table`` for run ``number`` (epoch-ms landing encoding)."""
    return to_bronze(source(spark, sf_dir, table, number), table)


def batch_keys(spark: SparkSession, sf_dir: str, table: str, number: int) -> DataFrame | None:
    """The keys of an aggregated batch, each as often as its rows come before they are aggregated; None for the other tables."""
    if table != "product_suppliers":
        return None
    return _shipped(spark, sf_dir, number).select(F.col("l_suppkey").alias("supplier_id"), F.col("l_partkey").alias("product_id"))


def batches(spark: SparkSession, sf_dir: str, number: int) -> dict[str, DataFrame]:
    return {name: batch(spark, sf_dir, name, number) for name in ADAPTERS}
