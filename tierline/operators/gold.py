"""The five gold marts.

``mode="faithful"`` (default) reproduces the reference marts exactly,
including their quirks: superseded SCD2 versions of order lines, supplier
links and reviews take part; customer engagement is per customer *and*
distinct days-since-order; product performance multiplies across its
independent children. ``mode="corrected"`` reads only live versions,
counts distinct orders and does not multiply across children.

Physical plans are built for skewed, large inputs:

* every fact table (order lines, reviews) is aggregated per join key
  *before* it meets a dimension. Partial aggregation runs map-side, so a hot
  product or order collapses to one row per map task before any shuffle;
* the fan-out of product performance is computed arithmetically from those
  per-product aggregates (eager aggregation). It equals the naive six-way join
  exactly, without materialising the product x supplier x line x review rows;
* all joins are plain equi-joins: Spark broadcasts a side only when its
  estimated (or, under AQE, measured) size is under the broadcast threshold,
  otherwise it shuffles. No side is forced into memory.

Money is summed exactly (DECIMAL) and returned as DOUBLE.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.money import as_double, line_value, parts_value, ratio, value_parts
from tierline.functions.time import days_between, parse_event_ts
from tierline.operators.quality import clean
from tierline.schemas import IS_ACTIVE

FAITHFUL = "faithful"
CORRECTED = "corrected"


def _live(df: DataFrame, mode: str) -> DataFrame:
    return df.where(F.col(IS_ACTIVE) == F.lit(True)) if mode == CORRECTED else df


def _check(mode: str, strategy: str | None = None) -> None:
    if mode not in (FAITHFUL, CORRECTED):
        raise ValueError(f"mode must be {FAITHFUL!r} or {CORRECTED!r}, got {mode!r}")
    if strategy is not None and strategy not in ("eager", "naive"):
        raise ValueError(f"strategy must be 'eager' or 'naive', got {strategy!r}")


def _lines(silver: Mapping[str, DataFrame], mode: str) -> DataFrame:
    return _live(silver["order_items"], mode).select(
        "order_id", "product_id", "quantity", line_value("price", "quantity").alias("value"))


# --------------------------------------------------------------------------- GD1

def sales_summary(silver: Mapping[str, DataFrame], mode: str = FAITHFUL) -> DataFrame:
    """order_date x category x product -> units, sales, distinct customers (inner joins)."""
    _check(mode)
    orders = silver["orders"].where(F.col(IS_ACTIVE) == F.lit(True))
    order_date = F.col("order_date")
    if mode == CORRECTED:
        order_date = F.date_format(parse_event_ts("order_date"), "yyyy-MM-dd")
    o = orders.select("order_id", order_date.alias("order_date"), "customer_id")
    p = silver["products"].select("product_id", "category_id", F.col("name").alias("product_name"))
    c = silver["categories"].select("category_id", F.col("name").alias("category_name"))
    # Lines collapse to one row per (order, product) map-side before the join,
    # so a hot order cannot pile its lines into one join partition. Exact: an
    # order row joins every line of its group alike, and the customer is a
    # property of the order, not the line.
    lines = _lines(silver, mode).groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("value").alias("value"))
    # Products meet their categories first: the fact meets one dimension, on product_id.
    joined = lines.join(o, "order_id").join(p.join(c, "category_id"), "product_id")
    return joined.groupBy("order_date", "category_id", "category_name", "product_id", "product_name").agg(
        F.sum("quantity").alias("total_units_sold"),
        as_double(F.sum("value")).alias("total_sales"),
        F.countDistinct("customer_id").alias("unique_customers"))


# --------------------------------------------------------------------------- GD2

def customer_engagement(silver: Mapping[str, DataFrame], as_of: dt.date,
                        mode: str = FAITHFUL) -> DataFrame:
    """Per active customer (and, faithfully, per distinct days-since-order value).

    total_orders counts order *lines* joined (an order without lines counts
    once), as the reference's COUNT(o.order_id) over the line join does.
    """
    _check(mode)
    per_order = _lines(silver, mode).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("value").alias("spent"),
        F.count("value").alias("n_values"))
    orders = _live(silver["orders"], mode).select("order_id", "customer_id", "order_date")
    o = orders.join(per_order, "order_id", "left")
    latest = F.max  # the reference's greatest text; corrected: the text of the latest instant
    if mode == CORRECTED:
        def latest(c):
            return F.max_by(c, parse_event_ts(c))
        counted = F.when(F.col("order_id").isNotNull(), 1).otherwise(0)
        days_key = F.lit(None).cast("bigint")
    else:
        counted = F.when(F.col("order_id").isNotNull(), F.coalesce("n_lines", F.lit(1))).otherwise(0)
        days_key = days_between(as_of, "order_date")
    per_day = o.groupBy("customer_id", days_key.alias("days_since_last_order")).agg(
        F.sum(counted).alias("n_orders"), F.sum("spent").alias("spent"),
        F.sum("n_values").alias("n_values"), latest("order_date").alias("last_order_date"))
    customers = silver["customers"].where(F.col(IS_ACTIVE) == F.lit(True)) \
        .select("customer_id", F.col("name").alias("customer_name"))
    out = customers.join(per_day, "customer_id", "left").groupBy(
        "customer_id", "customer_name", "days_since_last_order").agg(
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        as_double(F.sum("spent")).alias("total_spent"),
        latest("last_order_date").alias("last_order_date"),
        ratio(F.sum("spent"), F.sum("n_values")).alias("avg_order_value"))
    if mode == CORRECTED:
        out = out.withColumn("days_since_last_order", days_between(as_of, "last_order_date"))
    return out.select("customer_id", "customer_name", "total_orders", "total_spent",
                      "last_order_date", "days_since_last_order", "avg_order_value")


# --------------------------------------------------------------------------- GD3

_GD3_KEYS = ["product_id", "product_name", "category_id", "category_name", "supplier_id",
             "supplier_name"]


def _gd3_dims(silver: Mapping[str, DataFrame], mode: str):
    p = clean(silver["products"]).select("product_id", F.col("name").alias("product_name"),
                                         "category_id")
    c = silver["categories"].select("category_id", F.col("name").alias("category_name"))
    ps = _live(silver["product_suppliers"], mode).select("supplier_id", "product_id")
    s = silver["suppliers"].select("supplier_id", "supplier_name")
    return p, c, ps, s


def product_performance(silver: Mapping[str, DataFrame], mode: str = FAITHFUL,
                        strategy: str = "eager") -> DataFrame:
    """Per clean product x supplier: units, revenue, average rating, review count."""
    _check(mode, strategy)
    if strategy == "naive":
        return _product_performance_naive(silver, mode)
    p, c, ps, s = _gd3_dims(silver, mode)
    lines = _lines(silver, mode).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("units"),
        F.sum("value").alias("revenue"))
    reviews = _live(silver["customer_reviews"], mode).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("n_ratings"), F.count("review_text").alias("n_texts"))
    # products (+category) per output key, with their multiplicity
    pc = p.join(c, "category_id", "left").groupBy(
        "product_id", "product_name", "category_id", "category_name").agg(
        F.count(F.lit(1)).alias("m_product"))
    # supplier links (+name) per product, with their multiplicity; ps is joined
    # to suppliers first, so the later product join stays partitioned by product
    links = ps.join(s, "supplier_id", "left").groupBy("product_id", "supplier_id", "supplier_name") \
        .agg(F.count(F.lit(1)).alias("m_link"))
    base = pc.join(links, "product_id", "left") \
        .withColumn("m", F.col("m_product") * F.coalesce("m_link", F.lit(1)))
    joined = base.join(lines, "product_id", "left").join(reviews, "product_id", "left")
    if mode == CORRECTED:
        line_mult = review_mult = F.lit(1)
    else:
        line_mult = F.col("m") * F.coalesce("n_reviews", F.lit(1))
        review_mult = F.col("m") * F.coalesce("n_lines", F.lit(1))
    return joined.select(
        *_GD3_KEYS,
        (F.col("units") * line_mult).cast("bigint").alias("total_units_sold"),
        as_double(F.col("revenue") * line_mult).alias("total_revenue"),
        ratio(F.col("rating_sum"), F.col("n_ratings")).alias("avg_rating"),
        (F.coalesce("n_texts", F.lit(0)) * review_mult).cast("bigint").alias("total_reviews"))


def _spread(dim: DataFrame, key: str) -> DataFrame:
    """A dimension in as many partitions as a shuffle has: if the facts are small enough to be broadcast, its few files would make few tasks of the whole fan-out."""
    return dim.repartition(int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


_PARTS = ["value_units", "value_more", "value_most"]


def _product_performance_naive(silver: Mapping[str, DataFrame], mode: str) -> DataFrame:
    """The reference's literal six-way left join, for comparison and tests.

    Every product x supplier x line x review row is made and summed; what a row carries, adds and is found by is therefore kept
    small: longs for the value, a number for the presence of a review's text, and for the keys the product and the number
    that their values have among those of the product. The values come back to the sums as they lie, without an exchange.
    Left joins by one key commute, so the reviews, of which a product has fewer than lines, come first.
    """
    p, c, ps, s = _gd3_dims(silver, mode)
    lines = _lines(silver, mode).select("product_id", "quantity", *[v.alias(n) for n, v in zip(_PARTS, value_parts(F.col("value")))])
    reviews = _live(silver["customer_reviews"], mode).select("product_id", "rating", F.col("review_text").isNotNull().cast("int").alias("has_text"))
    # Links meet their suppliers before the products, when they are narrowest.
    keys = _spread(p, "product_id").join(c, "category_id", "left").join(ps.join(s, "supplier_id", "left"), "product_id", "left")
    others = [k for k in _GD3_KEYS if k != "product_id"]
    keys = keys.select(*_GD3_KEYS, F.dense_rank().over(Window.partitionBy("product_id").orderBy(*others)).alias("key_number"))
    joined = keys.select("product_id", "key_number").join(reviews, "product_id", "left").join(lines, "product_id", "left")
    sums = joined.groupBy("product_id", "key_number").agg(
        F.sum("quantity").alias("total_units_sold"), *[F.sum(n).alias(n) for n in _PARTS],
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("n_ratings"), F.sum("has_text").alias("total_reviews"))
    # Of a product's number all key rows are alike and there is one row of sums: the greatest value is the only one.
    found = keys.unionByName(sums, allowMissingColumns=True).groupBy("product_id", "key_number").agg(
        *[F.max(n).alias(n) for n in [*others, *sums.columns] if n not in ("product_id", "key_number")])
    return found.select(
        *_GD3_KEYS, "total_units_sold", as_double(parts_value(*[F.col(n) for n in _PARTS])).alias("total_revenue"),
        ratio(F.col("rating_sum"), F.col("n_ratings")).alias("avg_rating"),
        F.coalesce("total_reviews", F.lit(0)).cast("bigint").alias("total_reviews"))


# --------------------------------------------------------------------------- GD4

def supplier_analysis(silver: Mapping[str, DataFrame], mode: str = FAITHFUL,
                      strategy: str = "eager") -> DataFrame:
    """Per clean supplier: distinct products supplied, units and revenue of those products.

    A product's sales are credited in full to each of its suppliers.
    """
    _check(mode, strategy)
    s = clean(silver["suppliers"]).select("supplier_id", "supplier_name")
    ps = _live(silver["product_suppliers"], mode).select("supplier_id", "product_id")
    lines = _lines(silver, mode)
    if strategy == "naive":
        # The literal joins; every supplier x product x line row adds longs, not wide decimals.
        lines = lines.select("product_id", "quantity", *[v.alias(n) for n, v in zip(_PARTS, value_parts(F.col("value")))])
        joined = _spread(s, "supplier_id").join(ps, "supplier_id", "left").join(lines, "product_id", "left")
        return joined.groupBy("supplier_id", "supplier_name").agg(
            F.countDistinct("product_id").alias("total_products_supplied"),
            F.sum("quantity").alias("total_units_sold"), *[F.sum(n).alias(n) for n in _PARTS]).select(
            "supplier_id", "supplier_name", "total_products_supplied", "total_units_sold",
            as_double(parts_value(*[F.col(n) for n in _PARTS])).alias("total_revenue"))
    per_product = lines.groupBy("product_id").agg(F.sum("quantity").alias("units"),
                                                  F.sum("value").alias("revenue"))
    per_supplier = ps.join(per_product, "product_id", "left").groupBy("supplier_id").agg(
        F.countDistinct("product_id").alias("n_products"), F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"))
    s = s.groupBy("supplier_id", "supplier_name").agg(F.count(F.lit(1)).alias("m"))
    return s.join(per_supplier, "supplier_id", "left").select(
        "supplier_id", "supplier_name",
        F.coalesce("n_products", F.lit(0)).cast("bigint").alias("total_products_supplied"),
        (F.col("units") * F.col("m")).cast("bigint").alias("total_units_sold"),
        as_double(F.col("revenue") * F.col("m")).alias("total_revenue"))


# --------------------------------------------------------------------------- GD5

def customer_reviews_summary(silver: Mapping[str, DataFrame], mode: str = FAITHFUL) -> DataFrame:
    """Per clean product: average rating, reviews with text, positive (>=4), negative (<3)."""
    _check(mode)
    per_product = _live(silver["customer_reviews"], mode).groupBy("product_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("n_ratings"),
        F.count("review_text").alias("n_texts"),
        F.count(F.when(F.col("rating") >= 4, 1)).alias("n_pos"),
        F.count(F.when(F.col("rating") < 3, 1)).alias("n_neg"))
    p = clean(silver["products"]).select("product_id", F.col("name").alias("product_name"))
    return p.join(per_product, "product_id", "left").groupBy("product_id", "product_name").agg(
        ratio(F.sum("rating_sum"), F.sum("n_ratings")).alias("avg_rating"),
        F.coalesce(F.sum("n_texts"), F.lit(0)).cast("bigint").alias("total_reviews"),
        F.coalesce(F.sum("n_pos"), F.lit(0)).cast("bigint").alias("positive_reviews"),
        F.coalesce(F.sum("n_neg"), F.lit(0)).cast("bigint").alias("negative_reviews"))


MARTS = {
    "sales_summary": sales_summary,
    "customer_engagement": customer_engagement,
    "product_performance": product_performance,
    "supplier_analysis": supplier_analysis,
    "customer_reviews_summary": customer_reviews_summary,
}
