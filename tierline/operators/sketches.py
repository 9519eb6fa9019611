"""Approximate COUNT(DISTINCT) from sketches that are stored per day and merged.

An exact distinct count can't be added up: a customer of two days is one customer of the month, so each
report reads all rows again. A HyperLogLog sketch of each (key, day) is a few KB, and the union of
sketches is the sketch of the union: rows are sketched once, when their load
arrives, and any later report reads sketches only. A row that comes again in a later load counts once.

``store`` replaces what its load date has stored (dynamic partition overwrite), so a repeated run
changes nothing. The relative standard error of a merged estimate is 1.04 / sqrt(2 ** LG_K).

Results: null values aren't counted (as COUNT(DISTINCT) doesn't); rows without a day are kept under a null day; a group without
values counts 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)


def daily(df: DataFrame, day: Column, value: Column, keys: dict[str, Column] | None = None, lg_k: int = LG_K) -> DataFrame:
    """(keys, day, sketch) of the values of each day; partial sketches are merged on the map side."""
    named = [c.alias(k) for k, c in (keys or {}).items()]
    rows = df.select(*named, day.cast("date").alias("day"), value.alias("value"))
    return rows.groupBy(*(keys or {}), "day").agg(F.hll_sketch_agg("value", F.lit(lg_k)).alias("sketch"))


def store(sketches: DataFrame, path: str, load_date: str) -> None:
    """Write the sketches of a load; other loads stay as they are."""
    rows = sketches.withColumn("load_date", F.lit(load_date).cast("date"))
    rows.write.partitionBy("load_date").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def merged(sketches: DataFrame, keys: dict[str, Column], name: str = "estimate") -> DataFrame:
    """(keys, estimate): distinct values over all sketches of each group."""
    rows = sketches.select(*[c.alias(k) for k, c in keys.items()], "sketch")
    union = rows.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return union.select(*keys, F.hll_sketch_estimate("sketch").alias(name))
