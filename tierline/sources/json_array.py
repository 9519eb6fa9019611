"""One large JSON array of records, read by many tasks.

Spark reads such a file with ``multiLine`` as one task, since the borders of its
records aren't known before all that precedes them is read. Here the text
reader deals it out by byte ranges, with ``}`` as the end of a line, so that every record ends at
the end of some fragment. Which fragments those are follows from three running sums
over the file, each summed per byte range first, and over the ranges after that
(one row per range):

1. quotes that aren't escaped: an odd number before a fragment puts its start inside a string;
2. braces outside of strings: a fragment that brings the depth to 0 ends a record;
3. ends of records: their number is that of the record a fragment belongs to.

Only the fragments of one record are ever brought together.

Results: records nested to any depth, strings with braces, quotes and line breaks, several files and empty
arrays are read as ``multiLine`` reads them. A file that ends inside a
record, or a record that doesn't fit the schema, fails the query. Elements of the array
that are no objects are not records and fail it too, as the text between two records must be a comma.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.session import scratch_root

_BETWEEN = r"^[\s,\[﻿]*"      # what may stand before a record
_AFTER = r"^[\s,\[\]﻿]*$"     # what may stand after the last one
_PLACE = ["file", "block", "pos"]


def _times(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _outside(bare: Column) -> Column:
    """``bare`` (without escapes, starting outside of strings) without its strings; the last one may be open."""
    return F.regexp_replace(bare, r'"[^"]*("|$)', "")


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, pos, text, quotes, opened if it starts outside, opened if inside a string) of each piece up to a closing brace."""
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    return (spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos"), F.col("value").alias("text"))
            .withColumn("quotes", _times(bare, '"'))
            .withColumn("opened_out", _times(_outside(bare), "{"))
            .withColumn("opened_in", _times(_outside(F.concat(F.lit('"'), bare)), "{")))


def _sum_before(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over all fragments of the file that come before."""
    first = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum(value).alias("total"))
    starts = blocks.select("file", "block", F.coalesce(F.sum("total").over(first), F.lit(0)).alias("start"))
    return (rows.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(starts, ["file", "block"]).withColumn(name, F.col(name) + F.col("start")).drop("start"))


def numbered(places: DataFrame) -> DataFrame:
    """(file, block, pos, record, ends): the record of each fragment, and if it ends there."""
    rows = _sum_before(places, "quotes", "quoted").withColumn("inside", F.col("quoted") % 2 == 1)
    closes = F.when((F.col("quoted") + F.col("quotes")) % 2 == 0, 1).otherwise(0)
    opened = F.when(F.col("inside"), F.col("opened_in")).otherwise(F.col("opened_out"))
    rows = rows.select(*_PLACE, closes.alias("closes"), (opened - closes).alias("change"))
    rows = _sum_before(rows, "change", "depth")
    rows = rows.select(*_PLACE, F.when((F.col("closes") == 1) & (F.col("depth") + F.col("change") == 0), 1).otherwise(0).alias("ends"))
    return _sum_before(rows, "ends", "record")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of the JSON array file(s) at ``path``.

    The fragments are written once to the shared scratch folder; the sums read their
    numbers only, and the texts are exchanged by record.
    """
    stored = scratch_root(spark, "json-array")
    fragments(spark, path).write.parquet(stored)
    pieces = spark.read.parquet(stored)
    places = numbered(pieces.drop("text"))
    rows = pieces.select(*_PLACE, "text").join(places, _PLACE)
    whole = rows.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "pos", "text"))).alias("parts"), F.max("ends").alias("ended"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "}")
    whole = whole.select("file", "ended", F.regexp_replace(text, _BETWEEN, "").alias("rest"), text.alias("text"))

    def broken(rest: Column) -> Column:
        return F.raise_error(F.concat(F.lit("no record of a JSON array ends here: "), "file", F.lit(": "), F.substring(rest, 1, 100))).cast("string")
    record = F.when((F.col("ended") == 1) & F.col("rest").startswith("{"), F.concat("rest", F.lit("}"))).otherwise(broken(F.col("rest")))
    whole = whole.where((F.col("ended") == 1) | ~F.col("text").rlike(_AFTER)).select(record.alias("json"))
    # the bracket that closes the array follows the last record; a file that was cut off lacks it
    last = places.groupBy("file").agg(F.max_by("ends", F.struct("block", "pos")).alias("ended"))
    whole = whole.unionByName(last.where("ended = 1").select(broken(F.lit("the array isn't closed")).alias("json")))
    return whole.select(F.from_json("json", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
