"""Pages of an incremental extract: where each ends, by (watermark, id).

``page_ends`` reads the two columns of the increment once, sorts them over
the cluster and numbers them; every ``page_rows``-th row ends a page, and so
does the last. Each page is then a keyset extract of its own (typed
predicates, pushed into the source), lands as a run of its own and has its own audit row, so a
run that fails is taken up again behind the last page that was audited.

The sorted keys are written once to the shared scratch folder, as numbering
needs the size of every range before a row's own. Only the ends (rows / ``page_rows`` pairs) reach the driver.

Rows without a watermark are in no incremental extract. Rows of equal
(watermark, id) are in one page, which may then be longer. A row without an
id has no place in the order; such an increment is refused rather than losing it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.schemas import INCREMENTAL
from tierline.session import scratch_root
from tierline.sources.jdbc import extract

PAGE_NO = "_page"
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_RANGE, _IN_RANGE, _BEFORE = "_range", "_in_range", "_before"


def numbered(keys: DataFrame, path: str) -> DataFrame:
    """``keys`` in order of their columns with ``n`` from 1 and the number of rows ``total``; no partition holds more than a sorted range."""
    order = keys.columns
    keys.orderBy(*order).withColumn(_RANGE, F.spark_partition_id()).write.parquet(path)
    stored = keys.sparkSession.read.parquet(path)
    # one row a range: their running sum is the only thing that goes through one task
    sizes = stored.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(_RANGE, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(_BEFORE),
                         F.sum("rows").over(Window.partitionBy()).alias("total"))
    place = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order))
    return stored.withColumn(_IN_RANGE, place).join(sizes, _RANGE).select(
        *order, (F.col(_BEFORE) + F.col(_IN_RANGE)).alias("n"), "total")


def page_ends(spark: SparkSession, source, table: str, watermark_col: str, id_col: str, mark: dt.datetime, last_id,
              page_rows: int, **read_kwargs) -> list[tuple[dt.datetime, object]]:
    """The (watermark, id) at which each page of the rows behind (``mark``, ``last_id``) ends, ascending."""
    if page_rows < 1:
        raise ValueError("a page needs a row at least")
    keys = extract(spark, source, table, INCREMENTAL, watermark_col, mark, keyset=(id_col, last_id),
                   columns=[watermark_col, id_col], **read_kwargs)
    refused = F.raise_error(f"a page of {table} would lose rows without {id_col}")
    keys = keys.withColumn(id_col, F.when(F.col(id_col).isNull(), refused.cast(keys.schema[id_col].dataType)).otherwise(F.col(id_col)))
    found = numbered(keys, scratch_root(spark, f"pages-{table}"))
    ends = found.where((F.col("n") % page_rows == 0) | (F.col("n") == F.col("total")))
    rows = ends.select(F.col(watermark_col).cast("timestamp"), id_col).distinct().orderBy(watermark_col, id_col).collect()
    return [(wm if wm.tzinfo else wm.replace(tzinfo=dt.timezone.utc), ident) for wm, ident in rows]


def page_number(watermark_col: str, id_col: str, id_type: T.DataType, ends: list[tuple[dt.datetime, object]]) -> Column:
    """The number, from 0, of the page a row is in: the first of the ascending ``ends`` that isn't before the row."""
    marks = F.lit([round((wm - _EPOCH) / dt.timedelta(microseconds=1)) for wm, _ in ends])
    idents = F.lit([ident for _, ident in ends]).cast(T.ArrayType(id_type))
    at = F.unix_micros(F.col(watermark_col).cast("timestamp"))

    def halved(found: Column, _: Column) -> Column:
        """``found`` = 2**32 * low + high: the page is one of these or between."""
        low, high = F.shiftright(found, 32), found.bitwiseAND(F.lit(0xFFFFFFFF))
        mid = F.floor((low + high) / 2)
        place = (mid + 1).cast("int")
        mark, ident = F.element_at(marks, place), F.element_at(idents, place)
        before = (mark < at) | ((mark == at) & (ident < F.col(id_col)))
        return F.when(low >= high, found).when(before, F.shiftleft(mid + 1, 32).bitwiseOR(high)).otherwise(F.shiftleft(low, 32).bitwiseOR(mid))
    steps = F.sequence(F.lit(0), F.lit(len(ends).bit_length()))
    return F.shiftright(F.aggregate(steps, F.lit(len(ends) - 1).cast("long"), halved), 32).cast("int")


def stored_pages(df: DataFrame, watermark_col: str, id_col: str, ends: list[tuple[dt.datetime, object]], path: str) -> DataFrame:
    """``df``, the rows up to the last of ``ends``, read once, with PAGE_NO; each page's rows lie in one file of ``path``."""
    page = page_number(watermark_col, id_col, df.schema[id_col].dataType, ends)
    tasks = min(len(ends), 4 * df.sparkSession.sparkContext.defaultParallelism)
    df.withColumn(PAGE_NO, page).repartition(tasks, PAGE_NO).write.parquet(path)
    return df.sparkSession.read.parquet(path)
