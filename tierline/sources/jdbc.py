"""Relational sources: full, incremental (watermark) and keyset extracts.

An extract is a lazy DataFrame: ``spark.read.format("jdbc")`` plus a typed
``where``. Spark compiles the comparison into the source query's WHERE
clause (visible as ``PushedFilters`` in the plan), so only new rows leave
the database, and no timestamp is ever spliced into SQL text.

Reads are partitioned: with ``num_partitions > 1`` Spark opens that many
connections, each reading one stride of ``partition_column``. The stride
bounds come from a pushed-down MIN/MAX (one row returns to the driver) over
the rows of the extract, so the connections share an increment evenly.
The reference reads every table on a single connection.

Equal strides share a skewed key badly (most ids in one narrow range, or one
far outlier). With ``equal_depth`` the connections read ranges between
quantiles of the column instead: one more read of that column alone, over
the same strides, into a bounded quantile sketch per task; only the bounds reach the driver.

``ParquetSource`` offers the same interface over Parquet tables (the
driver's tables in tests and benchmarks); the extract logic is shared.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.predicates import after_keyset, after_watermark, up_to_keyset
from tierline.schemas import FULL, INCREMENTAL

LOAD_TYPES = (FULL, INCREMENTAL)

# A quantile is off by at most (rows / QUANTILE_ACCURACY) rows in rank.
QUANTILE_ACCURACY = 10_000


def sql_literal(value) -> str:
    """A bound read back from the source, as SQL text: numbers, and dates and instants by JDBC's escapes."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal)):
        raise TypeError(f"can't split a read by values of {type(value).__name__}")
    return str(value)


def ranges(column: str, bounds: list) -> list[str]:
    """Disjoint SQL predicates that together hold every row: below, between and from the ascending ``bounds``; NULLs are in the first."""
    if not bounds:
        return ["1 = 1"]
    texts = [sql_literal(b) for b in bounds]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} < {texts[0]} OR {column} IS NULL", *inner, f"{column} >= {texts[-1]}"]


@dataclass
class JdbcSource:
    url: str
    driver: str
    schema: str | None = None
    user: str | None = None
    password_env: str | None = None          # name of an environment variable, never a literal
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 10_000
    quote: str = '"'
    options: dict = field(default_factory=dict)

    def qualified(self, table: str) -> str:
        name = f"{self.quote}{table}{self.quote}"
        if self.schema:
            return f"{self.quote}{self.schema}{self.quote}.{name}"
        return name

    def _reader(self, spark: SparkSession):
        r = spark.read.format("jdbc").option("url", self.url).option("driver", self.driver) \
            .option("fetchsize", str(self.fetch_size)).option("pushDownAggregate", "true")
        if self.user:
            r = r.option("user", self.user)
        secret = self.password or (os.environ.get(self.password_env) if self.password_env else None)
        if secret:
            r = r.option("password", secret)
        for k, v in self.options.items():
            r = r.option(k, v)
        return r

    def bounds(self, spark: SparkSession, table: str, column: str, where: Column | None = None):
        df = self._reader(spark).option("dbtable", self.qualified(table)).load()
        row = (df if where is None else df.where(where)).agg(
            F.min(column).alias("lo"), F.max(column).alias("hi")).first()
        return row["lo"], row["hi"]

    def _strided(self, spark: SparkSession, table: str, column: str, num_partitions: int, bounds: tuple) -> DataFrame:
        r = self._reader(spark).option("dbtable", self.qualified(table))
        if None not in bounds:
            r = r.option("partitionColumn", column).option("lowerBound", str(bounds[0])) \
                .option("upperBound", str(bounds[1])).option("numPartitions", str(num_partitions))
        return r.load()

    def quantiles(self, spark: SparkSession, table: str, column: str, num_partitions: int,
                  bounds: tuple, where: Column | None = None) -> list:
        """At most ``num_partitions - 1`` ascending values of ``column`` that part the extract into ranges of like numbers of rows.

        A value that alone fills several ranges is one bound: its rows can't be parted by this column.
        """
        df = self._strided(spark, table, column, num_partitions, bounds)
        shares = [k / num_partitions for k in range(1, num_partitions)]
        row = (df if where is None else df.where(where)).agg(
            F.array_distinct(F.percentile_approx(column, shares, QUANTILE_ACCURACY)).alias("at")).first()
        return sorted(row["at"] or [])

    def read(self, spark: SparkSession, table: str, partition_column: str | None = None,
             num_partitions: int = 1, bounds: tuple | None = None, where: Column | None = None,
             equal_depth: bool = False) -> DataFrame:
        if partition_column and num_partitions > 1:
            bounds = bounds or self.bounds(spark, table, partition_column, where)
            if equal_depth:
                found = self.quantiles(spark, table, partition_column, num_partitions, bounds, where)
                name = f"{self.quote}{partition_column}{self.quote}"
                df = self._reader(spark).jdbc(self.url, self.qualified(table), predicates=ranges(name, found))
            else:
                df = self._strided(spark, table, partition_column, num_partitions, bounds)
        else:
            df = self._reader(spark).option("dbtable", self.qualified(table)).load()
        return df if where is None else df.where(where)


@dataclass
class ParquetSource:
    """Tables as Parquet files/folders: ``tables[name]`` is a path, or a function of the session."""
    tables: dict

    def read(self, spark: SparkSession, table: str, partition_column: str | None = None,
             num_partitions: int = 1, bounds: tuple | None = None, where: Column | None = None,
             equal_depth: bool = False) -> DataFrame:
        src = self.tables[table]
        df = src(spark) if callable(src) else spark.read.parquet(src)
        return df if where is None else df.where(where)


def normalize_load_type(value: str | None) -> str:
    """'Full Load' / 'full' -> full; 'Incremental' / 'incremental' -> incremental; else error."""
    text = (value or "").strip().lower()
    if text in ("full", "full load", "full_load"):
        return FULL
    if text in ("incremental", "incremental load", "incremental_load"):
        return INCREMENTAL
    raise ValueError(f"unknown load type {value!r}; expected one of {LOAD_TYPES}")


def extract(spark: SparkSession, source, table: str, load_type: str = FULL,
            watermark_col: str | None = None, mark: dt.datetime | None = None,
            keyset: tuple[str, object] | None = None, columns: list[str] | None = None,
            partition_column: str | None = None, num_partitions: int = 1, equal_depth: bool = False,
            until: tuple | None = None) -> DataFrame:
    """One extract of ``table``.

    * ``full``: every row;
    * ``incremental``: rows with ``watermark_col > mark`` (strict, as the
      reference), or with ``keyset=(id_col, last_id)`` the tie-safe
      predicate ``wm > mark OR (wm = mark AND id > last_id)``.

    ``until=(mark, id)`` ends a keyset extract there, that row included (a page, see ``sources.paging``).
    ``equal_depth``: connections read ranges between quantiles of ``partition_column``.

    An incremental spec without a watermark column is rejected instead of
    silently becoming a full load.
    """
    load_type = normalize_load_type(load_type)
    cond: Column | None = None
    if load_type == INCREMENTAL:
        if not watermark_col:
            raise ValueError(f"incremental extract of {table!r} needs a watermark column")
        if mark is not None:
            cond = (after_keyset(watermark_col, keyset[0], mark, keyset[1]) if keyset
                    else after_watermark(watermark_col, mark))
            if keyset and until:
                cond = cond & up_to_keyset(watermark_col, keyset[0], *until)
    df = source.read(spark, table, partition_column=partition_column, num_partitions=num_partitions, where=cond,
                     equal_depth=equal_depth)
    return df.select(*columns) if columns else df
