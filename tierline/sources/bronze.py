"""Bronze readers: landing files -> the registry's typed bronze schema.

Schema-on-read with an explicit schema, projected by *name* (landing adds
``load_date``/``run_id`` partition columns, so positional ``SELECT *``
would shift or widen the table).

JSON is read as text first, then converted with checked casts. That avoids
two silent traps of a typed JSON read: ``{"id": 1.0}`` (a nullable integer
that a pandas extract wrote as float) becomes NULL under a BIGINT
schema, and so does ``{"id": "x"}`` in PERMISSIVE mode. Here ``1.0``
reads as 1, and malformed values either fail the job (``mode="FAILFAST"``,
the default) or become NULL with a ``_malformed`` flag
(``mode="PERMISSIVE"``). Event times stay text in either encoding
(epoch-ms digits or ISO-8601), as bronze declares them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.schemas import TableSpec
from tierline.sources.landing import (DAILY_NAME_PATTERN, DAILY_NAME_SPARK_FORMAT, LANDING_DATE, LOAD_DATE,
                                     RUN_ID)

FAILFAST = "FAILFAST"
PERMISSIVE = "PERMISSIVE"
MALFORMED = "_malformed"
CORRUPT = "_corrupt_record"
INTEGRAL_TEXT = r"^\s*[-+]?[0-9]+(\.0*)?\s*$"


def _raw_schema(spec: TableSpec) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType(), True) for f in spec.schema.fields]
    fields += [T.StructField(LOAD_DATE, T.DateType(), True), T.StructField(RUN_ID, T.StringType(), True)]
    return T.StructType(fields)


def _convert(text: Column, dtype: T.DataType, name: str, strict: bool) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.LongType):
        ok = text.rlike(INTEGRAL_TEXT)
        value = F.trim(text).cast("decimal(38,9)").cast("bigint") if strict \
            else F.trim(text).try_cast("decimal(38,9)").try_cast("bigint")
    elif isinstance(dtype, T.DoubleType):
        value = text.try_cast("double") if not strict else text.cast("double")
        ok = value.isNotNull() if not strict else F.lit(True)
    elif isinstance(dtype, T.BooleanType):
        low = F.lower(F.trim(text))
        ok = low.isin("true", "false")
        value = low == F.lit("true")
    else:
        value = text.cast(dtype)
        ok = F.lit(True)
    if strict:
        err = F.raise_error(F.concat(F.lit(f"malformed {name}: "), text))
        return F.when(text.isNull(), F.lit(None).cast(dtype)).when(ok, value).otherwise(err.cast(dtype))
    return F.when(text.isNotNull() & ok, value).otherwise(F.lit(None).cast(dtype))


def typed(raw: DataFrame, spec: TableSpec, mode: str = FAILFAST, keep_run: bool = False,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Text columns -> registry types (see module docstring); ``keep`` passes columns through."""
    strict = mode == FAILFAST
    cols = [_convert(F.col(f.name), f.dataType, f.name, strict).alias(f.name) for f in spec.schema.fields]
    if not strict:
        bad = [F.col(f.name).isNotNull() & _convert(F.col(f.name), f.dataType, f.name, False).isNull()
               for f in spec.schema.fields if not isinstance(f.dataType, T.StringType)]
        if CORRUPT in raw.columns:      # a line that is not JSON
            bad.append(F.col(CORRUPT).isNotNull())
        cols.append((reduce(or_, bad) if bad else F.lit(False)).alias(MALFORMED))
    if keep_run:
        cols += [F.col(LOAD_DATE), F.col(RUN_ID)]
    cols += [F.col(c) for c in keep]
    return raw.select(cols)


def read_bronze_daily(spark: SparkSession, root: str, spec: TableSpec, mode: str = FAILFAST) -> DataFrame:
    """Bronze view of the older daily landing: every ``<table>_<ddMMyyyy>.json`` under ``root``.

    This is the external table's wildcard. ``root`` may itself be a glob, such
    as ``archived_daily_glob``. Each row gets ``landing_date``, parsed from its
    object's name by the file-metadata column (no listing on the driver), so
    days stay apart after a union of landing and archive.
    """
    from tierline.plans.publish import path_exists
    glob = f"{root.rstrip('/')}/{spec.name}_*.json"
    schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in spec.schema.fields])
    if not path_exists(spark, glob):            # no object yet: an empty, typed batch
        empty = spark.createDataFrame([], schema).withColumn(LANDING_DATE, F.lit(None).cast("date"))
        return typed(empty, spec, mode, keep=(LANDING_DATE,))
    raw = _json_reader(spark, schema, mode).json(glob)
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), DAILY_NAME_PATTERN, 1),
                    DAILY_NAME_SPARK_FORMAT)
    return typed(raw.withColumn(LANDING_DATE, day), spec, mode, keep=(LANDING_DATE,))


def read_bronze_json(spark: SparkSession, path: str, spec: TableSpec, runs: list[str] | None = None,
                     mode: str = FAILFAST, keep_run: bool = False) -> DataFrame:
    """Bronze view of a table's JSON landing folder, optionally limited to some runs.

    The run filter is on a partition column, so Spark lists and reads only
    those runs' folders (partition pruning). An empty or missing landing folder
    yields an empty DataFrame with the bronze schema (an empty increment
    is normal).
    """
    raw = _read_or_empty(spark, path, _raw_schema(spec), "json", mode)
    if runs is not None:
        raw = raw.where(F.col(RUN_ID).isin(list(runs)))
    return typed(raw, spec, mode, keep_run)


def read_bronze_runs(spark: SparkSession, landing_root: str, spec: TableSpec, runs: list[str] | None = None,
                     mode: str = FAILFAST, keep_run: bool = False) -> DataFrame:
    """Bronze view of a table's landing runs, whatever its landing format."""
    path = f"{landing_root.rstrip('/')}/{spec.name}"
    if spec.landing_format == "json":
        return read_bronze_json(spark, path, spec, runs, mode, keep_run)
    schema = T.StructType(list(spec.schema.fields) + [T.StructField(LOAD_DATE, T.DateType(), True),
                                                      T.StructField(RUN_ID, T.StringType(), True)])
    raw = _read_or_empty(spark, path, schema, "parquet", mode)
    if runs is not None:
        raw = raw.where(F.col(RUN_ID).isin(list(runs)))
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    if keep_run:
        cols += [F.col(LOAD_DATE), F.col(RUN_ID)]
    return raw.select(cols)


def read_bronze_parquet(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Bronze view of Parquet landing files (typed at the source; read by name)."""
    df = _read_or_empty(spark, path, spec.schema, "parquet", FAILFAST)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def _json_reader(spark: SparkSession, schema: T.StructType, mode: str):
    if mode == FAILFAST:
        return spark.read.schema(schema).option("mode", FAILFAST)
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return spark.read.schema(kept).option("mode", PERMISSIVE).option("columnNameOfCorruptRecord", CORRUPT)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str, mode: str) -> DataFrame:
    from tierline.plans.publish import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if fmt == "json":
        # FAILFAST here only concerns lines that are not JSON at all
        return _json_reader(spark, schema, mode).json(path)
    return reader.parquet(path)
