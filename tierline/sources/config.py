"""Ingest configuration: a table of tables, from CSV or nested JSON.

Both dialects normalise to one small DataFrame
``source, table_name, load_type, watermark_col, is_active, target_path``;
``load_type`` is validated (``full`` / ``incremental``). Configuration is
control-plane metadata (a handful of rows), so ``active_tables`` collects it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.schemas import CONFIG_CSV_SCHEMA, INCREMENTAL, REGISTRY, TableSpec
from tierline.sources.jdbc import normalize_load_type

NORMALIZED = ["source", "table_name", "load_type", "watermark_col", "is_active", "target_path"]


def _load_type_col(c) -> F.Column:
    t = F.lower(F.trim(c))
    return F.when(t.isin("full", "full load"), F.lit("full")) \
        .when(t.isin("incremental", "incremental load"), F.lit("incremental")) \
        .otherwise(F.raise_error(F.concat(F.lit("unknown load type: "), F.coalesce(c, F.lit("NULL")))))


def read_config_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV dialect: header row, all strings, ``is_active`` is '1'/'0'."""
    raw = spark.read.schema(CONFIG_CSV_SCHEMA).option("header", True).csv(path)
    wm = F.nullif(F.trim(F.col("watermark")), F.lit(""))
    return raw.select(
        F.col("database").alias("source"),
        F.col("tablename").alias("table_name"),
        _load_type_col(F.col("loadtype")).alias("load_type"),
        wm.alias("watermark_col"),
        (F.trim(F.col("is_active")) == F.lit("1")).alias("is_active"),
        F.col("targetpath").alias("target_path"))


def read_config_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON dialect: one document with a ``tables`` array (booleans are real booleans)."""
    doc = spark.read.option("multiLine", True).json(path)
    rows = doc.select(F.col("source_name").alias("source"), F.explode("tables").alias("t"))
    return rows.select(
        "source",
        F.col("t.name").alias("table_name"),
        _load_type_col(F.col("t.load_type")).alias("load_type"),
        F.col("t.watermark").cast("string").alias("watermark_col"),
        F.coalesce(F.col("t.is_active").cast("boolean"), F.lit(False)).alias("is_active"),
        F.col("t.target_path").alias("target_path"))


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return read_config_json(spark, path) if path.endswith(".json") else read_config_csv(spark, path)


def active_tables(config: DataFrame) -> list[dict]:
    """Active table entries, in file order (a config has a handful of rows)."""
    rows = config.where(F.col("is_active")).collect()
    out = []
    for r in rows:
        d = r.asDict()
        d["load_type"] = normalize_load_type(d["load_type"])
        out.append(d)
    return out


def configured(config: DataFrame, registry: dict[str, TableSpec] = REGISTRY) -> list[TableSpec]:
    """The registry's specs of the active tables, in file order, with the config's source, load type and watermark column.

    A table the registry doesn't know, or an incremental one without a watermark column, is an error.
    The target path is kept in ``extra``: the folder the table lands in, below the layout's root.
    """
    specs = []
    for row in active_tables(config):
        name = row["table_name"]
        if name not in registry:
            raise ValueError(f"config names an unknown table: {name!r}")
        if row["load_type"] == INCREMENTAL and not row["watermark_col"]:
            raise ValueError(f"incremental table {name!r} needs a watermark column")
        specs.append(replace(registry[name], source=row["source"], load_type=row["load_type"],
                             watermark_col=row["watermark_col"], extra={"target_path": row["target_path"]}))
    return specs
