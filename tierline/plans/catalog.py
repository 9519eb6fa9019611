"""Marts as tables of Spark's catalog, which SQL clients read by name.

``create_table_if_absent`` is the reference's ``CREATE TABLE IF NOT EXISTS ... AS``: the
second run is a no-op that doesn't evaluate the query. A new table is
analysed, so that the planner knows its rows, sizes and column ranges.
``insert`` appends by an explicit list of columns.

A job that fails while it creates a table leaves files but no table; they are
removed before the next attempt, as they belong to no table of the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.plans.publish import delete_path


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def create_database(spark: SparkSession, name: str, location: str) -> None:
    """A database whose managed tables lie in ``location``; a no-op if it exists."""
    place = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} LOCATION '{place}'")


def _folder(spark: SparkSession, database: str, table: str) -> str:
    root = spark.catalog.getDatabase(_quoted(database)).locationUri
    return f"{root.rstrip('/')}/{table.lower()}"


def analyze(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {_quoted(database, table)} COMPUTE STATISTICS FOR ALL COLUMNS")


def create_table_if_absent(df: DataFrame, database: str, table: str) -> DataFrame:
    """The table by name; made from ``df`` if it isn't there."""
    spark, name = df.sparkSession, _quoted(database, table)
    if not spark.catalog.tableExists(name):
        delete_path(spark, _folder(spark, database, table))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet AS SELECT * FROM {{df}}", df=df)
        analyze(spark, database, table)
    return spark.table(name)


def insert(df: DataFrame, database: str, table: str, columns: list[str]) -> None:
    """``INSERT INTO table (columns) SELECT columns``; columns that aren't named get NULL. The statistics are taken anew."""
    names = ", ".join(_quoted(c) for c in columns)
    df.sparkSession.sql(f"INSERT INTO {_quoted(database, table)} ({names}) SELECT {names} FROM {{df}}", df=df)
    analyze(df.sparkSession, database, table)
