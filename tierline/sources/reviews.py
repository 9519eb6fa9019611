"""Review feed: a JSON array of review records -> dated Parquet landing.

The reference fetches the array over HTTP into pandas on one machine. Here
the dumped payload (one or many JSON-array files, e.g. one per page) is
read by Spark directly, a large file by many tasks (``json_array``). The
landing file is ``customer_reviews_<yyyyMMdd>.parquet``, written by the
executors and replaced on a same-day rerun.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.watermark import observed
from tierline.plans.publish import overwrite
from tierline.schemas import CUSTOMER_REVIEWS, TableSpec
from tierline.sources.bronze import read_bronze_parquet
from tierline.sources.json_array import read_json_array

REVIEW_FILE_PREFIX = "customer_reviews_"


def read_review_feed(spark: SparkSession, path: str, spec: TableSpec = CUSTOMER_REVIEWS) -> DataFrame:
    """Records of JSON-array file(s) under ``path`` with the bronze schema."""
    raw = read_json_array(spark, path, spec.schema)
    return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def review_landing_path(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/customer_reviews/{REVIEW_FILE_PREFIX}{day.strftime('%Y%m%d')}.parquet"


def write_review_landing(df: DataFrame, root: str, day: dt.date) -> str:
    path = review_landing_path(root, day)
    overwrite(df, path)
    return path


def ingest_reviews(spark: SparkSession, feed: str, root: str, day: dt.date, spec: TableSpec = CUSTOMER_REVIEWS) -> tuple[str, int]:
    """Land the dumped feed as the day's review file; its path and number of rows, counted during the write."""
    df, stats = observed(read_review_feed(spark, feed, spec), None, name=f"reviews_{day.isoformat()}")
    path = write_review_landing(df, root, day)
    return path, int(stats.get["rows_loaded"])


def read_review_landing(spark: SparkSession, root: str, day: dt.date | None = None,
                        spec: TableSpec = CUSTOMER_REVIEWS) -> DataFrame:
    """Bronze reviews: one day's file, or every dated file (the external-table wildcard)."""
    if day is not None:
        return read_bronze_parquet(spark, review_landing_path(root, day), spec)
    return read_bronze_parquet(spark, f"{root.rstrip('/')}/customer_reviews/{REVIEW_FILE_PREFIX}*.parquet", spec)
