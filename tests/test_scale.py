"""Scale helpers: plain scans at every size and data-sized shuffle partitions."""

from pyspark.sql import functions as F

from tierline.session import (input_bytes, shuffle_partitions_for,
                              size_shuffle_partitions)
from tierline.sources import retail

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_scan_is_the_table_and_filters_reach_it(spark):
    df = retail.read_table(spark, SF001, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    plan = _plan(df)
    assert "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity" in plan


def test_shuffle_sizing_respects_explicit_setting(spark):
    # the test session sets spark.sql.shuffle.partitions explicitly: it wins
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffle_partitions(spark, 100 * 2**40) == int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_input_bytes_reads_metadata_only(spark, workdir):
    spark.range(100).write.parquet(f"{workdir}/t")
    assert input_bytes(spark, [f"{workdir}/t", f"{workdir}/absent"]) > 0


def test_shuffle_partitions_follow_input_size():
    mb = 2**20
    assert shuffle_partitions_for(38 * mb, 8, 128 * mb) == 16              # floor: two per core
    assert shuffle_partitions_for(10 * 2**30, 8, 128 * mb) == 80           # one per 128 MB
    assert shuffle_partitions_for(100 * 2**40, 8000, 128 * mb) == 819_200
