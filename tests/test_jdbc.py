"""JDBC extracts on embedded in-memory Derby: full, incremental, keyset, partitioned."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tierline.sources.jdbc import JdbcSource, extract, normalize_load_type, ranges

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
_ids = itertools.count()


@pytest.fixture()
def source(spark):
    url = f"jdbc:derby:memory:jdbc{next(_ids)};create=true"
    df = spark.createDataFrame(
        [(i, 100 + i, dt.datetime(2025, 3, 27) + dt.timedelta(hours=i // 3), float(i)) for i in range(1, 31)],
        "order_id bigint, customer_id bigint, updated_at timestamp, total_amount double")
    df.write.format("jdbc").option("url", url).option("driver", DRIVER) \
        .option("dbtable", '"retailer"."orders"').mode("overwrite").save()
    return JdbcSource(url=url, driver=DRIVER, schema="retailer")


def test_full(spark, source):
    assert extract(spark, source, "orders", "Full Load").count() == 30


def test_incremental_pushes_the_mark_into_the_query(spark, source):
    mark = dt.datetime(2025, 3, 27, 5, tzinfo=dt.timezone.utc)
    df = extract(spark, source, "orders", "incremental", "updated_at", mark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in plan
    # rows at hours 6..9 (ids 18..30); hour 5 (ids 15..17) is not after the mark
    assert sorted(r["order_id"] for r in df.collect()) == list(range(18, 31))


def test_keyset_keeps_ties_after_the_last_id(spark, source):
    mark = dt.datetime(2025, 3, 27, 5, tzinfo=dt.timezone.utc)
    df = extract(spark, source, "orders", "incremental", "updated_at", mark, keyset=("order_id", 15))
    assert sorted(r["order_id"] for r in df.collect()) == list(range(16, 31))


def test_partitioned_read(spark, source):
    df = extract(spark, source, "orders", "full", partition_column="order_id", num_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 30


def test_connections_share_the_increment(spark, source):
    mark = dt.datetime(2025, 3, 27, 5, tzinfo=dt.timezone.utc)
    df = extract(spark, source, "orders", "incremental", "updated_at", mark, partition_column="order_id", num_partitions=4)
    per = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per) == 13 and len(per) == 4 and max(r["count"] for r in per) <= 5
    late = dt.datetime(2025, 4, 27, tzinfo=dt.timezone.utc)
    assert extract(spark, source, "orders", "incremental", "updated_at", late, partition_column="order_id", num_partitions=4).count() == 0


def test_incremental_needs_a_watermark_column(spark, source):
    with pytest.raises(ValueError):
        extract(spark, source, "orders", "incremental", None, dt.datetime(2025, 1, 1))
    with pytest.raises(ValueError):
        normalize_load_type("sometimes")


def test_ranges_hold_every_row_once():
    assert ranges("k", []) == ["1 = 1"]
    assert ranges("k", [3, 7]) == ["k < 3 OR k IS NULL", "k >= 3 AND k < 7", "k >= 7"]
    assert ranges("k", [dt.datetime(2025, 1, 2, 3, 4, 5, 6), ])[1] == "k >= {ts '2025-01-02 03:04:05.000006'}"
    assert ranges("k", [dt.date(2025, 1, 2)])[1] == "k >= {d '2025-01-02'}"
    with pytest.raises(TypeError):
        ranges("k", ["'; x"])


def _skewed(spark, keys):
    url = f"jdbc:derby:memory:jdbc{next(_ids)};create=true"
    at = dt.datetime(2025, 3, 27)
    df = spark.createDataFrame([(k, n, at + dt.timedelta(minutes=n)) for n, k in enumerate(keys)], "k bigint, n bigint, updated_at timestamp")
    df.write.format("jdbc").option("url", url).option("driver", DRIVER).option("dbtable", '"retailer"."t"').mode("overwrite").save()
    return JdbcSource(url=url, driver=DRIVER, schema="retailer")


def _per_connection(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_equal_depth_shares_a_skewed_key(spark):
    src = _skewed(spark, [*range(1000), 10 ** 9, None])
    strided = extract(spark, src, "t", partition_column="k", num_partitions=4)
    assert _per_connection(strided) == [1, 1001]
    even = extract(spark, src, "t", partition_column="k", num_partitions=4, equal_depth=True)
    assert even.rdd.getNumPartitions() == 4 and len(_per_connection(even)) == 4 and max(_per_connection(even)) <= 260
    assert sorted(r["n"] for r in even.collect()) == list(range(1002))
    by_time = extract(spark, src, "t", partition_column="updated_at", num_partitions=4, equal_depth=True)
    assert max(_per_connection(by_time)) <= 260 and by_time.count() == 1002
    mark = dt.datetime(2025, 3, 27, 15, tzinfo=dt.timezone.utc)
    late = extract(spark, src, "t", "incremental", "updated_at", mark, partition_column="k", num_partitions=4, equal_depth=True)
    assert sorted(r["n"] for r in late.collect()) == list(range(901, 1002)) and max(_per_connection(late)) <= 30


def test_equal_depth_of_one_hot_value_and_of_nothing(spark):
    hot = extract(spark, _skewed(spark, [5] * 300 + list(range(10, 30))), "t", partition_column="k", num_partitions=4, equal_depth=True)
    assert hot.count() == 320
    none = extract(spark, _skewed(spark, [None, None]), "t", partition_column="k", num_partitions=4, equal_depth=True)
    assert none.count() == 2
    empty = _skewed(spark, [1])
    late = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    assert extract(spark, empty, "t", "incremental", "updated_at", late, partition_column="k", num_partitions=4, equal_depth=True).count() == 0
