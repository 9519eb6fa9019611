"""End to end: JDBC (embedded in-memory Derby) -> landing -> bronze -> silver -> gold,
over two days, with audit watermarks, archive, idempotent reruns, late and empty runs."""

import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import functions as F

from seed import source
from tierline.operators.audit import read_audit
from tierline.plans.pipeline import LOAD_TIME, Layout, archive, ingest, ingest_config, refine_table, run_all, silver
from tierline.plans.publish import SilverTables, create_if_absent, overwrite
from tierline.schemas import REGISTRY
from tierline.sources.jdbc import JdbcSource, ParquetSource
from tierline.sources.landing import landed_runs

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
_ids = itertools.count()
DAY1 = dt.datetime(2025, 3, 28, 5, 0, tzinfo=dt.timezone.utc)
DAY2 = dt.datetime(2025, 3, 29, 5, 0, tzinfo=dt.timezone.utc)


def _write(df, url, schema, table):
    df.write.format("jdbc").option("url", url).option("driver", DRIVER) \
        .option("dbtable", f'"{schema}"."{table}"').mode("overwrite").save()


def _load_db(spark, url, tables):
    for name, df in tables.items():
        if name == "customer_reviews":
            continue
        _write(df, url, REGISTRY[name].source, name)


def _sources(url, reviews):
    return {"retailer": JdbcSource(url=url, driver=DRIVER, schema="retailer"),
            "supplier": JdbcSource(url=url, driver=DRIVER, schema="supplier"),
            "reviews": ParquetSource({"customer_reviews": lambda spark: reviews})}


def test_two_days_end_to_end(spark, workdir):
    url = f"jdbc:derby:memory:tl{next(_ids)};create=true"
    day1 = source(spark)
    _load_db(spark, url, day1)
    reviews = spark.createDataFrame(
        [("r1", 1, 101, 5, "great", DAY1), ("r2", 2, 102, 2, None, DAY1)],
        "id string, customer_id bigint, product_id bigint, rating bigint, review_text string, review_date timestamp")
    layout = Layout(workdir)
    out1 = run_all(spark, _sources(url, reviews), layout, DAY1)
    assert {r.table: r.rows_loaded for r in out1["runs"]}["orders"] == 10

    s1 = silver(spark, layout)
    assert s1["customers"].where("is_active").count() == 10
    gold1 = {r["product_id"]: r for r in out1["gold"]["customer_reviews_summary"].collect()}
    assert gold1[101]["positive_reviews"] == 1 and gold1[102]["negative_reviews"] == 1

    # day 2: customer 1 renamed, a new order with one line, supplier 8 link repriced
    ts2 = F.lit(DAY2).cast("timestamp")
    customers = day1["customers"].withColumn(
        "name", F.when(F.col("customer_id") == 1, F.lit("John Q. Doe")).otherwise(F.col("name"))) \
        .withColumn("updated_at", F.when(F.col("customer_id") == 1, ts2).otherwise(F.col("updated_at")))
    orders = day1["orders"].unionByName(spark.createDataFrame(
        [(1011, 3, DAY2, 40.0, DAY2)], day1["orders"].schema))
    items = day1["order_items"].unionByName(spark.createDataFrame(
        [(11, 1011, 104, 2, 20.0, DAY2)], day1["order_items"].schema))
    links = day1["product_suppliers"].withColumn(
        "supply_price", F.when(F.col("supplier_id") == 8, F.lit(13.0)).otherwise(F.col("supply_price"))) \
        .withColumn("last_updated", F.when(F.col("supplier_id") == 8, ts2).otherwise(F.col("last_updated")))
    day2 = dict(day1, customers=customers, orders=orders, order_items=items, product_suppliers=links)
    _load_db(spark, url, day2)
    out2 = run_all(spark, _sources(url, reviews), layout, DAY2)
    loaded = {r.table: r.rows_loaded for r in out2["runs"]}
    # incremental tables only bring the rows past yesterday's mark
    assert loaded["orders"] == 1 and loaded["order_items"] == 1 and loaded["customers"] == 1
    assert loaded["product_suppliers"] == 1 and loaded["products"] == 20

    s2 = silver(spark, layout)
    cust = s2["customers"].where("customer_id = 1").collect()
    assert sorted((r["name"], r["is_active"]) for r in cust) == [("John Doe", False), ("John Q. Doe", True)]
    assert s2["orders"].count() == 11
    sales = {r["product_id"]: r["total_units_sold"] for r in out2["gold"]["sales_summary"].collect()}
    assert sales[104] == 2

    audit = read_audit(spark, layout.audit)
    marks = {r["table_name"]: r["m"] for r in audit.groupBy("table_name").agg(F.max("watermark").alias("m")).collect()}
    assert marks["orders"].replace(tzinfo=dt.timezone.utc) == DAY2
    # consumed runs were archived; landing keeps nothing silver still owes
    assert landed_runs(spark, layout.landing, "orders") == []
    assert len(landed_runs(spark, layout.archive, "orders")) == 2

    # a third day with no changes: incremental extracts are empty, silver unchanged
    out3 = run_all(spark, _sources(url, reviews), layout, DAY2 + dt.timedelta(days=1))
    assert {r.table: r.rows_loaded for r in out3["runs"]}["orders"] == 0
    assert silver(spark, layout)["customers"].count() == 11


def test_two_ingests_before_one_refine_lose_nothing(spark, workdir):
    url = f"jdbc:derby:memory:tl{next(_ids)};create=true"
    day1 = source(spark)
    _load_db(spark, url, day1)
    layout = Layout(workdir)
    spec = REGISTRY["orders"]
    ingest(spark, _sources(url, None), [spec], layout, DAY1)
    more = day1["orders"].unionByName(spark.createDataFrame([(1011, 3, DAY2, 40.0, DAY2)], day1["orders"].schema))
    _write(more, url, "retailer", "orders")
    ingest(spark, _sources(url, None), [spec], layout, DAY2)
    refine_table(spark, spec, layout, DAY2)
    store = SilverTables(spark, layout.silver)
    assert store.read("orders", spec).count() == 11


def _land(spark, layout, spec, df, when):
    from tierline.functions.time import run_metadata
    from tierline.sources.landing import write_landing
    meta = run_metadata(when)
    write_landing(df, layout.landing, spec.name, meta["run_id"], meta["load_date"])


def test_a_run_that_lands_late_is_refined_and_archived(spark, workdir):
    layout, spec = Layout(workdir), REGISTRY["orders"]
    orders = source(spark)["orders"]
    _land(spark, layout, spec, orders.where("order_id <> 1001"), DAY2)
    refine_table(spark, spec, layout, DAY2)
    _land(spark, layout, spec, orders.where("order_id = 1001"), DAY1)
    archive(spark, layout, ["orders"])
    assert len(landed_runs(spark, layout.landing, "orders")) == 1      # silver still owes the late run
    refine_table(spark, spec, layout, DAY2)
    store = SilverTables(spark, layout.silver)
    assert store.read("orders", spec).count() == orders.count()
    archive(spark, layout, ["orders"])
    assert landed_runs(spark, layout.landing, "orders") == []
    _land(spark, layout, spec, orders.limit(0), DAY2 + dt.timedelta(days=1))
    refine_table(spark, spec, layout, DAY2)
    assert store.read("orders", spec).count() == orders.count()


def test_an_empty_extract_does_not_replace_a_table(spark, workdir):
    layout, spec = Layout(workdir), REGISTRY["products"]
    products = source(spark)["products"]
    _land(spark, layout, spec, products, DAY1)
    refine_table(spark, spec, layout, DAY1)
    _land(spark, layout, spec, products.limit(0), DAY2)
    with pytest.raises(ValueError, match="empty batch"):
        refine_table(spark, spec, layout, DAY2)
    assert SilverTables(spark, layout.silver).read("products", spec).count() == products.count()


def test_a_failed_refresh_leaves_the_mart(spark, workdir):
    path = f"{workdir}/mart"
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    for write in (create_if_absent, overwrite):
        with pytest.raises(Exception, match="boom"):
            write(bad, path)
    assert create_if_absent(spark.range(5), path).count() == 5         # the failed job doesn't count as the table
    with pytest.raises(Exception, match="boom"):
        overwrite(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert create_if_absent(spark.range(9), path).count() == 5 and overwrite(spark.range(9), path).count() == 9


def test_a_failed_table_is_logged_whole_and_raised(spark, workdir):
    layout = Layout(workdir)

    class Broken:
        def __getattr__(self, name):
            raise RuntimeError("x" * 5000)

    with pytest.raises(RuntimeError):
        ingest(spark, {REGISTRY["orders"].source: Broken()}, [REGISTRY["orders"]], layout, DAY1)
    logged = spark.read.parquet(layout.logs).collect()
    assert len(logged) == 1 and "x" * 5000 in logged[0]["message"]


def test_keyset_mark_survives_the_archive(spark, workdir):
    url = f"jdbc:derby:memory:tl{next(_ids)};create=true"
    _load_db(spark, url, {"orders": source(spark)["orders"]})
    layout, spec = Layout(workdir), REGISTRY["orders"]
    assert ingest(spark, _sources(url, None), [spec], layout, DAY1, keyset_id="order_id")[0].rows_loaded == 10
    refine_table(spark, spec, layout, DAY1)
    archive(spark, layout, ["orders"])
    assert ingest(spark, _sources(url, None), [spec], layout, DAY2, keyset_id="order_id")[0].rows_loaded == 0


def test_keyset_mark_keeps_microseconds_and_ties(spark, workdir):
    at = dt.datetime(2025, 3, 1, 12, 0, 0, 123456)
    layout, spec = Layout(workdir), REGISTRY["customers"]

    def load(ids, now):
        rows = spark.createDataFrame([(i, "a", "a@x", at) for i in ids],
                                     "customer_id bigint, name string, email string, updated_at timestamp")
        sources = {"retailer": ParquetSource({"customers": lambda spark: rows})}
        return ingest(spark, sources, [spec], layout, now, keyset_id="customer_id")[0].rows_loaded
    assert load([1, 2], DAY1) == 2
    assert load([1, 2], DAY1 + dt.timedelta(hours=1)) == 0
    assert load([1, 2, 3], DAY2) == 1           # a tie at the mark
    assert load([1, 2, 3], DAY2 + dt.timedelta(hours=1)) == 0
    assert [r["last_id"] for r in read_audit(spark, layout.audit).orderBy("run_id").collect()] == ["2", None, "3", None]


@pytest.mark.parametrize("dialect", ["csv", "json"])
def test_ingest_from_a_config_with_one_failing_table(spark, workdir, dialect):
    tables = {k: (lambda spark, df=df: df) for k, df in source(spark).items() if k in ("categories", "customers", "orders")}
    layout = Layout(workdir)                    # products has no source table
    path = os.path.join(os.path.dirname(__file__), "fixtures", f"retailer_config.{dialect}")
    runs = ingest_config(spark, {"retailer": ParquetSource(tables)}, path, layout, DAY1, on_error="log")
    names = ["products", "categories", "customers"] + (["orders"] if dialect == "csv" else [])
    assert [r.table for r in runs] == names
    status = {r["tablename"]: r["status"] for r in spark.read.parquet(layout.status).collect()}
    assert status == {n: "FAILED" if n == "products" else "SUCCESS" for n in names}
    assert {r["table_name"] for r in read_audit(spark, layout.audit).collect()} == set(names) - {"products"}
    assert landed_runs(spark, f"{workdir}/landing/retailer-db", "customers") and not landed_runs(spark, layout.landing, "customers")    # the config's target path
    logged = spark.read.json(f"{layout.log_files}/pipeline_log_20250328050000.json").collect()
    assert sorted(r["event_type"] for r in logged) == ["ERROR"] + ["INFO"] * (len(names) - 1)


def test_wall_clock_mark(spark, workdir):
    rows = spark.createDataFrame(
        [(1, "a", "a@x", dt.datetime(2025, 3, 1)), (2, "b", "b@x", DAY1 + dt.timedelta(hours=1))],
        "customer_id bigint, name string, email string, updated_at timestamp")
    layout, sources = Layout(workdir), {"retailer": ParquetSource({"customers": lambda spark: rows.where("customer_id = 1")})}
    spec = REGISTRY["customers"]
    assert ingest(spark, sources, [spec], layout, DAY1, watermark_source=LOAD_TIME)[0].max_watermark == DAY1
    sources = {"retailer": ParquetSource({"customers": lambda spark: rows})}
    assert ingest(spark, sources, [spec], layout, DAY2, watermark_source=LOAD_TIME)[0].rows_loaded == 1
    with pytest.raises(ValueError):
        ingest(spark, sources, [spec], layout, DAY2, watermark_source="guess")
