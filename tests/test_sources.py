"""Config readers, landing encodings, bronze typing, review feed."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tierline.functions.time import epoch_ms_text, parse_event_ts
from tierline.schemas import CUSTOMER_REVIEWS, ORDERS, TableSpec, _schema
from tierline.sources.bronze import MALFORMED, PERMISSIVE, read_bronze_json
from tierline.sources.config import active_tables, read_config
from tierline.sources.landing import (EPOCH_MS, ISO, archive_runs, landed_runs, pending_runs,
                                      write_landing)
from tierline.sources.reviews import ingest_reviews, read_review_feed, read_review_landing, write_review_landing

HERE = os.path.dirname(__file__)


def test_config_csv(spark):
    cfg = read_config(spark, os.path.join(HERE, "fixtures", "retailer_config.csv"))
    active = active_tables(cfg)
    assert [t["table_name"] for t in active] == ["products", "categories", "customers", "orders"]
    assert [t["load_type"] for t in active] == ["full", "full", "incremental", "incremental"]
    assert active[0]["watermark_col"] is None and active[2]["watermark_col"] == "updated_at"


def test_config_json(spark):
    cfg = read_config(spark, os.path.join(HERE, "fixtures", "retailer_config.json"))
    active = active_tables(cfg)
    assert [t["table_name"] for t in active] == ["products", "categories", "customers"]
    assert active[2]["load_type"] == "incremental" and active[2]["source"] == "retailer"


def test_config_rejects_unknown_load_type(spark, workdir):
    path = os.path.join(workdir, "bad.csv")
    with open(path, "w") as fh:
        fh.write("database,datasource,tablename,loadtype,watermark,is_active,targetpath\n"
                 "r,d,orders,Sometimes,updated_at,1,x\n")
    with pytest.raises(Exception, match="unknown load type"):
        active_tables(read_config(spark, path))


def _orders_source(spark):
    rows = [(1, 10, dt.datetime(2025, 3, 27, 10, 0, 0, 123000), 12.5, dt.datetime(2025, 3, 27, 10, 0, 0, 123000)),
            (2, None, dt.datetime(2025, 3, 28), 7.25, dt.datetime(2025, 3, 28))]
    return spark.createDataFrame(rows, "order_id bigint, customer_id bigint, order_date timestamp, "
                                       "total_amount double, updated_at timestamp")


@pytest.mark.parametrize("encoding", [ISO, EPOCH_MS])
def test_landing_roundtrip_both_encodings(spark, workdir, encoding):
    write_landing(_orders_source(spark), workdir, "orders", "20250327T100000Z", "2025-03-27", encoding)
    bronze = read_bronze_json(spark, f"{workdir}/orders", ORDERS)
    got = {r["order_id"]: r for r in bronze.withColumn("ms", epoch_ms_text(parse_event_ts("order_date"))).collect()}
    assert got[1]["ms"] == "1743069600123" and got[1]["total_amount"] == 12.5
    assert got[2]["customer_id"] is None
    if encoding == EPOCH_MS:
        assert got[1]["order_date"] == "1743069600123"
    else:
        assert got[1]["order_date"] == "2025-03-27T10:00:00.123Z"


def test_nullable_integer_written_as_float_is_read(spark, workdir):
    path = os.path.join(workdir, "orders", "load_date=2025-03-27", "run_id=r1")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as fh:
        fh.write(json.dumps({"order_id": 1.0, "customer_id": 5.0, "order_date": 1743069600123,
                             "total_amount": 12.5, "updated_at": 1743069600123}) + "\n")
    r = read_bronze_json(spark, os.path.join(workdir, "orders"), ORDERS).first()
    assert (r["order_id"], r["customer_id"], r["order_date"]) == (1, 5, "1743069600123")


def test_malformed_integer_fails_or_is_flagged(spark, workdir):
    path = os.path.join(workdir, "orders", "load_date=2025-03-27", "run_id=r1")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as fh:
        fh.write(json.dumps({"order_id": "x", "customer_id": 5}) + "\n")
    with pytest.raises(Exception, match="malformed order_id"):
        read_bronze_json(spark, os.path.join(workdir, "orders"), ORDERS).collect()
    r = read_bronze_json(spark, os.path.join(workdir, "orders"), ORDERS, mode=PERMISSIVE).first()
    assert r["order_id"] is None and r[MALFORMED] is True


def test_missing_landing_is_an_empty_batch(spark, workdir):
    df = read_bronze_json(spark, os.path.join(workdir, "nothing"), ORDERS)
    assert df.count() == 0 and df.columns == ORDERS.columns


def test_runs_pending_and_archive(spark, workdir):
    src = _orders_source(spark)
    for run, day in (("20250327T050000Z", "2025-03-27"), ("20250328T050000Z", "2025-03-28")):
        write_landing(src, workdir, "orders", run, day)
    assert [r for _, r in landed_runs(spark, workdir, "orders")] == ["20250327T050000Z", "20250328T050000Z"]
    assert pending_runs(spark, workdir, "orders", {"20250327T050000Z"}) == ["20250328T050000Z"]
    only = read_bronze_json(spark, f"{workdir}/orders", ORDERS, runs=["20250328T050000Z"])
    assert only.count() == 2
    # a retried run replaces its own partition instead of duplicating it
    write_landing(src, workdir, "orders", "20250328T050000Z", "2025-03-28")
    assert read_bronze_json(spark, f"{workdir}/orders", ORDERS).count() == 4
    moved = archive_runs(spark, workdir, f"{workdir}/archive", "orders", keep=["20250328T050000Z"])
    assert moved == ["20250327T050000Z"]
    assert [r for _, r in landed_runs(spark, workdir, "orders")] == ["20250328T050000Z"]
    assert [r for _, r in landed_runs(spark, f"{workdir}/archive", "orders")] == ["20250327T050000Z"]


def test_review_feed_to_dated_parquet(spark, workdir):
    feed = os.path.join(workdir, "feed.json")
    with open(feed, "w") as fh:
        json.dump([{"id": "1", "customer_id": 3, "product_id": 101, "rating": 5, "review_text": "great",
                    "review_date": "2025-03-27T10:00:00Z"},
                   {"id": "2", "customer_id": 4, "product_id": 102, "rating": 2, "review_text": None,
                    "review_date": "2025-03-27T11:00:00Z"}], fh)
    df = read_review_feed(spark, feed)
    path = write_review_landing(df, workdir, dt.date(2025, 3, 27))
    assert path.endswith("customer_reviews/customer_reviews_20250327.parquet")
    back = read_review_landing(spark, workdir)
    assert sorted(r["id"] for r in back.collect()) == ["1", "2"]
    assert back.columns == CUSTOMER_REVIEWS.columns
    assert ingest_reviews(spark, feed, workdir, dt.date(2025, 3, 27)) == (path, 2)
    assert read_review_landing(spark, workdir).count() == 2


def test_parse_event_ts_both_encodings(spark):
    df = spark.createDataFrame([("1743069600123",), ("2025-03-27T10:00:00.123Z",), (None,)], "t string")
    out = [r[0] for r in df.select(epoch_ms_text(parse_event_ts("t"))).collect()]
    assert out == ["1743069600123", "1743069600123", None]
    bad = spark.createDataFrame([("garbage",)], "t string")
    assert bad.select(parse_event_ts("t", strict=False)).first()[0] is None


def test_daily_landing_names_rerun_archive_and_landing_date(spark, workdir):
    from tierline.sources.bronze import read_bronze_daily
    from tierline.sources.landing import (archive_daily, archived_daily_glob, daily_objects,
                                          write_daily_landing)
    landing, archive = f"{workdir}/landing", f"{workdir}/archive"
    assert read_bronze_daily(spark, landing, ORDERS).count() == 0          # nothing landed yet
    assert "landing_date" in read_bronze_daily(spark, landing, ORDERS).columns

    def day_rows(n, amount):
        return spark.createDataFrame(
            [(i, 7, dt.datetime(2025, 3, 27, 10), amount, dt.datetime(2025, 3, 27, 10)) for i in range(n)],
            "order_id bigint, customer_id bigint, order_date timestamp, total_amount double, updated_at timestamp")

    d1, d2 = dt.date(2025, 3, 27), dt.date(2025, 3, 28)
    write_daily_landing(day_rows(3, 1.0), landing, "orders", d1)
    write_daily_landing(day_rows(2, 2.0), landing, "orders", d1)           # same-day rerun replaces
    assert daily_objects(spark, landing, "orders") == [(d1, "orders_27032025.json")]
    assert archive_daily(spark, landing, archive, "orders", keep=d2) == [d1]
    assert os.path.isdir(f"{archive}/orders/2025/03/27/orders_27032025.json")
    write_daily_landing(day_rows(4, 3.0), landing, "orders", d2)
    bronze = read_bronze_daily(spark, landing, ORDERS).unionByName(
        read_bronze_daily(spark, archived_daily_glob(archive, "orders"), ORDERS))
    got = sorted((r["landing_date"], r["total_amount"], r["order_date"]) for r in
                 bronze.groupBy("landing_date", "total_amount", "order_date").count().collect())
    assert got == [(d1, 2.0, "1743069600000"), (d2, 3.0, "1743069600000")]
    assert bronze.count() == 6


def test_permissive_bronze_flags_lines_that_are_not_json_and_long_integers(spark, workdir):
    folder = f"{workdir}/orders/load_date=2025-03-27/run_id=20250327T050000Z"
    os.makedirs(folder)
    with open(f"{folder}/part-0.json", "w") as f:
        f.write('{"order_id": 1, "customer_id": 2}\nnot json\n{"order_id": 123456789012345678901234, "customer_id": 2}\n')
    got = read_bronze_json(spark, f"{workdir}/orders", ORDERS, mode=PERMISSIVE).collect()
    assert sorted((str(r["order_id"]), r["_malformed"]) for r in got) == [("1", False), ("None", True), ("None", True)]


def test_landed_lines_are_compressed_and_files_bounded(spark, workdir, monkeypatch):
    from tierline.sources import landing
    monkeypatch.setattr(landing, "MAX_FILE_ROWS", 1000)
    df = spark.range(2500).selectExpr("id order_id", "id customer_id", "timestamp'2025-03-27 10:00:00' order_date", "1.5D total_amount", "timestamp'2025-03-27 10:00:00' updated_at")
    plain = df.coalesce(1).selectExpr("sum(length(to_json(struct(*)))) n").first()["n"]
    path = write_landing(df.coalesce(1), workdir, "orders", "r1", "2025-03-27")
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(found) == 3 and sum(map(os.path.getsize, found)) < plain / 4
    assert read_bronze_json(spark, path, ORDERS).count() == 2500
