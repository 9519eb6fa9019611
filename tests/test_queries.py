"""Registered queries against their DuckDB oracles (the driver's check, on sf0.001)."""

import os
import sys

import duckdb
import pytest

from conftest import SF001

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from tools.check_oracle import TABLES, digest  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.exists(SF001), reason="driver test data not present")

FAST = ["sales_summary", "customer_engagement", "product_performance", "supplier_analysis",
        "customer_reviews_summary", "silver_customers", "silver_order_items",
        "silver_product_suppliers", "silver_products", "bronze_roundtrip_json", "bronze_roundtrip_iso",
        "bronze_roundtrip_order_items", "bronze_roundtrip_product_suppliers", "bronze_roundtrip_suppliers",
        "bronze_roundtrip_customers", "bronze_roundtrip_categories", "bronze_roundtrip_products",
        "bronze_roundtrip_parquet", "bronze_roundtrip_daily", "review_feed", "distinct_sketches", "mart_table", "incremental_extract", "keyset_extract",
        "batch_stats",
        "latest_watermark", "audit_roundtrip", "paged_ingest", "quarantine_report"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF001}/{t}.parquet"
        if os.path.exists(path):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_an_oracle():
    from tierline.plans import queries as Q
    assert set(Q.QUERIES) == set(Q.oracles()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_date", "category_id", "category_name", "product_id", "product_name",
                          "total_units_sold", "total_sales", "unique_customers"]
    assert df.count() > 0


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert digest(srows, df.columns)[0] == digest(orows, rel.columns)[0]
