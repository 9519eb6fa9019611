"""Gold marts on the reference's seed data (initial load, no reviews)."""

import datetime as dt

import pytest

from conftest import rows
from seed import bronze
from tierline.operators import gold
from tierline.plans.silver import refine

AS_OF = dt.datetime(2025, 3, 28, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def silver(spark):
    return {name: refine(spark, name, None, df, AS_OF) for name, df in bronze(spark).items()}


def test_sales_summary(silver):
    out = gold.sales_summary(silver)
    got = {r["product_id"]: (r["total_units_sold"], r["total_sales"], r["unique_customers"])
           for r in out.collect()}
    assert got == {101: (1, 1000.0, 1), 102: (2, 40.0, 2), 111: (1, 150.0, 1), 113: (1, 200.0, 1),
                   115: (1, 35.0, 1), 116: (1, 450.0, 1), 118: (1, 60.0, 1), 119: (1, 120.0, 1),
                   120: (1, 75.0, 1)}
    assert sum(v[1] for v in got.values()) == 2130.0


def test_customer_engagement(silver):
    out = gold.customer_engagement(silver, dt.date(2025, 3, 28))
    got = {r["customer_id"]: (r["total_orders"], r["total_spent"], r["avg_order_value"])
           for r in out.collect()}
    assert len(got) == 10
    assert got[1] == (2, 1020.0, 510.0)
    for cid, value in zip(range(2, 10), (20, 150, 35, 60, 450, 200, 75, 120)):
        assert got[cid] == (1, float(value), float(value))
    assert got[10] == (1, None, None)


@pytest.mark.parametrize("strategy", ["eager", "naive"])
def test_product_performance(silver, strategy):
    out = gold.product_performance(silver, strategy=strategy).collect()
    assert len(out) == 21
    assert sum(1 for r in out if r["total_units_sold"] is not None) == 10
    assert sum(r["total_units_sold"] or 0 for r in out) == 11
    assert sum(r["total_revenue"] or 0 for r in out) == 3130.0
    tire = [r for r in out if r["product_id"] == 109]
    assert [(r["supplier_id"], r["supplier_name"]) for r in tire] == [(8, None)]
    assert all(r["avg_rating"] is None and r["total_reviews"] == 0 for r in out)


@pytest.mark.parametrize("strategy", ["eager", "naive"])
def test_supplier_analysis(silver, strategy):
    out = gold.supplier_analysis(silver, strategy=strategy)
    got = {r["supplier_id"]: (r["total_products_supplied"], r["total_units_sold"], r["total_revenue"])
           for r in out.collect()}
    assert got == {1: (2, 3, 1040.0), 2: (1, None, None), 3: (2, 1, 1000.0), 4: (1, None, None),
                   5: (1, None, None), 6: (1, None, None), 7: (1, None, None)}


def test_customer_reviews_summary(silver):
    out = gold.customer_reviews_summary(silver).collect()
    assert len(out) == 20
    assert all(r["avg_rating"] is None and r["total_reviews"] == 0 and r["positive_reviews"] == 0
               and r["negative_reviews"] == 0 for r in out)


def test_eager_equals_naive_on_seed(silver):
    a = gold.product_performance(silver, strategy="eager")
    b = gold.product_performance(silver, strategy="naive")
    assert rows(a) == rows(b)


def test_corrected_engagement_takes_the_latest_instant_of_mixed_encodings(spark):
    import datetime as dt

    from tierline.operators import gold
    from tierline.schemas import REGISTRY
    silver = {name: spark.createDataFrame([], REGISTRY[name].silver_schema()) for name in REGISTRY}
    customer = {"customer_id": 1, "name": "A", "is_active": True}
    silver["customers"] = spark.createDataFrame([customer], REGISTRY["customers"].silver_schema())
    silver["orders"] = spark.createDataFrame(
        [{"order_id": k, "customer_id": 1, "order_date": d, "is_active": True}
         for k, d in enumerate(["999999999999", "1743069600123", "2025-03-26T00:00:00.000Z"])], REGISTRY["orders"].silver_schema())
    row = gold.customer_engagement(silver, dt.date(2025, 3, 28), mode="corrected").collect()
    assert [(r["last_order_date"], r["days_since_last_order"], r["total_orders"]) for r in row] == [("1743069600123", 1, 3)]
