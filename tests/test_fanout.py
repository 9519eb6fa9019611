"""Eager aggregation of the fan-out marts equals the naive joins, exactly,
on random small silver tables (including empty children, duplicate rows,
NULL keys and superseded versions)."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from tierline.operators import gold
from tierline.schemas import REGISTRY

T0 = dt.datetime(2025, 1, 1)
pid = st.one_of(st.none(), st.integers(1, 3))
sid = st.one_of(st.none(), st.integers(1, 3))


def silver_frames(spark, products, links, suppliers, lines, reviews):
    def mk(name, data):
        return spark.createDataFrame(data, REGISTRY[name].silver_schema())
    return {
        "products": mk("products", [(p, f"p{p}", c, 1.0, "0", q) for p, c, q in products]),
        "categories": mk("categories", [(1, "c1", "0", False), (2, None, "0", True)]),
        "product_suppliers": mk("product_suppliers", [(s, p, 1.0, "0", T0, T0, a) for s, p, a in links]),
        "suppliers": mk("suppliers", [(s, n, None, None, None, None, None, None, "0", q)
                                      for s, n, q in suppliers]),
        "order_items": mk("order_items", [(i, 1, p, q, pr, "0", T0, T0, True)
                                          for i, (p, q, pr) in enumerate(lines)]),
        "customer_reviews": mk("customer_reviews", [(f"r{i}", 1, p, r, t, "0", T0, T0, True)
                                                    for i, (p, r, t) in enumerate(reviews)]),
    }


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(pid, st.sampled_from([1, 2, None]), st.booleans()), min_size=1, max_size=4),
    st.lists(st.tuples(sid, pid, st.booleans()), max_size=5),
    st.lists(st.tuples(sid, st.sampled_from(["s", None]), st.booleans()), max_size=4),
    st.lists(st.tuples(pid, st.one_of(st.none(), st.integers(1, 5)),
                       st.one_of(st.none(), st.sampled_from([1.25, 10.5, 99.99]))), max_size=5),
    st.lists(st.tuples(pid, st.one_of(st.none(), st.integers(1, 5)), st.sampled_from(["ok", None])),
             max_size=5),
)
def test_eager_equals_naive(spark, products, links, suppliers, lines, reviews):
    silver = silver_frames(spark, products, links, suppliers, lines, reviews)
    assert rows(gold.product_performance(silver, strategy="eager")) == \
        rows(gold.product_performance(silver, strategy="naive"))
    assert rows(gold.supplier_analysis(silver, strategy="eager")) == \
        rows(gold.supplier_analysis(silver, strategy="naive"))


def test_the_literal_join_sums_longs_exactly(spark):
    """The rows of the fan-out add no wide decimals, and large, negative and absent values still come out exact."""
    lines = [(1, 2, 0.01), (1, 10 ** 12, 9999999999.99), (1, -3, 9999999999.99), (1, 7, None), (2, None, 1.5), (2, -10 ** 12, 12345678.91), (3, 4, -0.07)]
    reviews = [(1, 5, "ok"), (1, None, None), (2, 1, None)]
    silver = silver_frames(spark, [(k, 1, False) for k in (1, 2, 3, 4)], [(1, 1, True), (2, 1, True), (1, 2, True)], [(1, "s", False)], lines, reviews)
    naive = gold.product_performance(silver, strategy="naive")
    assert rows(naive) == rows(gold.product_performance(silver, strategy="eager"))
    sums = re.findall(r"partial_sum\((\w+)#\d+(L?)\)", naive._jdf.queryExecution().executedPlan().toString())
    assert len(sums) >= 5 and all(long or name in ("rating", "has_text") for name, long in sums)


def test_rows_of_the_fan_out_are_summed_by_two_longs(spark):
    """Not by six keys with names, nor exchanged with them again; products, suppliers and links that occur several times, with other or absent names, too."""
    products = [(1, "a", 1, 1.0, "0", False), (1, "b", 1, 1.0, "0", False), (1, "b", 1, 1.0, "0", False), (1, None, 2, 1.0, "0", False),
                (None, "n", 1, 1.0, "0", False), (None, "n", None, 1.0, "0", False), (2, "a", None, 1.0, "0", False), (3, "q", 1, 1.0, "0", True)]
    suppliers = [(1, "s"), (1, "t"), (1, None), (2, "s"), (None, "u")]
    lines = [(1, 2, 1.25), (1, None, 3.5), (1, 5, None), (2, 1, 9.99), (None, 4, 7.0)]
    silver = silver_frames(spark, [], [(1, 1, True), (1, 1, False), (2, 1, True), (None, 1, True), (2, 2, True), (1, None, True)], [(s, n, False) for s, n in suppliers],
                           lines, [(1, 4, "ok"), (1, None, None), (1, 2, None), (None, 5, "ok")])
    silver["products"] = spark.createDataFrame(products, REGISTRY["products"].silver_schema())
    naive = gold.product_performance(silver, strategy="naive")
    assert rows(naive) == rows(gold.product_performance(silver, strategy="eager")) and naive.count() == 18
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.product_performance(silver, strategy="naive")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"HashAggregate\(keys=\[([^]]*)\], functions=\[[^]]*partial_sum\(quantity", plan)
    assert keys and all(re.fullmatch(r"product_id#\d+L, key_number#\d+", k) for k in keys)
    # the sums and the values of the keys meet without an exchange
    lines = plan.splitlines()
    union = next(i for i, line in enumerate(lines) if re.search(r"\bUnion\b", line))
    assert not any("Exchange" in line for line in lines[:union])


def test_the_literal_join_of_suppliers_sums_longs_exactly(spark):
    lines = [(1, 2, 0.01), (1, 10 ** 12, 9999999999.99), (1, -3, 9999999999.99), (1, 7, None), (2, None, 1.5), (2, -10 ** 12, 12345678.91), (3, 4, None)]
    silver = silver_frames(spark, [], [(1, 1, True), (1, 1, False), (2, 2, True), (2, 1, True), (3, 3, True), (4, 9, True)],
                           [(s, "s", False) for s in (1, 2, 3, 4, 5)], lines, [])
    naive = gold.supplier_analysis(silver, strategy="naive")
    assert rows(naive) == rows(gold.supplier_analysis(silver, strategy="eager"))
    sums = re.findall(r"partial_sum\((\w+)#\d+(L?)\)", naive._jdf.queryExecution().executedPlan().toString())
    assert len(sums) >= 4 and all(long for _, long in sums)
