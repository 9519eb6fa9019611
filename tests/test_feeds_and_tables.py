"""JSON arrays read by many tasks, merged distinct sketches, tables of the catalog."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tierline.operators import sketches
from tierline.plans import catalog
from tierline.sources.json_array import fragments, read_json_array

SCHEMA = "id long, text string, more struct<a: long, tags: array<struct<t: string>>>"
HOSTILE = ['', '}', '{', '}{', '"', '\\', '\\"', '\\\\"}', '[{"id": 1}]', 'a\n},\n{', 'ü}€"', ']', ',']


def records(n, seed=1):
    rng = random.Random(seed)
    def text():
        return "".join(rng.choice(HOSTILE) + "x" * rng.randrange(20) for _ in range(rng.randrange(6)))
    return [{"id": i, "text": rng.choice([None, text()]),
             "more": rng.choice([None, {"a": i, "tags": [{"t": text()} for _ in range(rng.randrange(3))]}])} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_over_several_tasks(spark, workdir, indent):
    path = f"{workdir}/one.json"
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(records(3000), fh, indent=indent, ensure_ascii=False)
    schema = spark.createDataFrame([], SCHEMA).schema
    want = rows(spark.read.option("multiLine", True).schema(schema).json(path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    try:
        assert fragments(spark, path).select("block").distinct().count() > 8
        assert rows(read_json_array(spark, path, schema)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(want) == 3000


def test_several_empty_and_broken_arrays(spark, workdir):
    schema = spark.createDataFrame([], "id long").schema
    for name, text in (("a", "[]"), ("b", ' [ {"id": 1} ,\n{"id": null}, {"id": 1}]\n'), ("c", ""), ("d", '[{}]')):
        with open(f"{workdir}/{name}.json", "w") as fh:
            fh.write(text)
    assert rows(read_json_array(spark, f"{workdir}/*.json", schema)) == sorted([(1,), (None,), (1,), (None,)], key=repr)
    for name, text in (("cut", '[{"id": 1}, {"id": 2'), ("open", '[{"id": 1}'),  ("in-string", '[{"id": "}'), ("scalar", '[3, {"id": 1}]'), ("type", '[{"id": {"x": 1}}]')):
        with open(f"{workdir}/{name}.broken", "w") as fh:
            fh.write(text)
        with pytest.raises(Exception):
            read_json_array(spark, f"{workdir}/{name}.broken", schema).collect()


def test_merged_sketches_count_like_one(spark, workdir):
    path = f"{workdir}/sketches"
    df = spark.range(60000).select((F.col("id") % 20011).alias("who"), F.date_add(F.lit("2025-01-30"), (F.col("id") % 5).cast("int")).alias("day"),
                                   F.when(F.col("id") % 3 > 0, "b").otherwise("a").alias("kind"))
    for date, part in (("2025-02-01", "id < 30000"), ("2025-02-02", "id >= 20000"), ("2025-02-02", "id >= 20000")):
        load = spark.range(60000).where(part).select((F.col("id") % 20011).alias("who"), F.date_add(F.lit("2025-01-30"), (F.col("id") % 5).cast("int")).alias("day"),
                                                     F.when(F.col("id") % 3 > 0, "b").otherwise("a").alias("kind"))
        sketches.store(sketches.daily(load, F.col("day"), F.col("who"), {"kind": F.col("kind")}), path, date)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 * 5 * 2                       # the repeated load replaced its own
    exact = {r["kind"]: r["n"] for r in df.groupBy("kind").agg(F.count_distinct("who").alias("n")).collect()}
    found = {r["kind"]: r["estimate"] for r in sketches.merged(stored, {"kind": F.col("kind")}).collect()}
    assert found.keys() == exact.keys()
    assert all(abs(found[k] / exact[k] - 1) < 5 * sketches.STANDARD_ERROR for k in exact)
    nothing = spark.createDataFrame([(None, None)], "who long, day date")
    assert sketches.merged(sketches.daily(nothing, F.col("day"), F.col("who")), {}).first()["estimate"] == 0


def test_catalog_table_is_made_once_and_analysed(spark, workdir):
    catalog.create_database(spark, "shelf", f"{workdir}/shelf")
    catalog.create_database(spark, "shelf", f"{workdir}/elsewhere")
    bad = spark.range(3).select(F.raise_error(F.concat(F.lit("row "), F.col("id").cast("string"))).cast("int").alias("id"))
    with pytest.raises(Exception):
        catalog.create_table_if_absent(bad, "shelf", "Things")
    assert not spark.catalog.tableExists("shelf.Things")
    df = spark.range(10).select("id", F.col("id").cast("string").alias("the name"))
    assert catalog.create_table_if_absent(df, "shelf", "Things").count() == 10
    assert catalog.create_table_if_absent(bad, "shelf", "Things").count() == 10      # not evaluated
    catalog.insert(spark.createDataFrame([("x", 77)], "`the name` string, id long"), "shelf", "Things", ["the name", "id"])
    catalog.insert(spark.createDataFrame([(78,)], "id long"), "shelf", "Things", ["id"])
    assert rows(spark.sql("SELECT * FROM shelf.things WHERE id > 8")) == [(77, "x"), (78, None), (9, "9")]
    stats = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED shelf.Things").collect()}
    assert "12 rows" in stats["Statistics"]
    before = spark.conf.get("spark.sql.cbo.enabled")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:      # the range of the column tells the planner that nothing is left
        sizes = [spark.table("shelf.Things").where(c)._jdf.queryExecution().optimizedPlan().stats().rowCount().get() for c in ("id >= 0", "id > 1000")]
    finally:
        spark.conf.set("spark.sql.cbo.enabled", before)
    assert sizes == [12, 0]
    spark.sql("DROP DATABASE shelf CASCADE")
