"""Silver tables: buckets a run doesn't touch stay, interrupted runs are repeated, refreshes survive a crash."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.plans import publish as P
from tierline.plans.publish import SilverTables, overwrite
from tierline.schemas import SCD2, TableSpec

from conftest import SF001, rows

SPEC = TableSpec("t", T.StructType([T.StructField("k", T.LongType()), T.StructField("attr", T.StringType())]),
                 keys=("k",), tracked=("attr",), silver_policy=SCD2, dedup=True)
DAY1 = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
DAY2 = dt.datetime(2025, 1, 2, tzinfo=dt.timezone.utc)
COLUMNS = ("k", "attr", "is_active")


def batch(spark, data):
    return spark.createDataFrame(data, SPEC.schema)


def merge(spark, store, data, run, as_of, **kwargs):
    return store.merge("t", batch(spark, data), run, SPEC, as_of, **kwargs)


def files(root):
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_ino
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_runs_without_closed_versions_and_with_changes(spark, workdir):
    store = SilverTables(spark, workdir)
    assert store.read("t", SPEC) is None
    first = merge(spark, store, [(1, "a"), (2, "b"), (None, "n")], "run1", DAY1)
    assert rows(first, *COLUMNS) == [(1, "a", True), (2, "b", True), (None, "n", True)]
    assert not os.path.exists(f"{workdir}/t/is_active=false")           # nothing closed
    second = merge(spark, store, [(1, "a2"), (3, "c"), (None, "n")], "run2", DAY2)
    assert rows(second, *COLUMNS) == [(1, "a", False), (1, "a2", True), (2, "b", True), (3, "c", True), (None, "n", True), (None, "n", True)]
    assert store.runs("t") == ["run1", "run2"] and os.listdir(f"{workdir}/t/_merge") == []
    assert os.listdir(f"{workdir}/t/is_active=false") == ["slot=rrun2"]
    again = merge(spark, store, [(1, "zz")], "run2", DAY2)              # a run already taken in
    assert rows(again, *COLUMNS) == rows(second, *COLUMNS)


def test_a_run_reads_and_replaces_only_the_buckets_it_touches(spark, workdir):
    store = SilverTables(spark, workdir)
    merge(spark, store, [(k, "a") for k in range(2000)] + [(None, "n")], "run1", DAY1, buckets=50)
    before = files(f"{workdir}/t")
    slots = {r.k: r.slot for r in store._slots("t", SPEC).where("k is not null").collect()}
    merge(spark, store, [(7, "b"), (5000, "new"), (None, "m")], "run2", DAY2, buckets=99)    # a table keeps its buckets
    after = files(f"{workdir}/t")
    slots |= {r.k: r.slot for r in store._slots("t", SPEC).where("k = 5000").collect()}
    touched = {f"is_active=true/slot={slots[7]}", f"is_active=true/slot={slots[5000]}"}
    assert {os.path.dirname(f) for f in before if after.get(f) != before[f]} <= touched and store.buckets("t") == 50
    assert {os.path.dirname(f) for f in after if f not in before} == touched | {"is_active=false/slot=rrun2", "is_active=true/slot=nrun2"}
    live = store.read("t", SPEC).where("is_active")
    assert live.count() == 2003 and rows(live.where("k in (7, 5000)"), *COLUMNS) == [(5000, "new", True), (7, "b", True)]
    # the merge of a run scans a fraction of the live rows
    target = store._slots("t", SPEC).where(F.col("is_active") & F.col("slot").isin([slots[7]]))
    assert 0 < target.count() < 2003 / 10 and target.select(F.input_file_name()).distinct().count() == 1
    assert "slot" in target._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_a_failed_run_leaves_the_table_and_is_repeated(spark, workdir):
    store = SilverTables(spark, workdir)
    merge(spark, store, [(1, "a"), (2, "b")], "run1", DAY1)
    before = files(f"{workdir}/t")
    with pytest.raises(Exception, match="several batch rows"):
        merge(spark, store, [(1, "x"), (1, "y"), (2, "z")], "run2", DAY2)
    assert {f: i for f, i in files(f"{workdir}/t").items() if f[0] != "_"} == before and store.runs("t") == ["run1"]
    got = merge(spark, store, [(1, "x"), (2, "z")], "run2", DAY2)
    assert rows(got, *COLUMNS) == [(1, "a", False), (1, "x", True), (2, "b", False), (2, "z", True)]


@pytest.mark.parametrize("replaced", [0, 1, 2])
def test_a_run_interrupted_while_buckets_are_replaced_is_finished(spark, workdir, monkeypatch, replaced):
    """A crash after some buckets, with one of them deleted, then another run: the first one is finished before."""
    store = SilverTables(spark, workdir)
    merge(spark, store, [(1, "a"), (2, "b"), (None, "n")], "run1", DAY1)
    monkeypatch.setattr(SilverTables, "finish", lambda self, table, spec: None)
    merge(spark, store, [(1, "a2"), (2, "b2"), (None, "n")], "run3", DAY2)      # merged, not yet put in place
    monkeypatch.undo()
    written = f"{workdir}/t/_merge/run3"
    assert rows(store.read("t", SPEC), *COLUMNS) == [(1, "a", True), (2, "b", True), (None, "n", True)] and store.runs("t") == ["run1"]
    for slot in sorted(os.listdir(f"{written}/is_active=true"))[:replaced]:
        P.delete_path(spark, f"{workdir}/t/is_active=true/{slot}")
    late = merge(spark, store, [(3, "late"), (2, "b2")], "run2", DAY2)
    assert rows(late, *COLUMNS) == [(1, "a", False), (1, "a2", True), (2, "b", False), (2, "b2", True), (3, "late", True), (None, "n", True), (None, "n", True)]
    assert store.runs("t") == ["run1", "run2", "run3"] and not os.path.exists(written)


def test_an_interrupted_first_load_is_repeated(spark, workdir):
    store = SilverTables(spark, workdir)
    os.makedirs(f"{workdir}/t/is_active=true/slot=b00001-7")
    spark.range(3).selectExpr("id k", "'old' attr").write.mode("overwrite").parquet(f"{workdir}/t/is_active=true/slot=b00001-7")
    assert store.read("t", SPEC) is None
    assert rows(merge(spark, store, [(1, "a")], "run1", DAY1), *COLUMNS) == [(1, "a", True)]


def test_a_refresh_interrupted_between_its_renames_is_undone(spark, workdir):
    path = f"{workdir}/mart"
    overwrite(spark.range(5), path)
    os.rename(path, f"{workdir}/_before-mart")          # the crash: the old folder is aside, the new one not in place
    assert P.create_if_absent(spark.range(9), path).count() == 5
    os.rename(path, f"{workdir}/_before-mart")
    with pytest.raises(Exception, match="boom"):
        overwrite(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5 and overwrite(spark.range(9), path).count() == 9


def test_buckets_follow_the_size_of_the_first_batch():
    assert P.buckets_for(0) == P.BUCKETS and P.buckets_for(1 << 40) == 4096


def test_buckets_of_the_retail_tables_follow_their_source(spark, workdir, monkeypatch):
    """A fixed number of buckets would make the tasks of a merge grow with the table."""
    from tierline.plans import retail as R
    monkeypatch.setattr(R, "SOURCE_BUCKET_BYTES", 4096)
    store = SilverTables(spark, workdir)
    live = R.silver_table(spark, SF001, "order_items", store).where("is_active")
    assert store.buckets("order_items") > P.BUCKETS
    slots = [d for d in os.listdir(f"{workdir}/order_items/is_active=true") if d.startswith("slot=b")]
    assert all(len([f for f in os.listdir(f"{workdir}/order_items/is_active=true/{d}") if f.endswith(".parquet")]) == 1 for d in slots)
    assert live.groupBy("order_item_id").count().where("count > 1").count() == 0


@pytest.mark.parametrize("derive_once", [True, False])
def test_a_key_twice_in_a_batch_is_merged_as_distinct_rows(spark, workdir, derive_once):
    store = SilverTables(spark, workdir)
    merge(spark, store, [(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n")], "run1", DAY1)
    got = merge(spark, store, [(1, "a2"), (1, "a2"), (3, "c"), (3, "d"), (None, "n"), (None, "n")], "run2", DAY2, derive_once=derive_once)
    assert rows(got, *COLUMNS) == [(1, "a", False), (1, "a2", True), (2, "b", True), (3, "c", True), (3, "d", True), (None, "n", True), (None, "n", True)]
    assert os.listdir(f"{workdir}/t/_merge") == [] and not os.path.exists(f"{workdir}/t/_try")


def _above(plan, found):
    """The operators above each scan of a plan whose line has ``found``: lines of less indentation."""
    lines, out = plan.splitlines(), []
    for at in (i for i, line in enumerate(lines) if "FileScan" in line and found in line):
        depth, names = len(re.match(r"[ :+-]*", lines[at]).group()), []
        for line in reversed(lines[:at]):
            if (d := len(re.match(r"[ :+-]*", line).group())) < depth:
                depth, names = d, [*names, line]
        out.append(names)
    return out


def test_live_rows_and_aggregated_batches_are_not_exchanged_again(spark, workdir, monkeypatch):
    """The live rows of a bucket meet the batch where they lie; a batch aggregated by its key is exchanged for that only."""
    store, plans, write = SilverTables(spark, f"{workdir}/silver"), [], SilverTables._write

    def recorded(self, merged, run, spec, buckets, path):
        with P.setting(spark, "spark.sql.shuffle.partitions", buckets), P.setting(spark, "spark.sql.adaptive.enabled", "false"):
            plans.append(merged._jdf.queryExecution().executedPlan().toString())
        write(self, merged, run, spec, buckets, path)

    monkeypatch.setattr(SilverTables, "_write", recorded)
    spark.range(300).selectExpr("if(id % 50 = 0, null, id % 120) k", "cast(id % 3 as string) attr").write.parquet(f"{workdir}/source")
    source = spark.read.parquet(f"{workdir}/source")
    for number, day in ((1, DAY1), (2, DAY2)):
        grouped = source.where(f"{number} = 2 or k < 100 or k is null").groupBy("k").agg(F.max(F.col("attr") * number).cast("string").alias("attr"))
        got = store.merge("t", grouped, f"run{number}", SPEC, day, buckets=12, derive_once=False, batch_keys=source.select("k"))
    for plan in plans:
        keyed = [names for names in _above(plan, "source") if any("Union" in n for n in names)]
        assert keyed and all(sum("Exchange" in n for n in names) <= 1 for names in keyed)
    live = _above(plans[1], "Bucketed: true")
    assert any("Window" in n for names in live for n in names) and not any("Exchange" in n for names in live for n in names)
    want = {k: max(i % 3 for i in range(300) if i % 50 and i % 120 == k) for k in range(120) if any(i % 50 and i % 120 == k for i in range(300))}
    null = max(i % 3 for i in range(0, 300, 50))
    expected = [(k, str(v), v == 0) for k, v in want.items() if k < 100] + [(k, str(2 * v), True) for k, v in want.items() if k >= 100 or v] \
        + [(None, str(null), True), (None, str(2 * null), True)]
    assert rows(got, *COLUMNS) == sorted(expected, key=repr)


def test_buckets_of_an_earlier_version_are_refused(spark, workdir):
    """They hashed keys otherwise: a run would look for live rows in the wrong ones."""
    store = SilverTables(spark, workdir)
    merge(spark, store, [(1, "a")], "run1", DAY1)
    slot = next(d for d in os.listdir(f"{workdir}/t/is_active=true") if d.startswith("slot=b"))
    os.rename(f"{workdir}/t/is_active=true/{slot}", f"{workdir}/t/is_active=true/{slot.replace('-h', '-')}")
    with pytest.raises(ValueError, match="earlier version"):
        merge(spark, store, [(1, "b")], "run2", DAY2)


def test_a_slot_is_named_after_its_bucket(spark):
    slots = spark.createDataFrame([(0,), (99999,), (None,)], "b int").select(P.slot_name(F.col("b"), 100000)).collect()
    assert [s[0] for s in slots] == ["b00000-h100000", "b99999-h100000", None] and P.buckets_for(1 << 60) == 100000
