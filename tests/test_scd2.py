"""SCD2 merge: the case table of the two-MERGE semantics, options, and a
property test against DuckDB's own MERGE statements."""

import datetime as dt
import random
import re

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import scd2
from tierline.operators.scd2 import scd2_merge
from tierline.schemas import SCD2, TableSpec

AS_OF = dt.datetime(2025, 1, 2, tzinfo=dt.timezone.utc)
T0 = dt.datetime(2025, 1, 1)

SPEC = TableSpec("t", T.StructType([T.StructField("k", T.LongType()), T.StructField("attr", T.StringType()),
                                    T.StructField("upd", T.LongType())]),
                 keys=("k",), tracked=("attr", "upd"), silver_policy=SCD2, dedup=True)


def target_df(spark, rows):
    data = [(k, a, u, T0, T0, act) for k, a, u, act in rows]
    return spark.createDataFrame(data, SPEC.silver_schema())


def batch_df(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema)


def result(res):
    out = []
    for r in res.all_versions().collect():
        start = "old" if r["effective_start_date"].year == 2025 and r["effective_start_date"].day == 1 else "new"
        end = "old" if r["effective_end_date"].day == 1 else "new"
        out.append((r["k"], r["attr"], r["upd"], r["is_active"], start, end))
    return sorted(out, key=repr)


TARGET = [(1, "x", 1, True), (2, "y", 1, True), (3, None, 1, True), (4, "z", 1, True), (4, "zz", 0, False),
          (None, "n", 1, True), (5, "gone", 1, True), (7, "p", 1, True), (8, "q", 1, True), (8, "q2", 2, True)]
BATCH = [(1, "x", 1), (1, "x", 1), (2, "y2", 2), (3, "now", 1), (4, None, 1), (None, "n", 1), (6, "new", 1),
         (7, "p", 1), (7, "p2", 2), (8, "q2", 2)]


def test_case_table(spark):
    res = scd2_merge(target_df(spark, TARGET), batch_df(spark, BATCH), SPEC, AS_OF)
    got = result(res)
    assert len(got) == 15
    expected = sorted([
        (1, "x", 1, True, "old", "old"),                                  # unchanged
        (2, "y", 1, False, "old", "new"), (2, "y2", 2, True, "new", "new"),  # changed
        (3, None, 1, True, "old", "old"),                                 # NULL -> value ignored
        (4, "z", 1, True, "old", "old"), (4, "zz", 0, False, "old", "old"),  # value -> NULL ignored
        (None, "n", 1, True, "old", "old"), (None, "n", 1, True, "new", "new"),  # NULL key re-inserted
        (5, "gone", 1, True, "old", "old"),                               # absent from batch
        (6, "new", 1, True, "new", "new"),                                # new key
        (7, "p", 1, False, "old", "new"), (7, "p", 1, True, "new", "new"), (7, "p2", 2, True, "new", "new"),
        (8, "q", 1, False, "old", "new"), (8, "q2", 2, True, "old", "old"),
    ], key=repr)
    assert got == expected


def test_first_load_equals_merge_into_empty_target(spark):
    batch = BATCH + [(9, None, None), (9, None, None)]
    direct = scd2_merge(None, batch_df(spark, batch), SPEC, AS_OF)
    via_empty = scd2_merge(target_df(spark, []), batch_df(spark, batch), SPEC, AS_OF)
    assert result(direct) == result(via_empty)
    assert direct.closed.count() == 0 and direct.kept.count() == 0
    assert all(r[3] and r[4] == "new" for r in result(direct))


def test_rerun_is_noop_except_null_keys(spark):
    first = scd2_merge(target_df(spark, []), batch_df(spark, [(1, "a", 1), (None, "n", 1)]), SPEC, AS_OF)
    again = scd2_merge(first.all_versions(), batch_df(spark, [(1, "a", 1), (None, "n", 1)]), SPEC, AS_OF)
    assert again.closed.count() == 0
    assert [(r["k"], r["attr"]) for r in again.opened.collect()] == [(None, "n")]


def test_strict_conflict_raises_and_lenient_opens_both(spark):
    tgt = target_df(spark, [(9, "a", 1, True)])
    src = batch_df(spark, [(9, "b", 2), (9, "c", 3)])
    with pytest.raises(Exception, match="several batch rows"):
        scd2_merge(tgt, src, SPEC, AS_OF).all_versions().collect()
    res = scd2_merge(tgt, src, SPEC, AS_OF, strict=False)
    assert res.closed.count() == 1 and res.opened.count() == 2


def test_null_safe_option(spark):
    tgt = target_df(spark, [(3, None, 1, True)])
    res = scd2_merge(tgt, batch_df(spark, [(3, "now", 1)]), SPEC, AS_OF, null_safe=True)
    assert res.closed.count() == 1 and res.opened.count() == 1


@pytest.mark.parametrize("null_safe", [False, True])
def test_classes_of_many_random_keys(spark, null_safe):
    """Each key by itself against all pairs of its live versions and batch rows, conflicts included."""
    rng = random.Random(11)

    def some(n):
        return [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3])) for _ in range(n)]
    live, new = {k: some(rng.randint(0, 3)) for k in range(1500)}, {k: some(rng.choice([0, 1, 1, 2, 3, 5])) for k in range(1500)}

    def differ(t, s):
        return any((a is None) != (b is None) if null_safe and (a is None or b is None) else a is not None and b is not None and a != b for a, b in zip(t, s))
    want = []
    for k in live:
        changes = [sum(differ(t, s) for s in new[k]) for t in live[k]]
        want += [(k, *t, False, c > 0, c > 1) for t, c in zip(live[k], changes)] + [(k, *s, True, 0 in changes, False) for s in new[k]]
    new_rows = spark.createDataFrame([(k, *s) for k in new for s in new[k]], "k long, attr string, upd long")
    live_rows = spark.createDataFrame([(k, *t) for k in live for t in live[k]], new_rows.schema)
    rows = live_rows.withColumn("_kind", F.lit("live")).unionByName(new_rows.withColumn("_kind", F.lit("new"))) \
        .unionByName(scd2._ends(new_rows, ["k"], SPEC, null_safe), allowMissingColumns=True)
    got = scd2._classified(rows, Window.partitionBy("k"), SPEC, null_safe).collect()
    assert sorted(((r.k, r.attr, r.upd, r._kind == "new", r._n_kept > 0 if r._kind == "new" else r._changed, r._conflict) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(w[5] for w in want) > 200


def test_the_target_is_exchanged_once(spark, workdir):
    target_df(spark, TARGET).write.parquet(f"{workdir}/target")
    batch_df(spark, BATCH).write.parquet(f"{workdir}/batch")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(before, ("-1", "false")):
            spark.conf.set(c, v)
        res = scd2_merge(spark.read.parquet(f"{workdir}/target"), spark.read.parquet(f"{workdir}/batch"), SPEC, AS_OF)
        plan = res.merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and f"{workdir}/target"[:20] in line and "effective_start_date" in line]
    above = []
    for at in scans:        # the operators above each scan of the target: lines of less indentation
        depth, names = len(re.match(r"[ :+-]*", lines[at]).group()), []
        for line in reversed(lines[:at]):
            if (d := len(re.match(r"[ :+-]*", line).group())) < depth:
                depth, names = d, [*names, line]
        above.append(names)
    # rows with a key are exchanged and sorted once and meet no join; rows without are not exchanged at all
    assert sorted((sum("Exchange" in x for x in names), sum(" Sort " in x for x in names), sum("Join" in x for x in names)) for names in above) == [(0, 0, 0), (1, 1, 0)]


def test_history_is_never_touched(spark):
    tgt = target_df(spark, [(1, "old", 0, False), (1, "cur", 1, True)])
    res = scd2_merge(tgt, batch_df(spark, [(1, "next", 2)]), SPEC, AS_OF)
    assert [(r["attr"], r["is_active"]) for r in res.history.collect()] == [("old", False)]


def duck_merge(target, batch):
    con = duckdb.connect()
    con.sql("CREATE TABLE t (k BIGINT, attr VARCHAR, upd BIGINT, s TIMESTAMP, e TIMESTAMP, act BOOLEAN)")
    con.sql("CREATE TABLE b (k BIGINT, attr VARCHAR, upd BIGINT)")
    for k, a, u, act in target:
        con.execute("INSERT INTO t VALUES (?, ?, ?, TIMESTAMP '2025-01-01', TIMESTAMP '2025-01-01', ?)",
                    [k, a, u, act])
    for k, a, u in batch:
        con.execute("INSERT INTO b VALUES (?, ?, ?)", [k, a, u])
    src = "(SELECT DISTINCT k, attr, upd FROM b)"
    con.sql(f"""MERGE INTO t USING {src} s ON t.k = s.k AND t.act = true
        WHEN MATCHED AND (t.attr != s.attr OR t.upd != s.upd)
        THEN UPDATE SET act = false, e = TIMESTAMP '2025-01-02'""")
    con.sql(f"""MERGE INTO t USING {src} s ON t.k = s.k AND t.act = true
        WHEN NOT MATCHED THEN INSERT VALUES
        (s.k, s.attr, s.upd, TIMESTAMP '2025-01-02', TIMESTAMP '2025-01-02', true)""")
    out = []
    for k, a, u, s, e, act in con.sql("SELECT * FROM t").fetchall():
        out.append((k, a, u, act, "old" if s.day == 1 else "new", "old" if e.day == 1 else "new"))
    return sorted(out, key=repr)


keys = st.one_of(st.none(), st.integers(1, 4))
attrs = st.one_of(st.none(), st.sampled_from(["a", "b"]))
upds = st.integers(1, 2)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(keys, attrs, upds, st.booleans()), max_size=6),
       st.lists(st.tuples(keys, attrs, upds), max_size=6))
def test_property_matches_duckdb_merge(spark, target, batch):
    try:
        expected = duck_merge(target, batch)
    except duckdb.Error:
        expected = "conflict"
    res = scd2_merge(target_df(spark, target), batch_df(spark, batch), SPEC, AS_OF)
    if expected == "conflict":
        with pytest.raises(Exception):
            result(res)
    else:
        assert result(res) == expected
