"""Keyset pages on embedded in-memory Derby: ends, resumed runs, ties, refused ids."""

import datetime as dt
import itertools
import random

import pytest

from conftest import SF001  # noqa: F401 - puts the repository on the path
from tierline.operators.audit import read_audit
from tierline.plans.pipeline import Layout, ingest, ingest_pages, refine_table, silver
from tierline.schemas import REGISTRY
from tierline.sources.bronze import read_bronze_json
from tierline.sources.jdbc import JdbcSource, ParquetSource
from tierline.sources.landing import landed_runs
from tierline.sources.paging import page_ends

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
SCHEMA = "customer_id bigint, name string, email string, updated_at timestamp"
START = dt.datetime(1900, 1, 1, tzinfo=dt.timezone.utc)
DAY1 = dt.datetime(2025, 3, 28, 5, tzinfo=dt.timezone.utc)
DAY2 = dt.datetime(2025, 3, 29, 5, tzinfo=dt.timezone.utc)
SPEC = REGISTRY["customers"]
_ids = itertools.count()


def _rows(spark, ids, hours=7):
    """Customers in random order; every seventh hour's worth share an instant, with microseconds."""
    at = dt.datetime(2025, 3, 1, 12, 0, 0, 123456)
    rows = [(i, f"n{i}", f"{i}@x", at + dt.timedelta(hours=i // hours)) for i in ids]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def _source(spark, df):
    url = f"jdbc:derby:memory:pages{next(_ids)};create=true"
    df.write.format("jdbc").option("url", url).option("driver", DRIVER) \
        .option("dbtable", '"retailer"."customers"').mode("overwrite").save()
    return JdbcSource(url=url, driver=DRIVER, schema="retailer")


class _Failing:
    """A source that gives up at its ``at``-th read."""

    def __init__(self, source, at):
        self.source, self.at, self.reads = source, at, 0

    def read(self, *args, **kwargs):
        self.reads += 1
        if self.reads == self.at:
            raise ConnectionError("lost")
        return self.source.read(*args, **kwargs)


def _landed(spark, layout):
    return sorted(r["customer_id"] for r in read_bronze_json(spark, f"{layout.landing}/customers", SPEC).collect())


def test_pages_end_at_every_nth_row(spark):
    ends = page_ends(spark, _source(spark, _rows(spark, range(50))), "customers", "updated_at", "customer_id", START, -1, 12)
    assert [i for _, i in ends] == [11, 23, 35, 47, 49]
    assert ends[0][0] == dt.datetime(2025, 3, 1, 13, 0, 0, 123456, tzinfo=dt.timezone.utc)
    assert page_ends(spark, ParquetSource({"customers": lambda s: _rows(s, range(0))}), "customers", "updated_at", "customer_id", START, -1, 12) == []
    assert [i for _, i in page_ends(spark, ParquetSource({"customers": lambda s: _rows(s, range(24))}), "customers", "updated_at", "customer_id", START, -1, 12)] == [11, 23]


def test_rows_of_one_place_stay_together(spark):
    df = _rows(spark, [1, 2, 2, 2, 2, 3])
    assert [i for _, i in page_ends(spark, ParquetSource({"customers": lambda s: df}), "customers", "updated_at", "customer_id", START, -1, 2)] == [2, 3]


def test_rows_without_an_id_are_refused(spark):
    df = _rows(spark, [1]).selectExpr("CAST(NULL AS bigint) customer_id", "name", "email", "updated_at")
    with pytest.raises(Exception, match="without customer_id"):
        page_ends(spark, ParquetSource({"customers": lambda s: df}), "customers", "updated_at", "customer_id", START, -1, 2)


@pytest.mark.parametrize("again", [DAY1, DAY2])
def test_a_failed_run_goes_on_behind_its_last_page(spark, workdir, again):
    source, layout = _source(spark, _rows(spark, range(50))), Layout(workdir)
    with pytest.raises(ConnectionError):        # the ends, pages 1 and 2, then page 3
        ingest_pages(spark, _Failing(source, 4), SPEC, layout, DAY1, "customer_id", 12)
    assert _landed(spark, layout) == list(range(24))
    pages = ingest_pages(spark, source, SPEC, layout, again, "customer_id", 12)
    assert [p.rows_loaded for p in pages] == [12, 12, 2]
    assert _landed(spark, layout) == list(range(50))
    audit = read_audit(spark, layout.audit).orderBy("run_id").collect()
    assert [r["last_id"] for r in audit] == ["11", "23", "35", "47", "49"] and len({r["run_id"] for r in audit}) == 5
    assert ingest_pages(spark, source, SPEC, layout, DAY2, "customer_id", 12) == []
    refine_table(spark, SPEC, layout, DAY2)
    assert silver(spark, layout)["customers"].where("is_active").count() == 50


@pytest.mark.parametrize("again", [DAY1, DAY2])
def test_a_page_that_landed_without_its_audit_row_is_made_again(spark, workdir, again, monkeypatch):
    from tierline.plans import pipeline
    source, layout, append, calls = _source(spark, _rows(spark, range(50))), Layout(workdir), pipeline.append, itertools.count(1)

    def failing(df, path, **kwargs):
        if next(calls) == 2:
            raise OSError("full")
        append(df, path, **kwargs)
    monkeypatch.setattr(pipeline, "append", failing)
    with pytest.raises(OSError):
        ingest_pages(spark, source, SPEC, layout, DAY1, "customer_id", 12)
    assert len(landed_runs(spark, layout.landing, "customers")) == 2
    ingest_pages(spark, source, SPEC, layout, again, "customer_id", 12)
    assert _landed(spark, layout) == list(range(50))


def test_ingest_takes_increments_as_pages(spark, workdir):
    layout, df = Layout(workdir), _rows(spark, range(30))
    runs = ingest(spark, {"retailer": ParquetSource({"customers": lambda s: df})}, [SPEC], layout, DAY1, keyset_id="customer_id", page_rows=12)
    assert [r.rows_loaded for r in runs] == [30] and len(landed_runs(spark, layout.landing, "customers")) == 3
    more = ParquetSource({"customers": lambda s: _rows(s, range(35))})
    assert ingest(spark, {"retailer": more}, [SPEC], layout, DAY2, keyset_id="customer_id", page_rows=12)[0].rows_loaded == 5
    with pytest.raises(ValueError):
        ingest(spark, {"retailer": more}, [SPEC], layout, DAY2, page_rows=12)


def test_many_pages_land_in_a_bounded_number_of_reads(spark, workdir):
    """Each page as an extract of its own would read the source once a page."""
    source, layout = _Failing(ParquetSource({"customers": lambda s: _rows(s, range(200))}), -1), Layout(workdir)
    pages = ingest_pages(spark, source, SPEC, layout, DAY1, "customer_id", 3)
    assert len(pages) == 67 and [p.rows_loaded for p in pages] == [3] * 66 + [2]
    assert source.reads <= 17 and _landed(spark, layout) == list(range(200))
    landed = read_bronze_json(spark, f"{layout.landing}/customers", SPEC, keep_run=True).groupBy("run_id").agg({"customer_id": "max"}).orderBy("run_id").collect()
    assert [r[1] for r in landed] == [*range(2, 199, 3), 199]
    assert [r["last_id"] for r in read_audit(spark, layout.audit).orderBy("run_id").collect()] == [str(r[1]) for r in landed]
    assert ingest_pages(spark, source, SPEC, layout, DAY2, "customer_id", 3) == []
