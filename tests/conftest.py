import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tierline.session import DEFAULTS, ensure_checkpoint_dir
    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8") \
        .config("spark.driver.memory", "8g")
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tierline-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
