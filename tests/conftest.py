from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("cwd"))
    session = local_session(8, memory="8g", app="tests")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from a DDL schema and rows; decimals and times may be given as text."""

    def build(ddl: str, rows: list[tuple]):
        from pyspark.sql import functions as F
        from pyspark.sql import types as T

        schema = T.StructType.fromDDL(ddl)
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        plain = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], text)
        return plain.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    return build


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(name: str, value: str):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def skew_path(conf):
    """Send every lookup join through the profile, and let small shares count as hot."""
    conf("spark.cartwright.skewMinBytes", "0")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "16")
