from __future__ import annotations

import pytest

from cartwright.llm.base import reachable


@pytest.fixture(scope="module")
def small_parts(spark):
    """Fewer shuffle partitions: the tables here have a few rows."""
    reachable(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def documents(spark, small_parts):
    """Documents from (id, text) pairs, with extra columns whose names operators use themselves."""

    def build(rows):
        full = [(i, t, "en", f"s{(i or 0) % 3}", n, "x", n) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, lang string, source string, chunk int, rest string, size int")

    return build
