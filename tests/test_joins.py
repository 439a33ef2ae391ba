from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.operators import joins
from cartwright.operators.dedupe import distinct_ordered_concat, latest_per_key
from cartwright.operators.joins import lookup_join
from cartwright.operators.repeat import repeat_rows
from cartwright.sources import tables
from tests.rows import rows

HOWS = ["inner", "left", "left_semi", "left_anti"]


@pytest.fixture
def hot_counts(monkeypatch):
    """How many hot keys each spread join had."""
    seen = []
    real = joins.salted_join

    def spy(fact, dim, types, how, hot, spread_by=None):
        seen.append(len(hot))
        return real(fact, dim, types, how, hot, spread_by)

    monkeypatch.setattr(joins, "salted_join", spy)
    return seen


def fact_and_dim(frame, fact_type="INT", dim_type="INT"):
    fact = frame(f"id INT, k {fact_type}", [
        (i, None if i % 3 == 0 else 7 if i % 3 == 1 else i) for i in range(300)])
    dim = frame(f"k {dim_type}, v STRING", [(7, "seven"), (2, "two"), (5, "five"), (9999, "none"), (None, "null")])
    return fact, dim


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("types", [("INT", "INT"), ("INT", "BIGINT"), ("BIGINT", "SMALLINT"), ("STRING", "STRING"),
                                   ("DECIMAL(12,2)", "DECIMAL(12,2)")])
def test_hot_and_null_keys_are_spread(frame, skew_path, hot_counts, how, types):
    fact, dim = fact_and_dim(frame, *types)
    got = joins.lookup_join(fact, dim, "k", how)
    want = fact.join(dim, "k", how)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    assert hot_counts == [2]


@pytest.mark.parametrize("types", [("DOUBLE", "DOUBLE"), ("INT", "DOUBLE"), ("DECIMAL(12,2)", "DECIMAL(14,3)")])
def test_keys_that_may_hash_apart_take_the_plain_join(frame, skew_path, hot_counts, types):
    fact, dim = fact_and_dim(frame, *types)
    assert rows(joins.lookup_join(fact, dim, "k", "left")) == rows(fact.join(dim, "k", "left"))
    assert hot_counts == []


def test_small_facts_and_small_sides_take_the_plain_join(spark, frame, conf, hot_counts, tmp_path):
    """Files have a known size; a frame from local rows has none and counts as large."""
    sides = []
    for name, df in zip(("fact", "dim"), fact_and_dim(frame)):
        df.write.parquet(f"{tmp_path}/{name}")
        sides.append(spark.read.parquet(f"{tmp_path}/{name}"))
    fact, dim = sides
    joins.lookup_join(fact, dim, "k")
    conf("spark.cartwright.skewMinBytes", "0")
    joins.lookup_join(fact, dim, "k")
    assert hot_counts == []


def test_profile_finds_only_hot_keys(spark):
    df = spark.range(0, 90_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"))
    types = {"k": T.LongType()}
    hot = joins.hot_key_hashes(df, types, 100)
    want = spark.sql("SELECT xxhash64(1L), xxhash64(CAST(NULL AS BIGINT))").first()
    assert sorted(hot) == sorted(want) and set(hot.values()) == {34}
    assert joins.hot_key_hashes(spark.range(10_000).withColumnRenamed("id", "k"), types, 100) == {}


def test_profile_has_no_fixed_floor(spark):
    """A key of 18 average partitions at 20,000 partitions is 0.09 % of the rows."""
    df = spark.range(0, 1_000_000, 1, 4).select(F.when(F.col("id") < 900, -1).otherwise(F.col("id")).alias("k"))
    assert list(joins.hot_key_hashes(df, {"k": T.LongType()}, 20_000).values())[0] in (18, 19)  # the sketch may count a little over


def test_copies_follow_each_keys_share(spark, frame):
    types = {"k": T.LongType()}
    fact = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 10 == 1, 2).otherwise(F.col("id")).alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    one, two = spark.sql("SELECT xxhash64(1L), xxhash64(2L)").first()
    seen = []
    kind = type(fact)
    real = kind.join
    kind.join = lambda self, other, *a, **b: (seen.append(other.groupBy("k").count().where("count > 1").collect()), real(self, other, *a, **b))[1]
    try:
        out = joins.salted_join(fact, dim, types, "inner", {one: 50, two: 10})
    finally:
        kind.join = real
    assert sorted((r["k"], r["count"]) for r in seen[0]) == [(1, 64), (2, 16)]
    assert rows(out, "id", "k") == rows(fact.where("k < 1000"), "id", "k")


def test_spread_rows_reach_many_tasks(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    fact = spark.range(0, 10_000, 1, 4).select("id", F.lit(1).alias("k"))
    dim = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    hash_of_one = spark.sql("SELECT xxhash64(1L)").first()[0]
    out = joins.salted_join(fact, dim.hint("merge"), {"k": T.LongType()}, "inner", {hash_of_one: 16})
    assert out.count() == 10_000
    used = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 4


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)),
                     min_size=1, max_size=25), seed=st.randoms())
def test_latest_per_key_ignores_row_order(frame, data, seed):
    shuffled = list(data)
    seed.shuffle(shuffled)
    ddl = "k INT, t INT, v INT"
    pick = lambda d: rows(latest_per_key(frame(ddl, d), ["k"], [F.col("t").desc_nulls_last()]))
    got = pick(data)
    assert got == pick(shuffled)
    best = {}
    for k, t, v in data:
        rank = (-1 if t is None else t, -v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    assert got == sorted((b for _, b in best.values()), key=repr)


def test_distinct_ordered_concat_takes_the_first_time(frame):
    df = frame("k INT, v STRING, t INT", [(1, "b", 1), (1, "a", 2), (1, "b", 9), (1, "c", 2), (2, None, 1)])
    out = distinct_ordered_concat(df, ["k"], "v", "t", "|", "text", last="last")
    assert rows(out) == [(1, "b|a|c", 9), (2, None, 1)]


def test_repeated_rows(spark, conf):
    df = spark.sql("SELECT * FROM VALUES (1, 3L), (2, 0L), (3, NULL), (4, 1L), (5, -2L), (6, 27L), (7, 1000L) AS t(id, n)")
    got = repeat_rows(df, F.col("n"), block=3).groupBy("id", "n").count().collect()
    assert sorted((r["id"], r["count"]) for r in got) == [(1, 3), (4, 1), (6, 27), (7, 1000)]


def test_a_million_copies_of_one_row_are_spread(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = repeat_rows(spark.sql("SELECT 1 AS id, 'x' AS t"), F.lit(1_000_000))
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) == 8 and max(sizes) < 250_000


def jobs_of(spark, build) -> int:
    """Jobs that building a frame runs."""
    spark.sparkContext.setJobGroup(group := f"build {id(build)}", "")
    build()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(found)


def test_a_table_is_profiled_once(spark, skew_path, tmp_path):
    facts = spark.range(4000).selectExpr("id", "IF(id % 2 = 0, 1, id) AS k")
    facts.write.parquet(f"{tmp_path}/facts")
    spark.range(4000).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/dim")
    read = lambda name: spark.read.schema("id bigint, k bigint" if name == "facts" else "k bigint, v bigint").parquet(f"{tmp_path}/{name}")
    build = lambda: lookup_join(read("facts"), read("dim"), "k", "left")
    assert jobs_of(spark, build) >= 1 and jobs_of(spark, lambda: build()) == 0


def test_profiles_stay_with_the_published_version(spark, skew_path, tmp_path):
    facts = spark.range(4000).selectExpr("id", "IF(id % 2 = 0, 1, id) AS k")
    tables.publish(facts, "profiled", root=str(tmp_path), profile=["k"])
    dim = spark.range(4000).selectExpr("id AS k", "id AS v")
    joins._PROFILES.clear()  # as in a later session
    read = tables.published(spark, "profiled")
    build = lambda: lookup_join(read, dim, "k", "left", profile=read.select("k"))
    assert jobs_of(spark, build) == 0 and "_salt" in build()._jdf.queryExecution().analyzed().toString()
    assert build().where("v IS NULL").count() == 0 and build().count() == 4000
    joins._PROFILES.clear()
    assert jobs_of(spark, lambda: lookup_join(spark.table("profiled"), dim, "k", "left")) >= 1  # read past the profile
