"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Facts whose key columns reach this size are profiled for hot keys. Set per session by SKEW_CONF.
SKEW_MIN_BYTES = 16 << 20
SKEW_CONF = "spark.cartwright.skewMinBytes"
# What the sketch itself can return and track; keys over two average partitions are at most half the partitions.
MOST_RETURNED, MOST_TRACKED = 100_000, 1_000_000

log = logging.getLogger(__name__)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, the one its own broadcast choice is based on."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold; -1 where broadcasting is switched off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    if text.startswith("-"):
        return -1
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def key_types(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> dict[str, T.DataType] | None:
    """The type in which each key hashes alike on both sides, or None where equal keys might not.

    Whole numbers of any width hash as long. Other keys must have one type on both sides; floating point is
    left out, as its zeros and NaNs compare equal but hash apart.
    """
    types = {}
    for key in keys:
        left, right = fact.schema[key].dataType, dim.schema[key].dataType
        if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
            types[key] = T.LongType()
        elif left == right and not isinstance(left, T.FractionalType):
            types[key] = left
        elif left == right and isinstance(left, T.DecimalType):
            types[key] = left
        else:
            return None
    return types


def key_hash(types: Mapping[str, T.DataType]) -> Column:
    return F.xxhash64(*[F.col(k).cast(t) for k, t in types.items()])


def hot_key_hashes(df: DataFrame, types: Mapping[str, T.DataType], partitions: int) -> dict[int, int]:
    """Hashes of the keys that hold more than two average partitions' worth of rows, with that many partitions each.

    One pass over the key columns alone with a mergeable sketch: no shuffle of keys, and at most a pair of numbers
    per two partitions reaches the driver. The sketch tracks ten times as many keys as can be that hot. NULL hashes
    like any other key, so NULL-heavy keys show up too. The list steers work only; results are the same whatever it
    holds.
    """
    returned = min(MOST_RETURNED, max(1, partitions // 2))
    tracked = min(MOST_TRACKED, max(1_000, 10 * returned))
    top = df.select(key_hash(types).alias("h")).agg(
        F.expr(f"approx_top_k(h, {returned}, {tracked})").alias("top"), F.count("*").alias("total")
    )
    hot = top.select("total", F.inline("top")).where(F.col("count") * partitions > F.col("total") * 2)
    return {r["item"]: min(partitions, -(-r["count"] * partitions // r["total"])) for r in hot.collect()}


# Profiles known in this process, by the meaning of the profiled frame, its keys and the number of partitions.
_PROFILES: dict[tuple, dict[int, int]] = {}


def _identity(df: DataFrame, keys: Sequence[str], partitions: int) -> tuple:
    return df.sparkSession.sparkContext.applicationId, df.select(*keys).semanticHash(), tuple(keys), partitions


def profile_of(df: DataFrame, types: Mapping[str, T.DataType]) -> dict[int, int]:
    """``hot_key_hashes`` of a frame, once per frame and keys: frames that read the same table alike share one job. A
    profile that the data has outgrown costs balance, never rows."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = _identity(df, list(types), partitions)
    if key not in _PROFILES:
        _PROFILES[key] = hot_key_hashes(df, types, partitions)
    return _PROFILES[key]


def profile_entry(df: DataFrame, column: str) -> str:
    """The profile of one column as text, for the number of partitions of this session."""
    types = key_types(df, df, [column])
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return json.dumps({"partitions": partitions, "hot": profile_of(df.select(column), types) if types else {}})


def remember(df: DataFrame, column: str, entry: str) -> None:
    """Take over a profile that was kept with a table, as the profile of this column of this frame."""
    kept = json.loads(entry)
    _PROFILES.setdefault(_identity(df, [column], kept["partitions"]), {int(k): n for k, n in kept["hot"].items()})


def hot_keys(df: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """The hot keys of a frame, from one job over these columns; none where the frame is too small to matter, shows no
    size estimate, or has keys that cannot be hashed alike."""
    if not hasattr(df, "_jdf"):
        return {}
    types = key_types(df, df, keys)
    if types is None or estimated_bytes(df) < least_profiled(df):
        return {}
    return profile_of(df, types)


def is_hot(df: DataFrame, keys: Sequence[str], hot: Mapping[int, int]) -> Column:
    """Whether a row has one of the keys found by ``hot_keys``; never NULL."""
    return key_hash(key_types(df, df, keys)).isin(list(hot))


def least_profiled(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(SKEW_CONF, str(SKEW_MIN_BYTES)))


def is_large(df: DataFrame) -> bool:
    """Whether a table reaches the size from which keys are profiled; never where no size estimate shows."""
    return hasattr(df, "_jdf") and estimated_bytes(df) >= least_profiled(df)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    profile: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join a fact to a side that has one row (or few) per key, whatever the fact's key distribution.

    A side within the session's broadcast threshold, or a fact too small to matter, takes the plain join;
    Spark picks its form and adaptive execution may still change it. Otherwise the fact's keys are profiled
    (``profile``: a cheaper frame with the same key distribution, usually the base table; give one wherever
    the fact is itself a join, or the join runs twice). Rows of hot keys are spread over sub-keys by a hash of their own columns and only those keys' rows of ``dim`` are
    repeated, so each hot key becomes as many join tasks as its share asks for. Profiling runs one job while the plan is built. The hash is a function of the row alone: a retried
    task sends each row to the same place. ``how``: inner, left, left_semi or left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    spark = fact.sparkSession
    profile = fact if profile is None else profile
    if not hasattr(fact, "_jdf"):  # a remote session shows no size estimates; adaptive execution splits what it can
        return fact.join(dim, keys, how)
    if estimated_bytes(profile) < least_profiled(fact):
        return fact.join(dim, keys, how)
    if estimated_bytes(dim) <= broadcast_limit(dim):
        return fact.join(dim, keys, how)
    types = key_types(fact, dim, keys)
    if types is None:
        return fact.join(dim, keys, how)
    hot = profile_of(profile, types)
    log.info("join on %s: %d hot keys, %d sub-keys", keys, len(hot), sum(hot.values()))
    if not hot:
        return fact.join(dim, keys, how)
    return salted_join(fact, dim, types, how, hot, spread_by)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    types: Mapping[str, T.DataType],
    how: str,
    hot: Mapping[int, int],
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Equi join in which every key hashing to one in ``hot`` is split over as many sub-keys as that says.

    Numbers of sub-keys are rounded up to powers of two, so a handful of lists covers any number of hot keys, and only
    their rows of ``dim`` are repeated, each as often as its key needs.
    """
    by_salts: dict[int, list[int]] = {}
    for item, salts in hot.items():
        by_salts.setdefault(1 << (max(2, salts) - 1).bit_length(), []).append(item)
    count = F.lit(1)
    for salts, items in by_salts.items():
        count = F.when(key_hash(types).isin(items), F.lit(salts)).otherwise(count)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in (spread_by or fact.columns)])
    left = fact.withColumn("_salt", F.pmod(spread, count).cast("int"))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1)))
    return left.join(right, [*types, "_salt"], how).drop("_salt")
