"""Copying chosen tables, loading into a declared schema, and publishing whole tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.operators import joins


def table_names(text: str) -> list[str]:
    """Names in a comma list, trimmed; empty entries and repeats fall away."""
    return list(dict.fromkeys(name.strip() for name in text.split(",") if name.strip()))


@dataclass(frozen=True)
class Split:
    """How one table is read in parallel: a numeric or time column, its range, and the number of reads."""

    column: str
    lower: str
    upper: str
    reads: int


@dataclass(frozen=True)
class Ranges:
    """How one table is read in parallel by conditions of its own: every row meets exactly one."""

    predicates: tuple[str, ...]


def split_points(keys: DataFrame, column: str, reads: int, accuracy: int = 10_000) -> list:
    """At most ``reads - 1`` values that cut a column into parts of about equal numbers of rows, by a mergeable sketch:
    one pass, one row to the driver. A value with more rows than a part stands alone, between two points at most."""
    shares = [i / reads for i in range(1, reads)]
    if not shares:
        return []
    value = F.col(f"`{column}`")
    row = keys.agg(F.percentile_approx(value, shares, accuracy).alias("points"), F.min(value).alias("least")).first()
    return sorted({p for p in row["points"] or () if p != row["least"]})


def equi_depth(keys: DataFrame, column: str, reads: int) -> Ranges:
    """Ranges of a numeric, date or time column that hold about equal numbers of rows, however its values lie: from a
    frame with that column, such as the last landing of the table or a sample of the source. Values beyond the frame's
    own fall into the first or last range, NULL into the first, so the ranges are complete for any later state."""
    points = [_literal(p) for p in split_points(keys, column, reads)]
    if not points:
        return Ranges(("1 = 1",))
    inner = tuple(f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:]))
    return Ranges((f"{column} < {points[0]} OR {column} IS NULL", *inner, f"{column} >= {points[-1]}"))


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    return f"DATE '{value:%Y-%m-%d}'" if isinstance(value, date) else str(value)


def jdbc_options(url: str, table: str, split: Split | None = None, fetch_rows: int = 10_000,
                 properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of one table's JDBC read. Without a split the table is one read: only for small tables.

    Times land without a zone, as the source holds them.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), "preferTimestampNTZ": "true",
               **(properties or {})}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.reads),
        }
    return options


def jdbc_reader(spark: SparkSession, url: str, table: str, split: Split | None = None,
                properties: Mapping[str, str] | None = None) -> DataFrameReader:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, split, properties=properties))


def jdbc_frame(spark: SparkSession, url: str, table: str, split: Split | Ranges | None = None,
               properties: Mapping[str, str] | None = None) -> DataFrame:
    """One table of a database, read by its split or by a condition per task."""
    if not isinstance(split, Ranges):
        return jdbc_reader(spark, url, table, split, properties).load()
    options = jdbc_options(url, table, None, properties=properties)
    return spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=list(split.predicates), properties=options)


def read_tables(spark: SparkSession, root: str, tables: str | Iterable[str], fmt: str = "parquet",
                suffix: str = "") -> dict[str, DataFrame]:
    """Landed tables below ``root``, by name. ``tables`` is a comma list or a list of names."""
    names = table_names(tables) if isinstance(tables, str) else list(tables)
    return {name: spark.read.format(fmt).load(f"{root}/{name}{suffix}") for name in names}


#: Below a snapshot: what was written of each table, so that later readers can tell whether they see all of it.
MANIFEST = "_landed"


def _tally(df: DataFrame) -> list[Column]:
    """Number of rows, and a checksum of their contents in any order."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*plain).cast("decimal(38,0)")).cast("string").alias("checksum")]


def snapshot(frames: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Land each frame in a new folder below ``root`` and return the landed frames.

    Rows are counted and summed up as they are written, and again from the landed files; a difference stops the job. The
    figures are kept beside the tables (``landed``). A run that fails leaves earlier landings as they were. Parallel
    database reads share no transaction: for one consistent state, read a quiet replica.
    """
    version = f"{root}/{uuid.uuid4().hex[:8]}"
    spark, written = next(iter(frames.values())).sparkSession, {}
    for name, frame in frames.items():
        seen = Observation(name)
        frame.observe(seen, *_tally(frame)).write.format(fmt).save(f"{version}/{name}")
        written[name] = (seen.get["rows"], seen.get["checksum"])
    found = read_tables(spark, version, frames, fmt)
    _compare(found, written)
    entries = [(name, *of) for name, of in written.items()]
    spark.createDataFrame(entries, "name string, rows bigint, checksum string").coalesce(1).write.parquet(f"{version}/{MANIFEST}")
    return found


def landed(spark: SparkSession, version: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables of a landed snapshot, checked against what was written."""
    entries = {r["name"]: (r["rows"], r["checksum"]) for r in spark.read.parquet(f"{version}/{MANIFEST}").collect()}
    found = read_tables(spark, version, entries, fmt)
    _compare(found, entries)
    return found


def _compare(found: Mapping[str, DataFrame], written: Mapping[str, tuple]) -> None:
    for name, frame in found.items():
        there = tuple(frame.agg(*_tally(frame)).first())
        if there != tuple(written[name]):
            raise ValueError(f"{name}: landed {there} (rows, checksum), written {tuple(written[name])}")


def copy_tables(spark: SparkSession, url: str, tables: str | Iterable[str], root: str,
                splits: Mapping[str, Split | Ranges] | None = None, small: Iterable[str] = (),
                properties: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Copy chosen database tables to ``root`` and return the landed frames. A table is read by its split, an even one or
    ranges as ``equi_depth`` plans them; one that a single task can hold may be named in ``small`` instead."""
    small = set(small)
    names = table_names(tables) if isinstance(tables, str) else list(tables)
    whole = [n for n in names if n not in (splits or {}) and n not in small]
    if whole:
        raise ValueError(f"give a split, or list as small, for: {', '.join(whole)}")
    frames = {n: jdbc_frame(spark, url, n, (splits or {}).get(n), properties) for n in names}
    return snapshot(frames, root)


def versions(spark: SparkSession, table: str) -> list[str]:
    """The written versions of a published table, oldest first."""
    database, _, name = table.rpartition(".")
    marked = re.compile(re.escape(name) + r"__v[0-9]{17}_[0-9a-f]{8}", re.IGNORECASE)
    listed = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES").collect()
    prefix = f"{database}." if database else ""
    return sorted(prefix + r["tableName"] for r in listed if not r["isTemporary"] and marked.fullmatch(r["tableName"]))


def publish(df: DataFrame, table: str, fmt: str = "parquet", root: str | None = None,
            buckets: tuple[int, str] | None = None, keep: int = 2, profile: Sequence[str] = ()) -> DataFrame:
    """Replace a table with this frame. The rows are written in full as a version of their own; the published name is
    a view, and one catalogue statement moves it to the new version. A job that stops anywhere leaves the name on the
    old rows, and the query may read the table it replaces.

    A plain table that already has the name is taken over (``_take_over``).

    The last ``keep`` versions stay, so that readers of the one before can end; older ones and those of failed runs
    are dropped. With ``root`` each version gets a folder below it, which stays for whoever owns the root to remove;
    without it the catalogue manages the files.

    ``buckets`` (number, column) lays the rows out by a join key and sorts them by it: tables bucketed alike
    join on that key without a shuffle. Worth it for tables joined many times; not for a key with hot values.
    ``profile`` names columns that later joins use: their hot keys are found now and kept with the version
    (``published`` reads them back).
    """
    spark = df.sparkSession
    _recover(spark, table)
    made = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")[:17]
    fresh = f"{table}__v{made}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format(fmt)
    if buckets:
        count, column = buckets
        writer = df.repartition(count, column).write.format(fmt).bucketBy(count, column).sortBy(column)
    if root:
        writer = writer.option("path", f"{root.rstrip('/')}/{table}/{fresh.rpartition('__')[2]}")
    writer.saveAsTable(fresh)
    for column in profile:
        entry = joins.profile_entry(spark.table(fresh), column)
        spark.sql(f"ALTER TABLE {fresh} SET TBLPROPERTIES ('{PROFILE}{column}' = '{entry}')")
    if _is_plain(spark, table):
        _take_over(spark, table, fresh)
    else:
        _point(spark, table, fresh)
    for old in versions(spark, table)[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return published(spark, table)


#: Before the column's name, in the properties of a version: the hot keys of that column.
PROFILE = "cartwright.hot."


def published(spark: SparkSession, table: str) -> DataFrame:
    """A published table, with the key profiles kept with its version: joins on those keys need no profiling job."""
    frame, there = spark.table(table), versions(spark, table)
    if there and not _is_plain(spark, table):
        for r in spark.sql(f"SHOW TBLPROPERTIES {there[-1]}").collect():
            if r["key"].startswith(PROFILE):
                joins.remember(frame, r["key"].removeprefix(PROFILE), r["value"])
    return frame


def _point(spark: SparkSession, table: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")


def _is_plain(spark: SparkSession, table: str) -> bool:
    """Whether the name is a table of its own, not a view."""
    if not spark.catalog.tableExists(table):
        return False
    found = spark.catalog.getTable(table)
    return not found.isTemporary and found.tableType != "VIEW"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _take_over(spark: SparkSession, table: str, version: str) -> None:
    """Move the name of a plain table to a version. The old rows are there until the new ones are.

    A table with the version's columns and format moves to the version's files in one catalogue statement, stays a table,
    and moves again the next time; the files it had first stay where they are. Any other becomes the oldest version, by
    a new name (a partitioned table, whose partitions would keep their old places, by a copy), and its name a view. That
    is the one case with a moment between two statements, once in a table's life: should a job stop there, the old rows
    are whole under the version's name, and the next ``publish`` puts the name back on them before it does anything else.
    """
    old, new = _described(spark, table), _described(spark, version)
    alike = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in spark.table(version).schema]
    plain = not {"# Partition Information", "Num Buckets"} & (old.keys() | new.keys())
    if alike and plain and old.get("Provider") == new.get("Provider"):
        _relocate(spark, table, new["Location"])
    else:
        oldest = f"{table}__v{'0' * 17}_{uuid.uuid4().hex[:8]}"
        if "# Partition Information" in old:
            spark.table(table).write.format(old.get("Provider", "parquet")).saveAsTable(oldest)
            spark.sql(f"DROP TABLE {table}")
        else:
            spark.sql(f"ALTER TABLE {table} RENAME TO {oldest}")
        _point(spark, table, version)


def _relocate(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def _recover(spark: SparkSession, table: str) -> None:
    """Put a name that was lost between the two statements of ``_take_over`` back on the rows it had."""
    if not spark.catalog.tableExists(table):
        kept = [v for v in versions(spark, table) if f"__v{'0' * 17}_" in v]
        if kept:
            _point(spark, table, kept[-1])


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The declared columns, in order and type. A text over its declared length stops the job."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return df.select(*[_typed(field) for field in schema.fields])


def _typed(field: T.StructField):
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        text, limit = value.cast("string"), field.dataType.length
        message = F.concat(F.lit(f"{field.name}: text longer than {limit}: "), text)
        value = F.when(F.length(text) > limit, F.raise_error(message)).otherwise(text)
    elif isinstance(field.dataType, T.DecimalType):
        value = F.round(value, field.dataType.scale).cast(field.dataType)
    else:
        value = value.cast(field.dataType)
    return value.alias(field.name)


def ordered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A whole table in a stated order: a range shuffle, then a sort within each range."""
    return df.orderBy(*[F.col(f"`{c}`") for c in by])
