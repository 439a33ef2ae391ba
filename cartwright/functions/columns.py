"""Small column expressions shared by the marts. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode(code: Column, labels: Mapping[int, str], default: str) -> Column:
    """Label of an integer code; ``default`` for unknown codes, for text that is no integer, and for NULL."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[code.try_cast("int")], F.lit(default))


def folded(value: Column) -> Column:
    """The text under which spellings that differ in case alone are equal; NULL stays NULL.

    Lower case, with the final sigma as any other sigma. Two texts are equal this way exactly where the collation
    ``UTF8_LCASE`` calls them equal: accents count, ``ß`` is not ``ss``, ``İ`` is an i with a dot above. Unlike a collated
    column the result is plain text, which scans can filter on, and which hashes, buckets and joins as it is.
    """
    return F.translate(F.lower(value), "ς", "σ")


def with_folded_keys(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with a column ``<name>_key`` per named one, to be stored with it."""
    return df.withColumns({f"{c}_key": folded(F.col(f"`{c}`")) for c in columns})


def folded_key(df: DataFrame, column: str) -> Column:
    """The folded text of a column: the stored ``<name>_key`` where the frame has one, else computed."""
    return F.col(f"`{column}_key`") if f"{column}_key" in df.columns else folded(F.col(f"`{column}`"))


def same_text(value: Column, text: str) -> Column:
    """Case-blind equality with a literal; NULL stays NULL."""
    return folded(value) == folded(F.lit(text))


def text_in(value: Column, texts: list[str]) -> Column:
    """Case-blind membership in a literal list."""
    return folded(value).isin([folded(F.lit(t)) for t in texts])


def text_or_empty(value: Column) -> Column:
    """The value as text, empty text for NULL. The cast comes first: '' is no number in ANSI mode."""
    return F.coalesce(value.cast("string"), F.lit(""))


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"INTERVAL {int(hours)} HOURS")


def since(text: str) -> Column:
    """A typed literal, so that the comparison reaches the parquet scan."""
    return F.lit(text).cast("timestamp_ntz")


def percent_of(amount: Column, pct: Column, digits: int = 2) -> Column:
    """``amount * pct / 100``, rounded half up. Decimals in, decimal out; times 0.01 is exact and cheaper."""
    return F.round(amount * pct * F.lit(Decimal("0.01")), digits)


def in_list(item: Column, text: Column, sep: str = ",") -> Column:
    """Is the item one of the delimited elements?"""
    return F.array_contains(F.split(text, sep), item.cast("string"))


def list_position(item: Column, text: Column, sep: str = ",") -> Column:
    """1-based place of the item in a delimited text, 0 if absent."""
    return F.array_position(F.split(text, sep), item.cast("string"))


def ordered_concat(value: str, order_by: str, sep: str) -> Column:
    """Aggregate: values joined in order; NULL values are skipped and an all-NULL group gives NULL.

    The text of one group is held by one task. Callers reduce each group to distinct values first, so
    that its length is bounded by the vocabulary (tree depth, statuses, categories), not by the rows.
    """
    quoted = sep.replace("'", "''")
    return F.expr(f"listagg({value}, '{quoted}') WITHIN GROUP (ORDER BY {order_by})")
