"""Rows as plain tuples, money as text without trailing zeros, times as text."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal


def tidy(value):
    if isinstance(value, Decimal):
        text = format(value, "f")
        return text.rstrip("0").rstrip(".") if "." in text else text
    if isinstance(value, datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S")
    return value


def rows(df, *columns):
    if columns:
        df = df.select(*columns)
    return sorted((tuple(tidy(v) for v in r) for r in df.collect()), key=repr)


def as_map(df, key, *columns):
    return {r[0]: (r[1] if len(columns) == 1 else r[1:]) for r in rows(df, key, *columns)}
