"""Output types that every checker compares alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Exact decimals become doubles at the very end, and dates become ISO text."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd").alias(field.name)
        columns.append(value)
    return df.select(*columns)
