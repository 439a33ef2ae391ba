"""CSV export in the layout spreadsheet users expect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.sources.tables import ordered


def export_csv(
    df: DataFrame, path: str, order: Sequence[str], one_file: bool = False, compression: str = "none"
) -> None:
    """Write ``df`` ordered, UTF-8, header on every part, quotes doubled, NULL as nothing.

    Booleans print as 1 and 0, timestamps to the second. The parts follow the order (part 0 holds the
    lowest keys). ``one_file`` puts the whole result through a single task: only for results one task can
    hold. An empty frame still gets its header.
    """
    flags = {name for name, kind in df.dtypes if kind == "boolean"}
    columns = [F.col(f"`{c}`").cast("int").alias(c) if c in flags else F.col(f"`{c}`") for c in df.columns]
    result = ordered(df, order).select(*columns)
    if one_file:
        result = result.coalesce(1)
    (
        result.write.mode("overwrite")
        .options(header=True, escape='"', emptyValue="", encoding="UTF-8", compression=compression,
                 timestampNTZFormat="yyyy-MM-dd HH:mm:ss", timestampFormat="yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
