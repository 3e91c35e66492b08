"""Turn a table into a directory of files that a file stream picks up in order.

Test and replay helper: rows are written in ``arrival`` order, one write per
arrival group, so file modification times follow arrival order. The number of
groups is a parameter, not a function of the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_arrivals(df: DataFrame, arrival: str, path: str, fmt: str = "parquet") -> list[int]:
    """Write the rows of each ``arrival`` value (ascending) as one append."""
    df = df.persist()  # one scan of the input for all groups
    try:
        groups = [r[0] for r in df.select(arrival).distinct().orderBy(arrival).collect()]
        for g in groups:
            df.where(F.col(arrival) == g).drop(arrival).coalesce(1).write.mode("append").format(fmt).save(path)
    finally:
        df.unpersist()
    return groups
