"""Time chunks of bounded size per key, cut at borders of equal depth.

A key's rows are spread unevenly over time (a burst may hold thousands of rows in a few milliseconds
after a silent year), so chunks of one length are too large in some places and too small in others.
Here the borders come from the rows themselves: keys with at most ``target`` rows stay whole; every
larger key gets a histogram of ``BUCKETS`` buckets of equal depth (one bounded quantile sketch per key),
and a bucket that may still exceed ``target`` is refined by a histogram of its own, level by level, until none does.

A level is one aggregate over the rows of the buckets still too large, and one small pinned table:
at most ``rows / target`` sketches of ``BUCKETS`` borders. A table without large keys costs one count
per key and nothing else. Rows of one key at one instant stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

BUCKETS = 64
ACCURACY = 100 * BUCKETS  # a sketch's rank error is at most 1 / ACCURACY of its rows
MAX_LEVELS = 8

KEY, TIME, CHUNK = "_gk", "_t", "_chunk"


def _bucket(borders: Column, t: Column) -> Column:
    """Number of borders at or before ``t``; 0 without borders or time."""
    return F.when(borders.isNotNull() & t.isNotNull(), F.size(F.filter(borders, lambda b: b <= t))).otherwise(F.lit(0))


def _descend(rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Add ``_c0``, ``_c1``, ...: the bucket of each level (0 below a bucket that was not refined)."""
    for level, table in enumerate(tables):
        on = [KEY, *[f"_c{i}" for i in range(level)]]
        rows = rows.join(table.select(*on, "_borders"), on, "left")
        rows = rows.withColumn(f"_c{level}", _bucket(F.col("_borders"), F.col(TIME))).drop("_borders")
    return rows


def border_tables(rows: DataFrame, target: int) -> list[DataFrame]:
    """The levels of the border tree of ``rows`` (``_gk`` struct, ``_t`` long): none if no key exceeds ``target``.

    Level ``i`` has one row per refined bucket: ``_gk``, ``_c0`` .. ``_c(i-1)``, ``_borders`` (array of long).
    """
    if target < 1:
        raise ValueError("target must be >= 1")
    rows = rows.select(KEY, TIME)
    timed = rows.where(F.col(TIME).isNotNull())
    large = timed.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target)
    parents = materialize(large.select(KEY), "table")
    tables: list[DataFrame] = []
    grid = [i / BUCKETS for i in range(1, BUCKETS)]
    while len(tables) < MAX_LEVELS and not parents.isEmpty():
        path = [KEY, *[f"_c{i}" for i in range(len(tables))]]
        level = (
            _descend(timed.join(parents.select(KEY).distinct(), KEY, "left_semi"), tables)
            .join(parents, path, "left_semi")
            .groupBy(*path)
            .agg(F.count(F.lit(1)).alias("_n"), F.min(TIME).alias("_lo"), F.max(TIME).alias("_hi"),
                 F.percentile_approx(TIME, grid, ACCURACY).alias("_b"))
            .where((F.col("_n") > target) & (F.col("_lo") < F.col("_hi")))
        )
        # as few of the borders as keep every bucket within the target, sketch error included
        step = F.greatest(F.lit(1), F.floor(BUCKETS * (target / F.col("_n") - 3.0 / ACCURACY)).cast("int"))
        kept = F.filter(F.col("_b"), lambda b, i: ((i + 1) % step == 0) & (b > F.col("_lo")))
        # a sketch with one heavy instant may give no border above the first time; the last time then is one
        kept = F.when(F.size(kept) > 0, F.array_sort(F.array_distinct(kept))).otherwise(F.array(F.col("_hi")))
        done = F.col("_n") * (1.0 / BUCKETS + 3.0 / ACCURACY) <= target
        table = materialize(level.select(*path, "_n", kept.alias("_borders"), done.alias("_done")), "table")
        tables.append(table)
        # buckets of a large parent, or around a heavy instant, are counted again; the others are within the target
        open_ = table.where(~F.col("_done") | (F.size("_borders") < BUCKETS // 2) & (F.col("_n") > 2 * target)).select(*path)
        nxt = [*path, f"_c{len(tables) - 1}"]
        counted = (
            _descend(timed.join(open_.select(KEY).distinct(), KEY, "left_semi"), tables)
            .join(open_, path, "left_semi").groupBy(*nxt)
            .agg(F.count(F.lit(1)).alias("_n"), F.min(TIME).alias("_lo"), F.max(TIME).alias("_hi"))
        )
        if open_.isEmpty():
            break
        parents = materialize(counted.where((F.col("_n") > target) & (F.col("_lo") < F.col("_hi"))).select(*nxt), "table")
    return tables


def with_chunks(rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``rows`` (with ``_gk`` and ``_t``) and their ``_chunk``, a struct that never falls as time grows."""
    found = _descend(rows, tables)
    names = [f"_c{i}" for i in range(len(tables))]
    chunk = F.struct(*[F.col(c) for c in names]) if names else F.struct(F.lit(0).alias("_c0"))
    return found.withColumn(CHUNK, chunk).drop(*names)
