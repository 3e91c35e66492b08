"""Sharding by global byte-size prefix sums (DataFrame operations only).

Rows are put in id order by a range shuffle of (id, size, checksum), never of the text, and written
once. Per-partition totals give each partition its base; a running sum inside the partition gives
each row its global byte position; the position of a row's middle against equal targets gives its
shard. Shards are therefore contiguous in id order and differ from the target by at most one row's
size at each end.

Defined cases: a null text counts no bytes and the checksum of the empty text; null ids come first;
rows with the same id are ordered by checksum, size and a fixed random number, so a hot id spreads
over partitions; an empty table gives an empty result. A size in bytes below 2**62 / shards in total
is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import estimate_partitions

from .common import pin

ROW_OVERHEAD = 16


def shard(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row; law ``bytes``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("crc"), F.rand(11).alias("tie"))
    order = ["id", "crc", "size", "tie"]
    # AQE does not split explicit range partitions, so their number follows the table
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), estimate_partitions(sized))
    ranged = sized.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = pin(ranged)  # the cut into partitions is fixed from here on

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_base"),
                          F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_base"),
                          F.sum("bytes").over(whole).alias("total"))

    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumns({"bytes_before": F.coalesce(F.sum("size").over(inside), F.lit(0)),
                                  "rows_before": F.count("*").over(inside)})
              .join(F.broadcast(bases), "part"))  # as many rows as range partitions
    placed = placed.select("id", "size", "crc", (F.col("row_base") + F.col("rows_before")).alias("place"),
                           F.least(F.lit(n_shards - 1), F.expr(
                               f"{n_shards} * (2 * (byte_base + bytes_before) + size) div (2 * total)")).cast("int").alias("shard"))
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first_place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
