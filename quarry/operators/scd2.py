"""Type-2 slowly changing dimension merge (DataFrame form).

Per business key, with null-safe comparison of the tracked columns:

| active row | in source | tracked equal | output                                        |
|------------|-----------|---------------|-----------------------------------------------|
| yes        | yes       | yes           | active row kept                               |
| yes        | yes       | no            | active row closed at as_of; new open version  |
| yes        | no        | -             | active row closed at as_of                    |
| no         | yes       | -             | new open version                              |
| expired rows (history) are always kept untouched                           |

One full outer join of active rows and source classifies every key in one
shuffle of each side; the classified rows are pinned once so that join runs once. Repeated keys are
counted in the join's own partitions, so the checks need no shuffle. New versions get dense ids after the current maximum, changed keys
first then new keys, each in key order, numbered without a single-partition
window (``quarry.operators.ranks.dense_ids``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranks import dense_ids
from quarry.session import materialize

# Fixed value: the end date that marks the open version.
SENTINEL = "9999-12-31 00:00:00"


class BadKeysError(ValueError):
    pass


def null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def raise_bad_keys(joined: DataFrame, keys: list[str]) -> None:
    """Raise if the pinned classified join holds a null or repeated key (a scan of two of its columns)."""
    most = joined.agg(F.max("_tn").alias("t"), F.max("_sn").alias("s")).first()
    for n, what in ((most["s"], "source"), (most["t"], "active target")):
        if (n or 0) > 1:
            raise BadKeysError(f"{what} has null or duplicate keys {keys}")


def _same(cols: list[str], left: str, right: str) -> Column:
    if not cols:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])


def classified(active: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], on_bad_keys: str) -> DataFrame:
    """Open rows (``t__`` columns) and source rows (``s__``) joined by key, with ``_in_t``, ``_kind``, ``_tn`` and ``_sn``.

    ``_kind``: insert, delete, keep, change, untouched (open rows of a bad key), left_out (source rows of one).
    ``_tn`` and ``_sn`` are the rows of the key on each side, over 1 for null keys too. They are windows over
    the keys, whose partitions the join reuses: each side is shuffled once. Of a repeated source key one row is
    joined; rows without a key are not shuffled at all.
    """
    tcols, scols = active.columns, source.columns
    if on_bad_keys == "ignore":
        t, s = (df.withColumn("_n", F.lit(1).cast("bigint")) for df in (active, source))
    else:
        by = Window.partitionBy(*keys)
        t, s = (df.where(~null_key(keys)).withColumn("_n", F.count(F.lit(1)).over(by)) for df in (active, source))
        s = s.withColumn("_r", F.row_number().over(by.orderBy(*keys))).where(F.col("_r") == 1).drop("_r")
    t, s = t.withColumn("_in_t", F.lit(True)).alias("t"), s.withColumn("_in_s", F.lit(True)).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    in_t, bad_s = F.col("t._in_t").isNotNull(), F.col("s._n") > 1
    kind = (
        F.when(F.col("t._n") > 1, F.lit("untouched"))
        .when(~in_t, F.when(bad_s, F.lit("left_out")).otherwise(F.lit("insert")))
        .when(F.col("s._in_s").isNull() | bad_s, F.lit("delete"))
        .when(_same(tracked, "t", "s"), F.lit("keep"))
        .otherwise(F.lit("change"))
    )
    joined = t.join(s, on, "full_outer").select(
        *[F.col(f"t.{c}").alias(f"t__{c}") for c in tcols], *[F.col(f"s.{c}").alias(f"s__{c}") for c in scols],
        in_t.alias("_in_t"), kind.alias("_kind"), F.col("t._n").alias("_tn"), F.col("s._n").alias("_sn"))
    if on_bad_keys == "ignore":
        return joined
    two = F.lit(2).cast("bigint")
    lost_t = active.where(null_key(keys)).select(*[F.col(c).alias(f"t__{c}") for c in tcols], F.lit(True).alias("_in_t"),
                                                 F.lit("untouched").alias("_kind"), two.alias("_tn"))
    lost_s = source.where(null_key(keys)).select(*[F.col(c).alias(f"s__{c}") for c in scols], F.lit(False).alias("_in_t"),
                                                 F.lit("left_out").alias("_kind"), two.alias("_sn"))
    return joined.unionByName(lost_t, allowMissingColumns=True).unionByName(lost_s, allowMissingColumns=True)


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    id_col: str = "record_id",
    as_of: str = None,
    start_col: str = "effective_start_date",
    end_col: str = "effective_end_date",
    sentinel: str = SENTINEL,
    on_bad_keys: str = "error",
    pin: str = "table",
) -> DataFrame:
    """Merge a source snapshot into a versioned dimension (see module doc).

    ``as_of`` is required so a re-run gives the same rows. Output has the
    target's columns in the target's order. Null or repeated keys raise (``error``), are joined as they are
    (``ignore``), or with ``drop`` never remove a stored version: open rows with a null or repeated key stay as
    they are, and source rows without a key, with a repeated one or with that of such an open row are left out.
    """
    if as_of is None:
        raise ValueError("as_of is required")
    keys, tracked = list(keys), list(tracked)
    tcols = target.columns
    ts_type = target.schema[end_col].dataType
    sent = F.lit(sentinel).cast(ts_type)
    asof = F.lit(as_of).cast(ts_type)
    if on_bad_keys not in ("error", "drop", "ignore"):
        raise ValueError(f"unknown on_bad_keys {on_bad_keys!r}")
    is_open = F.col(end_col).eqNullSafe(sent)
    scols = source.columns
    # The classified join feeds two outputs that are computed by different
    # actions (numbering the new versions, then the final union); pinning it
    # once means the full outer join runs once.
    joined = materialize(classified(target.where(is_open), source, keys, tracked, on_bad_keys), pin)
    if on_bad_keys == "error":
        raise_bad_keys(joined, keys)
    max_id = target.agg(F.max(id_col)).first()[0] or 0
    history = target.where(~is_open)

    closes = F.col("_kind").isin("change", "delete")
    old = joined.where(F.col("_in_t")).select(
        *[
            F.when(closes, asof).otherwise(F.col(f"t__{c}")).alias(c) if c == end_col else F.col(f"t__{c}").alias(c)
            for c in tcols
        ]
    )
    fresh = joined.where(F.col("_kind").isin("change", "insert")).select(
        *[F.col(f"s__{c}").alias(c) for c in tcols if c in set(scols) and c not in (id_col, start_col, end_col)],
        asof.alias(start_col),
        sent.alias(end_col),
        F.when(F.col("_kind") == "change", 0).otherwise(1).alias("_grp"),
    )
    fresh = dense_ids(fresh, ["_grp", *keys], id_col, offset=int(max_id), pin=pin).drop("_grp")
    fresh = fresh.select(
        *[F.col(c) if c in fresh.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in tcols]
    )
    id_type = target.schema[id_col].dataType
    return (
        history.unionByName(old)
        .unionByName(fresh.withColumn(id_col, F.col(id_col).cast(id_type)))
    )
