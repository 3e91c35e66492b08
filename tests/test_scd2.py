import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF1, rows
from quarry.operators.scd2 import BadKeysError, scd2_merge
from quarry.plans.scd2_sql import scd2_merge_sql
from quarry.sources import derive

TS = "customer_id bigint, name string, city string, record_id bigint, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz"
OPEN = dt.datetime(9999, 12, 31)
T0 = dt.datetime(2020, 1, 1)
ASOF = "2024-01-01 00:00:00"
A = dt.datetime(2024, 1, 1)
ARGS = dict(keys=["customer_id"], tracked=["name", "city"], id_col="record_id", as_of=ASOF)


def merge_both(spark, target, source, **kw):
    args = dict(ARGS, **kw)
    a = scd2_merge(target, source, **args)
    b = scd2_merge_sql(spark, target, source, **args)
    ra, rb = rows(a), rows(b)
    assert ra == rb, "DataFrame and SQL forms differ"
    return ra


def test_truth_table(spark):
    target = spark.createDataFrame([
        (1, "a", "X", 1, T0, OPEN),          # unchanged
        (2, "b", "X", 2, T0, OPEN),          # changed city
        (3, "c", None, 3, T0, OPEN),         # null -> value is a change
        (4, "d", "X", 4, T0, OPEN),          # deleted
        (5, "e", "X", 5, dt.datetime(2019, 1, 1), T0),  # expired only; key reappears
        (2, "b", "OLD", 6, dt.datetime(2019, 1, 1), T0),  # history of a changed key stays
    ], TS)
    source = spark.createDataFrame([
        (1, "a", "X"), (2, "b", "Y"), (3, "c", "Z"), (5, "e", "W"), (6, "f", "V"),
    ], "customer_id bigint, name string, city string")
    got = merge_both(spark, target, source)
    want = sorted([
        (1, "a", "X", 1, T0, OPEN),
        (2, "b", "X", 2, T0, A),
        (3, "c", None, 3, T0, A),
        (4, "d", "X", 4, T0, A),
        (5, "e", "X", 5, dt.datetime(2019, 1, 1), T0),
        (2, "b", "OLD", 6, dt.datetime(2019, 1, 1), T0),
        (2, "b", "Y", 7, A, OPEN),    # changed keys first, by key
        (3, "c", "Z", 8, A, OPEN),
        (5, "e", "W", 9, A, OPEN),    # then new keys, by key
        (6, "f", "V", 10, A, OPEN),
    ], key=repr)
    assert got == want


def test_value_to_null_is_a_change(spark):
    target = spark.createDataFrame([(1, "a", "X", 1, T0, OPEN)], TS)
    source = spark.createDataFrame([(1, "a", None)], "customer_id bigint, name string, city string")
    got = merge_both(spark, target, source)
    assert (1, "a", None, 2, A, OPEN) in got and (1, "a", "X", 1, T0, A) in got


def test_empty_target(spark):
    target = spark.createDataFrame([], TS)
    source = spark.createDataFrame([(2, "b", "Y"), (1, "a", "X")], "customer_id bigint, name string, city string")
    got = merge_both(spark, target, source)
    assert got == [(1, "a", "X", 1, A, OPEN), (2, "b", "Y", 2, A, OPEN)]


def test_composite_key(spark):
    schema = "k1 bigint, k2 string, v string, rid bigint, s timestamp_ntz, e timestamp_ntz"
    target = spark.createDataFrame([(1, "x", "a", 1, T0, OPEN), (1, "y", "a", 2, T0, OPEN)], schema)
    source = spark.createDataFrame([(1, "x", "a"), (1, "y", "b"), (2, "x", "c")], "k1 bigint, k2 string, v string")
    kw = dict(keys=["k1", "k2"], tracked=["v"], id_col="rid", as_of=ASOF, start_col="s", end_col="e")
    a = rows(scd2_merge(target, source, **kw))
    b = rows(scd2_merge_sql(spark, target, source, **kw))
    assert a == b
    assert (1, "y", "b", 3, A, OPEN) in a and (2, "x", "c", 4, A, OPEN) in a and len(a) == 4


def test_bad_keys(spark):
    target = spark.createDataFrame([(1, "a", "X", 1, T0, OPEN)], TS)
    source = spark.createDataFrame([(1, "a", "Y"), (1, "a", "Z"), (None, "n", "N"), (2, "b", "B")],
                                   "customer_id bigint, name string, city string")
    with pytest.raises(BadKeysError):
        scd2_merge(target, source, **ARGS)
    got = rows(scd2_merge(target, source, on_bad_keys="drop", **ARGS))
    # key 1 is duplicated in the source: dropped, so the active row is closed
    assert got == sorted([(1, "a", "X", 1, T0, A), (2, "b", "B", 2, A, OPEN)], key=repr)


def test_bad_stored_keys_survive_in_both_forms(spark):
    target = spark.createDataFrame([(1, "a", "X", 1, T0, OPEN), (None, "n", "N", 2, T0, OPEN), (3, "c", "P", 3, T0, OPEN),
                                    (3, "c", "Q", 4, T0, OPEN), (3, "c", "O", 5, T0, T0)], TS)
    source = spark.createDataFrame([(1, "a", "Y"), (3, "c", "R"), (4, "d", "D")], "customer_id bigint, name string, city string")
    for merge in (scd2_merge, lambda t, s, **kw: scd2_merge_sql(spark, t, s, **kw)):
        with pytest.raises(BadKeysError):
            merge(target, source, **ARGS)
        got = rows(merge(target, source, on_bad_keys="drop", **ARGS))
        assert got == sorted([(1, "a", "X", 1, T0, A), (1, "a", "Y", 6, A, OPEN), (None, "n", "N", 2, T0, OPEN), (3, "c", "P", 3, T0, OPEN),
                              (3, "c", "Q", 4, T0, OPEN), (3, "c", "O", 5, T0, T0), (4, "d", "D", 7, A, OPEN)], key=repr)


def test_invariants_on_customer(spark):
    c = spark.read.parquet(f"{SF1}/customer.parquet")
    target, source = derive.scd_target_from_customer(c), derive.scd_source_from_customer(c)
    out = scd2_merge(target, source, **ARGS).cache()
    open_ = out.where(F.col("effective_end_date") == F.lit(OPEN))
    assert open_.groupBy("customer_id").count().where("count > 1").count() == 0
    assert out.select("record_id").distinct().count() == out.count()
    max_before = target.agg(F.max("record_id")).first()[0]
    new_ids = sorted(r[0] for r in out.where(F.col("record_id") > max_before).select("record_id").collect())
    assert new_ids == list(range(max_before + 1, max_before + 1 + len(new_ids)))
    hist = target.where(F.col("effective_end_date") != F.lit(OPEN))
    assert hist.subtract(out).count() == 0
    again = scd2_merge(out, source, **ARGS)
    assert rows(again) == rows(out)


def test_each_side_is_shuffled_once(spark):
    """Key checks add no exchange to the join: one for the open rows, one for the source."""
    from quarry.operators.scd2 import classified

    c = spark.read.parquet(f"{SF1}/customer.parquet")
    target, source = derive.scd_target_from_customer(c), derive.scd_source_from_customer(c)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("error", "drop"):
            is_open = F.col("effective_end_date").eqNullSafe(F.lit(derive.SENTINEL).cast(target.schema["effective_end_date"].dataType))
            joined = classified(target.where(is_open), source, ["customer_id"], ["name", "city"], mode)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 2 and "Exchange SinglePartition" not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("pin", ["table", "checkpoint", "persist"])
def test_both_forms_agree_on_bad_keys_for_every_pin(spark, pin):
    target = spark.createDataFrame([(1, "a", "X", 1, T0, OPEN), (None, "n", "N", 9, T0, OPEN), (3, "c", "P", 3, T0, OPEN),
                                    (3, "c", "Q", 4, T0, OPEN), (5, "e", "E", 2, T0, OPEN), (3, "c", "O", 5, T0, T0)], TS)
    source = spark.createDataFrame([(1, "a", "Y"), (3, "c", "R"), (4, "d", "D"), (None, "n", "M"), (6, "f", "F"), (6, "f", "G"), (5, "e", "E")],
                                   "customer_id bigint, name string, city string")
    want = sorted([(1, "a", "X", 1, T0, A), (1, "a", "Y", 10, A, OPEN), (None, "n", "N", 9, T0, OPEN), (3, "c", "P", 3, T0, OPEN),
                   (3, "c", "Q", 4, T0, OPEN), (3, "c", "O", 5, T0, T0), (4, "d", "D", 11, A, OPEN), (5, "e", "E", 2, T0, OPEN)], key=repr)
    for merge in (scd2_merge, lambda t, s, **kw: scd2_merge_sql(spark, t, s, **kw)):
        assert rows(merge(target, source, on_bad_keys="drop", pin=pin, **ARGS)) == want
        for bad in (target.where("record_id <> 9"), target.where("customer_id = 1 or customer_id is null")):
            with pytest.raises(BadKeysError):
                merge(bad, source.where("customer_id < 5"), pin=pin, **ARGS)
        assert len(rows(merge(target.limit(0), source.limit(0), pin=pin, **ARGS))) == 0
