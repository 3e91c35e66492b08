import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF1
from quarry.operators.ranks import dense_ids, exact_quantiles, global_positions


def test_dense_ids_equal_row_number(spark):
    orders = spark.read.parquet(f"{SF1}/orders.parquet").select("o_orderkey", "o_orderdate")
    got = dense_ids(orders, ["o_orderdate", "o_orderkey"], "id", offset=100, num_partitions=6)
    want = orders.withColumn("id", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")) + 100)
    a = {(r[0], r[1]) for r in got.select("o_orderkey", "id").collect()}
    b = {(r[0], r[1]) for r in want.select("o_orderkey", "id").collect()}
    assert a == b


def test_dense_ids_plan_has_no_single_partition_over_data(spark):
    orders = spark.read.parquet(f"{SF1}/orders.parquet").select("o_orderkey")
    plan = dense_ids(orders, ["o_orderkey"], "id")._jdf.queryExecution().executedPlan().toString()
    # The numbered rows come from a pinned range-partitioned scan; only the
    # per-partition count table (one row per partition) is gathered.
    assert "BroadcastExchange" in plan


def test_positions_with_ties_are_a_permutation(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("v"))
    pos = [r[0] for r in global_positions(df, ["v"], num_partitions=7).select("_pos").collect()]
    assert sorted(pos) == list(range(5000))


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25)])  # a third of rows share one value
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    qs = [0.0, 0.1, 0.5, 0.95, 0.99995, 1.0]
    got = exact_quantiles(df, "x", qs, num_partitions=5)
    want = np.quantile(vals, qs, method="linear")
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_exact_quantiles_empty(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]


def test_range_partitions_follow_data_size(spark):
    from quarry.session import estimate_partitions

    li = spark.read.parquet(f"{SF1}/lineitem.parquet")
    small = estimate_partitions(li, target_bytes=1 << 40)
    assert small == spark.sparkContext.defaultParallelism
    size = int(str(li._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    big = estimate_partitions(li, target_bytes=16 << 10)
    assert big == max(spark.sparkContext.defaultParallelism, -(-size // (16 << 10)))
    assert estimate_partitions(li, target_bytes=1, max_partitions=50) == 50


def test_selection_with_heavy_ties_and_narrow_sketches(spark):
    from quarry.operators.ranks import values_at_ranks

    rng = np.random.default_rng(11)
    vals = np.concatenate([np.full(9000, 0.5), np.full(300, -1.0), rng.normal(size=7000), np.full(4000, 2.0)])
    df = spark.createDataFrame([(float(v),) for v in vals], "_v double").repartition(5)
    order = np.sort(vals)
    ranks = [0, 1, 299, 300, 5000, 10_149, 10_150, 16_299, 20_298, 20_299]
    for accuracy, limit in ((10_000, 100_000), (20, 100_000), (20, 300), (100, 50)):  # several rounds of narrowing
        got = values_at_ranks(df, ranks, len(vals), float(order[0]), float(order[-1]), accuracy, limit)
        assert [got[r] for r in ranks] == [order[r] for r in ranks]


def test_selection_of_equal_values_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.5,)] * 500 + [(None,)] * 100, "x double")
    assert exact_quantiles(df, "x", [0.0, 0.3, 1.0]) == [1.5, 1.5, 1.5]
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(float("nan"),)], "x double")
    got = exact_quantiles(df, "x", [0.0, 0.5, 1.0])
    assert got[:2] == [0.0, 4.5] and got[2] != got[2]
    assert exact_quantiles(spark.createDataFrame([(3,), (1,), (2,)], "x int"), "x", [0.25, 0.5]) == [1.5, 2]


def test_quantiles_shuffle_no_column(spark):
    """The plans before the pin and of the scans hold no range exchange and no sort."""
    df = spark.range(0, 1000).select(F.rand(3).alias("x"))
    _, values = exact_quantiles(df, "x", [0.5], return_values=True)
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_partition_estimate_of_a_join_is_bounded_by_its_inputs(spark):
    from quarry.session import estimate_partitions

    li = spark.read.parquet(f"{SF1}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF1}/orders.parquet")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey).join(orders.select(F.col("o_custkey").alias("c")), F.col("c") == F.col("o_custkey"))
    size = sum(int(str(x._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for x in (li, orders, orders))
    got = estimate_partitions(joined, target_bytes=16 << 10)
    assert got <= max(spark.sparkContext.defaultParallelism, -(-size // (16 << 10)))


def test_dense_ids_over_a_join_use_few_partitions(spark):
    from quarry.operators import ticks
    from quarry.session import estimate_partitions
    from quarry.sources import derive

    t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    changes = ticks.price_changes(t, chunk="day")  # joins each chunk's halo
    assert estimate_partitions(changes) <= 2 * spark.sparkContext.defaultParallelism
