import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF1
from quarry.operators import ticks
from quarry.operators.history import with_history
from quarry.sources import derive


def plain(df, rows=10):
    w = Window.partitionBy("stock_ticker").orderBy("timestamp", "event_id")
    return df.withColumn("p", F.lag("close").over(w)).withColumn("a", F.avg("volume").over(w.rowsBetween(-rows, -1)))


def compare(a, b):
    ka = {(r["event_id"]): (r["p"], None if r["a"] is None else round(r["a"], 9)) for r in a.collect()}
    kb = {(r["event_id"]): (r["p"], None if r["a"] is None else round(r["a"], 9)) for r in b.collect()}
    assert ka == kb


@pytest.mark.parametrize("chunk", ["day", "hour", "month", None])
def test_history_chunks_equal_plain_window(spark, chunk):
    t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    got = with_history(t, "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, 10, chunk)
    compare(got, plain(t))


def test_history_hot_key_and_null_volumes(spark):
    # one ticker holds most rows, spread over many chunks; some volumes missing
    ev = spark.read.parquet(f"{SF1}/events.parquet")
    t = derive.ticks_from_events(ev).withColumn(
        "stock_ticker", F.when(F.col("stock_ticker") % 3 == 0, F.col("stock_ticker")).otherwise(F.lit(-7))
    ).withColumn("volume", F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("volume")))
    for rows_ in (1, 3, 10):
        got = with_history(t, "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, rows_, "hour")
        compare(got, plain(t, rows_))


def test_history_plan_shuffles_data_once(spark):
    """Even without broadcasts (the 100 TB case): one exchange of the data on (key, chunk),
    reused by the tails branch, and the halo join does not reshuffle the data."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
        got = with_history(t.select("stock_ticker", "timestamp", "event_id", "close", "volume"),
                           "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"})
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 1  # the tails branch reads the reused exchange
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_threshold_summary_exact_and_approx(spark):
    t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    ch = ticks.price_changes(t).cache()
    x = np.array([r[0] for r in ch.select("pct_change").collect() if r[0] is not None])
    exact = ticks.threshold_summary(ch).collect()
    for r, q in zip(exact, ticks.QUANTILES):
        v = np.quantile(x, q)
        assert abs(r["value"] - v) <= 1e-9 * max(1, abs(v))
        assert r["n_exceeding"] == int((x > r["value"]).sum())
    assert [r["percentile"] for r in exact] == list(ticks.QUANTILE_LABELS)
    approx = ticks.threshold_summary(ch, exact=False, accuracy=100000).collect()
    for a, e in zip(approx, exact):
        # rank error at most n / accuracy
        assert abs((x <= a["value"]).mean() - (x <= e["value"]).mean()) <= 2.0 / 1000 + 1.0 / len(x)


def test_anomaly_rules_literal(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(minutes=i), float(c), v, i) for i, (c, v) in
            enumerate([(100, 10), (100.6, 10), (0, 10), (5, 100), (5, 10)])]
    df = spark.createDataFrame(rows, "stock_ticker long, timestamp timestamp, close double, volume long, event_id long")
    got = {r["event_id"]: r for r in ticks.detect_anomalies(df).collect()}
    assert got[0]["anomaly_type"] == "None" and got[0]["price_change_pct"] == 0.0
    assert got[1]["anomaly_type"] == "Price"
    assert got[2]["anomaly_type"] == "Price"           # -100 %
    assert got[3]["prev_minute_close"] == 0.0 and got[3]["price_change_pct"] is None
    assert got[3]["anomaly_type"] == "Volume"          # zero previous close: no price anomaly
    assert got[4]["is_volume_anomaly"] is False


def test_auto_chunk_narrows_for_dense_keys(spark):
    from quarry.operators.history import auto_chunk

    base = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    dense = spark.range(0, 100_000).select(
        F.lit(1).alias("k"), (base + F.make_dt_interval(secs=F.col("id") / 1000)).alias("ts"))
    assert auto_chunk(dense, ["k"], "ts", target_rows=2_000_000) == "minute"
    assert auto_chunk(dense, ["k"], "ts", target_rows=10**12) == "month"
    t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    assert auto_chunk(t, ["stock_ticker"], "timestamp") == "month"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_random_series_with_null_keys(spark, seed):
    import datetime as dt

    rng = np.random.default_rng(seed)
    n = 3000
    keys = rng.choice([1, 2, 3, None], size=n, p=[0.5, 0.2, 0.2, 0.1])
    t0 = dt.datetime(2024, 1, 1)
    secs = np.sort(rng.integers(0, 6 * 3600, size=n))
    vol = rng.integers(0, 1000, size=n).astype(float)
    vol[rng.random(n) < 0.05] = np.nan
    data = [(None if k is None else int(k), t0 + dt.timedelta(seconds=int(s)), float(rng.random()),
             None if np.isnan(v) else int(v), i) for i, (k, s, v) in enumerate(zip(keys, secs, vol))]
    df = spark.createDataFrame(data, "stock_ticker long, timestamp timestamp_ntz, close double, volume long, event_id long")
    rows_ = int(rng.integers(1, 12))
    for chunk in ("minute", "hour", "auto"):
        got = with_history(df, "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, rows_, chunk)
        compare(got, plain(df, rows_))


def test_hot_key_is_spread_over_tasks(spark):
    """One key with a third of the rows: no task of the history window holds it all."""
    import datetime as dt

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        base = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
        n = 30_000
        df = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("stock_ticker"),
            (base + F.make_dt_interval(secs=F.col("id") * 3)).cast("timestamp_ntz").alias("timestamp"),
            F.rand(5).alias("close"), (F.col("id") % 97).alias("volume"), F.col("id").alias("event_id"))
        got = with_history(df, "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, 10, "hour")
        sizes = got.where(F.col("stock_ticker") == 0).groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1 and max(r["count"] for r in sizes) < n / 3 / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("chunk", ["auto", "minute", "hour", None])
def test_time_history_equals_plain_range_window(spark, chunk):
    from quarry.operators.history import with_time_history

    t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    t = t.unionByName(t.withColumn("event_id", F.col("event_id") + 10**9))  # equal timestamps inside a key
    got = with_time_history(t, "stock_ticker", "timestamp", {"a": "volume"}, 6 * 3600, chunk)
    w = Window.partitionBy("stock_ticker").orderBy(F.unix_micros(F.col("timestamp").cast("timestamp"))) \
        .rangeBetween(-6 * 3600 * 1_000_000, -1)
    want = t.withColumn("a", F.avg("volume").over(w))
    a = {r["event_id"]: r["a"] for r in got.collect()}
    b = {r["event_id"]: r["a"] for r in want.collect()}
    assert a.keys() == b.keys()
    assert all((a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-9 for k in a)


def _burst(spark, n=5000):
    """n bars within n microseconds and one a year earlier, a second key with three bars, and one without a time."""
    base = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    at = F.unix_micros(base)
    rows = spark.range(0, n + 1).select(
        F.lit(1).cast("long").alias("stock_ticker"),
        F.timestamp_micros(F.when(F.col("id") == n, at - 365 * 86_400_000_000).otherwise(at + F.col("id"))).alias("timestamp"),
        (F.col("id") % 17).cast("double").alias("close"), (F.col("id") % 97).alias("volume"), F.col("id").alias("event_id"))
    few = spark.range(0, 4).select(
        F.lit(None).cast("long").alias("stock_ticker"), F.when(F.col("id") < 3, F.timestamp_micros(at + F.col("id") * 10**12)).alias("timestamp"),
        F.lit(1.0).alias("close"), F.lit(5).cast("long").alias("volume"), (F.col("id") + 10**6).alias("event_id"))
    return rows.unionByName(few)


def test_chunks_of_a_burst_stay_within_the_target(spark):
    from quarry.operators.chunks import border_tables, with_chunks
    from quarry.operators.history import _keyed

    rows = _keyed(_burst(spark), ["stock_ticker"], "timestamp")
    for target in (100, 10, 4000):
        tables = border_tables(rows, target)
        sizes = with_chunks(rows, tables).groupBy("_gk", "_chunk").agg(
            F.count("*").alias("n"), F.min("_t").alias("lo"), F.max("_t").alias("hi")).collect()
        assert max(r["n"] for r in sizes) <= target
        assert sum(r["_gk"]["stock_ticker"] is None for r in sizes) == 1  # the sparse key is one chunk
        mine = sorted((r["lo"], r["hi"], tuple(r["_chunk"])) for r in sizes if r["_gk"]["stock_ticker"] == 1)
        assert all(a[1] < b[0] and a[2] < b[2] for a, b in zip(mine, mine[1:]))  # chunks follow time
    assert border_tables(rows, 10_000) == []


def test_one_instant_stays_one_chunk(spark):
    from quarry.operators.chunks import border_tables, with_chunks

    rows = spark.range(0, 3000).select(F.struct(F.lit(1).alias("k")).alias("_gk"),
                                       F.when(F.col("id") < 2500, F.lit(7)).otherwise(F.col("id")).cast("long").alias("_t"))
    sizes = [r["n"] for r in with_chunks(rows, border_tables(rows, 50)).groupBy("_gk", "_chunk").agg(F.count("*").alias("n")).collect()]
    assert sorted(sizes)[-1] <= 2550 and sorted(sizes)[-2] <= 50


def test_equal_depth_history_equals_plain_window(spark):
    t = _burst(spark).where(F.col("timestamp").isNotNull())
    for target in (100, 7):
        got = with_history(t, "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, 10, "auto", target_rows=target)
        compare(got, plain(t))
    ev = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    compare(with_history(ev, "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, 10, "auto", target_rows=20), plain(ev))


def test_sparse_keys_need_one_shuffle(spark):
    t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    got = with_history(t, "stock_ticker", ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, 10, "auto")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    physical = got._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and physical.count("Window") == 1


def _range_averages(df, got, seconds, cols):
    w = Window.partitionBy("stock_ticker").orderBy(F.unix_micros(F.col("timestamp").cast("timestamp"))) \
        .rangeBetween(-int(seconds * 1_000_000), -1)
    want = df.withColumns({n: F.when(F.col("timestamp").isNotNull(), F.avg(c).over(w)) for n, c in cols.items()})
    a = {r["event_id"]: [r[n] for n in cols] for r in got.collect()}
    b = {r["event_id"]: [r[n] for n in cols] for r in want.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None), k
            if x is not None:
                assert x == y or (x != x and y != y) or abs(x - y) <= 1e-9 * max(1.0, abs(y)), (k, x, y)


@pytest.mark.parametrize("seconds", [0.0005, 600, 10 * 86400])
def test_linear_range_average_over_chunks_of_any_size(spark, seconds):
    from quarry.operators.history import with_time_history

    t = _burst(spark, 1500)
    for target in (50, 10**6):
        _range_averages(t, with_time_history(t, "stock_ticker", "timestamp", {"a": "volume", "c": "close"}, seconds, target_rows=target),
                        seconds, {"a": "volume", "c": "close"})
    ev = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    _range_averages(ev, with_time_history(ev, "stock_ticker", "timestamp", {"a": "close"}, seconds, target_rows=30), seconds, {"a": "close"})


def test_range_average_takes_odd_numbers_back(spark):
    from quarry.operators.history import with_time_history

    odd = [0.1, float("nan"), None, 1e300, float("inf"), -5.0, float("-inf"), 0.2, 1e16, 0.3, 1e-9, None, 0.7, 2.5, 1e15, 3.5]
    rows = [(1, i * 1_000_000, v, i) for i, v in enumerate(odd)]
    t = spark.createDataFrame(rows, "stock_ticker long, us long, v double, event_id long").select(
        "stock_ticker", F.timestamp_micros("us").alias("timestamp"), "v", "event_id")
    got = {r["event_id"]: r["a"] for r in with_time_history(t, "stock_ticker", "timestamp", {"a": "v"}, 2.0).collect()}
    for i in range(len(odd)):
        held = [v for v in odd[max(0, i - 2):i] if v is not None]
        want = sum(held) / len(held) if held else None
        assert got[i] == want or (want is not None and want != want and got[i] != got[i]) or abs(got[i] - want) <= 1e-12 * abs(want), i


def test_range_average_is_linear(spark):
    import time

    from quarry.operators.history import with_time_history

    def seconds(n):
        base = F.unix_micros(F.to_timestamp(F.lit("2024-01-01 00:00:00")))
        t = spark.range(0, n).select(F.lit(1).alias("k"), F.timestamp_micros(base + F.col("id")).alias("ts"), (F.col("id") % 97).alias("v"))
        out = with_time_history(t, "k", "ts", {"a": "v"}, 3600, chunk=None)  # all rows lie in one range
        t0 = time.time()
        out.write.format("noop").mode("overwrite").save()
        return time.time() - t0

    seconds(1000)
    assert seconds(400_000) <= 5 * max(seconds(100_000), 0.5)
