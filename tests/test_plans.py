"""Plan shape checks: the properties the build relies on at scale."""

from conftest import SF1
from quarry.plans import queries as Q


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_buckets_stay_in_the_jvm_and_aggregate_partially(spark):
    plan = Q.q_time_bucket_counts(spark, SF1)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("HashAggregate") >= 2  # partial before the shuffle, final after


def test_scans_read_only_needed_columns(spark):
    plan = Q.q_time_bucket_counts(spark, SF1)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan or "struct<ts:timestamp_ntz>" in plan
    plan = Q.q_dense_ids(spark, SF1)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan


def test_clean_bars_pushes_null_checks_to_the_scan(spark):
    from pyspark.sql import functions as F

    from quarry.operators.clean import clean_bars

    raw = spark.read.parquet(f"{SF1}/events.parquet").select(
        F.col("user_id").alias("stock_ticker"), F.col("ts").alias("timestamp"), *[
            F.col("value").alias(c) for c in ("open", "high", "low", "close")], F.col("event_id").alias("volume"))
    good, _ = clean_bars(raw, carry=["stock_ticker"])
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(value), IsNotNull(event_id)]" in plan


def test_anomaly_window_shuffles_the_data_once(spark):
    """Sparse keys: one scan, one shuffle, no join. A large key: its chunks' tails reuse the data's exchange."""
    from quarry.operators.history import with_history
    from quarry.operators.ticks import detect_anomalies
    from quarry.sources import derive

    t = derive.ticks_from_events(spark.read.parquet(f"{SF1}/events.parquet"))
    plan = detect_anomalies(t)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = with_history(t.select("stock_ticker", "timestamp", "event_id", "close", "volume"), "stock_ticker",
                           ["timestamp", "event_id"], {"p": "close"}, {"a": "volume"}, chunk="auto", target_rows=20)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "ReusedExchange" in plan and plan.count("events.parquet") == 1
