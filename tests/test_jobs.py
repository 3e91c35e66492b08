import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF0, rows
from quarry.operators import buckets, clean, scd2, ticks
from quarry.plans import jobs
from quarry.sources import derive


def test_click_counter_job(spark):
    d = tempfile.mkdtemp(prefix="quarry-clicks-")
    clicks = derive.clicks_from_events(spark.read.parquet(f"{SF0}/events.parquet"))
    clicks.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{d}/in")
    out = jobs.click_counter_job(spark, f"{d}/in", f"{d}/out")
    assert rows(out) == rows(buckets.time_bucket_counts(clicks, "Time"))
    back = spark.read.csv(f"{d}/out").collect()
    assert sum(int(r[1]) for r in back) == clicks.count()


def test_stock_threshold_job_reads_ticker_from_file_name(spark):
    d = tempfile.mkdtemp(prefix="quarry-bars-")
    ev = spark.read.parquet(f"{SF0}/events.parquet")
    users = sorted(r[0] for r in ev.select("user_id").distinct().collect())[:3]
    ev = ev.where(F.col("user_id").isin(users))
    pdf = derive.ticks_from_events(ev).toPandas()
    for t, g in pdf.groupby("stock_ticker"):
        g[["timestamp", "open", "high", "low", "close", "volume"]].to_csv(os.path.join(d, f"T{t}.csv"), index=False)
    with open(os.path.join(d, "BAD.csv"), "w") as f:
        f.write("timestamp,open,high,low,close,volume\n2024-01-01 00:00:00,1,1,1,oops,5\n,1,1,1,1,1\n")
    report = jobs.stock_threshold_job(spark, f"{d}/*.csv", f"{d}/out")
    got = report.collect()
    assert [r[0] for r in got] == list(ticks.QUANTILE_LABELS)
    assert report.columns == list(ticks.REPORT_COLUMNS)
    bars, bad = clean.load_bars(spark, f"{d}/*.csv")
    assert sorted(r[0] for r in bars.select("stock_ticker").distinct().collect()) == sorted(f"T{u}" for u in users)
    assert bad.count() == 2


def test_scd2_csv_job(spark):
    d = tempfile.mkdtemp(prefix="quarry-scd-")
    c = spark.read.parquet(f"{SF0}/customer.parquet")
    target, source = derive.scd_target_from_customer(c), derive.scd_source_from_customer(c)
    target.write.option("header", True).csv(f"{d}/target")
    source.write.option("header", True).csv(f"{d}/source")
    kw = dict(keys=["customer_id"], tracked=["name", "city"], id_col="record_id", as_of=derive.SCD_AS_OF)
    for sql in (False, True):
        out = jobs.scd2_csv_job(spark, f"{d}/source", f"{d}/target", f"{d}/out{int(sql)}",
                                source_schema=source.schema, target_schema=target.schema, sql=sql, **kw)
        assert rows(out) == rows(scd2.scd2_merge(target, source, **kw))


def test_tune_tree_job_on_libsvm(spark):
    d = tempfile.mkdtemp(prefix="quarry-svm-")
    vecs = derive.vectors_from_embeddings(spark.read.parquet(f"{SF0}/embeddings.parquet"))
    train, test = vecs.randomSplit([0.7, 0.3], seed=3)
    train.select("label", "features").write.format("libsvm").save(f"{d}/train")
    test.select("label", "features").write.format("libsvm").save(f"{d}/test")
    dim = len(vecs.first()["features"])
    out = jobs.tune_tree_job(spark, f"{d}/train", f"{d}/test", {"maxDepth": [1, 2], "maxBins": [8]}, folds=2,
                             num_features=dim)
    assert set(out["best"]) == {"maxDepth", "maxBins"} and len(out["grid"]) == 2
    assert 0.0 <= out["train_weighted_precision"] <= 1.0 and 0.0 <= out["test_weighted_precision"] <= 1.0
