import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF0
from quarry.operators import clean, inference
from quarry.sources import derive, files, topics


def test_libsvm_round_trip_keeps_dimension(spark):
    d = tempfile.mkdtemp(prefix="quarry-svm-")
    vecs = derive.vectors_from_embeddings(spark.read.parquet(f"{SF0}/embeddings.parquet"))
    dim = len(vecs.first()["features"])
    vecs.select("label", "features").write.format("libsvm").save(f"{d}/v")
    back = files.read_libsvm(spark, f"{d}/v", num_features=dim)
    assert back.count() == vecs.count()
    assert {len(r["features"]) for r in back.select("features").collect()} == {dim}


def test_topic_option_maps():
    src = topics.topic_source_options("h:9092", "t", max_offsets_per_trigger=500)
    assert src == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t",
                   "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500"}
    assert topics.topic_sink_options("h:9092", "out") == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}


def test_messages_round_trip_and_publish_order(spark):
    t = derive.ticks_from_events(spark.read.parquet(f"{SF0}/events.parquet"))
    ordered = clean.publish_order(t, "stock_ticker", "timestamp", num_partitions=4)
    msgs = clean.to_messages(ordered, "stock_ticker")
    good, bad = clean.parse_messages(msgs, t.schema)
    assert bad.count() == 0
    assert good.drop("key").exceptAll(t).count() == 0 and good.count() == t.count()
    # inside each partition one ticker's rows are in time order
    chk = ordered.withColumn("p", F.spark_partition_id()).groupBy("p", "stock_ticker").agg(
        F.collect_list("timestamp").alias("ts")).collect()
    assert all(r["ts"] == sorted(r["ts"]) for r in chk)


def test_csv_header_is_checked_against_schema(spark):
    d = tempfile.mkdtemp(prefix="quarry-csv-")
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("b,a\n1,2\n")
    import pytest

    with pytest.raises(Exception):
        files.read_csv(spark, d, "a string, b string").collect()
    assert files.read_csv(spark, d, "b string, a string").first()["a"] == "2"


def test_topk_decoder(spark):
    emb = spark.read.parquet(f"{SF0}/embeddings.parquet")
    labels, cents = inference.class_centroids(emb, "embedding", "label")
    pred = inference.classify(emb, "embedding", inference.nearest_centroid_factory(labels, cents),
                              inference.array_preprocess, inference.topk_decoder(labels, 3),
                              schema=inference.topk_schema(3))
    top1 = inference.classify(emb, "embedding", inference.nearest_centroid_factory(labels, cents),
                              inference.array_preprocess, inference.top1_decoder(labels))
    a = {r["vec_id"]: r["prediction"]["top3"] for r in pred.collect()}
    b = {r["vec_id"]: r["prediction"]["class"] for r in top1.collect()}
    assert all(len(v) == 3 and v[0]["class"] == b[k] and v[0]["score"] >= v[1]["score"] >= v[2]["score"]
               for k, v in a.items())


def test_named_files_are_written_whole_by_tasks(spark):
    """One file a name, in folders below the root, with no move in the driver and no hidden file left."""
    from quarry.session import scratch_path
    from quarry.sources.sinks import key_folder, write_named_files

    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b\nc"), (None, "é"), (3, "")], "id long, t string")
    root = scratch_path(spark, "t-named")
    n = write_named_files(df, root, F.concat(key_folder("id", F.col("id")), F.lit("/f.txt")), F.col("t"), header="h")
    base = root.replace("file:", "")
    got = {}
    for folder, _, names in os.walk(base):
        for name in names:
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                got[os.path.relpath(os.path.join(folder, name), base)] = sorted(f.read().split("\n"))
    assert n == 4 and got == {
        "id=1/f.txt": ["", "", "a", "h"], "id=2/f.txt": ["", "b", "c", "h"],
        "id=3/f.txt": ["", "", "h"], "id=__HIVE_DEFAULT_PARTITION__/f.txt": ["", "h", "é"]}
    assert write_named_files(df.limit(0), root, F.lit("x"), F.col("t")) == 0


def _tables(spark, name, df):
    """A folder of driver tables that holds ``df`` as table ``name``."""
    from quarry.session import scratch_path

    sf = scratch_path(spark, "t-tables")
    df.write.parquet(f"{sf}/{name}.parquet")
    return sf


def test_documents_share_folders(spark):
    """the files of the documents lie in few folders, and one file holds one document."""
    from quarry.plans.queries import QUERIES, write_documents_as_files

    sf = _tables(spark, "documents", spark.createDataFrame([(i, "x\n" * i) for i in range(40)], "doc_id long, text string"))
    base = write_documents_as_files(spark, sf).replace("file:", "")
    assert len(os.listdir(base)) == 1 and len(os.listdir(os.path.join(base, os.listdir(base)[0]))) == 40
    want = {(i, i + 1) for i in range(40)}
    assert {tuple(r) for r in QUERIES["line_counts_files"](spark, sf).collect()} == want


def test_bars_are_listed_in_few_tasks(spark):
    """folders of tickers are written by tasks and listed in four tasks a core, not one a folder."""
    from quarry.plans.queries import QUERIES

    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    ev = spark.range(80).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id % 50 as user_id",
                                    "'click' as event_type", "id + 0.25D as value")
    sf = _tables(spark, "events", ev)
    old = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        got = {(r["stock_ticker"], r["event_id"], r["close"], r["volume"]) for r in QUERIES["load_bars"](spark, sf).collect()}
        assert int(spark.conf.get(key)) == 4 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set(key, old)
    assert got == {(str(i % 50), str(i), i + 0.25, 100 * i + 25) for i in range(80)}
