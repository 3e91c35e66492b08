"""Registered queries: each takes (spark, sf_dir) and reads whole driver tables.

Column names and types line up with ``quarry.plans.oracle`` so the results can
be compared with DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import buckets, clean, linecount, ranks, scd2, sliding, ticks
from quarry.session import scratch_path
from quarry.plans.scd2_sql import scd2_merge_sql
from quarry.operators.history import with_history
from quarry.sources import derive
from quarry.sources.sinks import key_folder, write_named_files
from quarry.sources.tables import load_table


def _events(spark: SparkSession, sf: str, cols=None) -> DataFrame:
    return load_table(spark, sf, "events", cols)


def _ticks(spark: SparkSession, sf: str) -> DataFrame:
    return derive.ticks_from_events(_events(spark, sf, ["event_id", "ts", "user_id", "value"]))


def q_time_bucket_counts(spark, sf):
    clicks = derive.clicks_from_events(_events(spark, sf, ["ts", "user_id"]))
    return buckets.time_bucket_counts(clicks, "Time")


def q_pct_change(spark, sf):
    ch = ticks.price_changes(_ticks(spark, sf))
    return ch.select("stock_ticker", "timestamp", "event_id", "close", "prev_close", "pct_change")


def q_threshold_summary(spark, sf):
    ch = ticks.price_changes(_ticks(spark, sf))
    out = ticks.threshold_summary(ch, exact=True)
    return out.withColumn("value", F.round("value", 6))


def q_moving_avg_10(spark, sf):
    h = with_history(
        _ticks(spark, sf), "stock_ticker", ["timestamp", "event_id"],
        moving_avgs={"avg_10_volume": "volume"}, rows=10, chunk="auto",
    )
    return h.select("stock_ticker", "timestamp", "event_id", "volume", "avg_10_volume")


def q_detect_anomalies(spark, sf):
    return ticks.anomalies(ticks.detect_anomalies(_ticks(spark, sf)))


def q_dense_ids(spark, sf):
    orders = load_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return ranks.dense_ids(orders, ["o_orderdate", "o_orderkey"], "id")


def q_key_set_union(spark, sf):
    c = load_table(spark, sf, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("custkey"))
    o = load_table(spark, sf, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("custkey"))
    return c.union(o).distinct()


def _scd_inputs(spark, sf):
    customer = load_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return derive.scd_target_from_customer(customer), derive.scd_source_from_customer(customer)


_SCD_ARGS = dict(keys=["customer_id"], tracked=["name", "city"], id_col="record_id", as_of=derive.SCD_AS_OF)


def _scd_view(df: DataFrame) -> DataFrame:
    # The open-ended sentinel (year 9999) does not fit pandas' nanosecond
    # timestamps; the registered form renders validity dates as text.
    fmt = "yyyy-MM-dd HH:mm:ss"
    return df.withColumns({
        "effective_start_date": F.date_format("effective_start_date", fmt),
        "effective_end_date": F.date_format("effective_end_date", fmt),
    })


def q_scd2_merge(spark, sf):
    target, source = _scd_inputs(spark, sf)
    return _scd_view(scd2.scd2_merge(target, source, **_SCD_ARGS))


def q_scd2_merge_sql(spark, sf):
    target, source = _scd_inputs(spark, sf)
    return _scd_view(scd2_merge_sql(spark, target, source, **_SCD_ARGS))


def q_scd2_second_run(spark, sf):
    """Merging the same snapshot again changes nothing."""
    target, source = _scd_inputs(spark, sf)
    once = scd2.scd2_merge(target, source, **_SCD_ARGS)
    return _scd_view(scd2.scd2_merge(once, source, **_SCD_ARGS))


_BAR_NTZ = dict(clean.BAR_TYPES, timestamp="timestamp_ntz")


def q_clean_bars(spark, sf):
    raw = derive.bar_text_from_events(_events(spark, sf, ["event_id", "ts", "user_id", "event_type", "value"]))
    good, _ = clean.clean_bars(raw, _BAR_NTZ, carry=["stock_ticker", "event_id"])
    return good


def q_clean_bar_rejects(spark, sf):
    raw = derive.bar_text_from_events(_events(spark, sf, ["event_id", "ts", "user_id", "event_type", "value"]))
    _, rejected = clean.clean_bars(raw, _BAR_NTZ, carry=["stock_ticker", "event_id"])
    return rejected.select("stock_ticker", "event_id", "close")


def q_parse_messages(spark, sf):
    from pyspark.sql.types import TimestampNTZType, StructField, StructType

    msgs = derive.stock_messages_from_events(_events(spark, sf, ["event_id", "ts", "user_id", "value"]))
    schema = StructType([
        StructField(f.name, TimestampNTZType() if f.name == "timestamp" else f.dataType, True)
        for f in clean.STOCK_SCHEMA.fields
    ])
    good, _ = clean.parse_messages(msgs, schema)
    return good


def q_parse_props(spark, sf):
    from pyspark.sql.types import IntegerType, StructField, StructType

    ev = _events(spark, sf, ["event_id", "props"])
    good, _ = clean.parse_messages(ev, StructType([StructField("k", IntegerType())]), "props", "event_id")
    return good.withColumn("event_id", F.col("event_id").cast("bigint"))


def q_alert_messages(spark, sf):
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

    msgs = ticks.alert_messages(ticks.detect_anomalies(_ticks(spark, sf)))
    schema = StructType([
        StructField("stock_ticker", StringType()), StructField("timestamp", StringType()),
        StructField("volume", LongType()), StructField("avg_volume", DoubleType()),
        StructField("volume_change_pct", DoubleType()), StructField("warning", StringType()),
    ])
    good, _ = clean.parse_messages(msgs, schema)
    return good


def q_line_counts(spark, sf):
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    return linecount.with_line_count(docs, "text").select("doc_id", "n_lines")


_FILES_PER_FOLDER = 2_000


def write_documents_as_files(spark, sf) -> str:
    """One text file per document, each row ended by a newline, in folders of about ``_FILES_PER_FOLDER`` files."""
    out = scratch_path(spark, "documents-files")
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    folders = 1 + docs.count() // _FILES_PER_FOLDER
    write_named_files(docs, out, _document_file(folders), F.col("text"))
    return out


def _document_file(folders: int):
    """Path of a document's file below the folder of all."""
    folder = key_folder("folder", F.pmod(F.xxhash64("doc_id"), F.lit(folders)))
    return F.concat_ws("/", folder, F.concat(key_folder("doc_id", F.col("doc_id")), F.lit(".txt")))


def _doc_id_from_path(col="path"):
    return F.regexp_extract(F.col(col), r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id")


def q_line_counts_files(spark, sf):
    root = write_documents_as_files(spark, sf)
    counts = linecount.count_file_lines(linecount.read_file_groups(spark, root, "*.txt"))[0]
    return counts.select(_doc_id_from_path(), "n_lines")


def q_line_counts_scan(spark, sf):
    root = write_documents_as_files(spark, sf)
    counts = linecount.line_counts(spark, root, glob="*.txt")
    return counts.select(_doc_id_from_path(), "n_lines")


def q_sliding_counts(spark, sf):
    ev = _events(spark, sf, ["ts"])
    return sliding.sliding_counts(ev, "ts", "10 minutes", "5 minutes")


def _events_feed(spark, sf, cols, days_per_file=5):
    """Events as a file stream: one file per span of days, error events one file late."""
    from quarry.streaming.feed import write_arrivals

    ev = _events(spark, sf, cols + ["event_type"] if "event_type" not in cols else cols)
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    late = F.when(F.col("event_type") == "error", 1).otherwise(0)
    arrival = (F.floor(day / days_per_file) + late).alias("_arrival")
    feed_dir = scratch_path(spark, "events-feed")
    write_arrivals(ev.select(*cols, arrival), "_arrival", feed_dir)
    return feed_dir


def q_sliding_counts_stream(spark, sf):
    from quarry.sources.tables import to_event_time
    from quarry.streaming.sliding import read_counts, sliding_counts_stream

    feed = _events_feed(spark, sf, ["event_id", "ts"])
    # read the feed with its stored types, then cast in the session time zone
    schema = _events(spark, sf, ["event_id", "ts"]).schema
    stream = to_event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed), "ts")
    out = scratch_path(spark, "sliding-out")
    q = sliding_counts_stream(
        stream, scratch_path(spark, "sliding-ckpt"), ts="ts", size="10 minutes", slide="5 minutes",
        watermark="12 days", mode="update", path=out, trigger={"availableNow": True},
        shuffle_partitions=spark.sparkContext.defaultParallelism,
    )
    q.awaitTermination()
    res = read_counts(spark, out)
    return res.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "count",
    )


def q_late_rows(spark, sf):
    """Events that arrive more than 3 days after later ones, split off before the sliding counts would drop them,
    and the number of on-time rows that the counts then hold."""
    from quarry.sources.tables import to_event_time
    from quarry.streaming.late import gate_stream

    feed = _events_feed(spark, sf, ["event_id", "ts"])
    schema = _events(spark, sf, ["event_id", "ts"]).schema
    stream = to_event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed), "ts")
    on_time, late, marks = (scratch_path(spark, f"gate-{x}") for x in ("on-time", "late", "marks"))
    gate_stream(stream, "ts", 3 * 86_400, on_time, late, marks, scratch_path(spark, "gate-ckpt"),
                trigger={"availableNow": True}).awaitTermination()
    kept = spark.read.schema("event_id long").parquet(on_time).agg(F.count(F.lit(1)).alias("n_on_time"))
    rows = spark.read.schema("event_id long, reason string").parquet(late)
    return rows.select("event_id", "reason").join(F.broadcast(kept))  # one row


def q_line_counts_stream(spark, sf):
    from quarry.streaming.linecount import line_counts_stream

    root = write_documents_as_files(spark, sf)
    out = scratch_path(spark, "linecount-out")
    q = line_counts_stream(
        spark, root, scratch_path(spark, "linecount-ckpt"), out, glob="*.txt",
        max_files_per_trigger=max(1, 1 + spark.read.parquet(f"{sf}/documents.parquet").count() // 4),
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    return spark.read.parquet(out).select(_doc_id_from_path(), "n_lines")


def _ticks_feed(spark, sf):
    """Ticks as a file stream (error bars one file late) plus one far-future bar that moves the watermark
    past every real bar; that bar itself stays buffered and is never emitted. Returns (folder, schema)."""
    from quarry.streaming.feed import write_arrivals

    ev = _events(spark, sf, ["event_id", "ts", "user_id", "value", "event_type"])
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    late = F.when(F.col("event_type") == "error", 1).otherwise(0)
    t = derive.ticks_from_events(ev.withColumn("_arrival", F.floor(day / 5) + late), keep=["_arrival"])
    last = ev.agg(F.max("ts").alias("ts"), F.max("event_id").alias("event_id"))
    sentinel = last.select(
        F.lit(-1).cast("bigint").alias("stock_ticker"),
        (F.col("ts") + F.expr("INTERVAL 60 DAYS")).alias("timestamp"),
        *[F.lit(0.0).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(0).cast("bigint").alias("volume"),
        (F.col("event_id") + 1).alias("event_id"),
        F.lit(10_000).cast("bigint").alias("_arrival"),
    )
    feed = scratch_path(spark, "ticks-feed")
    write_arrivals(t.unionByName(sentinel), "_arrival", feed)
    return feed, derive.ticks_from_events(ev).schema


_BARS_PER_BUCKET = 20_000


def _anomaly_stream(spark, feed, schema, out, checkpoint, bars, row_api=True):
    """The stream over ``feed``; its ticker buckets follow ``bars``, the number of all bars, as a task holds one bucket's at a time."""
    from quarry.sources.tables import to_event_time
    from quarry.streaming.anomalies import detect_anomalies_stream
    from quarry.streaming.runner import start

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    cores = spark.sparkContext.defaultParallelism
    flagged = detect_anomalies_stream(to_event_time(stream, "timestamp"), watermark="12 days", row_api=row_api,
                                      chunk_seconds=30 * 86_400, buckets=max(2 * cores, -(-bars // _BARS_PER_BUCKET)))
    return start(flagged, checkpoint, sink="parquet", path=out, mode="append", trigger={"availableNow": True}, shuffle_partitions=cores)


def q_detect_anomalies_stream(spark, sf):
    """The anomaly rules over ticks that arrive as files, with history across micro-batches and time chunks."""
    feed, schema = _ticks_feed(spark, sf)
    out = scratch_path(spark, "anomaly-out")
    bars = _events(spark, sf).count()
    _anomaly_stream(spark, feed, schema, out, scratch_path(spark, "anomaly-ckpt"), bars).awaitTermination()
    res = spark.read.parquet(out).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return ticks.anomalies(res)


def _nearest_centroid_predictions(spark, sf):
    from quarry.operators import inference

    emb = load_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    labels, cents = inference.class_centroids(emb, "embedding", "label")
    return inference.classify(
        emb, "embedding", inference.nearest_centroid_factory(labels, cents),
        inference.array_preprocess, inference.top1_decoder(labels),
    )


def q_classify(spark, sf):
    pred = _nearest_centroid_predictions(spark, sf)
    return pred.select("vec_id", "label", F.col("prediction.class").alias("pred_class"))


def q_weighted_precision(spark, sf):
    from quarry.operators.tuning import weighted_precision

    pred = _nearest_centroid_predictions(spark, sf).select(
        F.col("label").cast("string").alias("label"), F.col("prediction.class").alias("prediction")
    )
    return weighted_precision(pred).select(F.round("weighted_precision", 9).alias("weighted_precision"))


def q_tune_tree_metrics(spark, sf):
    """Cross-validated grid: all 40 points of the reference, 3 folds."""
    from quarry.operators.tuning import tune_tree

    vecs = derive.vectors_from_embeddings(load_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]))
    _, metrics = tune_tree(vecs, seed=7)
    return metrics


def q_load_bars(spark, sf):
    """Bars written as CSV, one folder per ticker, read back with the ticker from the folder."""
    raw = derive.bar_text_from_events(_events(spark, sf, ["event_id", "ts", "user_id", "event_type", "value"]))
    out = scratch_path(spark, "bars-csv")
    cols = [c for c in raw.columns if c != "stock_ticker"]
    write_named_files(raw, out, F.concat(key_folder("stock_ticker", F.col("stock_ticker")), F.lit("/bars.csv")), F.to_csv(F.struct(*cols)), ",".join(cols))
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField(c, StringType()) for c in ["event_id", *_BAR_NTZ]])
    good, _ = clean.load_bars(spark, out, ticker_from="dir", schema=schema, types=_BAR_NTZ)
    return good.select("stock_ticker", "event_id", *_BAR_NTZ)


def _file_events(spark, sf):
    """File-arrival messages for the document files, plus broken and dangling ones."""
    root = write_documents_as_files(spark, sf)
    bucket = re.sub("^file:/*(?=/)", "", root)
    ids = load_table(spark, sf, "documents", ["doc_id"])
    rel = ids.select(_document_file(1 + ids.count() // _FILES_PER_FOLDER).alias("file")).distinct()  # a file of each name was written
    ok = rel.select(F.to_json(F.struct(F.lit(bucket).alias("bucket"), "file")).alias("value"))
    docs = load_table(spark, sf, "documents", ["lang", "source"])
    broken = docs.select("lang").distinct().select(F.concat(F.lit('{"bucket": "x", "file": '), F.col("lang")).alias("value"))
    dangling = docs.select("source").distinct().select(
        F.to_json(F.struct(F.lit(bucket).alias("bucket"), F.concat(F.col("source"), F.lit(".missing")).alias("file"))).alias("value")
    )
    return root, ok.unionByName(broken).unionByName(dangling)


def q_line_counts_from_events(spark, sf):
    root, events = _file_events(spark, sf)
    counts, _ = linecount.line_counts_from_events(events, linecount.read_file_groups(spark, root, glob="*.txt"))
    return counts.select(_doc_id_from_path(), "n_lines")


def q_line_count_event_rejects(spark, sf):
    root, events = _file_events(spark, sf)
    _, rejected = linecount.line_counts_from_events(events, linecount.read_file_groups(spark, root, glob="*.txt"))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_classify_stream(spark, sf):
    """Vectors written one file each under label=<l>/ folders, about ``_FILES_PER_FOLDER`` to a folder, classified on arrival."""
    from quarry.operators import inference
    from quarry.streaming.classify import classify_stream

    emb = load_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    labels, cents = inference.class_centroids(emb, "embedding", "label")
    src = scratch_path(spark, "vector-files")
    n = emb.count()
    folder = key_folder("folder", F.pmod(F.xxhash64("vec_id"), F.lit(1 + n // (_FILES_PER_FOLDER * max(1, len(labels))))))
    file = F.concat_ws("/", key_folder("label", F.col("label")), folder, F.concat(key_folder("vec_id", F.col("vec_id")), F.lit(".txt")))
    write_named_files(emb, src, file, F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))))
    out = scratch_path(spark, "classify-out")
    q = classify_stream(
        spark, src, scratch_path(spark, "classify-ckpt"),
        inference.nearest_centroid_factory(labels, cents), inference.text_vector_preprocess,
        inference.top1_decoder(labels), sink="parquet", path=out, trigger={"availableNow": True},
        glob="*.txt", max_files_per_trigger=max(1, n // 4 + 1), label_pattern=r"label=(\d+)/",
    )
    q.awaitTermination()
    res = spark.read.parquet(out)
    return res.select(
        F.regexp_extract("path", r"vec_id=(\d+)\.txt", 1).cast("bigint").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.col("prediction.class").alias("pred_class"),
    )


def q_sliding_counts_10s(spark, sf):
    """The original window settings: 10 second windows every 5 seconds."""
    return sliding.sliding_counts(_events(spark, sf, ["ts"]), "ts", "10 seconds", "5 seconds")


def q_click_counter_tsv(spark, sf):
    """Click log written as tab-separated text with a header, counted by the end-to-end job."""
    from quarry.plans.jobs import click_counter_job

    src, out = scratch_path(spark, "clicks-tsv"), scratch_path(spark, "clicks-out")
    clicks = derive.clicks_from_events(_events(spark, sf, ["ts", "user_id"]))
    clicks.write.mode("overwrite").option("header", True).option("sep", "\t").csv(src)
    click_counter_job(spark, src, out)
    return spark.read.schema("time_range string, count bigint").csv(out)


def q_threshold_summary_approx(spark, sf):
    """Approximate thresholds (bounded sketches), each with its rank error checked by a second aggregate."""
    ch = ticks.price_changes(_ticks(spark, sf))
    out = ticks.threshold_summary(ch, exact=False, accuracy=10_000, certify=True)
    return out.select("percentile", "within_bound")


def q_moving_avg_range(spark, sf):
    """Average volume over the previous 10 minutes (time range, current instant excluded)."""
    from quarry.operators.history import with_time_history

    h = with_time_history(_ticks(spark, sf), "stock_ticker", "timestamp", {"avg_10min_volume": "volume"}, 600)
    return h.select("stock_ticker", "timestamp", "event_id", "volume", "avg_10min_volume")


def q_customer_messages(spark, sf):
    """Customer rows as a CSV file with a header, fed as JSON messages and parsed back."""
    from pyspark.sql.types import StringType, StructField, StructType

    fields = ["customer_id", "name", "city"]
    src = scratch_path(spark, "customers-csv")
    load_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"]).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city")
    ).write.mode("overwrite").option("header", True).csv(src)
    msgs = clean.csv_to_messages(spark, src, fields, header=True, key="customer_id")
    good, _ = clean.parse_messages(msgs, StructType([StructField(f, StringType()) for f in fields]))
    return good


def q_detect_anomalies_stream_table(spark, sf):
    """The same stream into a table, stopped and started again from its checkpoint: state and output go on where
    they were. The bars of the first run's files are written before it, all others and the far-future bar after it."""
    from quarry.streaming.feed import write_arrivals

    feed, schema = _ticks_feed(spark, sf)
    parts = spark.read.schema(schema).parquet(feed)
    middle = parts.agg(F.percentile_approx(F.unix_micros(F.col("timestamp").cast("timestamp")), 0.5)).first()[0]
    later = F.unix_micros(F.col("timestamp").cast("timestamp")) >= F.lit(middle)
    both, bars = parts.withColumn("_half", later.cast("int")), parts.count()
    src, out, ckpt = (scratch_path(spark, f"ticks-{n}") for n in ("halves", "table", "table-ckpt"))
    for run in (0, 1):
        write_arrivals(both.where(F.col("_half") == run), "_half", src)
        _anomaly_stream(spark, src, schema, out, ckpt, bars, row_api=False).awaitTermination()
    res = spark.read.parquet(out).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return ticks.anomalies(res)


def q_tune_tree_majority(spark, sf):
    """The grid's points of depth 0, whose trees predict the majority class, over folds fixed by a hash of the id:
    cross-validated weighted precision, the best model's parameters and its score on the training table."""
    from quarry.operators.tuning import DEFAULT_GRID, INDEXED_LABEL, best_params, hash_folds, tune_tree, weighted_precision

    vecs = derive.vectors_from_embeddings(load_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]))
    grid = {"maxDepth": [0], "maxBins": DEFAULT_GRID["maxBins"]}
    model, metrics = tune_tree(hash_folds(vecs, "vec_id"), grid=grid, fold_col="fold")
    best = best_params(model)
    score = weighted_precision(model.transform(vecs), INDEXED_LABEL).select(F.round("weighted_precision", 9).alias("train_score"))
    return metrics.select(
        F.col("maxDepth").alias("max_depth"), F.col("maxBins").alias("max_bins"), F.round("avg_metric", 9).alias("avg_metric"),
        F.lit(len(DEFAULT_GRID["maxDepth"]) * len(DEFAULT_GRID["maxBins"])).alias("grid_size"),
        F.lit(best["maxDepth"]).alias("best_depth")).join(F.broadcast(score))  # one row


def q_path_parts(spark, sf):
    """What the jobs take from a file's path: the label from its folder, the ticker from its name, and the report line."""
    from quarry.functions.text import file_stem, parent_dir, report_line

    docs = load_table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])
    path = F.concat_ws("/", F.lit("/data"), "source", F.coalesce("lang", F.lit("none")), F.concat(F.lit("doc."), F.col("doc_id").cast("string"), F.lit(".txt")))
    counted = linecount.with_line_count(docs.withColumn("path", path), "text")
    return counted.select("path", parent_dir(F.col("path")).alias("label"), file_stem(F.col("path")).alias("stem"),
                          report_line(F.col("path"), F.col("n_lines")).alias("report"))


def q_libsvm_scan(spark, sf):
    """Embeddings written as LibSVM text and read back with a fixed vector size: rows and length per label."""
    from pyspark.ml.functions import vector_to_array

    from quarry.sources import files

    emb = load_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    dim = emb.agg(F.max(F.size("embedding"))).first()[0]
    out = scratch_path(spark, "embeddings-libsvm")
    derive.vectors_from_embeddings(emb).select("label", "features").write.mode("overwrite").format("libsvm").save(out)
    back = files.read_libsvm(spark, out, dim).select("label", vector_to_array("features").alias("v"))
    return back.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.round(F.sum(F.element_at("v", 1)), 4).alias("first_sum"))


def q_publish_order(spark, sf):
    """Place of each bar among its ticker's in the order in which a keyed sink gets them."""
    from pyspark.sql import Window

    bars = clean.publish_order(_ticks(spark, sf), "stock_ticker", "timestamp", tiebreak=("event_id",))
    placed = bars.select("stock_ticker", "event_id", F.monotonically_increasing_id().alias("_at"))
    by = Window.partitionBy("stock_ticker").orderBy("_at")
    return placed.select("stock_ticker", "event_id", F.row_number().over(by).alias("place"))


QUERIES = {
    "late_rows": q_late_rows,
    "tune_tree_majority": q_tune_tree_majority,
    "path_parts": q_path_parts,
    "libsvm_scan": q_libsvm_scan,
    "publish_order": q_publish_order,
    "detect_anomalies_stream_table": q_detect_anomalies_stream_table,
    "customer_messages": q_customer_messages,
    "moving_avg_range": q_moving_avg_range,
    "sliding_counts_10s": q_sliding_counts_10s,
    "click_counter_tsv": q_click_counter_tsv,
    "threshold_summary_approx": q_threshold_summary_approx,
    "classify_stream": q_classify_stream,
    "load_bars": q_load_bars,
    "line_counts_from_events": q_line_counts_from_events,
    "line_count_event_rejects": q_line_count_event_rejects,
    "classify": q_classify,
    "weighted_precision": q_weighted_precision,
    "tune_tree_metrics": q_tune_tree_metrics,
    "detect_anomalies_stream": q_detect_anomalies_stream,
    "sliding_counts_stream": q_sliding_counts_stream,
    "line_counts_stream": q_line_counts_stream,
    "line_counts": q_line_counts,
    "line_counts_files": q_line_counts_files,
    "line_counts_scan": q_line_counts_scan,
    "sliding_counts": q_sliding_counts,
    "scd2_merge": q_scd2_merge,
    "scd2_merge_sql": q_scd2_merge_sql,
    "scd2_second_run": q_scd2_second_run,
    "clean_bars": q_clean_bars,
    "clean_bar_rejects": q_clean_bar_rejects,
    "parse_messages": q_parse_messages,
    "parse_props": q_parse_props,
    "alert_messages": q_alert_messages,
    "time_bucket_counts": q_time_bucket_counts,
    "pct_change": q_pct_change,
    "threshold_summary": q_threshold_summary,
    "moving_avg_10": q_moving_avg_10,
    "detect_anomalies": q_detect_anomalies,
    "dense_ids": q_dense_ids,
    "key_set_union": q_key_set_union,
}
