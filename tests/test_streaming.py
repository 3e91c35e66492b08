import os

import pytest

from pyspark.sql import functions as F

from conftest import SF0
from quarry.operators import sliding, ticks
from quarry.session import scratch_path
from quarry.sources import derive
from quarry.sources.tables import to_event_time
from quarry.streaming.feed import write_arrivals


def test_sliding_stream_equals_batch(spark):
    from quarry.streaming.sliding import read_counts, sliding_counts_stream

    ev = to_event_time(spark.read.parquet(f"{SF0}/events.parquet").select("event_id", "ts", "event_type"))
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    feed = scratch_path(spark, "t-sliding-feed")
    write_arrivals(ev.withColumn("_a", F.floor(day / 10) + F.when(F.col("event_type") == "view", 1).otherwise(0))
                   .drop("event_type"), "_a", feed)
    stream = spark.readStream.schema(ev.drop("event_type").schema).option("maxFilesPerTrigger", 1).parquet(feed)
    out = scratch_path(spark, "t-sliding-out")
    q = sliding_counts_stream(stream, scratch_path(spark, "t-sliding-ck"), "ts", "1 hour", "30 minutes",
                              watermark="25 days", path=out, trigger={"availableNow": True})
    q.awaitTermination()
    got = {(r[0], r[1]): r[2] for r in read_counts(spark, out).collect()}
    want = {(r[0], r[1]): r[2] for r in sliding.sliding_counts(ev, "ts", "1 hour", "30 minutes").collect()}
    assert got == want
    assert sum(want.values()) == 2 * ev.count()  # every row in size/slide windows


@pytest.mark.parametrize("row_api", [True, False])
def test_anomaly_stream_equals_batch_with_disorder(spark, row_api):
    from quarry.streaming.anomalies import detect_anomalies_stream
    from quarry.streaming.runner import start

    ev = spark.read.parquet(f"{SF0}/events.parquet")
    t = to_event_time(derive.ticks_from_events(ev))
    day = F.datediff(F.to_date("timestamp"), F.lit("2024-01-01"))
    feed = scratch_path(spark, "t-anom-feed")
    # arrival groups in reverse-ish order inside a 10-day watermark
    arr = (F.floor(day / 4) * 2 + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0))
    sentinel = t.agg(F.max("timestamp").alias("ts")).select(
        F.lit(-1).cast("bigint").alias("stock_ticker"), (F.col("ts") + F.expr("INTERVAL 40 DAYS")).alias("timestamp"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("bigint").alias("volume"),
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(999).cast("bigint").alias("_a"))
    write_arrivals(t.withColumn("_a", arr.cast("bigint")).unionByName(sentinel), "_a", feed)
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(feed)
    out = scratch_path(spark, "t-anom-out")
    q = start(detect_anomalies_stream(stream, "10 days", row_api=row_api), scratch_path(spark, "t-anom-ck"), path=out,
              trigger={"availableNow": True})
    q.awaitTermination()
    cols = ["stock_ticker", "event_id", "prev_minute_close", "avg_10min_volume", "anomaly_type"]
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    want = sorted(tuple(r) for r in ticks.detect_anomalies(t).select(*cols).collect())
    assert got == want


def test_line_count_stream_counts_each_file_once(spark):
    from quarry.streaming.linecount import line_counts_stream

    src = scratch_path(spark, "t-lc-src").replace("file:", "")
    out = scratch_path(spark, "t-lc-out")
    ck = scratch_path(spark, "t-lc-ck")
    for i, text in enumerate(["a\nb\n", "c"]):
        with open(os.path.join(src, f"f{i}.txt"), "w") as f:
            f.write(text)
    with open(os.path.join(src, "output.txt"), "w") as f:  # own output: never counted
        f.write("Number of lines in x: 1")
    line_counts_stream(spark, src, ck, out, exclude=r"/output\.txt$",
                       trigger={"availableNow": True}).awaitTermination()
    with open(os.path.join(src, "f2.txt"), "w") as f:
        f.write("x\ny\nz")
    # restart from the same checkpoint: only the new file is counted
    line_counts_stream(spark, src, ck, out, exclude=r"/output\.txt$",
                       trigger={"availableNow": True}).awaitTermination()
    got = sorted((os.path.basename(r["path"]), r["n_lines"]) for r in spark.read.parquet(out).collect())
    assert got == [("f0.txt", 2), ("f1.txt", 1), ("f2.txt", 3)]


def test_per_batch_writer_and_late_rows(spark):
    from quarry.streaming.anomalies import per_batch_alert_writer
    from quarry.streaming.runner import rows_dropped_by_watermark, start_foreach_batch

    t = to_event_time(derive.ticks_from_events(spark.read.parquet(f"{SF0}/events.parquet")))
    feed = scratch_path(spark, "t-pb-feed")
    t.write.mode("overwrite").parquet(feed)
    stream = spark.readStream.schema(t.schema).parquet(feed)
    out = scratch_path(spark, "t-pb-out")
    q = start_foreach_batch(stream, scratch_path(spark, "t-pb-ck"), per_batch_alert_writer(out),
                            mode="append", trigger={"availableNow": True})
    q.awaitTermination()
    # one micro-batch holding everything equals the batch job
    got = spark.read.json(out).count()
    want = ticks.alert_messages(ticks.detect_anomalies(t)).count()
    assert got == want
    assert rows_dropped_by_watermark(q) == 0


def _hot_ticks(spark):
    """One ticker with a third of the bars, null volumes, many chunks, and bars of equal time."""
    base = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    n = 900
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("t"), (F.col("id") % 7).cast("string"))).alias("stock_ticker"),
        (base + F.make_dt_interval(secs=F.floor(F.col("id") / 2) * 97)).alias("timestamp"),
        (F.col("id") % 13).cast("double").alias("close"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 101).alias("volume"), F.col("id").alias("event_id"))


def test_hot_ticker_is_spread_over_chunks_and_survives_a_restart(spark):
    from quarry.streaming.anomalies import detect_anomalies_stream
    from quarry.streaming.runner import start

    t = _hot_ticks(spark).persist()
    feed, out, ck = (scratch_path(spark, f"t-hot-{x}") for x in ("feed", "out", "ck"))
    tail = t.agg(F.max("timestamp").alias("ts")).select(
        F.lit("end").alias("stock_ticker"), (F.col("ts") + F.expr("INTERVAL 40 DAYS")).alias("timestamp"),
        F.lit(1.0).alias("close"), F.lit(1).cast("long").alias("volume"), F.lit(-1).cast("long").alias("event_id"))
    arrival = F.floor(F.col("event_id") / 300) + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)  # some bars one file late
    for last, rows_ in ((False, t.where("event_id < 500")), (True, t.where("event_id >= 500"))):
        frame = rows_.withColumn("_a", arrival.cast("bigint"))
        write_arrivals(frame.unionByName(tail.withColumn("_a", F.lit(999).cast("bigint"))) if last else frame, "_a", feed)
        stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(feed)
        flagged = detect_anomalies_stream(stream, "10 hours", rows=3, chunk_seconds=3600, buckets=2)
        start(flagged, ck, path=out, trigger={"availableNow": True}).awaitTermination()
    cols = ["stock_ticker", "event_id", "prev_minute_close", "avg_10min_volume", "anomaly_type"]
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    want = sorted(tuple(r) for r in ticks.detect_anomalies(t, rows=3).select(*cols).collect())
    assert len(got) == t.count() and got == want


def test_line_count_stream_of_edge_files(spark):
    """Counts and rejects of arriving files equal those of the batch scan; a repeated batch writes the same folders."""
    from quarry.operators.linecount import count_lines
    from quarry.streaming.linecount import line_counts_stream

    src = scratch_path(spark, "t-lcs-src").replace("file:", "")
    texts = {"a.txt": b"1\n2\n3\n", "vt.txt": b"x\x0by\x0b", "nel.txt": "x\u0085".encode(), "crlf.txt": b"a\r\nb\r\n", "cr.txt": b"a\rb",
             "bom.txt": b"\xef\xbb\xbfone\ntwo", "bad.txt": b"ok\n\xff\xfe\n", "two words.txt": b"one line\n", "open.txt": b"a\nb", "ff.txt": b"a\n\x0c"}
    for n, t in texts.items():
        with open(os.path.join(src, n), "wb") as f:
            f.write(t)
    out, bad = scratch_path(spark, "t-lcs-out"), scratch_path(spark, "t-lcs-bad")
    line_counts_stream(spark, src, scratch_path(spark, "t-lcs-ck"), out, max_files_per_trigger=3, rejects_path=bad,
                       trigger={"availableNow": True}).awaitTermination()
    counts, rejected = count_lines(spark, src)
    got = {os.path.basename(r["path"]): r["n_lines"] for r in spark.read.parquet(out).collect()}
    assert got == {os.path.basename(r["path"]): r["n_lines"] for r in counts.collect()}
    assert {n: v for n, v in got.items() if n != "bom.txt"} == {n: len(t.decode().splitlines()) for n, t in texts.items() if n not in ("bad.txt", "bom.txt")}
    reasons = [tuple(r) for r in spark.read.parquet(bad).select("path", "reason").collect()]
    assert sorted(reasons) == sorted(tuple(r) for r in rejected.collect()) and len(reasons) == 1


def test_sliding_stream_append_mode_emits_closed_windows_once(spark):
    from quarry.streaming.sliding import sliding_counts_stream

    ev = to_event_time(spark.read.parquet(f"{SF0}/events.parquet").select("event_id", "ts"))
    feed = scratch_path(spark, "t-app-feed")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    last = ev.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("bigint").alias("event_id"),
                                                  (F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    write_arrivals(ev.withColumn("_a", F.floor(day / 10)).unionByName(last.withColumn("_a", F.lit(99).cast("bigint"))),
                   "_a", feed)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    out = scratch_path(spark, "t-app-out")
    q = sliding_counts_stream(stream, scratch_path(spark, "t-app-ck"), "ts", "1 hour", "30 minutes",
                              watermark="1 hour", mode="append", sink="parquet", path=out,
                              trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.groupBy("window_start").count().where("count > 1").count() == 0  # each window once
    want = {(r[0], r[1]): r[2] for r in sliding.sliding_counts(ev, "ts", "1 hour", "30 minutes").collect()}
    assert {(r[0], r[1]): r[2] for r in got.collect()} == want  # the sentinel's windows stay open


def test_on_time_and_late_rows_are_all_rows(spark):
    from quarry.streaming.late import gate_stream
    from quarry.streaming.runner import rows_dropped_by_watermark
    from quarry.streaming.sliding import read_counts, sliding_counts_stream

    ev = to_event_time(spark.read.parquet(f"{SF0}/events.parquet").select("event_id", "ts", "event_type"))
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    feed, on_time, late, marks, out = (scratch_path(spark, f"t-late-{x}") for x in ("feed", "on", "late", "marks", "out"))
    src = ev.withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts"))).drop("event_type")
    arrival = F.floor(day / 10) + F.when(ev["event_type"] == "error", 2).otherwise(0)  # a late file
    write_arrivals(ev.withColumn("_a", arrival).withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts"))).drop("event_type"), "_a", feed)
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    q = gate_stream(stream, "ts", 86_400, on_time, late, marks, scratch_path(spark, "t-late-ck"), trigger={"availableNow": True})
    q.awaitTermination()
    kept, lost = spark.read.parquet(on_time), spark.read.parquet(late)
    ids = [r["event_id"] for d in (kept, lost) for r in d.select("event_id").collect()]
    assert sorted(ids) == sorted(r["event_id"] for r in ev.select("event_id").collect())
    reasons = {r["reason"]: r["count"] for r in lost.groupBy("reason").count().collect()}
    assert set(reasons) == {"late", "no time"} and reasons["no time"] == ev.where("event_id % 50 = 0").count()
    after = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(on_time)
    q = sliding_counts_stream(after, scratch_path(spark, "t-late-ck2"), "ts", "1 hour", "30 minutes", watermark="1 day", path=out,
                              trigger={"availableNow": True})
    q.awaitTermination()
    assert rows_dropped_by_watermark(q) == 0
    assert sum(r["count"] for r in read_counts(spark, out).collect()) == 2 * kept.count()


def test_streams_list_files_in_few_tasks(spark):
    """a micro-batch's files are listed in four tasks a core, not in a task of each file."""
    from quarry.operators import inference
    from quarry.streaming.classify import classified_files
    from quarry.streaming.linecount import line_counts_stream

    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    src = scratch_path(spark, "t-ls-src").replace("file:", "")
    for i in range(3):
        with open(os.path.join(src, f"f{i}.txt"), "w") as f:
            f.write("1,2\n")
    old, few = spark.conf.get(key), str(4 * spark.sparkContext.defaultParallelism)
    try:
        spark.conf.set(key, "10000")
        line_counts_stream(spark, src, scratch_path(spark, "t-ls-ck"), scratch_path(spark, "t-ls-out"),
                           trigger={"availableNow": True}).awaitTermination()
        assert spark.conf.get(key) == few
        spark.conf.set(key, "10000")
        classified_files(spark, src, inference.nearest_centroid_factory([0], None), inference.text_vector_preprocess,
                         inference.top1_decoder([0]))
        assert spark.conf.get(key) == few
    finally:
        spark.conf.set(key, old)


def test_anomaly_buckets_follow_the_bars(spark, monkeypatch):
    """F8, F9: a task's Python holds one bucket's bars of a chunk, so there are more buckets for more bars."""
    from quarry.plans import queries as Q
    from quarry.streaming import anomalies

    class Caught(Exception):
        pass

    def catch(*_, buckets, **__):
        raise Caught(buckets)

    sf = scratch_path(spark, "t-buckets")
    spark.range(400).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) as ts", "id % 50 as user_id",
                                "'click' as event_type", "id + 0.25D as value").write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(anomalies, "detect_anomalies_stream", catch)
    monkeypatch.setattr(Q, "_BARS_PER_BUCKET", 4)
    for query in (Q.q_detect_anomalies_stream, Q.q_detect_anomalies_stream_table):
        with pytest.raises(Caught) as got:
            query(spark, sf)
        assert got.value.args[0] in (100, 101)  # with the far-future bar


@pytest.mark.parametrize("row_api", [True, False])
def test_complete_bars_pass_through_without_being_held(row_api):
    import pandas as pd

    from quarry.streaming.anomalies import ChunkJoints

    read = [0]

    def rows():
        for i in range(5000):
            read[0] += 1
            r = dict(chunk=0, kind=0, ticker="a", ts_us=i, tb=i, close=1.0, volume=2.0, prev=None, average=0.5, vols=None)
            yield r if row_api else pd.DataFrame([r])

    out = ChunkJoints(10, row_api).handleInputRows((0, 7), rows(), None)
    next(iter(out))
    assert 0 < read[0] <= 1000


def test_row_form_emits_packs_not_a_row_a_bar():
    """F8: Spark holds all rows that a task's timers emit, so released bars come in packs."""
    from quarry.streaming.anomalies import ChunkHistory

    h = ChunkHistory(10, True, 86_400_000_000)
    bars = [["a", i, i, 1.0, 2.0] for i in range(2500)]
    out = list(h._emit(h._release(3, 0, bars, {})))
    assert len(out) == 3 and {(r["bucket"], r["chunk"]) for r in out} == {(3, 0)}
