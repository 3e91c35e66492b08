"""End-to-end jobs: source -> operators -> sink, one per original project.

Each job is a thin composition of library operators; all work runs in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import buckets, clean, linecount, scd2, ticks
from quarry.plans.scd2_sql import scd2_merge_sql
from quarry.sources import files, sinks, topics


def click_counter_job(spark: SparkSession, input_path: str, output_path: str) -> DataFrame:
    """Tab-separated click log -> rows per six-hour range -> CSV (overwrite, no header)."""
    counts = buckets.time_bucket_counts(files.read_tsv(spark, input_path), "Time")
    sinks.write_csv(counts, output_path, mode="overwrite", header=False)
    return counts


def stock_threshold_job(
    spark: SparkSession, csv_glob: str, output_path: str | None = None, exact: bool = True
) -> DataFrame:
    """Per-ticker CSV bars -> |% change| between ticks -> percentile thresholds and
    the number of trades above each -> CSV with the report's headers."""
    bars, _ = clean.load_bars(spark, csv_glob, ticker_from="stem")
    # bars have no id: those of one ticker and time are ordered by their other columns
    changes = ticks.price_changes(bars, tiebreak=("open", "high", "low", "close", "volume"))
    report = ticks.threshold_summary(changes, exact=exact, names=ticks.REPORT_COLUMNS)
    if output_path:
        sinks.write_csv(report, output_path, header=True)
    return report


def bars_to_topic_job(spark: SparkSession, csv_glob: str, servers: str, topic: str) -> DataFrame:
    """Clean CSV bars and publish one keyed JSON message per bar, each ticker in time order."""
    bars, _ = clean.load_bars(spark, csv_glob, ticker_from="stem")
    msgs = clean.to_messages(clean.publish_order(bars, "stock_ticker", "timestamp"), "stock_ticker")
    topics.write_topic(msgs, topics.topic_sink_options(servers, topic))
    return msgs


def scd2_csv_job(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    output_path: str,
    keys: list[str],
    tracked: list[str],
    id_col: str,
    as_of: str,
    source_schema=None,
    target_schema=None,
    sql: bool = False,
    num_files: int | None = None,
) -> DataFrame:
    """CSV snapshot + CSV dimension -> merged dimension -> CSV (overwrite)."""
    src = files.read_csv(spark, source_path, source_schema, infer=source_schema is None)
    tgt = files.read_csv(spark, target_path, target_schema, infer=target_schema is None)
    kw = dict(keys=keys, tracked=tracked, id_col=id_col, as_of=as_of)
    out = scd2_merge_sql(spark, tgt, src, **kw) if sql else scd2.scd2_merge(tgt, src, **kw)
    sinks.write_csv(out, output_path, mode="overwrite", header=True, num_files=num_files)
    return out


def anomaly_stream_job(
    spark: SparkSession,
    source_options: dict,
    checkpoint: str,
    alerts_sink_options: dict | None = None,
    alerts_path: str | None = None,
    watermark: str = "15 minutes",
    trigger: dict | None = None,
    rejects_path: str | None = None,
):
    """Topic of stock messages -> stateful anomaly rules -> volume alerts.

    Alerts go to a topic (keyed by ticker) or to JSON files; both stay
    distributed and are checkpointed, so a restart neither loses nor repeats
    a committed micro-batch. With ``rejects_path``, malformed messages and bars
    without a time or a ticker are written there as JSON, and both query handles
    are returned.
    """
    from quarry.sources.tables import to_event_time
    from quarry.streaming.anomalies import detect_anomalies_stream, incomplete
    from quarry.streaming.runner import start

    raw = topics.read_topic(spark, source_options, stream=True)
    # bars of one ticker and time are ordered by their place in the topic
    place = F.shiftleft(F.col("offset").cast("bigint"), 16) + F.col("partition")
    good, bad = clean.parse_messages(raw.withColumn("event_id", place), carry=["event_id"])
    bars = to_event_time(good, "timestamp")
    flagged = detect_anomalies_stream(bars, watermark)
    alerts = ticks.alert_messages(flagged)
    if alerts_sink_options:
        query = start(alerts, checkpoint, sink="kafka", options=alerts_sink_options, trigger=trigger)
    else:
        query = start(alerts, checkpoint, sink="json", path=alerts_path, trigger=trigger)
    if rejects_path is None:
        return query
    lost = incomplete(bars).select(F.to_json(F.struct(*bars.columns)).alias("raw_value"))
    rejects = bad.select("raw_value").unionByName(lost)
    return query, start(rejects, f"{checkpoint}-rejects", sink="json", path=rejects_path, trigger=trigger)


def sliding_count_stream_job(
    spark: SparkSession, source_options: dict, checkpoint: str, size="10 seconds", slide="5 seconds",
    watermark: str | None = "1 minute", sink: str = "console", path: str | None = None,
):
    """Topic records -> counts per sliding window of the broker timestamp."""
    from quarry.streaming.sliding import sliding_counts_stream

    raw = topics.read_topic(spark, source_options, stream=True).selectExpr("CAST(value AS STRING) AS value", "timestamp")
    return sliding_counts_stream(raw, checkpoint, "timestamp", size, slide, watermark, "update", path, sink)


def line_count_job(spark: SparkSession, path: str) -> DataFrame:
    """Files -> one report line per file."""
    return linecount.with_report(linecount.line_counts(spark, path))


def tune_tree_job(
    spark: SparkSession,
    train_path: str,
    test_path: str | None = None,
    grid: dict | None = None,
    folds: int = 3,
    num_features: int | None = None,
    seed: int = 42,
    parallelism: int = 4,
) -> dict:
    """LibSVM train (and test) files -> k-fold CV over the tree grid -> best parameters,
    per-grid metrics and weighted precision of the best model on train and test."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from quarry.operators.tuning import best_params, tune_tree

    train = files.read_libsvm(spark, train_path, num_features)
    model, metrics = tune_tree(train, grid=grid, folds=folds, seed=seed, parallelism=parallelism)
    ev = MulticlassClassificationEvaluator(labelCol="indexedLabel", predictionCol="prediction",
                                           metricName="weightedPrecision")
    out = {"best": best_params(model), "grid": [r.asDict() for r in metrics.collect()],
           "train_weighted_precision": ev.evaluate(model.bestModel.transform(train))}
    if test_path:
        # the test file must have the training vector size, whatever its largest index
        test = files.read_libsvm(spark, test_path, num_features or train.first()["features"].size)
        out["test_weighted_precision"] = ev.evaluate(model.bestModel.transform(test))
    return out
