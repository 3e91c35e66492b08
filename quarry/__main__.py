"""Command line for the end-to-end jobs: ``python -m quarry <job> ...``."""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarry")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)

    c = sub.add_parser("click-counts", help="tab-separated clicks -> rows per six-hour range (CSV)")
    c.add_argument("input"), c.add_argument("output")

    t = sub.add_parser("stock-thresholds", help="per-ticker CSV bars -> percentile report (CSV)")
    t.add_argument("csv_glob"), t.add_argument("output")
    t.add_argument("--approx", action="store_true", help="percentile_approx instead of exact")

    s = sub.add_parser("scd2", help="CSV snapshot + CSV dimension -> merged dimension (CSV)")
    s.add_argument("source"), s.add_argument("target"), s.add_argument("output")
    s.add_argument("--keys", required=True), s.add_argument("--tracked", required=True)
    s.add_argument("--id-col", default="record_id"), s.add_argument("--as-of", required=True)
    s.add_argument("--sql", action="store_true", help="use the Spark SQL form")

    b = sub.add_parser("bars-to-topic", help="CSV bars -> keyed JSON messages on a topic")
    b.add_argument("csv_glob"), b.add_argument("--servers", required=True), b.add_argument("--topic", required=True)

    lc = sub.add_parser("line-counts", help="files -> one report line per file")
    lc.add_argument("path")
    lc.add_argument("--output", default=None)

    a = sub.add_parser("anomaly-stream", help="topic of bars -> stateful anomaly rules -> alerts")
    a.add_argument("--servers", required=True), a.add_argument("--topic", required=True)
    a.add_argument("--checkpoint", required=True), a.add_argument("--alerts-topic", default=None)
    a.add_argument("--alerts-path", default=None), a.add_argument("--watermark", default="15 minutes")
    a.add_argument("--max-offsets-per-trigger", type=int, default=500)

    w = sub.add_parser("sliding-counts", help="topic records -> counts per sliding window")
    w.add_argument("--servers", required=True), w.add_argument("--topic", required=True)
    w.add_argument("--checkpoint", required=True), w.add_argument("--size", default="10 seconds")
    w.add_argument("--slide", default="5 seconds"), w.add_argument("--watermark", default="1 minute")

    tt = sub.add_parser("tune-tree", help="LibSVM train/test -> k-fold CV decision tree -> metrics (JSON)")
    tt.add_argument("train"), tt.add_argument("--test", default=None), tt.add_argument("--folds", type=int, default=3)
    tt.add_argument("--max-depth", default="0,1,2,3,4,5,6,7"), tt.add_argument("--max-bins", default="2,4,8,16,32")
    tt.add_argument("--num-features", type=int, default=None)

    args = p.parse_args(argv)

    from quarry.plans import jobs
    from quarry.session import get_spark
    from quarry.sources import sinks, topics

    spark = get_spark(args.master, app=f"quarry-{args.job}")
    if args.job == "click-counts":
        jobs.click_counter_job(spark, args.input, args.output)
    elif args.job == "stock-thresholds":
        jobs.stock_threshold_job(spark, args.csv_glob, args.output, exact=not args.approx)
    elif args.job == "scd2":
        jobs.scd2_csv_job(spark, args.source, args.target, args.output, args.keys.split(","),
                          args.tracked.split(","), args.id_col, args.as_of, sql=args.sql)
    elif args.job == "bars-to-topic":
        jobs.bars_to_topic_job(spark, args.csv_glob, args.servers, args.topic)
    elif args.job == "line-counts":
        out = jobs.line_count_job(spark, args.path)
        if args.output:
            sinks.write_json(out, args.output, mode="overwrite")
        else:
            for r in out.select("report").toLocalIterator():
                print(r[0])
    elif args.job == "anomaly-stream":
        src = topics.topic_source_options(args.servers, args.topic,
                                          max_offsets_per_trigger=args.max_offsets_per_trigger)
        sink = topics.topic_sink_options(args.servers, args.alerts_topic) if args.alerts_topic else None
        jobs.anomaly_stream_job(spark, src, args.checkpoint, sink, args.alerts_path, args.watermark).awaitTermination()
    elif args.job == "sliding-counts":
        src = topics.topic_source_options(args.servers, args.topic)
        jobs.sliding_count_stream_job(spark, src, args.checkpoint, args.size, args.slide,
                                      args.watermark).awaitTermination()
    elif args.job == "tune-tree":
        grid = {"maxDepth": [int(x) for x in args.max_depth.split(",")],
                "maxBins": [int(x) for x in args.max_bins.split(",")]}
        print(json.dumps(jobs.tune_tree_job(spark, args.train, args.test, grid, args.folds, args.num_features)))
    print(json.dumps({"job": args.job, "status": "done"}), file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
