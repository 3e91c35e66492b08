import duckdb

import __spark_entry__ as E
from conftest import SF0
from quarry.sources.tables import TABLES, table_path

FAST = ["time_bucket_counts", "pct_change", "threshold_summary", "moving_avg_10", "detect_anomalies",
        "dense_ids", "scd2_merge", "scd2_merge_sql", "clean_bars", "parse_messages", "alert_messages",
        "line_counts", "sliding_counts", "classify", "weighted_precision", "threshold_summary_approx",
        "moving_avg_range", "path_parts", "publish_order", "libsvm_scan"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "anomaly_type" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    from quarry.plans.oracle import ORACLE
    from quarry.plans.queries import QUERIES

    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE) == {"tune_tree_metrics"}


def test_fast_queries_match_duckdb_at_sf0001(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF0, t)}')")
    qs, sql = E.queries(), E.oracle_sql()
    for name in FAST:
        df = qs[name](spark, SF0)
        rel = con.sql(sql[name])
        assert sorted(df.columns) == sorted(rel.columns), name
        order = sorted(df.columns)

        def norm(v):
            return round(v, 6) if isinstance(v, float) else v

        a = sorted((tuple(norm(r[c]) for c in order) for r in df.collect()), key=repr)
        idx = [rel.columns.index(c) for c in order]
        b = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
        assert a == b, name


def test_stream_query_under_non_utc_session(spark):
    """Feeds keep wall-clock (NTZ) times; streams cast them in the session zone and back."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{table_path(SF0, 'events')}')")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = sorted(tuple(r) for r in E.queries()["sliding_counts_stream"](spark, SF0)
                     .select("window_start", "window_end", "count").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = sorted(tuple(r) for r in con.sql(
        f"SELECT window_start, window_end, count FROM ({E.oracle_sql()['sliding_counts_stream']})").fetchall())
    assert got == want


def test_python_worker_queries_from_another_directory(tmp_path):
    """The driver may start outside the repo: UDF and stateful-processor queries must still run."""
    import os
    import subprocess
    import sys

    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry_mod", {entry!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("classify", "detect_anomalies_stream"):
    print(name, m.queries()[name](spark, {SF0!r}).count())
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "classify " in out.stdout and "detect_anomalies_stream " in out.stdout


def test_tuning_covers_the_full_grid(spark, monkeypatch):
    from quarry.operators import tuning

    seen = {}
    monkeypatch.setattr(tuning, "tune_tree", lambda train, grid=None, folds=tuning.DEFAULT_FOLDS, **rest: (
        None, seen.update(grid=grid or tuning.DEFAULT_GRID, folds=folds, rows=train.count())))
    E.queries()["tune_tree_metrics"](spark, SF0)
    assert seen == {"grid": {"maxDepth": list(range(8)), "maxBins": [2, 4, 8, 16, 32]}, "folds": 3,
                    "rows": spark.read.parquet(table_path(SF0, "embeddings")).count()}
