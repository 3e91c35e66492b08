"""Line counts for files as they arrive."""

from __future__ import annotations

import logging
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.linecount import as_they_are, file_totals, read_file_groups, text_rows, totals_split, with_report
from quarry.operators.ranks import global_positions
from quarry.session import list_by_cores, materialize
from quarry.sources import files as source
from quarry.streaming.runner import start_foreach_batch

_ARRIVALS = "path string, modificationTime timestamp, chunk bigint"


def line_counts_stream(
    spark: SparkSession,
    source_dir: str,
    checkpoint: str,
    out_path: str,
    glob: str | None = None,
    exclude: str | None = None,
    max_files_per_trigger: int | None = None,
    trigger: dict | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Count lines of each new file under ``source_dir`` once.

    The checkpoint records which files were taken, so a restart neither skips
    nor recounts a committed file. One row per file (path, n_lines, report) goes
    to ``out_path``; output lives apart from the input, and
    ``exclude`` (regex on the path) skips files that must never be counted.

    One form for files of any size, with the counts and rejects of the batch ``count_lines``: lines
    are read with the splittable text source, and every file goes whole to one
    micro-batch, so its count there is final. Each micro-batch scans its files once and writes
    both outputs under ``batch_id=<id>`` with overwrite, so a repeated batch replaces its own rows.
    Files that are not UTF-8 go to ``rejects_path`` (path, reason), if given.

    Spark's file source holds the names and statuses of all files in the driver. Here the names of new files are
    written to tables under ``checkpoint`` (``arrivals``, at most ``max_files_per_trigger`` names a table file),
    and the stream reads those: a micro-batch is such a file, or all there are without a limit, and its files are
    scanned in parts of a bounded number. Names are listed before the stream starts, and while it runs if its
    trigger does not end by itself. A checkpoint of Spark's file source is gone on with as it is.
    """
    list_by_cores(spark)
    if _path(spark, f"{checkpoint}/sources", "exists"):
        return _start_plain(spark, source_dir, checkpoint, out_path, glob, exclude, max_files_per_trigger, trigger, rejects_path)
    arrivals = f"{checkpoint}/arrivals"
    list_arrivals(spark, source_dir, arrivals, glob, max_files_per_trigger)
    r = spark.readStream.schema(_ARRIVALS).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", 1)
    names = r.parquet(arrivals)
    if exclude:
        names = names.where(~F.col("path").rlike(exclude))

    def write(batch: DataFrame, batch_id: int) -> None:
        _write(_totals(batch), out_path, rejects_path, batch_id)

    query = start_foreach_batch(names, f"{checkpoint}/stream", write, mode="append", trigger=trigger)
    if not {"availableNow", "once"} & set(trigger or {}):
        threading.Thread(target=_keep_listing, args=(query, spark.newSession(), source_dir, arrivals, glob, max_files_per_trigger),
                         daemon=True).start()
    return query


def list_arrivals(spark: SparkSession, source_dir: str, arrivals: str, glob: str | None = None, per_file: int | None = None) -> int:
    """Add the files under ``source_dir`` that ``arrivals`` does not name, oldest first, ``per_file`` names a table file;
    returns their number."""
    groups = read_file_groups(spark, source_dir, glob)
    cols = ["path", "modificationTime"]
    listed = groups.only().select(cols) if groups.few else groups.table(lambda frame, _: frame.select(cols))
    if _path(spark, arrivals, "exists"):
        known = spark.read.schema(_ARRIVALS).option("recursiveFileLookup", "true").parquet(arrivals)
        listed = listed.join(known, "path", "left_anti")
    else:
        _path(spark, arrivals, "mkdirs")  # a stream needs its folder
    new = materialize(listed.select(cols), "table")
    n = new.count()
    most = per_file or source.FILES_PER_GROUP
    if n:
        placed = global_positions(new, ["modificationTime", "path"], "_at")
        placed = placed.select(*cols, F.floor(F.col("_at") / source.FILES_PER_GROUP).alias("chunk"), F.floor(F.col("_at") / most).alias("part"))
        (placed.repartition(-(-n // most), "part").sortWithinPartitions("part").write.mode("append").partitionBy("part").parquet(arrivals))
    return n


def _keep_listing(query: StreamingQuery, spark: SparkSession, *args) -> None:
    """List again while the query runs, with pauses as long as a listing takes, a second at least."""
    list_by_cores(spark)
    while query.isActive:
        began = time.monotonic()
        try:
            list_arrivals(spark, *args)
        except Exception:  # a folder that changes meanwhile; the next listing tries again
            if query.isActive:
                logging.getLogger(__name__).exception("new files could not be listed")
        query.awaitTermination(max(1, int(time.monotonic() - began)))


def _totals(names: DataFrame) -> DataFrame:
    """``file_totals`` of the named files, chunk after chunk of names."""
    spark = names.sparkSession
    chunks = [r["chunk"] for r in names.select("chunk").distinct().orderBy("chunk").collect()]  # one in FILES_PER_GROUP names

    def frame(chunk: int) -> DataFrame:
        paths = [r["path"] for r in names.where(F.col("chunk") == chunk).select("path").distinct().collect()]
        return _read_text(spark, paths)

    def frames():
        for c in chunks:
            yield lambda: frame(c)

    if not chunks:
        return spark.createDataFrame([], "path string, _ok boolean, _lines bigint, _ends boolean, _over bigint")
    return source.table_of(spark, frames(), lambda lines, _: file_totals(text_rows(lines)))


def _read_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of many files by name, which go to the JVM in one call."""
    names = spark._jvm.java.util.regex.Pattern.compile("\0").split("\0".join(paths))
    r = as_they_are(spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n"), paths)
    return r._df(r._jreader.text(names))


def _write(totals: DataFrame, out_path: str, rejects_path: str | None, batch_id: int) -> None:
    counts, rejected = totals_split(totals)
    with_report(counts).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    if rejects_path:
        rejected.write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")


def _path(spark: SparkSession, path: str, do: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return getattr(at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), do)(at)


def _start_plain(
    spark: SparkSession, source_dir: str, checkpoint: str, out_path: str, glob: str | None, exclude: str | None,
    max_files_per_trigger: int | None, trigger: dict | None, rejects_path: str | None,
) -> StreamingQuery:
    """The stream of Spark's file source, for checkpoints that were begun with it."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true").option("lineSep", "\n")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = text_rows(r.load(source_dir))
    if exclude:
        rows = rows.where(~F.col("path").rlike(exclude))

    def write(batch: DataFrame, batch_id: int) -> None:
        totals = file_totals(batch).persist()  # one row per file of this micro-batch
        try:
            _write(totals, out_path, rejects_path, batch_id)
        finally:
            totals.unpersist()

    return start_foreach_batch(rows, checkpoint, write, mode="append", trigger=trigger)
