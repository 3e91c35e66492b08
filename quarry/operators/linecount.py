"""Line counting over text columns, files, and file-arrival events.

Counts follow ``str.splitlines``: every Unicode line boundary ends a line, a
last line without a boundary counts, a trailing boundary adds nothing, an
empty text has no lines.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.functions.json import parse_json
from quarry.functions.text import LINE_BREAK, line_break_count, line_count, plain_path, report_line
from quarry.session import estimate_partitions, list_by_cores, materialize, scratch_path
from quarry.sources.files import FileGroups

# The text reader already splits on \n, \r and \r\n; these are the other boundaries.
_EXTRA_BREAKS = r"[\x{0B}\x{0C}\x{1C}\x{1D}\x{1E}\x{85}\x{2028}\x{2029}]"


def with_line_count(df: DataFrame, text_col: str = "text", out: str = "n_lines") -> DataFrame:
    """Whole-text line count per row."""
    return df.withColumn(out, line_count(F.col(text_col)))


def read_files(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = True) -> DataFrame:
    """One row per file: path, modificationTime, length, content (binary). Paths of a list are taken as they are, not as patterns."""
    r = list_by_cores(spark).read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    return as_they_are(r, path).load(path)


def as_they_are(reader, path: str | list[str]):
    return reader.option("__globPaths__", "false") if isinstance(path, list) else reader


def read_file_groups(spark: SparkSession, path: str, glob: str | None = None) -> FileGroups:
    """The files of ``read_files``, group after group: their listings need not fit the driver together."""
    return FileGroups(spark, path, lambda paths: read_files(spark, paths, glob))


def count_file_lines(files: DataFrame | FileGroups, exclude: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(path, n_lines) for whole-file rows; files that are not UTF-8 are rejected.

    ``exclude`` is a regex on the path for files never to count (own output). Groups of ``read_file_groups`` are
    counted one after the other, into a table, unless the files are few.
    """
    if isinstance(files, FileGroups):
        if not files.few:
            checked = files.table(lambda frame, _: _checked(frame, exclude))
            good = checked.where("_ok").select("path", "n_lines")
            return good, checked.where("not _ok").select("path", F.lit("invalid utf-8").alias("reason"))
        files = files.only()
    if exclude:
        files = files.where(~F.col("path").rlike(exclude))
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    base = files.select("path", text.alias("_text"), valid.alias("_ok"))
    good = base.where("_ok").select("path", line_count(F.col("_text")).alias("n_lines"))
    rejected = base.where(~F.col("_ok")).select("path", F.lit("invalid utf-8").alias("reason"))
    return good, rejected


def _checked(files: DataFrame, exclude: str | None = None) -> DataFrame:
    """Counts and rejects of ``count_file_lines`` by one scan: path, _ok, n_lines (null if rejected)."""
    if exclude:
        files = files.where(~F.col("path").rlike(exclude))
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    return files.select("path", valid.alias("_ok"), F.when(valid, line_count(text)).alias("n_lines"))


def text_rows(lines: DataFrame) -> DataFrame:
    """Rows of the text source (``lineSep`` = line feed, batch or stream) with what ``file_totals`` needs of their files."""
    return lines.select("value", plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("_size"),
                        F.col("_metadata.file_block_start").alias("_block"))


def file_totals(rows: DataFrame) -> DataFrame:
    """One row per file from ``text_rows``: path, _ok, _lines, _ends, _over."""
    row = F.col("value")
    parts = rows.select(
        "path", "_size",
        (F.octet_length(row) + 1).cast("bigint").alias("_bytes"),
        (line_break_count(F.regexp_replace(row, r"\r\z", "")) + 1).alias("_lines"),
        row.rlike(_EXTRA_BREAKS + r"\z").alias("_ends"),
        F.is_valid_utf8(row).alias("_ok"),
        F.struct(F.col("_block").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_at"),
    )
    return parts.groupBy("path").agg(
        F.min("_ok").alias("_ok"), F.sum("_lines").alias("_lines"), F.max_by("_ends", "_at").alias("_ends"),
        (F.sum("_bytes") - F.max("_size")).alias("_over"),
    )


def totals_split(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``file_totals`` as (path, n_lines) and (path, reason)."""
    counts = files.where("_ok").select("path", counts_of(_open_end()).cast("bigint").alias("n_lines"))
    return counts, files.where("not _ok").select("path", F.lit("invalid utf-8").alias("reason"))


def _open_end() -> Column:
    # A byte order mark (3 bytes) is not part of the first row.
    return F.col("_over").isin(1, -2) & F.col("_ends")


def count_lines(
    spark: SparkSession, path: str, glob: str | None = None, manifest: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(counts, rejected)``: (path, n_lines) and (path, reason) of every file under ``path``.

    One exact scan for files of any size. The splittable text source cuts at line feeds only, so a huge
    file is spread over many tasks; the other boundaries are counted in each row (a carriage return
    before a line feed belongs to it). A file's last row ends without a line feed when its rows and
    their line feeds are one byte longer than the file; if that row ends in another boundary, no
    further line follows. Files that are not UTF-8 are rejected. Zero-length files are not listed by
    Spark's file sources; pass ``manifest`` (a ``path`` column) to report them with 0. Manifest entries
    that do not exist also count 0, and rejected files stay rejected. Many files are scanned group after group of
    folders (``FileGroups``), into a table of one row per file.
    """
    def read(paths: str | list[str]) -> DataFrame:
        r = list_by_cores(spark).read.option("recursiveFileLookup", "true").option("lineSep", "\n")
        if glob:
            r = r.option("pathGlobFilter", glob)
        return as_they_are(r, paths).text(paths)

    groups = FileGroups(spark, path, read)
    files = file_totals(text_rows(groups.only())) if groups.few else groups.table(lambda lines, _: file_totals(text_rows(lines)))
    counts, rejected = totals_split(files)
    if manifest is not None:
        known = manifest.select("path", plain_path(F.col("path"), decode=False).alias("_p"))
        every = files.select(F.col("path").alias("_p"), "_ok", counts_of(_open_end()).alias("n_lines"))
        counts = (known.join(every, "_p", "left").where("_ok is null or _ok")
                  .select("path", F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines")))
    return counts, rejected


def counts_of(open_end: Column) -> Column:
    """Lines of a file: one less when its open last row ends in a boundary."""
    return F.col("_lines") - F.when(open_end, 1).otherwise(0)


def line_counts(
    spark: SparkSession, path: str, glob: str | None = None, manifest: DataFrame | None = None
) -> DataFrame:
    """(path, n_lines) of every readable file under ``path``; ``count_lines`` also returns the rejects."""
    return count_lines(spark, path, glob, manifest)[0]


def with_report(counts: DataFrame) -> DataFrame:
    """Add the human-readable report line per file."""
    return counts.withColumn("report", report_line(F.col("path"), F.col("n_lines")))


def _file_name(files: DataFrame) -> Column:
    """The name by which Spark leaves files out of a scan; of frames that are no file scan, the path itself."""
    try:
        files.select("_metadata.file_path")
    except AnalysisException:
        return F.col("path")
    return F.col("_metadata.file_path")


FILES_PER_SCAN = 5_000  # file names that a scan is limited to one by one
BITS_PER_NAME = 16


def _hashes(name: Column, bits: int) -> list[Column]:
    return [F.pmod(h, F.lit(bits)) for h in (F.xxhash64(name), F.xxhash64(name, F.lit("again")))]


def _bitmap(names: DataFrame, col: str) -> tuple[bytes, int]:
    """(bitmap, its bits) of two hashes of each name, put together by Spark in pieces of 4 KB."""
    piece = 8 * 4096
    bits = piece * -(-BITS_PER_NAME * names.count() // piece)
    bit = names.select(F.explode(F.array(*[h + 1 for h in _hashes(F.col(col), bits)])).alias("b"))
    pieces = bit.groupBy(F.bitmap_bucket_number("b").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    out = bytearray(bits // 8)
    for r in pieces.toLocalIterator():
        out[(r["n"] - 1) * 4096:r["n"] * 4096] = r["m"]
    return bytes(out), bits


def _in_bitmap(name: Column, bitmap: bytes, bits: int) -> Column:
    def held(h: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.lit(bitmap), (F.floor(h / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (h % 8).cast("int")) == 1

    first, second = _hashes(name, bits)
    return held(first) & held(second)



def _listed(files: DataFrame) -> DataFrame:
    return files.select(plain_path(F.col("path"), decode=False).alias("path"), _file_name(files).alias("_file"))


def _limited(files: DataFrame, matched: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The scan of ``files`` limited to the names of ``matched``, and, if it lets other files through, the paths asked for."""
    file = _file_name(files)
    some = files.withColumn("path", plain_path(F.col("path"), decode=False))
    names = matched.where("_file is not null").select("_file").distinct()
    few = [r["_file"] for r in names.limit(FILES_PER_SCAN + 1).collect()]
    if len(few) <= FILES_PER_SCAN:
        return some.where(file.isin(few) if few else F.lit(False)), None
    return some.where(_in_bitmap(file, *_bitmap(names, "_file"))), matched.where("_file is not null").select("path")


def _count_matched_groups(wanted: DataFrame, files: FileGroups) -> tuple[DataFrame, DataFrame]:
    """``(missing, checked)``: wanted paths without a file, and ``_checked`` rows of those with one."""
    spark = files.spark
    listing = files.table(lambda frame, i: _listed(frame).withColumn("_group", F.lit(i)))
    matched = wanted.join(listing, "path", "left")
    table = scratch_path(spark, "matched")  # a folder a group, so that each group reads its own names
    spread = matched.repartition(estimate_partitions(matched), "_group", F.pmod(F.xxhash64("path"), F.lit(16)))
    spread.write.mode("overwrite").partitionBy("_group").parquet(table)
    matched = spark.read.schema("path string, _file string, _group int").parquet(table)
    held = {r["_group"] for r in matched.where("_group is not null").select("_group").distinct().collect()}  # numbers of groups

    def part(frame: DataFrame, i: int) -> DataFrame | None:
        if i not in held:
            return None
        some, asked = _limited(frame, matched.where(F.col("_group") == i))
        checked = _checked(some)
        return checked if asked is None else checked.join(asked, "path", "left_semi")

    checked = files.table(part) if held else spark.createDataFrame([], "path string, _ok boolean, n_lines bigint")
    return matched.where("_group is null").select("path"), checked


# Fixed value: the file-event message schema.
EVENT_SCHEMA = StructType([StructField("bucket", StringType()), StructField("file", StringType())])


def line_counts_from_events(
    events: DataFrame, files: DataFrame | FileGroups, value_col: str = "value", root: str = ""
) -> tuple[DataFrame, DataFrame]:
    """File-event messages ``{"bucket", "file"}`` -> per-file line counts.

    ``files`` is a frame of ``read_files`` over the buckets, or their ``read_file_groups``, whose listings are matched in
    one join and whose files are then scanned group after group; ``root`` is what stands before a
    bucket's name in its paths (``gs://``, ``hdfs:///data/``). Events are matched with the listing of the files
    (their paths alone), and the scan of contents is then limited to the matched files by
    ``_metadata.file_path``: other files are not opened, and no content goes through a join or an exchange.
    More than ``FILES_PER_SCAN`` names limit the scan by a bitmap of their hashes, two bytes a name, so the names never
    pass through the driver; of the other files about one in 70 is opened then, and a join drops
    its count. Returns ``(counts, rejected)``; rejected holds malformed
    messages, events whose file is missing, and files that are not UTF-8.
    """
    good, bad = parse_json(events, value_col, EVENT_SCHEMA)
    wanted = good.select(
        plain_path(F.concat(F.lit(root), F.regexp_replace("bucket", "/+$", ""), F.lit("/"), F.regexp_replace("file", "^/+", "")),
                   decode=False).alias("path")
    ).distinct()
    if isinstance(files, FileGroups) and files.few:
        files = files.only()
    if isinstance(files, FileGroups):
        missing, checked = _count_matched_groups(wanted, files)
        counted, unreadable = checked.where("_ok").select("path", "n_lines"), checked.where("not _ok").select("path", F.lit("invalid utf-8").alias("reason"))
    else:
        matched = materialize(wanted.join(_listed(files), "path", "left"), "table")
        some, asked = _limited(files, matched)
        counted, unreadable = count_file_lines(some)
        if asked is not None:
            counted, unreadable = (x.join(asked, "path", "left_semi") for x in (counted, unreadable))
        missing = matched.where("_file is null").select("path")
    rejected = (
        bad.select(F.col("raw_value").alias("message"), F.lit(None).cast("string").alias("path"), F.lit("malformed").alias("reason"))
        .unionByName(missing.select(F.lit(None).cast("string").alias("message"), "path", F.lit("missing").alias("reason")))
        .unionByName(unreadable.select(F.lit(None).cast("string").alias("message"), "path", "reason"))
    )
    return counted, rejected


__all__ = [
    "LINE_BREAK", "with_line_count", "read_files", "count_file_lines", "count_lines", "line_counts",
    "with_report", "line_counts_from_events", "EVENT_SCHEMA",
]
