"""File readers: CSV/TSV with explicit schemas, LibSVM, whole files, text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from quarry.session import scratch_path, settings

# Fixed value: the click log schema (tab separated, header line).
CLICK_SCHEMA = StructType([
    StructField("Date", StringType(), True),
    StructField("Time", StringType(), True),
    StructField("UserID", StringType(), True),
])

# Fixed value: untyped bar columns as they appear in the CSV header.
BAR_TEXT_SCHEMA = StructType([
    StructField(c, StringType(), True) for c in ("timestamp", "open", "high", "low", "close", "volume")
])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    infer: bool = False,
    options: dict | None = None,
) -> DataFrame:
    """CSV (or any delimited text) with a declared schema.

    Inference is opt-in: it costs a full extra pass and drifts with the data
    (a column of one date infers differently from a mixed one).
    """
    r = spark.read.option("header", header).option("sep", sep)
    if header and schema is not None:
        # Check header names against the schema instead of trusting positions.
        r = r.option("enforceSchema", False)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_tsv(spark: SparkSession, path, schema=CLICK_SCHEMA, header: bool = True) -> DataFrame:
    return read_csv(spark, path, schema, header=header, sep="\t")


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``label`` double + sparse ``features``. Pass ``num_features`` so train and
    test files get the same vector size (otherwise it is inferred per file)."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def read_binary_files(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """One row per file: path, modificationTime, length, content."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def read_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Lines (``value``) or, with ``whole``, one row per file; plus the file path."""
    from pyspark.sql import functions as F

    df = spark.read.option("wholetext", whole).text(path)
    return df.select(F.col("_metadata.file_path").alias("path"), "value")


FILES_PER_FRAME = 5_000  # files that one frame lists and scans as it is
FILES_PER_GROUP = 25_000
# For scans of very many small files: tasks of several hundred files instead of a few, listing in tasks, and no listing
# kept by the session after its frame.
_MANY_FILES = {"spark.sql.files.openCostInBytes": "16k", "spark.sql.sources.parallelPartitionDiscovery.threshold": "1",
               "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}


def _left_out(name: str) -> bool:
    """Names that Spark's file sources do not list."""
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_metadata", "_common_metadata"))


def file_groups(spark: SparkSession, path: str, most: int) -> tuple[list[list[str]], int]:
    """``(groups, files)``: folders and files below ``path`` in lists that hold about ``most`` files each at most, and
    the number of all files.

    Cut at folders only, so the driver lists folders, and files that lie beside folders; a folder without folders stays
    whole. A pattern, a missing path and a path of at most ``most`` files are one group, the path itself.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(root):
        return [[path]], 0
    whole = fs.getContentSummary(root)
    if whole.getFileCount() <= most or whole.getDirectoryCount() <= 1:
        return [[path]], whole.getFileCount()
    groups, held = [[]], 0
    folders = [root]
    while folders:
        for entry in fs.listStatus(folders.pop()):
            at, n = entry.getPath(), 1
            if _left_out(at.getName()):
                continue
            if entry.isDirectory():
                below = fs.getContentSummary(at)
                n = below.getFileCount()
                if n > most and below.getDirectoryCount() > 1:
                    folders.append(at)
                    continue
            if held and held + n > most:
                groups.append([])
                held = 0
            groups[-1].append(at.toString())
            held += n
    return groups, whole.getFileCount()


class FileGroups:
    """The files under ``path``, of which the driver holds one group's listing at a time, however many there are.

    ``frame`` makes the frame of a list of paths. ``few`` tells that one lazy frame does, ``only()``.
    """

    def __init__(self, spark: SparkSession, path: str, frame: Callable[[str | list[str]], DataFrame]):
        self.spark, self.path, self.frame = spark, path, frame
        self.groups, n = file_groups(spark, path, FILES_PER_GROUP)
        self.few = len(self.groups) == 1 and n <= FILES_PER_FRAME

    def only(self) -> DataFrame:
        return self.frame(self.path)

    def table(self, part: Callable[[DataFrame, int], DataFrame | None]) -> DataFrame:
        """The rows of ``part(frame, number of the group)`` of all groups, scanned and written one after the other;
        None leaves a group out."""
        own = len(self.groups) == 1
        frames = ((lambda g=g: self.frame(self.path if own else g)) for g in self.groups)
        return table_of(self.spark, frames, part)


def table_of(spark: SparkSession, frames, part: Callable[[DataFrame, int], DataFrame | None]) -> DataFrame:
    """The rows of ``part(frame(), i)`` of the i-th of ``frames``, scanned and written one after the other."""
    table, schema = scratch_path(spark, "file-groups"), None
    with settings(spark, _MANY_FILES):
        for i, frame in enumerate(frames):
            out = part(frame(), i)
            if out is not None:
                out.write.mode("append").parquet(table)
                schema = out.schema
    return spark.createDataFrame([], "path string") if schema is None else spark.read.schema(schema).parquet(table)
