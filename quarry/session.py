"""Session construction and shared-storage helpers.

Lineage is cut with reliable checkpoints written under the folder the cluster
names in ``spark.checkpoint.dir``. A private folder is created only when the
setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def get_spark(
    master: str | None = None,
    app: str = "quarry",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs rely on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a local master (tests) may leave it unset and gets
    a fresh private folder; on a cluster every machine would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="quarry-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # core setting; the context call below suffices
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = f"{root}/quarry/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def materialize(df: DataFrame, how: str = "checkpoint", options: dict | None = None) -> DataFrame:
    """Pin a frame that is read more than once and must not change between reads.

    ``table`` writes it once as Parquet (with ``options``) under the shared checkpoint folder and
    reads it back: lineage is cut, a lost executor cannot make a second read
    see different rows, and the input is computed once. ``checkpoint`` uses
    ``Dataset.checkpoint`` (same guarantees; computes the input twice unless
    cached and keeps the partitioning). ``persist`` keeps it in executor
    memory/disk (recomputed from lineage on loss).
    """
    if how == "table":
        spark = df.sparkSession
        path = scratch_path(spark, "pinned")
        df.write.mode("overwrite").options(**(options or {})).parquet(path)
        return spark.read.parquet(path)
    if how == "checkpoint":
        checkpoint_root(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    raise ValueError(f"unknown materialize mode {how!r}")


def list_by_cores(spark: SparkSession) -> SparkSession:
    """Lower the session's setting so that sources list folders and files in four tasks a core at most.

    Spark's own limit is 10,000 tasks, so a folder of many folders, or a micro-batch of many files, is listed in
    tasks of one name each, whose start and results outweigh the names. A stream's source asks the session in
    every micro-batch, so the setting stays.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    most = 4 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(key)) > most:
        spark.conf.set(key, str(most))
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings inside the block."""
    old = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in Python workers (UDFs, stateful processors).

    Zips the package into the shared checkpoint folder and registers it with
    ``addPyFile`` once per application; a cluster that installs the package on
    every node does not need it, but it is harmless there.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target = scratch_path(spark, "pyfiles")
    local = target.replace("file:", "", 1) if target.startswith("file:") or "://" not in target else None
    if local is None:
        local = tempfile.mkdtemp(prefix="quarry-pkg-")  # zipped on the driver, then shipped by Spark
    archive = os.path.join(local, "quarry.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def estimate_partitions(
    df: DataFrame, target_bytes: int = 64 << 20, max_partitions: int = 1_000_000
) -> int:
    """Partition count for an explicit repartition, from the optimizer's size estimate.

    Explicit counts (e.g. ``repartitionByRange``) are not split by AQE, so they
    are sized to the data: about ``target_bytes`` of estimated input per
    partition, at least the session's default parallelism. Without column statistics
    the optimizer multiplies the sizes of join inputs, so a plan of several inputs is
    taken to be no larger than their sum. Falls back to
    ``spark.sql.shuffle.partitions`` when no estimate is available.
    """
    spark = df.sparkSession
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        size = int(str(plan.stats().sizeInBytes()))
        leaves = plan.collectLeaves()
        of = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        if len(of) > 1:
            size = min(size, sum(of))
        if any(x >= (1 << 62) for x in of):  # a leaf of unknown size, which a projection may have scaled down
            return default
    except Exception:  # no estimate (e.g. some remote plans)
        return default
    if size <= 0 or size >= (1 << 62):
        return default
    floor = max(1, spark.sparkContext.defaultParallelism)
    return int(min(max_partitions, max(floor, -(-size // target_bytes))))
