"""Helpers shared by the operators: input columns, pinned tables, Bloom filters built by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize, ship_package

from .textkernel import CHUNK_BYTES, Bloom, text_chunks


# Freed Arrow buffers go back to the system: whole documents pass through workers that live for the whole job.
pa.set_memory_pool(pa.system_memory_pool())

# Session settings for tables of whole documents, whose rows are long: rows and bytes that Spark hands to Python
# at a time, and rows that its Parquet reader decodes at a time.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 2 << 20,
            "spark.sql.parquet.columnarReaderBatchSize": 1024}


def small_batches(spark: SparkSession) -> SparkSession:
    """Lower the session's batch sizes to ``_BATCHES``: whole documents make long rows.

    Session settings, so they are made where a query or a pipeline stage begins, not inside operators.
    """
    for key, most in _BATCHES.items():
        old = spark.conf.get(key)
        if not old.isdigit() or int(old) > most or int(old) <= 0:
            spark.conf.set(key, str(most))
    return spark


def pin(df: DataFrame, options: dict | None = None) -> DataFrame:
    """Write once (with the writer's ``options``) under the shared checkpoint folder and read back: computed once, lineage cut."""
    return materialize(df, how="table", options=options)


def ready(df: DataFrame) -> DataFrame:
    """Make the package importable in the Python workers of the frame's session."""
    ship_package(df.sparkSession)
    return df


def blocks_of(df: DataFrame, text_col: str, block_bytes: int) -> DataFrame:
    """(block, rows): the rows of each task in blocks of about ``block_bytes`` of text, as compressed Arrow streams.

    Texts that are needed twice travel compressed. Rows are sorted by a hash of their columns within
    the task, so that a task that runs again makes the same blocks.
    """
    hashed = [F.col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def emit() -> pa.RecordBatch:
            table, sink = pa.Table.from_batches(held).combine_chunks(), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
                out.write_table(table)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])

        for batch in batches:
            for part, data, _ in text_chunks(batch, text_col, min(block_bytes, CHUNK_BYTES)):
                held.append(part)
                size += len(data)
                if size >= block_bytes:
                    yield emit()
                    block, held, size = block + 1, [], 0
        if held:
            yield emit()

    return ready(df).sortWithinPartitions(F.xxhash64(*hashed)).mapInArrow(run, "block long, rows binary")


def rows_of(block) -> pa.Table:
    """The rows of one block of ``blocks_of``."""
    return pa.ipc.open_stream(block).read_all()


def squeeze(a: np.ndarray) -> bytes:
    """64-bit integers, byte by byte of all, compressed: bytes that hardly vary take next to no room."""
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T), asbytes=True)


def loosen(raw: bytes, n: int, dtype: str) -> np.ndarray:
    """The ``n`` integers of ``squeeze``."""
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw, 8 * n), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def bloom_of(ids: DataFrame, col: str, bits: int) -> Bloom:
    """Bloom filter of an id column: one filter per task, merged on the driver pairwise by Spark.

    Its size is fixed by ``bits`` whatever the number of ids. Used only where a false hit costs work
    and changes no result.
    """
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bloom.empty(bits)
        for b in batches:
            own.add(b.column(0).drop_null().to_numpy(zero_copy_only=False))
        cells = own.bits.reshape(64, -1)
        on = [i for i in range(64) if cells[i].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(on, pa.int32()), pa.array([cells[i].tobytes() for i in on], pa.binary())], ["cell", "bits"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        out = np.zeros(bits // 8 // 64, np.uint8)
        for x in table["bits"]:
            out |= np.frombuffer(x.as_py(), np.uint8)
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([out.tobytes()], pa.binary())})

    ready(ids)
    parts = ids.select(F.col(col).cast("long")).mapInArrow(part, "cell int, bits binary")
    merged = parts.groupBy("cell").applyInArrow(merge, "cell int, bits binary")
    out = Bloom.empty(bits)
    cells = out.bits.reshape(64, -1)
    for r in merged.collect():  # 64 rows of bits / 512 bytes each
        cells[r["cell"]] = np.frombuffer(r["bits"], np.uint8)
    return out
