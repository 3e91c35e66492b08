"""Batch sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import estimate_partitions

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for a null in a ``key=value`` folder


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True, num_files: int | None = None
) -> None:
    """Delimited text output. ``num_files`` caps the writer tasks (``coalesce``);
    by default every partition writes its own file, in parallel."""
    out = df.coalesce(num_files) if num_files else df
    out.write.mode(mode).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def key_folder(name: str, col: Column) -> Column:
    """``name=<value>`` as Spark's writers name a folder."""
    return F.concat(F.lit(f"{name}="), F.coalesce(col.cast("string"), F.lit(NULL_FOLDER)))


def write_named_files(df: DataFrame, root: str, file: Column, line: Column, header: str | None = None) -> int:
    """Write ``line`` of all rows into the text file named by ``file`` (a path below ``root``), one line a row; returns the
    number of files.

    For very many small files. The rows of a file meet in one task, which writes it under a hidden name and then
    renames it, so a repeated task replaces its own files. Spark's partitioned writer moves every folder
    in the driver when the job commits, one after the other. A null line is an empty one; ``header`` starts each file.
    """
    root = "/" + root[5:].lstrip("/") if root.startswith("file:") else root
    rows = df.select(file.alias("file"), F.coalesce(line.cast("string"), F.lit("")).alias("line"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(root)
        base, mark = base.rstrip("/"), uuid.uuid4().hex
        done, folder, name, out = 0, None, None, None

        def hidden() -> str:
            return f"{folder}/.{name.rsplit('/', 1)[-1]}.{mark}"

        def finish() -> None:
            out.close()
            fs.move(hidden(), f"{base}/{name}")

        for batch in batches:
            for f, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if f != name:
                    if out is not None:
                        finish()
                        done += 1
                    name, at = f, f"{base}/{f}".rsplit("/", 1)[0]
                    if at != folder:
                        fs.create_dir(at)
                        folder = at
                    out = fs.open_output_stream(hidden())
                    if header is not None:
                        out.write(header.encode() + b"\n")
                out.write(text.encode() + b"\n")
        if out is not None:
            finish()
            done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["n"])

    ready = rows.repartition(estimate_partitions(rows), "file").sortWithinPartitions("file")
    return ready.mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
