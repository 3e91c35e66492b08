"""Batched model inference in an Arrow iterator pandas UDF.

The model is built once per task by ``model_factory`` on the executor (nothing
heavy is shipped from the driver), each Arrow batch goes through
``preprocess -> model -> decode`` and one output frame comes back per batch.
"""

from __future__ import annotations

import sys as _sys

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import parent_dir

# Workers (including Spark's driver-side Python runner for stateful
# processors) unpickle this module's classes and functions by value, so they
# do not need the package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

# Fixed value: the prediction struct of the classifier.
PREDICTION_SCHEMA = "class string, desc string, score float"


def model_udf(
    model_factory: Callable[[], Callable[[np.ndarray], np.ndarray]],
    preprocess: Callable[[pd.Series], np.ndarray],
    decode: Callable[[np.ndarray], pd.DataFrame],
    schema: str = PREDICTION_SCHEMA,
):
    """Build the pandas UDF: Iterator[Series] -> Iterator[DataFrame]."""

    @F.pandas_udf(schema)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for s in batches:
            yield decode(model(preprocess(s))).reset_index(drop=True)

    return predict


def classify(
    df: DataFrame,
    input_col: str,
    model_factory,
    preprocess,
    decode,
    schema: str = PREDICTION_SCHEMA,
    label_from_path: str | None = None,
    with_time: bool = False,
) -> DataFrame:
    """Add ``prediction`` (struct); optionally ``label`` from the file's folder
    and ``processing_time``."""
    from quarry.session import ship_package

    ship_package(df.sparkSession)
    out = df.withColumn("prediction", model_udf(model_factory, preprocess, decode, schema)(F.col(input_col)))
    if label_from_path:
        out = out.withColumn("label", parent_dir(F.col(label_from_path)))
    if with_time:
        out = out.withColumn("processing_time", F.current_timestamp())
    return out


# --- a small model family used for the embeddings table -----------------------


def class_centroids(
    df: DataFrame, vec_col: str, label_col: str, max_classes: int = 100_000, max_bytes: int = 64 << 20
) -> tuple[list, np.ndarray]:
    """Mean vector per class, computed by Spark (partial aggregation per task).

    Only the centroid matrix reaches the driver and then every task (it is the
    model); its size, classes x dims x 8 bytes, is checked against
    ``max_classes`` and ``max_bytes`` before anything is collected.
    """
    stats = df.agg(F.countDistinct(label_col).alias("n"), F.max(F.size(vec_col)).alias("d")).first()
    n, dims = stats["n"], stats["d"] or 0
    if n > max_classes or n * dims * 8 > max_bytes:
        raise ValueError(f"{n} classes x {dims} dims exceed the model budget")
    if dims <= 256:
        # one pass, one sum per dimension (partial aggregation per task)
        sums = df.groupBy(label_col).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.col(vec_col)[i].cast("double")).alias(f"s{i}") for i in range(dims)],
        )
        rows = sorted(sums.collect(), key=lambda r: r[label_col])
        labels = [r[label_col] for r in rows]
        mat = np.array([[r[f"s{i}"] / r["n"] for i in range(dims)] for r in rows], dtype="float64")
        return labels, mat
    # wide vectors: one row per (class, position) after a positional explode
    means = (
        df.select(label_col, F.posexplode(vec_col).alias("i", "x"))
        .groupBy(label_col, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
        .collect()
    )
    labels = sorted({r[label_col] for r in means})
    at = {lab: j for j, lab in enumerate(labels)}
    mat = np.zeros((len(labels), dims), dtype="float64")
    for r in means:
        mat[at[r[label_col]], r["i"]] = r["m"]
    return labels, mat


def nearest_centroid_factory(labels: list, centroids: np.ndarray):
    """Model factory: squared distances to each centroid."""

    def factory():
        c = centroids

        def model(x: np.ndarray) -> np.ndarray:
            d = (x * x).sum(1)[:, None] - 2.0 * x @ c.T + (c * c).sum(1)[None, :]
            return np.maximum(d, 0.0)

        return model

    return factory


def array_preprocess(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in s]) if len(s) else np.zeros((0, 0))


def text_vector_preprocess(s: pd.Series) -> np.ndarray:
    """File bytes holding comma-separated numbers -> one row vector per file."""
    rows = [np.asarray(bytes(b).decode("utf-8").strip().split(","), dtype="float32") for b in s]
    return np.stack(rows).astype("float64") if rows else np.zeros((0, 0))


def top1_decoder(labels: list):
    """Smallest distance wins; score = 1 / (1 + distance)."""

    def decode(d: np.ndarray) -> pd.DataFrame:
        if d.size == 0:
            return pd.DataFrame({"class": [], "desc": [], "score": []})
        i = d.argmin(1)
        best = d[np.arange(len(i)), i]
        return pd.DataFrame({
            "class": [str(labels[j]) for j in i],
            "desc": [f"nearest centroid of class {labels[j]}" for j in i],
            "score": (1.0 / (1.0 + best)).astype("float32"),
        })

    return decode


def topk_schema(k: int) -> str:
    return f"top{k} array<struct<class: string, desc: string, score: float>>"


def topk_decoder(labels: list, k: int):
    """The ``k`` nearest classes per row, best first (use with ``topk_schema(k)``)."""

    def decode(d: np.ndarray) -> pd.DataFrame:
        kk = min(k, d.shape[1]) if d.size else 0
        idx = np.argsort(d, axis=1)[:, :kk] if d.size else np.zeros((0, 0), dtype=int)
        out = [
            [{"class": str(labels[j]), "desc": f"nearest centroid of class {labels[j]}",
              "score": float(1.0 / (1.0 + d[r, j]))} for j in row]
            for r, row in enumerate(idx)
        ]
        return pd.DataFrame({f"top{k}": out})

    return decode


def path_label(path: Column) -> Column:
    return parent_dir(path)
