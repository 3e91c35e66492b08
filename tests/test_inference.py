import numpy as np
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF0
from quarry.operators import inference
from quarry.operators.tuning import best_params, tune_tree, weighted_precision
from quarry.sources import derive


def test_nearest_centroid_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF0}/embeddings.parquet")
    labels, cents = inference.class_centroids(emb, "embedding", "label")
    pred = inference.classify(emb, "embedding", inference.nearest_centroid_factory(labels, cents),
                              inference.array_preprocess, inference.top1_decoder(labels))
    got = {r["vec_id"]: r["prediction"]["class"] for r in pred.collect()}
    local = emb.toPandas()
    x = np.stack(local["embedding"].map(lambda v: np.asarray(v, dtype="float64")))
    y = local["label"].to_numpy()
    c = np.stack([x[y == lab].mean(0) for lab in labels])
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(-1)
    want = {int(v): str(labels[i]) for v, i in zip(local["vec_id"], d.argmin(1))}
    assert got == want


def test_weighted_precision_matches_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (3.0, 0.0)],
                               "label double, prediction double")
    ours = weighted_precision(df).first()[0]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="weightedPrecision")
    assert abs(ours - ev.evaluate(df)) < 1e-12


def test_tune_tree_small_grid(spark):
    vecs = derive.vectors_from_embeddings(spark.read.parquet(f"{SF0}/embeddings.parquet"))
    model, metrics = tune_tree(vecs, grid={"maxDepth": [1, 3], "maxBins": [4]}, folds=2, seed=1, parallelism=2)
    m = metrics.collect()
    assert len(m) == 2 and all(0.0 <= r["avg_metric"] <= 1.0 for r in m)
    best = max(m, key=lambda r: r["avg_metric"])
    assert best_params(model)["maxDepth"] == best["maxDepth"]
    assert model.bestModel.transform(vecs).select("prediction").count() == vecs.count()


def test_centroids_of_wide_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 300))
    y = rng.integers(0, 4, size=200)
    df = spark.createDataFrame([(int(l), [float(v) for v in row]) for l, row in zip(y, x)], "label int, v array<double>")
    labels, cents = inference.class_centroids(df, "v", "label")
    want = np.stack([x[y == lab].mean(0) for lab in labels])
    assert np.allclose(cents, want, atol=1e-12)
