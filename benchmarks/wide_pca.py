"""Standardise + PCA at the width of a real network's output: this package and MLlib.

``python benchmarks/wide_pca.py [copies] [dims] [k]`` makes ``copies`` x 2,000 vectors from the
embeddings table, fits and projects them both ways and prints the seconds of each step.
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vecloom.operators import reduction  # noqa: E402
from vecloom.operators.featurize import featurize  # noqa: E402
from vecloom.session import scratch_path  # noqa: E402


def waves(weights: np.ndarray):
    return lambda batch: np.cos(8 * batch @ weights)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main(copies: int = 4, dims: int = 2048, k: int = 325, mllib: bool = True) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    path = scratch_path(spark, "wide")
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"), "embedding"
    )
    turned = table.select(F.transform("embedding", lambda v: v * F.col("copy")).alias("v"))
    turned = turned.select(F.col("v").cast("array<float>").alias("v")).repartition(8)
    weights = np.random.default_rng(21).standard_normal((64, dims), dtype=np.float32)
    featurize(turned, "v", waves, weights).select("features").write.parquet(path)
    wide = spark.read.parquet(path)
    print(f"{copies * 2000} rows of {dims}, k = {k}")

    def timed(name: str, action):
        start = time.perf_counter()
        result = action()
        print(f"{name:28s}{time.perf_counter() - start:8.2f} s", flush=True)
        return result

    for _ in range(2):
        model = timed("one pass: fit", lambda: reduction.fit_components(wide))
        timed("one pass: project", lambda: run(model.transform(wide, k).select("vectors_pca")))
    if mllib:
        vectors = wide.select(array_to_vector("features").alias("v"))
        scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True)
        scaling = timed("MLlib: fit scaler", lambda: scaler.fit(vectors))
        scaled = scaling.transform(vectors)
        pca = timed("MLlib: fit PCA", lambda: PCA(k=k, inputCol="s", outputCol="p").fit(scaled))
        timed("MLlib: project", lambda: run(pca.transform(scaled).select("p")))
        same = np.abs(pca.explainedVariance.toArray() - model.explained_variance[:k]).max()
        print(f"largest difference of the variance ratios: {same:.1e}")
    spark.stop()


if __name__ == "__main__":
    numbers = [int(a) for a in sys.argv[1:4]]
    main(*numbers, mllib="--ours" not in sys.argv)
