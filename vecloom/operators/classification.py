"""Classifiers on a vector column, and what they learned as DataFrames."""

from __future__ import annotations

from collections.abc import Sized
from typing import Any

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import scratch_path, small_frame

# The settings of the fits; everything else is Spark's default.
SEED = 21
KINDS = {
    "lr": (LogisticRegression, {"maxIter": 5}),
    "tree": (DecisionTreeClassifier, {"seed": SEED}),
    "forest": (RandomForestClassifier, {"numTrees": 20, "seed": SEED}),
}


def train(
    kind: str,
    df: DataFrame,
    label_col: str = "Classe_index",
    features_col: str = "vectors_pca",
    **params: Any,
) -> Model:
    """Fit ``lr``, ``tree`` or ``forest``; ``params`` replace the settings above."""
    if kind not in KINDS:
        raise ValueError(f"{kind}: want one of {', '.join(KINDS)}")
    estimator, settings = KINDS[kind]
    chosen = {"labelCol": label_col, "featuresCol": features_col, **settings, **params}
    return estimator(**chosen).fit(df)


def stable_layout(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows where their key puts them, in key order; ``key`` must be unique.

    A forest draws its samples by position, so its trees depend on the layout. After this they
    depend on the rows only, at the price of one shuffle.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key)


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add ``rawPrediction, probability, prediction``."""
    return model.transform(df)


def coefficients(spark: SparkSession, model: Model) -> DataFrame:
    """``class_index, feature, coefficient`` of a logistic regression."""
    matrix = model.coefficientMatrix.toArray()
    rows, cols = np.indices(matrix.shape, dtype=np.int32)
    return small_frame(
        spark, class_index=rows.ravel(), feature=cols.ravel(), coefficient=matrix.ravel()
    )


def intercepts(spark: SparkSession, model: Model) -> DataFrame:
    """``class_index, intercept`` of a logistic regression."""
    values = model.interceptVector.toArray()
    return small_frame(spark, class_index=_positions(values), intercept=values)


def loss_history(spark: SparkSession, model: Model) -> DataFrame:
    """``iteration, objective``; iteration 0 is the start."""
    values = np.array(model.summary.objectiveHistory)
    return small_frame(spark, iteration=_positions(values), objective=values)


def tree_stats(spark: SparkSession, model: Model) -> DataFrame:
    """``tree, nodes, depth``: one row per tree of a tree or forest."""
    trees = getattr(model, "trees", [model])
    return small_frame(
        spark,
        tree=_positions(trees),
        nodes=np.array([tree.numNodes for tree in trees], np.int32),
        depth=np.array([tree.depth for tree in trees], np.int32),
    )


def tree_text(model: Model) -> str:
    """The splits of a tree or forest as text."""
    return model.toDebugString


def tree_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """The nodes of a tree or forest as rows, read from the saved model's own table.

    ``tree, node, parent, side, feature, threshold, gain, impurity, n, prediction``: node 0 is the
    root, which has no parent; values up to the threshold go to the child on the left. Leaves have
    no feature, threshold and gain. ``impurity`` is that of the node's rows by the Gini index.
    Nothing passes through the driver, and splits on categories have no threshold.
    """
    path = scratch_path(spark, "model")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        saved = saved.withColumn("tree", F.lit(0))
    inner, rows = F.col("leftChild") >= 0, F.col("impurityStats")
    n = F.aggregate(rows, F.lit(0.0), lambda total, x: total + x)
    squares = F.aggregate(rows, F.lit(0.0), lambda total, x: total + x * x)
    continuous = inner & (F.col("split.numCategories") < 0)
    threshold = F.get("split.leftCategoriesOrThreshold", F.lit(0))
    nodes = saved.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(continuous, threshold).alias("threshold"),
        F.when(inner, F.col("gain")).alias("gain"),
        (F.lit(1.0) - squares / (n * n)).alias("impurity"),
        n.cast("bigint").alias("n"),
        "prediction",
    )

    def child(name: str, side: str) -> Column:
        return F.struct(F.col(name).alias("node"), F.lit(side).alias("side"))

    children = F.array(child("leftChild", "left"), child("rightChild", "right"))
    edges = saved.where(inner).select("tree", F.col("id").alias("parent"), F.inline(children))
    return nodes.join(edges, ["tree", "node"], "left").select(
        "tree", "node", "parent", "side", "feature", "threshold", "gain", "impurity", "n",
        "prediction",
    )


def _positions(values: Sized) -> np.ndarray:
    return np.arange(len(values), dtype=np.int32)
