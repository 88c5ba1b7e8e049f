"""The whole way in three steps, each of which reads the table the one before has written.

files or images -> features -> reduced vectors -> classifiers and scores

The model sees every image once: all later work starts from the written features. A step that is
lost can be run again from its input table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vecloom.functions import label_from_path
from vecloom.operators import classification, evaluation, labels, reduction
from vecloom.operators.featurize import featurize
from vecloom.sources import read_features, write_features

REDUCED = ("path", "Classe", "features", "features_vectors", "features_scaled", "vectors_pca")


def extract_features(
    df: DataFrame,
    out: str,
    model_fn: Callable[[Any], Any],
    input_col: str = "content",
    path_col: str = "path",
    mode: str = "overwrite",
    label_of: Callable[[str], Column] = label_from_path,
    **options: Any,
) -> dict[str, int]:
    """Write ``path, Classe, features``; the options are those of :func:`featurize`.

    ``label_of=label_from_uri`` reads labels off ``image.origin``, where paths are escaped.

    Returns how many rows were written and how many of them lack a label or features, counted
    while writing. The driver lists all files of ``df``, so take a collection of more than some
    ten million files folder by folder, with ``mode='append'``.
    """
    labelled = df.withColumn("Classe", label_of(path_col))
    table = featurize(labelled, input_col, model_fn, **options).select(
        F.col(path_col).alias("path"), "Classe", "features"
    )
    seen = Observation()
    table = table.observe(
        seen,
        F.count("*").alias("rows"),
        F.count_if(F.col("Classe").isNull()).alias("without_label"),
        F.count_if(F.col("features").isNull()).alias("without_features"),
    )
    write_features(table, out, mode=mode)
    return seen.get


def extract_new_features(
    files: DataFrame,
    out: str,
    checkpoint: str,
    model_fn: Callable[[Any], Any],
    label_of: Callable[[str], Column] = label_from_path,
    **options: Any,
) -> int:
    """Append ``path, Classe, features`` of the files that no run with this checkpoint has seen.

    ``files`` is a stream (:func:`vecloom.sources.stream_files`). The run takes all files that are
    there, and ends; one that is broken off goes on where it stopped, and a batch's
    rows are in ``out`` once or not at all. Returns the number of rows.
    """
    if not files.isStreaming:
        raise ValueError("files is no stream")
    labelled = files.withColumn("Classe", label_of("path"))
    table = featurize(labelled, "content", model_fn, **options).select("path", "Classe", "features")
    run = (
        table.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    run.awaitTermination()
    return sum(p.numInputRows for p in run.recentProgress)


def reduce_features(
    spark: SparkSession,
    features_path: str,
    out: str,
    k: int | None = None,
    threshold: float = 0.95,
    width: int | None = None,
    fit_on: str = "all",
    columns: Sequence[str] = REDUCED,
) -> tuple[reduction.Components, int]:
    """Standardise, project on ``k`` components (or as many as ``threshold`` needs) and write.

    ``fit_on='train'`` fits on the training part only. ``columns`` may name fewer columns: the
    raw and standardised vectors take ten times the space of the reduced ones, and training
    reads only ``path, Classe, vectors_pca``.
    """
    table = read_features(spark, features_path).where(F.col("features").isNotNull())
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on is {fit_on}: want all or train")
    fitted = table if fit_on == "all" else labels.hash_split(table, "path")[0]
    model = reduction.fit_components(fitted)
    k = k or reduction.choose_k(model, threshold, width).k
    write_features(model.transform(table, k), out, columns)
    return model, k


@dataclass(frozen=True)
class Trained:
    """Fitted classifiers by kind, the two parts of the table, and the classes' names."""

    models: dict[str, Model]
    train: DataFrame
    valid: DataFrame
    names: DataFrame


def train_classifiers(
    spark: SparkSession,
    reduced_path: str,
    kinds: Sequence[str] = ("lr", "tree", "forest"),
    layout_partitions: int | None = None,
) -> Trained:
    """Index the labels, split by path and fit each kind on the training part.

    ``layout_partitions`` makes forests repeatable across layouts of the table, see
    :func:`classification.stable_layout`.
    """
    table = read_features(spark, reduced_path, ("path", "Classe", "vectors_pca"))
    table = table.where(F.col("Classe").isNotNull())
    index = labels.fit_label_index(table)
    train, valid = (index.transform(part) for part in labels.hash_split(table, "path"))
    laid_out = train
    if layout_partitions:
        laid_out = classification.stable_layout(train, "path", layout_partitions)
    models = {kind: classification.train(kind, laid_out) for kind in kinds}
    return Trained(models, train, valid, labels.label_table(table, index))


def predictions(models: dict[str, Model], df: DataFrame) -> DataFrame:
    """``path, Classe_index, kind, prediction`` of all classifiers, in one scan of ``df``."""
    for kind, model in models.items():
        alone = model.copy({model.rawPredictionCol: "", model.probabilityCol: ""})
        df = alone.setPredictionCol(f"{kind}_prediction").transform(df)
    both = (
        F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_prediction").alias("prediction"))
        for kind in models
    )
    return df.select("path", "Classe_index", F.inline(F.array(*both)))


def _scored(trained: Trained, part: str) -> DataFrame:
    if part not in ("train", "valid"):
        raise ValueError(f"part is {part}: want train or valid")
    return predictions(trained.models, getattr(trained, part))


def compare(trained: Trained, part: str = "valid") -> DataFrame:
    """``kind, n, accuracy, test_error`` on the validation or the training part."""
    return evaluation.accuracy(_scored(trained, part), by=("kind",))


def reports(trained: Trained, part: str = "valid") -> DataFrame:
    """The report of each kind, with the classes' names, on the validation or the training part."""
    return evaluation.named_report(_scored(trained, part), trained.names, by=("kind",))
