"""The registered queries. ``(spark, folder of the tables) -> DataFrame`` of plain columns."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions import dense_vector, label_from_path, long_form, models
from vecloom.operators import classification, evaluation, labels, reduction
from vecloom.operators.featurize import featurize, to_rgb
from vecloom.plans import bitmaps, flow
from vecloom.session import scratch_path, small_frame
from vecloom.sources import read_features, read_files, read_images, write_features

Query = Callable[[SparkSession, str], DataFrame]

REDUCED_K = 32
SCANS_PER_TASK = 32
TRUTH, GUESS = "quality", "toxic"


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded double without negative zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features table: ``vec_id, path, Classe, features``."""
    table = read_features(spark, f"{sf_dir}/embeddings.parquet")
    return table.select(
        "vec_id",
        F.col("vec_id").cast("string").alias("path"),
        F.concat(F.lit("class-"), F.col("label")).alias("Classe"),
        F.col("embedding").alias("features"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of true and predicted class."""
    return read_features(spark, f"{sf_dir}/labels.parquet", (TRUTH, GUESS))


_image_folders: dict[tuple[str, str], str] = {}


def image_folder(spark: SparkSession, sf_dir: str) -> str:
    """The folder of image files made from the vectors, once per application.

    It stands for the photos, which are there before a job starts.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _image_folders:
        try:
            spark.read.text(f"{_image_folders[key]}/_SUCCESS")
            return _image_folders[key]
        except AnalysisException:  # cleared away since
            pass
    path = scratch_path(spark, "images")
    table = read_features(spark, f"{sf_dir}/embeddings.parquet", ("label", "embedding"))
    bitmaps.write_bitmaps(table, "embedding", "label", path)
    _image_folders[key] = path
    return path


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(read_files(spark, image_folder(spark, sf_dir), glob="*.txt"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(read_images(spark, image_folder(spark, sf_dir), glob="*.txt"))


def fewer_tasks(scan: DataFrame) -> DataFrame:
    """Up to ``SCANS_PER_TASK`` of a scan's partitions (30 small files, unless set) in each task."""
    least = 4 * scan.sparkSession.sparkContext.defaultParallelism
    return scan.coalesce(max(least, scan.rdd.getNumPartitions() // SCANS_PER_TASK))


# Sources, sinks, projections


def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = image_files(spark, sf_dir).withColumn("Classe", label_from_path("path"))
    return files.groupBy("Classe").agg(
        F.count("*").alias("files"), F.sum("length").alias("total_bytes")
    )


def class_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the folders of the first classes, by a pattern in the path."""
    files = read_files(spark, f"{image_folder(spark, sf_dir)}/Classe=[0-4]", glob="*.txt")
    return files.groupBy(label_from_path("path").alias("Classe")).agg(
        F.count("*").alias("files"), F.sum("length").alias("total_bytes")
    )


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    table = vectors(spark, sf_dir).withColumn("features_vectors", dense_vector("features"))
    write_features(table, path, ("Classe", "features_vectors"))
    values = vector_to_array("features_vectors")
    by_place = F.aggregate(
        F.transform(values, lambda x, i: x * (i + 1)), F.lit(0.0), lambda total, x: total + x
    )
    return (
        read_features(spark, path, ("Classe", "features_vectors"))
        .groupBy("Classe")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.size(values)).alias("n_values"),
            rounded(F.sum(by_place)).alias("weighted_sum"),
        )
    )


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_features(spark, f"{sf_dir}/pages.parquet", ("page_id", "url"))
    return pages.select("page_id", label_from_path("url").alias("label"))


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_labels(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


def vector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = vectors(spark, sf_dir).withColumn("features_vectors", dense_vector("features"))
    return table.select("vec_id", long_form(vector_to_array("features_vectors"), "dim", "value"))


# Images


def image_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = images(spark, sf_dir).select(
        label_from_path("image.origin").alias("Classe"),
        "image.height",
        "image.width",
        F.col("image.nChannels").alias("n_channels"),
        "image.mode",
    )
    return scan.groupBy("Classe", "height", "width", "n_channels", "mode").agg(
        F.count("*").alias("n")
    )


def image_to_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte = F.expr(
        "transform(sequence(1, octet_length(rgb)),"
        " i -> cast(conv(hex(substring(rgb, i, 1)), 16, 10) as bigint))"
    )
    return (
        to_rgb(images(spark, sf_dir))
        .select(label_from_path("image.origin").alias("Classe"), long_form(byte, "pos", "value"))
        .groupBy("Classe", "pos")
        .agg(F.sum("value").alias("total"))
    )


def _channel_totals(features: DataFrame) -> DataFrame:
    level = F.round((F.col("value").cast("double") + 1.0) * 127.5).cast("bigint")
    return (
        features.select("Classe", long_form("features", "channel", "value"))
        .groupBy("Classe", "channel")
        .agg(F.count("*").alias("n"), F.sum(level).alias("total"))
    )


def image_featurize(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = images(spark, sf_dir).withColumn("Classe", label_from_path("image.origin"))
    return _channel_totals(featurize(table, "image", models.max_pool))


def files_featurize(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = image_files(spark, sf_dir).withColumn("Classe", label_from_path("path"))
    return _channel_totals(
        featurize(table, "content", models.max_pool, decode=bitmaps.decode_bitmap)
    )


def image_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over patches of 4 x 4, averaged by class."""
    table = images(spark, sf_dir).withColumn("Classe", label_from_path("image.origin"))
    y, x, channel, f = np.indices((4, 4, 3, 5))
    weights = ((5 * y + 3 * x + 7 * channel + 11 * f) % 13 - 6) / 8.0
    features = featurize(table, "image", models.patch_filters, weights)
    return (
        features.select("Classe", long_form("features", "filter", "value"))
        .groupBy("Classe", "filter")
        .agg(F.count("*").alias("n"), rounded(F.avg(F.col("value").cast("double"))).alias("mean"))
    )


def image_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resized to 299 x 299 and put through 64 filters, averaged by class."""
    table = images(spark, sf_dir).withColumn("Classe", label_from_path("image.origin"))
    weights = models.filter_weights(side=23, filters=64)
    features = featurize(table, "image", models.patch_filters, weights, size=(299, 299))
    return (
        features.select("Classe", long_form("features", "dim", "value"))
        .groupBy("Classe", "dim")
        .agg(F.count("*").alias("n"), rounded(F.avg("value"), 4).alias("mean"))
    )


# Featurising vectors


def featurize_maxpool(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = featurize(vectors(spark, sf_dir), "features", models.max_pool, output_col="pooled")
    return features.select("vec_id", rounded(F.col("pooled")[0].cast("double")).alias("value"))


def featurize_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt out over 16 tasks before the model."""
    pooled = featurize(
        vectors(spark, sf_dir), "features", models.max_pool, output_col="pooled", partitions=16
    )
    return pooled.select("vec_id", rounded(F.col("pooled")[0].cast("double")).alias("value"))


def featurize_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cols = np.indices((64, 8))
    weights = ((7 * rows + 3 * cols) % 11 - 5) / 8.0
    features = featurize(
        vectors(spark, sf_dir), "features", models.linear, weights, output_col="mapped"
    )
    lines = features.select("vec_id", long_form("mapped", "dim", "value"))
    return lines.select("vec_id", "dim", rounded(F.col("value").cast("double")).alias("value"))


# Scaling and reduction


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled, _ = reduction.standardize(vectors(spark, sf_dir))
    lines = scaled.select("vec_id", long_form(vector_to_array("features_scaled"), "dim", "z"))
    return lines.select("vec_id", "dim", rounded("z").alias("z"))


def correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = reduction.column_moments(vectors(spark, sf_dir)).correlation
    i, j = np.indices(matrix.shape, dtype=np.int32)
    cells = small_frame(spark, i=i.ravel(), j=j.ravel(), r=matrix.ravel())
    return cells.select("i", "j", rounded("r").alias("r"))


def variance_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = reduction.fit_components(vectors(spark, sf_dir))
    curve = reduction.variance_curve(spark, model)
    return curve.select(
        "k", rounded("ratio", 9).alias("ratio"), rounded("cumulative", 9).alias("cumulative")
    )


def variance_powers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the first three powers of the ratios, which SQL can get without the axes."""
    model = reduction.fit_components(vectors(spark, sf_dir))
    powers = F.array(*(F.pow("ratio", F.lit(p)) for p in (1, 2, 3)))
    lines = reduction.variance_curve(spark, model).select(long_form(powers, "p", "value"))
    return lines.groupBy((F.col("p") + 1).alias("power")).agg(
        rounded(F.sum("value"), 9).alias("total")
    )


def leading_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight shares by the range finder, without the matrix of all products."""
    model = reduction.fit_leading(vectors(spark, sf_dir), 8, rounds=16)
    return reduction.variance_curve(spark, model).select(
        "k", rounded("ratio").alias("ratio"), rounded("cumulative").alias("cumulative")
    )


def choose_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    choice = reduction.choose_k(reduction.fit_components(vectors(spark, sf_dir)))
    row = small_frame(spark, k=[choice.k], index=[choice.index], cumulative=[choice.cumulative])
    return row.select(
        F.col("k").cast("int"), F.col("index").cast("int"),
        rounded("cumulative", 9).alias("cumulative"),
    )


def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = vectors(spark, sf_dir)
    reduced = reduction.fit_components(table).transform(table, REDUCED_K, scaled_col=None)
    lines = reduced.select("vec_id", long_form(vector_to_array("vectors_pca"), "component", "v"))
    return lines.select("vec_id", "component", rounded("v", 4).alias("value"))


def pca_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared length over all components: projecting must keep that of the scaled vector."""
    table = vectors(spark, sf_dir)
    model = reduction.fit_components(table)
    reduced = model.transform(table, len(model.mean), scaled_col=None)
    square = F.aggregate(
        vector_to_array("vectors_pca"), F.lit(0.0), lambda total, v: total + v * v
    )
    return reduced.select("vec_id", rounded(square).alias("norm2"))


# Labels and split


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_features(spark, f"{sf_dir}/documents.parquet", ("source",))
    model = labels.fit_label_index(documents, "source", "source_index")
    return labels.label_table(documents, model)


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = vectors(spark, sf_dir)
    indexed = labels.fit_label_index(table).transform(table)
    return indexed.select("vec_id", "Classe", "Classe_index")


def label_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as labels, as many as there are: the index without a list on the driver."""
    lines = read_features(spark, f"{sf_dir}/lineitem.parquet", ("l_partkey",))
    return labels.rank_labels(lines, "l_partkey")


def label_rank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_features(spark, f"{sf_dir}/orders.parquet", ("o_orderkey", "o_custkey"))
    ranks = labels.rank_labels(orders, "o_custkey")
    return labels.index_rows(orders, ranks, "o_custkey", "index").select("o_orderkey", "index")


def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fifths of each class, to the row."""
    return labels.exact_split(vectors(spark, sf_dir), "vec_id").select("vec_id", "Classe", "part")


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(F.lit("train"), F.lit("valid"))
    return vectors(spark, sf_dir).select(
        "vec_id", F.get(names, labels.split_number("vec_id")).alias("part")
    )


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows are drawn depends on the layout; that each lands in one part does not."""
    train, valid = labels.random_split(vectors(spark, sf_dir), seed=classification.SEED)
    return train.unionByName(valid).groupBy("vec_id").agg(F.count("*").alias("parts"))


# Classifiers


def _training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both parts of the reduced table, which is written first, so no fit projects again."""
    path = scratch_path(spark, "reduced")
    table = vectors(spark, sf_dir)
    reduced = reduction.fit_components(table).transform(table, REDUCED_K, scaled_col=None)
    write_features(reduced, path, ("vec_id", "Classe", "vectors_pca"))
    saved = read_features(spark, path)
    index = labels.fit_label_index(saved)
    train, valid = (index.transform(part) for part in labels.hash_split(saved, "vec_id"))
    return train, valid


def _predict(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, valid = _training(spark, sf_dir)
        predicted = classification.predict(classification.train(kind, train), valid)
        return predicted.select("vec_id", "Classe_index", "prediction")

    return query


def _learned(kind: str, show: Callable[[SparkSession, object], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, _ = _training(spark, sf_dir)
        return show(spark, classification.train(kind, train))

    return query


def lr_training_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _training(spark, sf_dir)
    model = classification.train("lr", train)
    return evaluation.per_label(classification.predict(model, train))


# Classifiers of cells: with a column for each cell and no penalty, what they learn is known


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and state, counted: ``priority, cell (one-hot), year, state, n``."""
    orders = read_features(
        spark, f"{sf_dir}/orders.parquet", ("o_orderdate", "o_orderpriority", "o_orderstatus")
    )
    counts = orders.groupBy(
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").cast("double").alias("year"),
    ).agg(F.count("*").cast("double").alias("n"))
    for name, index in (("o_orderpriority", "priority"), ("o_orderstatus", "status")):
        ranks = labels.rank_labels(orders, name).select(
            F.col("label").alias(index), F.col("index").alias(f"{index}_index")
        )
        counts = counts.join(F.broadcast(ranks), index)  # three states, five priorities
    return counts


def _priority_fit(spark: SparkSession, sf_dir: str):
    cells = _cells(spark, sf_dir).groupBy("priority", "priority_index", "status_index")
    cells = cells.agg(F.sum("n").alias("n")).coalesce(1)
    encoder = OneHotEncoder(inputCols=["priority_index"], outputCols=["cell"]).fit(cells)
    cells = encoder.transform(cells)
    model = classification.train(
        "lr", cells, "status_index", "cell", weightCol="n", maxIter=500, tol=1e-15
    )
    return cells, model


def lr_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probabilities are the cells' shares."""
    cells, model = _priority_fit(spark, sf_dir)
    one = classification.predict(model, cells.dropDuplicates(["priority"]))
    lines = one.select(
        "priority", "prediction", long_form(vector_to_array("probability"), "state", "p")
    )
    return lines.select("priority", "prediction", "state", rounded("p", 5).alias("probability"))


def lr_cell_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log odds against the last cell."""
    _, model = _priority_fit(spark, sf_dir)
    table = classification.coefficients(spark, model)
    return table.select("class_index", "feature", rounded("coefficient", 5).alias("coefficient"))


def lr_cell_intercepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log odds in the last cell."""
    _, model = _priority_fit(spark, sf_dir)
    table = classification.intercepts(spark, model)
    return table.select("class_index", rounded("intercept", 5).alias("intercept"))


def lr_cell_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first loss is the states' entropy, the last that given the cell."""
    _, model = _priority_fit(spark, sf_dir)
    table = classification.loss_history(spark, model)
    ends = table.agg(
        F.min_by("objective", "iteration").alias("first"),
        F.max_by("objective", "iteration").alias("last"),
    )
    return ends.select(rounded("first", 7).alias("first"), rounded("last", 7).alias("last"))


def _year_fit(kind: str, **params) -> Callable:
    def fit(spark: SparkSession, sf_dir: str):
        cells = _cells(spark, sf_dir).groupBy("year", "status_index").agg(F.sum("n").alias("n"))
        cells = cells.withColumn("years", dense_vector(F.array("year"))).coalesce(1)
        return cells, classification.train(
            kind, cells, "status_index", "years", weightCol="n", **params
        )

    return fit


_forest_of_equals = {"numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all"}


def _year_predict(kind: str, **params) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Each year's state by the tree; orders of the year."""
        cells, model = _year_fit(kind, **params)(spark, sf_dir)
        predicted = classification.predict(model, cells)
        return predicted.groupBy("year", "prediction").agg(F.sum("n").cast("bigint").alias("n"))

    return query


def _year_nodes(kind: str, **params) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, model = _year_fit(kind, **params)(spark, sf_dir)
        return classification.tree_nodes(spark, model).select(
            "tree", "node", "parent", "side", "feature", "threshold",
            rounded("gain", 9).alias("gain"), rounded("impurity", 9).alias("impurity"), "n",
            "prediction",
        )

    return query


# Scores


def named_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the classes' names, one of which is a summary's."""
    names = small_frame(spark, label=["accuracy", "good"], index=[0.0, 1.0])
    report = evaluation.named_report(pairs(spark, sf_dir), names, TRUTH, GUESS)
    scores = ("precision", "recall", "f1")
    return report.select("line", "name", *(rounded(c).alias(c) for c in scores), "support")


def _scores(measure: Callable[..., DataFrame], *ratios: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = measure(pairs(spark, sf_dir), label_col=TRUTH, prediction_col=GUESS)
        return scored.select(
            *(rounded(c).alias(c) if c in ratios else F.col(c) for c in scored.columns)
        )

    return query


def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = evaluation.confusion_wide(pairs(spark, sf_dir), (0, 1, 2), TRUTH, GUESS)
    return wide.select("label", F.col("0").alias("predicted_0"), F.col("1").alias("predicted_1"))


# The whole way


def images_to_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    features, reduced = (scratch_path(spark, name) for name in ("features", "reduced"))
    flow.extract_features(
        images(spark, sf_dir),
        features,
        models.linear,
        input_col="image",
        path_col="image.origin",
        weights=models.projection_weights(3 * bitmaps.SIDE**2, 64),
    )
    flow.reduce_features(spark, features, reduced)
    lines = flow.reports(flow.train_classifiers(spark, reduced))
    scores = ("precision", "recall", "f1")
    return lines.select("kind", "name", *(rounded(c).alias(c) for c in scores), "support")


QUERIES: dict[str, Query] = {
    "binary_scan": binary_scan,
    "class_scan": class_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "label_from_path": page_labels,
    "label_counts": label_counts,
    "array_to_vector": vector_rows,
    "image_scan": image_scan,
    "image_to_rgb": image_to_rgb,
    "image_featurize": image_featurize,
    "image_patches": image_patches,
    "image_filters": image_filters,
    "files_featurize": files_featurize,
    "featurize_maxpool": featurize_maxpool,
    "featurize_linear": featurize_linear,
    "featurize_partitions": featurize_partitions,
    "standard_scale": standard_scale,
    "correlation": correlation,
    "variance_curve": variance_curve,
    "variance_powers": variance_powers,
    "leading_variance": leading_variance,
    "choose_k": choose_k,
    "pca_project": pca_project,
    "pca_norms": pca_norms,
    "string_index": string_index,
    "index_rows": index_rows,
    "label_ranks": label_ranks,
    "label_rank_rows": label_rank_rows,
    "exact_split": exact_split,
    "hash_split": hash_split,
    "random_split": random_split,
    "lr_predict": _predict("lr"),
    "tree_predict": _predict("tree"),
    "forest_predict": _predict("forest"),
    "lr_coefficients": _learned("lr", classification.coefficients),
    "lr_intercepts": _learned("lr", classification.intercepts),
    "lr_loss": _learned("lr", classification.loss_history),
    "lr_training_scores": lr_training_scores,
    "tree_stats": _learned("tree", classification.tree_stats),
    "forest_stats": _learned("forest", classification.tree_stats),
    "lr_cells": lr_cells,
    "lr_cell_coefficients": lr_cell_coefficients,
    "lr_cell_intercepts": lr_cell_intercepts,
    "lr_cell_loss": lr_cell_loss,
    "tree_cells": _year_predict("tree"),
    "tree_nodes": _year_nodes("tree"),
    "forest_cells": _year_predict("forest", **_forest_of_equals),
    "forest_nodes": _year_nodes("forest", **_forest_of_equals),
    "accuracy": _scores(evaluation.accuracy, "accuracy", "test_error"),
    "per_label_metrics": _scores(
        evaluation.per_label, "fpr", "tpr", "precision", "recall", "f1"
    ),
    "weighted_metrics": _scores(
        evaluation.weighted,
        "accuracy",
        *(f"weighted_{c}" for c in ("fpr", "tpr", "f1", "precision", "recall")),
    ),
    "confusion": _scores(evaluation.confusion, "row_share"),
    "confusion_wide": confusion_wide,
    "classification_report": _scores(
        evaluation.classification_report, "precision", "recall", "f1"
    ),
    "named_report": named_report,
    "images_to_report": images_to_report,
}
