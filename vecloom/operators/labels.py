"""Class names to indices, and reproducible splits."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.functions import unit_hash
from vecloom.session import scratch_path, small_frame


def fit_label_index(
    df: DataFrame,
    label_col: str = "Classe",
    output_col: str = "Classe_index",
    handle_invalid: str = "error",
    max_labels: int | None = None,
) -> StringIndexerModel:
    """Index 0 is the most frequent label; ties go by name.

    One aggregation that counts within each task first, so a label that holds most of the rows
    costs no more than any other. The labels become part of the model, so the
    driver holds them all; more than ``max_labels`` of them, if given, is an error.
    """
    ranked = (
        df.where(F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).cast("string").alias("label"))
        .count()
        .orderBy(F.desc("count"), "label")
    )
    top = (ranked.limit(max_labels + 1) if max_labels else ranked).collect()
    if not top:
        raise ValueError(f"no labels in {label_col}")
    if max_labels and len(top) > max_labels:
        raise ValueError(f"more than {max_labels} labels in {label_col}")
    return StringIndexerModel.from_labels(
        [row.label for row in top], label_col, output_col, handle_invalid
    )


def label_table(df: DataFrame, model: StringIndexerModel) -> DataFrame:
    """``label, index`` of a fitted index, for the session of ``df``."""
    index = np.arange(len(model.labels), dtype=np.float64)
    return small_frame(df.sparkSession, label=model.labels, index=index)


#: Labels with more than this share of the rows are hot; they are fewer than its inverse.
HOT_SHARE = 0.001


def rank_labels(df: DataFrame, label_col: str = "Classe") -> DataFrame:
    """``label, index, n`` of all labels, however many: the order of :func:`fit_label_index`.

    Counts are dealt out by ranges of (count, name) and sorted there; a label's index is its place
    in its range behind the totals of the ranges before. Only those totals, one per range, meet in
    one task. The result is written, so the ranges are cut once.
    """
    counts = (
        df.where(F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).cast("string").alias("label"))
        .agg(F.count("*").alias("n"))
    )
    order = [F.desc("n"), F.col("label")]
    counts = _written(counts, "label-counts")
    ranges = _written(
        counts.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "label-ranges"
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        ranges.groupBy("range")
        .agg(F.count("*").alias("labels"))
        .select("range", F.coalesce(F.sum("labels").over(before), F.lit(0)).alias("first"))
    )
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    ranked = ranges.withColumn("place", place).join(F.broadcast(firsts), "range")  # one per range
    index = (F.col("first") + F.col("place")).cast("double")
    return _written(ranked.select("label", index.alias("index"), "n"), "label-index")


def index_rows(
    df: DataFrame, ranks: DataFrame, label_col: str = "Classe", output_col: str = "Classe_index"
) -> DataFrame:
    """Add the index of :func:`rank_labels` to rows; NULL for a label without one.

    Labels with over ``HOT_SHARE`` of the rows, fewer than its inverse, are joined by broadcast,
    the others by a shuffle in which no label is large.
    """
    table = ranks.select(F.col("label").alias("of"), "index", "n")
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
    )
    return _by_label(rows, table).select("row.*", F.col("index").alias(output_col))


def _by_label(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` (with ``label``) and what ``table`` (``of``, its rows ``n``, others) has of it."""
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = table.where(F.col("n") > HOT_SHARE * total).withColumn("hot", F.lit(True))
    cold = table.where(F.col("n") <= HOT_SHARE * total).withColumn("hot", F.lit(False))
    same = F.col("label").eqNullSafe(F.col("of"))
    met = rows.join(F.broadcast(hot), same, "left")  # fewer than 1 / HOT_SHARE
    rest = met.where(F.col("hot").isNull()).select(rows.columns).join(cold, same, "left")
    return met.where("hot").unionByName(rest)


def exact_split(
    df: DataFrame,
    key: str,
    label_col: str = "Classe",
    share: float = 0.8,
    seed: int | None = None,
    output_col: str = "part",
) -> DataFrame:
    """Add ``part``: 0 for exactly ``floor(share * n + 0.5)`` of each class's ``n`` rows, else 1.

    The rows that are first in hash order of ``key`` (which must be unique, and may be NULL once a
    class), whatever the layout. Counts by class and the hash's first 16 bits say in which cell a
    class's border lies; only the rows of that one cell of each class are ranked, so no class meets
    in one task. NULL is a class of its own.
    """
    point = F.coalesce(unit_hash(key, seed), F.lit(0.0))
    cell = F.floor(point * F.lit(1 << 16)).cast("int")
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        F.col(f"`{label_col}`").alias("label"),
        F.col(f"`{key}`").cast("string").alias("key"),
        point.alias("point"),
        cell.alias("cell"),
    )
    cells = rows.groupBy("label", "cell").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("label").orderBy("cell")
    total = F.sum("n").over(Window.partitionBy("label"))
    wanted = F.floor(total * F.lit(float(share)) + F.lit(0.5)).cast("bigint")
    cells = cells.select(
        "label", "cell", "n", total.alias("total"), wanted.alias("wanted"),
        F.sum("n").over(upto).alias("upto"),
    )
    border = cells.where("upto >= wanted and upto - n < wanted")
    border = _written(
        border.select(
            F.col("label").alias("of"),
            F.col("cell").alias("border"),
            (F.col("wanted") - F.col("upto") + F.col("n")).alias("room"),
            F.col("total").alias("n"),
        ),
        "borders",
    )
    met = _by_label(rows, border)
    inside = F.col("cell") == F.col("border")
    clear = met.where(~F.coalesce(inside, F.lit(False))).withColumn(
        output_col, F.when(F.col("cell") < F.col("border"), 0).otherwise(1)
    )
    nth = F.row_number().over(Window.partitionBy("of").orderBy("point", "key"))
    ranked = met.where(inside).withColumn("nth", nth)
    ranked = ranked.withColumn(output_col, F.when(F.col("nth") <= F.col("room"), 0).otherwise(1))
    return clear.select("row.*", output_col).unionByName(ranked.select("row.*", output_col))


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def hash_split(
    df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2), seed: int | None = None
) -> list[DataFrame]:
    """Parts by a hash of ``key``: filters only, the same whatever the layout of the rows.

    Rows whose key is NULL are in the first part.
    """
    number = split_number(key, weights, seed)
    return [df.where(number == i) for i in range(len(weights))]


def split_number(
    key: str, weights: Sequence[float] = (0.8, 0.2), seed: int | None = None
) -> Column:
    """The part a row belongs to, from 0."""
    total = float(sum(weights))
    point = F.coalesce(unit_hash(key, seed), F.lit(0.0))
    number, bound = F.lit(0), 0.0
    for weight in weights[:-1]:
        bound += weight / total
        number = number + (point >= F.lit(bound)).cast("int")
    return number


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), *, seed: int
) -> list[DataFrame]:
    """Spark's own split. The seed fixes it only for one layout of the rows."""
    return df.randomSplit(list(weights), seed)
