"""Scores of a frame of labels and predictions.

Everything is derived from the counts of (label, prediction): one aggregation that counts within
each task before it shuffles, whatever the size and skew of the frame. After it there is one row
per pair of classes that occurs. ``by`` names columns to score separately, such as the classifier
of a frame that holds the predictions of several: one scan then scores them all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL, PREDICTION = "Classe_index", "prediction"


def pair_counts(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: Sequence[str] = (),
) -> DataFrame:
    """``label, prediction, n`` of the pairs that occur; rows without either are left out."""
    label, prediction = F.col(label_col), F.col(prediction_col)
    return (
        df.where(label.isNotNull() & prediction.isNotNull())
        .groupBy(*by, label.alias("label"), prediction.alias("prediction"))
        .agg(F.count("*").alias("n"))
    )


def accuracy(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: Sequence[str] = (),
) -> DataFrame:
    """``n, accuracy, test_error``."""
    label, prediction = F.col(label_col), F.col(prediction_col)
    rows = df.where(label.isNotNull() & prediction.isNotNull())
    share = F.avg((label == prediction).cast("int"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), share.alias("accuracy"), (F.lit(1.0) - share).alias("test_error")
    )


def per_label(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: Sequence[str] = (),
) -> DataFrame:
    """``label, support, predicted, tp, fpr, tpr, precision, recall, f1``, undefined ratios 0."""
    counts = pair_counts(df, label_col, prediction_col, by)
    classes = _class_scores(counts, by)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    if by:  # NULL is a group like any other
        renamed = totals.toDF(*(f"_of_{c}" for c in by), "total")
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
        classes = classes.join(renamed, same)
    else:
        classes = classes.withColumn("total", totals.scalar())
    wrong, others = F.col("predicted") - F.col("tp"), F.col("total") - F.col("support")
    return classes.select(
        *by, "label", "support", "predicted", "tp", _ratio(wrong, others).alias("fpr"),
        F.col("recall").alias("tpr"), "precision", "recall", "f1",
    )


def _class_scores(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per class that is a label or a prediction, from the pair counts."""
    n, hit = F.col("n"), F.col("label") == F.col("prediction")
    as_label = F.struct(
        F.col("label"), n.alias("support"), F.lit(0).cast("long").alias("predicted"),
        F.when(hit, n).otherwise(0).alias("tp"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("label"), F.lit(0).cast("long").alias("support"),
        n.alias("predicted"), F.lit(0).cast("long").alias("tp"),
    )
    classes = (
        counts.select(*by, F.inline(F.array(as_label, as_prediction)))
        .groupBy(*by, "label")
        .agg(*(F.sum(c).alias(c) for c in ("support", "predicted", "tp")))
    )
    recall = _ratio(F.col("tp"), F.col("support"))
    precision = _ratio(F.col("tp"), F.col("predicted"))
    f1 = _ratio(2 * precision * recall, precision + recall)
    return classes.withColumns({"recall": recall, "precision": precision, "f1": f1})


def weighted(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, and the per-label scores averaged by support."""
    names = ("fpr", "tpr", "f1", "precision", "recall")
    total = F.sum("support")
    return per_label(df, label_col, prediction_col, by).groupBy(*by).agg(
        _ratio(F.sum("tp"), total).alias("accuracy"),
        *(_ratio(F.sum(F.col(c) * F.col("support")), total).alias(f"weighted_{c}") for c in names),
    )


def confusion(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    labels: Sequence[float] | None = None,
) -> DataFrame:
    """``label, prediction, n, row_share`` for every pair of classes, 0 where none occurs.

    The classes are those of the data, or ``labels``, and then pairs with any other class are
    left out. ``pair_counts`` gives the same cells without the zeros. The matrix is filled by label
    in parallel; one row holds the list of classes.
    """
    counts = pair_counts(df, label_col, prediction_col)
    kind = counts.schema["label"].dataType
    if labels is None:
        # The condition always holds. It keeps the counts in this branch of the plan, which then
        # reuses the shuffle of the other branch instead of reading the frame again.
        both = F.explode(F.array("label", F.col("prediction").cast(kind)))
        found = counts.where(F.col("n") > 0).select(both.alias("c"))
        classes = found.groupBy("c").agg(F.count("*").alias("times")).select("c")
    else:
        one = df.sparkSession.range(1)
        listed = F.array(*(F.lit(v).cast(kind) for v in dict.fromkeys(labels)))
        classes = one.select(F.explode(listed).alias("c"))
    listed = classes.agg(F.collect_list("c").alias("classes")).scalar()
    grid = classes.select(F.col("c").alias("label")).select(
        "label", F.explode(listed).alias("prediction")
    )
    cells = counts.withColumn("prediction", F.col("prediction").cast(kind))
    filled = grid.join(cells, ["label", "prediction"], "left")
    n = F.coalesce(F.col("n"), F.lit(0).cast("long"))
    if labels is not None:
        cells = cells.where(F.col("prediction").isin(list(labels)))
    totals = cells.groupBy("label").agg(F.sum("n").alias("row_total"))
    total = F.coalesce(F.col("row_total"), F.lit(0).cast("long"))
    return filled.join(totals, "label", "left").select(
        "label", "prediction", n.alias("n"), _ratio(n, total).alias("row_share")
    )


def confusion_wide(
    df: DataFrame,
    labels: Sequence[float],
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
) -> DataFrame:
    """One row per true label, one column per predicted label, also for those that never occur."""
    counts = pair_counts(df, label_col, prediction_col)
    wide = counts.groupBy("label").pivot("prediction", list(labels)).agg(F.sum("n"))
    listed = F.array(*(F.lit(v).cast(counts.schema["label"].dataType) for v in dict.fromkeys(labels)))
    classes = df.sparkSession.range(1).select(F.explode(listed).alias("label"))
    return classes.join(wide, "label", "left").fillna(0)


def classification_report(
    df: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: Sequence[str] = (),
) -> DataFrame:
    """``name, precision, recall, f1, support`` by class, then accuracy and two averages."""
    classes = _class_scores(pair_counts(df, label_col, prediction_col, by), by)
    return _report_lines(classes, F.col("label").cast("string"), by).drop("line")


def _report_lines(classes: DataFrame, name: Column, by: Sequence[str]) -> DataFrame:
    """``line, name, precision, recall, f1, support`` of scored classes and their summaries."""
    scores = ("precision", "recall", "f1")
    total = F.sum("support")

    def line(name: str, values: Callable[[str], Column]) -> Column:
        return F.struct(
            F.lit(name).alias("name"), *(values(s).alias(s) for s in scores), total.alias("support")
        )

    averages = classes.groupBy(*by).agg(
        total.alias("total"),
        F.array(
            line("accuracy", lambda s: _ratio(F.sum("tp"), total)),
            line("macro avg", F.avg),
            line("weighted avg", lambda s: _ratio(F.sum(F.col(s) * F.col("support")), total)),
        ).alias("lines"),
    )
    own = classes.select(
        *by, F.lit("class").alias("line"), name.alias("name"), *scores, "support"
    )
    rest = averages.where(F.col("total").isNotNull()).select(
        *by, F.lit("summary").alias("line"), F.inline("lines")
    )
    return own.unionByName(rest)


def named_report(
    df: DataFrame,
    names: DataFrame,
    label_col: str = LABEL,
    prediction_col: str = PREDICTION,
    by: Sequence[str] = (),
) -> DataFrame:
    """``line, name, precision, recall, f1, support``: the report with the classes' names.

    ``names`` is a table ``label, index`` of the names, as :func:`labels.label_table` gives it; a
    class it lacks keeps its number. ``line`` is ``class`` or ``summary``, so that a class may have
    a summary's name.
    """
    counts = pair_counts(df, label_col, prediction_col, by)
    kind = counts.schema["label"].dataType
    known = names.select(F.col("index").cast(kind).alias("label"), F.col("label").alias("known"))
    classes = _class_scores(counts, by).join(known, "label", "left")
    return _report_lines(classes, F.coalesce("known", F.col("label").cast("string")), by)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)
