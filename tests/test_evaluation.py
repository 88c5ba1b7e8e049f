from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from vecloom.operators import evaluation


def frame(spark, pairs):
    rows = [tuple(None if c is None else float(c) for c in pair) for pair in pairs]
    return spark.createDataFrame(rows, "Classe_index double, prediction double")


@pytest.fixture(scope="module")
def pairs():
    """Skewed: class 0 holds a third; class 4 is never predicted, class 6 never true."""
    rng = random.Random(5)
    out = []
    for _ in range(900):
        true = 0 if rng.random() < 0.34 else rng.randrange(6)
        guess = true if rng.random() < 0.6 else rng.choice([0, 1, 2, 3, 5, 6])
        out.append((true, 0 if guess == 4 else guess))
    return out


@pytest.fixture(scope="module")
def scored(spark, pairs):
    return frame(spark, pairs).repartition(5)


def by_hand(pairs, c):
    tp = sum(a == c and b == c for a, b in pairs)
    support, predicted = sum(a == c for a, _ in pairs), sum(b == c for _, b in pairs)
    recall = tp / support if support else 0.0
    precision = tp / predicted if predicted else 0.0
    f1 = 2 * precision * recall / (precision + recall) if tp else 0.0
    fpr = (predicted - tp) / (len(pairs) - support)
    return support, predicted, tp, fpr, recall, precision, recall, f1


def test_accuracy(scored, pairs):
    row = evaluation.accuracy(scored).first()
    share = sum(a == b for a, b in pairs) / len(pairs)
    assert (row.n, row.accuracy, row.test_error) == pytest.approx((900, share, 1 - share))
    evaluator = MulticlassClassificationEvaluator(
        labelCol="Classe_index", predictionCol="prediction", metricName="accuracy"
    )
    assert row.accuracy == pytest.approx(evaluator.evaluate(scored))


def test_per_label(scored, pairs):
    rows = {r.label: tuple(r)[1:] for r in evaluation.per_label(scored).collect()}
    assert set(rows) == set(map(float, range(7)))
    for label, got in rows.items():
        assert got == pytest.approx(by_hand(pairs, label))
    assert rows[4.0][5] == 0 and rows[6.0][0] == 0


@pytest.mark.parametrize(
    ("column", "metric"),
    [
        ("accuracy", "accuracy"),
        ("weighted_fpr", "weightedFalsePositiveRate"),
        ("weighted_tpr", "weightedTruePositiveRate"),
        ("weighted_f1", "f1"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
    ],
)
def test_weighted_equals_mllib(scored, column, metric):
    evaluator = MulticlassClassificationEvaluator(
        labelCol="Classe_index", predictionCol="prediction", metricName=metric
    )
    assert evaluation.weighted(scored).first()[column] == pytest.approx(evaluator.evaluate(scored))


def test_confusion_is_complete(scored, pairs):
    counts = Counter(pairs)
    rows = evaluation.confusion(scored).collect()
    assert len(rows) == 49
    assert {(r.label, r.prediction): r.n for r in rows} == {
        (float(a), float(b)): counts[a, b] for a in range(7) for b in range(7)
    }
    for r in rows:
        total = sum(counts[r.label, b] for b in range(7))
        assert r.row_share == pytest.approx(counts[r.label, r.prediction] / total if total else 0)


def test_confusion_of_given_labels(scored, pairs):
    rows = evaluation.confusion(scored, labels=range(10)).collect()
    assert len(rows) == 100 and sum(r.n for r in rows) == 900
    few = evaluation.confusion(scored, labels=[0, 1]).collect()
    assert sum(r.n for r in few) == sum(a < 2 and b < 2 for a, b in pairs)


def test_confusion_grid_is_not_made_in_one_task(scored):
    plan = evaluation.confusion(scored)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert evaluation.confusion(scored).count() == 49


def test_confusion_wide_has_every_class(spark):
    rows = spark.createDataFrame([(0, 0), (0, 2), (1, 5)], "t int, p int")
    wide = evaluation.confusion_wide(rows, [0, 1, 2], "t", "p").collect()
    assert sorted(map(tuple, wide)) == [(0, 1, 0, 1), (1, 0, 0, 0), (2, 0, 0, 0)]


def test_per_label_keeps_null_groups(spark):
    rows = [("a", 0, 0), ("a", 1, 0), (None, 1, 1)]
    frame = spark.createDataFrame(rows, "g string, t int, p int")
    lines = evaluation.per_label(frame, "t", "p", by=("g",)).collect()
    assert sorted((r.g or "", r.label) for r in lines) == [("", 1), ("a", 0), ("a", 1)]


def test_confusion_wide(scored, pairs):
    counts = Counter(pairs)
    rows = evaluation.confusion_wide(scored, [float(i) for i in range(10)]).collect()
    for r in rows:
        assert list(r)[1:] == [counts[r.label, b] for b in range(10)]


def test_report(scored, pairs):
    rows = {r.name: r for r in evaluation.classification_report(scored).collect()}
    assert set(rows) == {f"{i}.0" for i in range(7)} | {"accuracy", "macro avg", "weighted avg"}
    hand = {c: by_hand(pairs, c) for c in range(7)}
    for c, (support, _, _, _, _, precision, recall, f1) in hand.items():
        got = rows[f"{c}.0"]
        assert (got.precision, got.recall, got.f1, got.support) == pytest.approx(
            (precision, recall, f1, support)
        )
    assert rows["macro avg"].f1 == pytest.approx(sum(h[7] for h in hand.values()) / 7)
    assert rows["weighted avg"].recall == pytest.approx(rows["accuracy"].recall)
    assert rows["accuracy"].support == 900


def test_by_scores_each_group_alone(spark, scored, pairs):
    other = frame(spark, [(1, 1), (1, 2), (2, 2)])
    both = scored.withColumn("kind", F.lit("a")).union(other.withColumn("kind", F.lit("b")))
    for measure in (
        evaluation.accuracy, evaluation.per_label, evaluation.weighted,
        evaluation.classification_report,
    ):
        grouped = measure(both, by=("kind",)).collect()
        for kind, alone in (("a", scored), ("b", other)):
            got = sorted(tuple(r)[1:] for r in grouped if r.kind == kind)
            want = sorted(map(tuple, measure(alone).collect()))
            assert len(got) == len(want)
            for a, b in zip(got, want, strict=True):
                assert a[0] == pytest.approx(b[0]) and a[1:] == pytest.approx(b[1:])


def test_rows_without_label_or_prediction_are_left_out(spark):
    df = frame(spark, [(1, 1), (1, None), (None, 1), (2, 1)])
    assert evaluation.accuracy(df).first().n == 2
    assert sum(r.n for r in evaluation.confusion(df).collect()) == 2


def test_no_rows(spark):
    df = frame(spark, [(1, 1)]).limit(0)
    assert evaluation.accuracy(df).first().n == 0
    assert evaluation.per_label(df).count() == 0
    assert evaluation.classification_report(df).count() == 0
    assert evaluation.confusion(df).count() == 0


def test_one_class(spark):
    df = frame(spark, [(0, 0)] * 4)
    row = evaluation.per_label(df).first()
    assert (row.fpr, row.tpr, row.f1) == (0.0, 1.0, 1.0)


def test_names_resolve_without_case(scored):
    assert evaluation.confusion(scored, label_col="Classe_Index").count() == 49


def test_counts_are_combined_before_the_shuffle(scored):
    plan = evaluation.per_label(scored)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange hashpartitioning(label"):]
    assert "partial_count" in first


@pytest.mark.parametrize(
    "measure",
    [
        evaluation.confusion, evaluation.per_label, evaluation.weighted,
        evaluation.classification_report,
    ],
)
def test_the_frame_is_read_once(spark, sf_dir, measure):
    pairs = spark.read.parquet(f"{sf_dir}/labels.parquet").select("quality", "toxic")
    scores = measure(pairs, "quality", "toxic")
    scores.collect()
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    assert "Window" not in plan or measure is evaluation.confusion


def test_named_report(spark):
    """A class with a summary's name, one without a name, and groups; equal to the plain report."""
    rows = [(0.0, 0.0, "x"), (0.0, 1.0, "x"), (1.0, 1.0, None), (2.0, 0.0, "x"), (None, 1.0, "x")]
    frame = spark.createDataFrame(rows, "Classe_index double, prediction double, g string")
    names = spark.createDataFrame([("accuracy", 0.0), ("b", 1.0), ("never", 9.0)], "label string, index double")
    named = evaluation.named_report(frame, names).collect()
    plain = evaluation.classification_report(frame).collect()
    known = {"0.0": "accuracy", "1.0": "b"}
    want = [("class" if r.name[0].isdigit() else "summary", known.get(r.name, r.name), *r[1:]) for r in plain]
    assert sorted(map(tuple, named)) == sorted(want)
    assert sorted(r.line for r in named if r.name == "accuracy") == ["class", "summary"]
    grouped = evaluation.named_report(frame, names, by=("g",)).collect()
    assert {r.g for r in grouped} == {"x", None}
