from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F

from pictures import write_png
from vecloom.functions import models
from vecloom.plans import bitmaps, flow
from vecloom.sources import read_features, read_files, read_images

COLORS = {"Apple-Red": (200, 30, 40), "Kiwi": (90, 140, 20), "Plum é": (80, 20, 90)}


@pytest.fixture(scope="module")
def photos(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("photos")
    rng = np.random.default_rng(4)
    for name, color in COLORS.items():
        for i in range(30):
            noise = rng.integers(-20, 21, (10, 10, 3))
            image = np.clip(np.array(color) + noise, 0, 255).astype(np.uint8)
            write_png(root / name / f"{i}_100.png", image)
    (root / "Kiwi" / "bad.png").write_bytes(b"no image")
    return str(root)


@pytest.fixture(scope="module")
def tables(spark, photos, tmp_path_factory):
    """The whole way once, counting the images the model sees."""
    root = tmp_path_factory.mktemp("tables")
    features, reduced = str(root / "features"), str(root / "reduced")
    seen = spark.sparkContext.accumulator(0)

    def factory(weights):
        model = models.patch_filters(weights)

        def predict(batch):
            seen.add(len(batch))
            return model(batch)

        return predict

    counts = flow.extract_features(
        read_images(spark, photos), features, factory, "image", "image.origin",
        weights=models.filter_weights(side=5, filters=32), size=(20, 20),
    )
    model, k = flow.reduce_features(spark, features, reduced)
    trained = flow.train_classifiers(spark, reduced)
    report = flow.reports(trained).collect()
    return features, reduced, counts, model, k, trained, report, seen


def test_the_model_sees_each_image_once(tables):
    *_, seen = tables
    assert seen.value == 90


def test_features_table(spark, tables):
    features, _, counts, *_ = tables
    assert counts == {"rows": 91, "without_label": 0, "without_features": 1}
    table = read_features(spark, features)
    assert table.schema.simpleString() == "struct<path:string,Classe:string,features:array<float>>"
    found = table.groupBy("Classe").count().collect()
    assert {r.Classe for r in found} == {"Apple-Red", "Kiwi", "Plum%20é"}  # origins are URIs


def test_reduced_table(spark, tables):
    _, reduced, _, model, k, *_ = tables
    table = read_features(spark, reduced)
    assert table.columns == list(flow.REDUCED)
    assert all(isinstance(table.schema[c].dataType, VectorUDT) for c in table.columns[3:])
    assert table.count() == 90
    assert table.first().vectors_pca.size == k
    assert model.cumulative[k - 1] >= 0.95 > (model.cumulative[k - 2] if k > 1 else 0)


def test_scores_equal_a_count_by_hand(tables):
    """The split follows the photos' full paths, so its size differs from run to run."""
    *_, trained, report, _ = tables
    scores = {r.kind: r for r in flow.compare(trained).collect()}
    assert set(scores) == {"lr", "tree", "forest"}
    for kind, model in trained.models.items():
        rows = model.transform(trained.valid).select("Classe_index", "prediction").collect()
        hits = sum(r.Classe_index == r.prediction for r in rows)
        assert scores[kind].n == len(rows)
        assert scores[kind].accuracy == pytest.approx(hits / len(rows))
        lines = {r.name: r for r in report if r.kind == kind}
        assert lines["accuracy"].f1 == pytest.approx(hits / len(rows))
        names = {r["index"]: r.label for r in trained.names.collect()}
        seen = {names[x] for r in rows for x in (r.Classe_index, r.prediction)}
        assert set(lines) == seen | {"accuracy", "macro avg", "weighted avg"}
        assert {r.name for r in report if r.kind == kind and r.line == "class"} == seen


def test_scores_of_the_training_part(tables):
    trained = tables[5]
    scores = {r.kind: r for r in flow.compare(trained, part="train").collect()}
    lines = {(r.kind, r.name): r for r in flow.reports(trained, part="train").collect()}
    for kind, model in trained.models.items():
        rows = model.transform(trained.train).select("Classe_index", "prediction").collect()
        hits = sum(r.Classe_index == r.prediction for r in rows)
        assert scores[kind].n == lines[kind, "accuracy"].support == len(rows)
        assert scores[kind].accuracy == pytest.approx(hits / len(rows))
    with pytest.raises(ValueError, match="part"):
        flow.compare(trained, part="test")


def test_classifiers_learn_the_colors(tables):
    """Over all 90 photos, as the held-out ones are too few for a bound that always holds."""
    trained = tables[5]
    both = flow.predictions(trained.models, trained.train.unionByName(trained.valid))
    rows = both.groupBy("kind").agg(
        F.count("*").alias("n"), F.avg((F.col("Classe_index") == F.col("prediction")).cast("int"))
    )
    for _, n, accuracy in rows.collect():
        assert n == 90 and accuracy > 0.9


def test_predictions_equal_those_of_each_model(tables):
    trained = tables[5]
    together = flow.predictions(trained.models, trained.valid)
    for kind, model in trained.models.items():
        alone = model.transform(trained.valid).select("path", "prediction").collect()
        found = together.where(F.col("kind") == kind).select("path", "prediction").collect()
        assert sorted(alone) == sorted(found)


def test_all_classifiers_are_scored_in_one_scan(tables):
    reports = flow.reports(tables[5])
    reports.collect()
    plan = reports._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_fixed_k_slim_table_and_fit_on_train(spark, tables, tmp_path):
    features = tables[0]
    columns = ("path", "Classe", "vectors_pca")
    model, k = flow.reduce_features(
        spark, features, str(tmp_path / "r"), k=3, fit_on="train", columns=columns
    )
    table = read_features(spark, str(tmp_path / "r"))
    assert (k, table.columns, table.count()) == (3, list(columns), 90)
    assert not np.allclose(model.mean, tables[3].mean)
    trained = flow.train_classifiers(spark, str(tmp_path / "r"), ("tree",), layout_partitions=2)
    assert list(trained.models) == ["tree"]
    with pytest.raises(ValueError, match="fit_on"):
        flow.reduce_features(spark, features, str(tmp_path / "q"), fit_on="some")


def test_file_bytes_give_the_same_features_as_images(spark, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    out = str(tmp_path / "images")
    bitmaps.write_bitmaps(table, "embedding", "label", out)
    weights = models.projection_weights(192, 4)
    results = []
    for name, df, input_col, path_col in (
        ("f", read_files(spark, out, "*.txt"), "content", "path"),
        ("i", read_images(spark, out, "*.txt"), "image", "image.origin"),
    ):
        counts = flow.extract_features(
            df, str(tmp_path / name), models.linear, input_col, path_col,
            weights=weights, decode=bitmaps.decode_bitmap,
        )
        assert counts == {"rows": 500, "without_label": 0, "without_features": 0}
        results.append(sorted(read_features(spark, str(tmp_path / name)).collect()))
    for a, b in zip(*results, strict=True):
        assert (a.path.split(":", 1)[1].lstrip("/"), a.Classe) == (
            b.path.split(":", 1)[1].lstrip("/"), b.Classe,
        )
        np.testing.assert_allclose(a.features, b.features, atol=1e-6)


def test_only_new_files_are_featurised(spark, tmp_path):
    """A second run over a grown folder takes the new files, a third none."""
    from vecloom.functions import models
    from vecloom.sources import read_features, stream_files

    root, out, state = (str(tmp_path / n) for n in ("photos", "features", "state"))
    seen = spark.sparkContext.accumulator(0)

    def decode(content):
        seen.add(1)
        return None if content == b"broken" else np.full((2, 2, 3), content[0], np.uint8)

    def add(folder, names):
        (tmp_path / "photos" / folder).mkdir(parents=True, exist_ok=True)
        for n in names:
            (tmp_path / "photos" / folder / n).write_bytes(b"broken" if "bad" in n else n[0].encode())

    def run():
        files = stream_files(spark, root)
        return flow.extract_new_features(files, out, state, models.max_pool, decode=decode)

    add("Plum", ["a.jpg", "b.jpg", "notes.txt"])
    assert run() == 2 and seen.value == 2
    add("Kiwi", ["c.jpg", "bad.jpg"])
    assert run() == 2 and seen.value == 4
    assert run() == 0 and seen.value == 4
    rows = read_features(spark, out).collect()
    assert sorted((r.Classe, r.features is None) for r in rows) == [
        ("Kiwi", False), ("Kiwi", True), ("Plum", False), ("Plum", False)
    ]
    with pytest.raises(ValueError, match="stream"):
        flow.extract_new_features(spark.range(1), out, state, models.max_pool)
