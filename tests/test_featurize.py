from __future__ import annotations

import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pictures import write_png
from vecloom.functions import models, pixels
from vecloom.operators.featurize import _image_pieces, _runner, featurize
from vecloom.plans.bitmaps import decode_bitmap
from vecloom.sources import read_files, read_images


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id int, v array<float>")


def test_one_result_per_row_in_its_place(spark):
    rows = [
        (0, [1.0, 5.0, 2.0]),
        (1, None),
        (2, [7.0]),
        (3, []),
        (4, [-1.0, -2.0, -3.0]),
        (5, [4.0, 3.0]),
    ]
    for partitions in (1, 3):
        df = featurize(vectors(spark, rows).coalesce(partitions), "v", models.max_pool)
        got = {r.id: r.features for r in df.collect()}
        assert got == {0: [5.0], 1: None, 2: [7.0], 3: None, 4: [-1.0], 5: [4.0]}


def test_result_type_and_other_columns(spark):
    df = featurize(vectors(spark, [(1, [1.0, 2.0])]), "v", models.max_pool, output_col="out")
    assert df.schema.simpleString() == "struct<id:int,v:array<float>,out:array<float>>"


@pytest.mark.parametrize("layout", [1, 7, 16])
@pytest.mark.parametrize("batch", [1, 13, None])
def test_layout_and_batch_do_not_matter(spark, sf_dir, layout, batch):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    weights = models.projection_weights(64, 5).astype(np.float64)
    df = featurize(
        table, "embedding", models.linear, weights, rows_per_batch=batch, partitions=layout
    )
    assert df.rdd.getNumPartitions() == layout
    rows = df.select("embedding", "features").collect()
    want = np.array([r.embedding for r in rows]) @ weights
    np.testing.assert_allclose([r.features for r in rows], want, rtol=1e-6, atol=1e-6)
    assert len(rows) == 500


def test_model_is_built_once_per_task(spark):
    built = spark.sparkContext.accumulator(0)
    seen = spark.sparkContext.accumulator(0)

    def factory(_):
        built.add(1)

        def predict(batch):
            seen.add(len(batch))
            return batch

        return predict

    df = spark.range(0, 1000, 1, 4).select("id", F.array(F.col("id").cast("float")).alias("v"))
    features = featurize(df, "v", factory, rows_per_batch=10)
    assert features.count() == 1000
    assert (built.value, seen.value) == (0, 0)  # not asked for, not run
    assert features.select("id").distinct().count() == 1000
    assert seen.value == 0
    features.write.format("noop").mode("overwrite").save()
    assert (built.value, seen.value) == (4, 1000)


def test_filters_on_the_features_do_not_run_the_model_again(spark):
    seen = spark.sparkContext.accumulator(0)

    def factory(_):
        def predict(batch):
            seen.add(len(batch))
            return batch

        return predict

    df = spark.range(0, 100, 1, 2).select("id", F.array(F.col("id").cast("float")).alias("v"))
    features = featurize(df, "v", factory)
    kept = features.where(F.col("features").isNotNull() & (F.col("features")[0] > 9))
    assert kept.select(F.explode("features")).agg(F.sum("col")).first()[0] == sum(range(10, 100))
    assert seen.value == 100


def test_filter_before_the_model_reaches_the_scan(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("label = 3")
    df = featurize(table, "embedding", models.max_pool).select("vec_id", "features")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)]" in plan
    assert plan.count("ArrowEvalPython") == 1


def test_later_filter_moves_below_the_model_on_request(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    df = featurize(table, "embedding", models.max_pool, partitions=3, once=False)
    plan = df.where("label = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)]" in plan


def test_images_of_several_shapes(spark, tmp_path):
    rng = np.random.default_rng(1)
    want = {}
    for i, shape in enumerate([(6, 4, 3), (6, 4, 1), (9, 9, 3), (6, 4, 3)]):
        image = rng.integers(0, 256, shape, dtype=np.uint8)
        write_png(tmp_path / f"{i}.png", image)
        rgb = np.repeat(image, 3, axis=2) if shape[2] == 1 else image
        want[f"{i}.png"] = (rgb.max(axis=(0, 1)) / 127.5 - 1).astype(np.float32)
    (tmp_path / "bad.png").write_bytes(b"?")
    df = featurize(read_images(spark, str(tmp_path)).coalesce(1), "image", models.max_pool)
    rows = df.select("image.origin", "features").collect()
    got = {r.origin.rsplit("/", 1)[1]: r.features for r in rows}
    assert got.pop("bad.png") is None
    assert got.keys() == want.keys()
    for name, features in got.items():
        np.testing.assert_allclose(features, want[name], atol=1e-6)


def test_images_are_resized_before_the_model(spark, tmp_path):
    write_png(tmp_path / "a.png", np.full((5, 9, 3), (10, 20, 30), np.uint8))

    def factory(_):
        return lambda batch: np.full((len(batch), 1), np.prod(batch.shape[1:]))

    df = featurize(read_images(spark, str(tmp_path)), "image", factory, size=(299, 299))
    assert df.first().features == [299.0 * 299 * 3]
    pooled = featurize(read_images(spark, str(tmp_path)), "image", models.max_pool, size=(299, 299))
    np.testing.assert_allclose(
        pooled.first().features, np.array([10, 20, 30]) / 127.5 - 1, atol=1e-6
    )


def test_file_bytes_with_a_decoder(spark, tmp_path):
    image = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    header = bytearray(54)
    header[10], header[18], header[22] = 54, 4, 4
    (tmp_path / "a.bmp").write_bytes(bytes(header) + image[::-1, :, ::-1].tobytes())
    files = read_files(spark, str(tmp_path), glob="*.bmp")
    df = featurize(files, "content", lambda _: lambda b: (b + 1) * 127.5, decode=decode_bitmap)
    np.testing.assert_allclose(df.first().features, image.ravel(), atol=1e-4)


def test_tasks_need_no_installed_package(tmp_path):
    """What workers run travels by value: it loads where the package cannot be imported."""
    dumped = tmp_path / "f.pkl"
    task = _runner(models.max_pool, None, _image_pieces, (3, 3), 2, 4).func
    dumped.write_bytes(cloudpickle.dumps(task))
    code = (
        "import pickle, sys, pyarrow as pa\n"
        f"run = pickle.load(open({str(dumped)!r}, 'rb'))\n"
        "batch = (pa.array([1]), pa.array([2]), pa.array([3]), pa.array([b'abcdef']))\n"
        "print(next(run(iter([batch])))[0].as_py())\n"
        "assert 'vecloom' not in sys.modules"
    )
    done = subprocess.run(
        [sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    assert len(done.stdout.split(",")) == 3


def test_missing_pillow_is_named(spark, tmp_path):
    try:
        import PIL  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="read_images"):
            pixels.decode_pillow(b"")


def test_input_type_and_weight_size_are_checked(spark, monkeypatch):
    with pytest.raises(TypeError, match="id is int"):
        featurize(vectors(spark, [(1, [1.0])]), "id", models.max_pool)
    monkeypatch.setattr("vecloom.operators.featurize.MAX_WEIGHT_BYTES", 10)
    with pytest.raises(ValueError, match="bytes of weights"):
        featurize(vectors(spark, [(1, [1.0])]), "v", models.linear, [np.zeros(4), b"abc"])


def test_resample_weights():
    for n_in, n_out in ((8, 299), (100, 299), (299, 8), (5, 5), (1, 4)):
        matrix = pixels.resample_matrix(n_in, n_out)
        np.testing.assert_allclose(matrix.sum(axis=1), 1, atol=1e-5)
    np.testing.assert_allclose(pixels.resample_matrix(6, 6), np.eye(6), atol=1e-6)
    ramp = np.arange(50, dtype=np.float32)
    inside = (pixels.resample_matrix(50, 100) @ ramp)[6:-6]
    np.testing.assert_allclose(np.diff(inside), 0.5, atol=1e-3)  # ramps stay ramps
    # twice as many points fall a quarter from the old ones
    quarter = np.array([-9, 111, 29, -3]) / 128
    np.testing.assert_allclose(pixels.resample_matrix(8, 16)[7, 2:6], quarter, atol=1e-6)
    middle = pixels.resample_matrix(4, 1)
    np.testing.assert_allclose(middle[0], middle[0][::-1], atol=1e-7)


def test_resize_keeps_flat_images_and_bytes():
    flat = np.full((3, 10, 20, 3), 77, np.uint8)
    out = pixels.resize(flat, 299, 33)
    assert out.shape == (3, 299, 33, 3) and out.dtype == np.uint8 and (out == 77).all()
    image = np.random.default_rng(0).integers(0, 256, (2, 8, 8, 3), dtype=np.uint8)
    assert (pixels.resize(image, 8, 8) == image).all()
    step = np.zeros((1, 1, 10, 1), np.uint8)
    step[..., 5:, :] = 255  # overshoots of the kernel are cut off, not wrapped
    wide = pixels.resize(step, 1, 100)[0, 0, :, 0].astype(int)
    assert wide[:40].max() < 40 and wide[60:].min() > 215


def test_patch_filters_are_a_convolution():
    rng = np.random.default_rng(2)
    weights = models.filter_weights(side=3, filters=4)
    batch = rng.standard_normal((2, 7, 8, 3)).astype(np.float32)
    want = np.zeros((2, 4))
    filled = np.pad(batch, ((0, 0), (0, 2), (0, 1), (0, 0)))  # up to whole patches
    for n in range(2):
        for y in (0, 3, 6):
            for x in (0, 3, 6):
                patch = filled[n, y : y + 3, x : x + 3]
                want[n] = np.maximum(want[n], np.tensordot(patch, weights, 3))
    np.testing.assert_allclose(models.patch_filters(weights)(batch), want, rtol=1e-5)


def test_patch_filters_see_the_last_pixels():
    weights = np.ones((4, 4, 3, 1))
    batch = np.zeros((1, 10, 10, 3), np.float32)
    batch[0, 9, 9] = 1
    assert models.patch_filters(weights)(batch).tolist() == [[3.0]]


def test_broken_files_have_no_features(spark):
    def decode(content):
        return None if content == b"broken" else np.full((2, 2, 3), content[0], np.uint8)

    df = spark.createDataFrame([(b"broken",), (b"x",), (None,)], "content binary")
    rows = featurize(df, "content", models.max_pool, decode=decode).collect()
    assert [r.features is None for r in rows] == [True, False, True]


def test_weights_of_any_kind_are_measured(monkeypatch):
    class Holder:
        def __init__(self):
            self.content = bytes(10_000)

    from vecloom.operators.featurize import _weight_bytes

    globals()["Holder"] = Holder
    Holder.__qualname__ = "Holder"
    assert _weight_bytes(Holder()) >= 10_000
    assert _weight_bytes({"a": [np.zeros(4)]}) == 32


@pytest.mark.parametrize("most", [1, 30, 60, 10**6])
def test_decoded_bytes_bound_a_batch(spark, most):
    """Whatever fits together, one image at least, gives the same features; none is held longer."""
    sides = [1, 2, 3, 2, 3, 1, 2]
    rows = [(i, bytes([n])) for i, n in enumerate(sides)] + [(9, None), (10, b"")]
    frame = spark.createDataFrame(rows, "id int, content binary").coalesce(1)
    bound = max(most, 27)

    def decode(content):
        return np.full((content[0], content[0], 3), content[0] * 50, np.uint8) if content else None

    def model_fn(_):
        def predict(batch):
            if batch.size > bound:
                raise ValueError("too many pixels at a time")
            return models.max_pool()(batch)

        return predict

    out = featurize(frame, "content", model_fn, decode=decode, pixel_bytes=most).collect()
    got = {r.id: r.features for r in out}
    assert got[9] is None and got[10] is None
    for i, n in enumerate(sides):
        assert got[i] == pytest.approx([n * 50 / 127.5 - 1] * 3, abs=1e-6)


def test_pieces_of_images_and_files_are_bounded():
    from vecloom.operators import featurize as module

    n, side = 10, 4
    data = pa.array([bytes([i]) * (side * side * 3) for i in range(n)])
    sizes = pa.array([side] * n, pa.int32())
    pieces = list(module._image_pieces(sizes, sizes, pa.array([3] * n, pa.int32()), data, 100))
    assert [len(r) for r, _ in pieces] == [2] * 5
    assert np.concatenate([r for r, _ in pieces]).tolist() == list(range(n))
    held = []

    def decode(content):
        held.append(content)
        return np.zeros((side, side, 3), np.uint8)

    files = module._file_pieces(decode, 100)(data)
    next(files)
    assert len(held) <= 3  # the rest is not decoded yet


def test_weights_as_files_are_mapped_and_shared(spark):
    """They exceed the broadcast's bound, and workers get read-only maps of one file."""
    weights = np.arange(12, dtype=np.float32).reshape(4, 3)
    shared = models.weight_files(spark, {"w": weights}, "shared-test")

    def model_fn(arrays):
        assert isinstance(arrays["w"], np.memmap) and not arrays["w"].flags.writeable
        return models.linear(arrays["w"])

    frame = spark.createDataFrame([([1.0, 0.0, 0.0, 2.0],), (None,)], "x array<double>")
    rows = featurize(frame.repartition(2), "x", model_fn, shared).collect()
    got = [r.features for r in rows if r.x is not None]
    assert got == [(np.array([1.0, 0, 0, 2]) @ weights).tolist()]
