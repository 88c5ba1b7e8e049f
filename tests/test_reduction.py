from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from vecloom.operators import reduction


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", F.col("embedding").alias("features")
    )


@pytest.fixture(scope="module")
def matrix(table):
    rows = table.orderBy("vec_id").collect()
    return np.array([r.features for r in rows], np.float64)


@pytest.fixture(scope="module")
def model(table):
    return reduction.fit_components(table)


def column(df, name):
    rows = df.select("vec_id", vector_to_array(name).alias("v")).orderBy("vec_id").collect()
    return np.array([r.v for r in rows])


def standardized(matrix):
    return (matrix - matrix.mean(axis=0)) / matrix.std(axis=0, ddof=1)


def test_standardize_equals_numpy(table, matrix):
    scaled, model = reduction.standardize(table)
    np.testing.assert_allclose(column(scaled, "features_scaled"), standardized(matrix), atol=1e-12)
    np.testing.assert_allclose(model.std.toArray(), matrix.std(axis=0, ddof=1), rtol=1e-12)
    np.testing.assert_allclose(column(scaled, "features_vectors"), matrix)


@pytest.mark.parametrize("layout", [1, 7, 16])
def test_moments_equal_numpy_in_any_layout(table, matrix, layout):
    moments = reduction.column_moments(table.repartition(layout))
    assert moments.n == 500
    np.testing.assert_allclose(moments.mean, matrix.mean(axis=0), atol=1e-14)
    np.testing.assert_allclose(moments.covariance, np.cov(matrix.T), atol=1e-15)
    np.testing.assert_allclose(moments.correlation, np.corrcoef(matrix.T), atol=1e-13)


def test_moments_far_from_zero(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 3)) * [1e-3, 1.0, 5.0] + [1e6, -1e6, 3.0]
    df = spark.createDataFrame([(r,) for r in x.tolist()], "features array<double>")
    moments = reduction.column_moments(df.repartition(5))
    np.testing.assert_allclose(moments.covariance, np.cov(x.T), rtol=1e-6, atol=1e-9)


def test_components_equal_numpy(model, matrix):
    values, axes = np.linalg.eigh(np.corrcoef(matrix.T))
    np.testing.assert_allclose(model.explained_variance, values[::-1] / 64, atol=1e-14)
    np.testing.assert_allclose(np.abs((model.axes * axes[:, ::-1]).sum(axis=0)), 1, atol=1e-10)
    assert (model.axes[np.abs(model.axes).argmax(axis=0), np.arange(64)] > 0).all()


def test_projection_equals_mllib_up_to_sign(table, model):
    ours = model.transform(table, 32)
    vectors = table.withColumn("v", array_to_vector("features"))
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vectors)
    scaled = scaler.transform(vectors)
    theirs = PCA(k=32, inputCol="s", outputCol="p").fit(scaled)
    np.testing.assert_allclose(
        model.explained_variance[:32], theirs.explainedVariance.toArray(), atol=1e-12
    )
    a, b = column(ours, "vectors_pca"), column(theirs.transform(scaled), "p")
    sign = np.sign((a * b).sum(axis=0))
    np.testing.assert_allclose(a, b * sign, atol=1e-9)
    np.testing.assert_allclose(column(ours, "features_scaled"), column(scaled, "s"), atol=1e-12)


def test_unstandardised_components(table, matrix):
    model = reduction.fit_components(table, standardized=False)
    values = np.linalg.eigvalsh(np.cov(matrix.T))[::-1]
    np.testing.assert_allclose(model.explained_variance, values / values.sum(), atol=1e-13)
    centred = matrix - matrix.mean(axis=0)
    got = column(model.transform(table, 3), "vectors_pca")
    np.testing.assert_allclose(got, centred @ model.axes[:, :3], atol=1e-12)


def test_unwanted_columns_are_not_computed(table, model):
    reduced = model.transform(table, 2)
    plan = reduced.select("vec_id", "vectors_pca")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("apply(") >= 1
    nodes = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(nodes) == 1 and nodes[0].count("apply(") == 1


def test_constant_column_and_null_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((60, 4))
    x[:, 2] = 0.1
    rows = [(i, r) for i, r in enumerate(x.tolist())] + [(60, None)]
    df = spark.createDataFrame(rows, "vec_id int, features array<double>").repartition(3)
    model = reduction.fit_components(df)
    assert model.scale[2] == 0
    assert model.explained_variance[-1] == pytest.approx(0, abs=1e-15)
    reduced = model.transform(df, 4)
    kept = reduced.where("vec_id < 60")
    assert (column(kept, "features_scaled")[:, 2] == 0).all()
    last = reduced.where("vec_id = 60").first()
    assert last.features_vectors is last.features_scaled is last.vectors_pca is None
    scaled, _ = reduction.standardize(df)
    assert scaled.count() == 60
    assert (column(scaled, "features_scaled")[:, 2] == 0).all()


def test_variance_curve(spark, model):
    rows = reduction.variance_curve(spark, model).orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1, 65))
    ratios = [r.ratio for r in rows]
    assert ratios == sorted(ratios, reverse=True)
    np.testing.assert_allclose([r.cumulative for r in rows], np.cumsum(ratios))
    assert rows[-1].cumulative == pytest.approx(1)
    assert rows[31].cumulative == pytest.approx(0.6494, abs=5e-5)


def test_choose_k(model):
    choice = reduction.choose_k(model)
    assert (choice.k, choice.index) == (58, 57)
    assert choice.cumulative == pytest.approx(0.95451, abs=5e-6)
    assert reduction.choose_k(model, threshold=0.0).k == 1
    with pytest.raises(ValueError, match="32 components reach 0.649"):
        reduction.choose_k(model, width=32)


def test_bad_input_is_named(spark, table, model):
    mixed = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "features array<double>")
    with pytest.raises(Exception, match="mixed length"):
        reduction.column_moments(mixed)
    with pytest.raises(ValueError, match="no rows"):
        reduction.column_moments(mixed.where("size(features) > 5"))
    same = spark.createDataFrame([([1.0, 2.0],)] * 3, "features array<double>")
    with pytest.raises(ValueError, match="does not vary"):
        reduction.fit_components(same)
    with pytest.raises(ValueError, match="two rows"):
        reduction.column_moments(same.limit(1))
    with pytest.raises(ValueError, match="k is 65"):
        model.transform(table, 65)
    with pytest.raises(Exception, match="mixed length"):
        model.transform(mixed.select(F.lit(0).alias("vec_id"), "features"), 2).collect()


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), None])
def test_moments_refuse_values_that_are_not_finite(spark, odd):
    rows = [([1.0, 2.0],), ([odd, 2.0],), ([0.0, 1.0],)]
    df = spark.createDataFrame(rows, "features array<double>")
    with pytest.raises(Exception, match="finite"):
        reduction.column_moments(df)


def test_moments_take_one_scan_and_merge_exactly(spark):
    """Values far from zero, a constant column, tasks of one row, and every row seen once."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((301, 70)) * np.arange(1, 71) + 1e8
    x[:, 5] = 1 / 3
    frame = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>")
    for tasks in (1, 3, 301):
        seen = spark.sparkContext.accumulator(0)

        def count(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        counted = frame.repartition(tasks).mapInArrow(count, frame.schema)
        moments = reduction.column_moments(counted)
        assert seen.value == len(x)
        assert moments.n == 301 and moments.covariance[5].tolist() == [0.0] * 70
        assert moments.mean[5] == 1 / 3
        np.testing.assert_allclose(moments.mean, x.mean(axis=0), rtol=1e-14)
        np.testing.assert_allclose(moments.covariance, np.cov(x.T), atol=1e-5, rtol=1e-6)


def test_mixed_lengths_in_different_tasks_are_an_error(spark):
    frame = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0],)], "features array<double>")
    with pytest.raises(Exception, match="mixed length"):
        reduction.column_moments(frame.repartition(2))


def test_one_trip_to_python_for_the_saved_table(spark):
    rng = np.random.default_rng(2)
    frame = spark.createDataFrame(
        [(i, r.tolist()) for i, r in enumerate(rng.standard_normal((50, 6)))],
        "path int, features array<double>",
    )
    model = reduction.fit_components(frame)
    saved = model.transform(frame, 4)
    plan = saved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    rows = saved.collect()
    for r in rows:
        z = (np.array(r.features) - model.mean) / model.scale
        np.testing.assert_allclose(r.features_scaled.toArray(), z)
        np.testing.assert_allclose(r.vectors_pca.toArray(), z @ model.axes[:, :4], atol=1e-12)


def test_leading_components_equal_the_exact_fit(spark):
    rng = np.random.default_rng(5)
    n, d, k = 400, 120, 10
    x = rng.standard_normal((n, 30)) * 0.9 ** np.arange(30) @ rng.standard_normal((30, d))
    x = x + 1e-3 * rng.standard_normal((n, d)) + 1e4
    x[:, 7] = 3.0
    frame = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>")
    exact = reduction.fit_components(frame)
    for tasks in (1, 5):
        found = reduction.fit_leading(frame.repartition(tasks), k, extra=25)
        np.testing.assert_allclose(found.explained_variance, exact.explained_variance[:k], atol=1e-6)
        np.testing.assert_allclose(found.scale, exact.scale, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(np.abs((found.axes * exact.axes[:, :k]).sum(axis=0)), 1, atol=1e-4)
        assert (found.axes[np.abs(found.axes).argmax(axis=0), np.arange(k)] > 0).all()
    reduced = found.transform(frame, k).select("vectors_pca").collect()
    want = (x - exact.mean) * reduction._inverse(exact.scale) @ found.axes
    np.testing.assert_allclose([r[0].toArray() for r in reduced], want, atol=1e-6)


def test_leading_components_of_many_features(spark):
    """More features than a matrix of all products may have."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((3, 9000))
    x = rng.standard_normal((24, 3)) * [9, 5, 2] @ base
    frame = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>")
    with pytest.raises(Exception, match="columns"):
        reduction.column_moments(frame)
    model = reduction.fit_leading(frame.repartition(4), 3, extra=5)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    values = np.linalg.svd(z, compute_uv=False) ** 2
    np.testing.assert_allclose(model.explained_variance, values[:3] / values.sum(), atol=1e-6)
