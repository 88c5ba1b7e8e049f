"""Standardising and principal components.

:func:`standardize` is MLlib's scaler. For PCA, MLlib reads the data three times (scaler, means,
covariance), updates a packed matrix row by row and decomposes it in Java on the driver; with
2,048 features that takes far longer than the scan. Here one Spark job gathers the count, sums
and products of the raw columns with a matrix product per Arrow batch, and the decomposition of
the features x features matrix is numpy's. Every width and threshold is then read off the one
fit, with no second job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions import dense_vector
from vecloom.session import small_frame

MAX_DIMS = 8192


def standardize(
    df: DataFrame,
    input_col: str = "features",
    vector_col: str = "features_vectors",
    output_col: str = "features_scaled",
) -> tuple[DataFrame, StandardScalerModel]:
    """Arrays to vectors of mean 0 and sample standard deviation 1 (constant columns: 0).

    Rows with NULL are left out.
    """
    vectors = df.where(F.col(input_col).isNotNull()).withColumn(
        vector_col, array_to_vector(F.col(input_col))
    )
    scaler = StandardScaler(inputCol=vector_col, outputCol=output_col, withMean=True, withStd=True)
    model = scaler.fit(vectors)
    return model.transform(vectors), model


@dataclass(frozen=True)
class Moments:
    """Row count, column means and sample covariance."""

    n: int
    mean: np.ndarray
    covariance: np.ndarray

    @property
    def std(self) -> np.ndarray:
        return np.sqrt(np.diag(self.covariance))

    @property
    def correlation(self) -> np.ndarray:
        """Covariance of the standardised columns; rows of constant columns are 0."""
        inverse = _inverse(self.std)
        return self.covariance * inverse[:, None] * inverse


def column_moments(
    df: DataFrame, input_col: str = "features", max_dims: int = MAX_DIMS
) -> Moments:
    """Moments of an array column, in one job that reads its non-NULL rows once.

    Each task shifts by a row of its own and sends its count, its means and one packed triangle of
    products about them (17 MB for 2,048 columns), so the shuffle depends on the number of tasks,
    not rows. The triangle's blocks are merged in parallel, pair by pair, in two levels, and only
    their sums reach the driver, which holds a matrix of at most ``max_dims`` columns. NaN, infinite
    or NULL values are an error.
    """
    rows = df.select(F.col(input_col).alias("x")).where(F.col("x").isNotNull())
    partials = rows.mapInArrow(_partial_products(max_dims), _PARTIAL)
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    merged = partials.withColumn("part", part).repartition("block", "part")
    merged = merged.sortWithinPartitions("block", "part").mapInArrow(_merged, _PARTIAL)
    merged = merged.repartition("block").sortWithinPartitions("block").mapInArrow(_merged, _PARTIAL)
    sums = merged.toArrow().sort_by("block")
    if not len(sums):
        raise ValueError(f"no rows with {input_col}")
    n = sums["n"][0].as_py()
    if n < 2:
        raise ValueError("moments need at least two rows")
    mean = sums["mean"][0].values.to_numpy()
    d = len(mean)
    products = np.empty((d, d))
    for columns, packed in zip(_blocks(d), sums["products"], strict=True):
        packed = packed.values.to_numpy()
        for i in columns:
            products[i, i:] = products[i:, i] = packed[: d - i]
            packed = packed[d - i :]
    return Moments(n, mean, products / (n - 1))


# Blocks of columns that are merged apart, and groups of tasks that are merged first.
MAX_BLOCKS, PARTS = 64, 64
_PARTIAL = "block int, part int, n long, mean array<double>, products array<double>"


def _blocks(d: int) -> list[np.ndarray]:
    return np.array_split(np.arange(d), min(d, MAX_BLOCKS))


def _partial(block: int, part: int, n: int, mean: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
    def one(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([n], pa.int64()),
            one(mean), one(products),
        ],
        names=["block", "part", "n", "mean", "products"],
    )


def _partial_products(max_dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """Per task and block of columns: the products of each column, less its mean, with itself and
    later columns. Shifted by the task's first row, so that large values lose no digits."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, shift = 0, None
        for batch in batches:
            lists = batch.column(0)
            if not len(lists):
                continue
            if shift is None:
                shift = np.array(lists[0].as_py(), np.float64)
                d = len(shift)
                if not 0 < d <= max_dims:
                    raise ValueError(f"{d} columns: the products matrix is held for 1 to {max_dims}")
                total, products = np.zeros(d), np.zeros((d, d))
            if not np.all(lists.value_lengths().to_numpy() == d):
                raise ValueError(f"vectors of mixed length: want {d}")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - shift
            odd = len(x) - int(np.isfinite(x).all(axis=1).sum())
            if odd:
                raise ValueError(f"{odd} vectors of a batch hold NULL or values that aren't finite")
            n += len(x)
            total += x.sum(axis=0)
            products += x.T @ x
        if n:
            for block, columns in enumerate(_blocks(d)):
                own = [products[i, i:] - total[i] / n * total[i:] for i in columns]
                yield _partial(block, 0, n, shift + total / n, np.concatenate(own))

    return partial


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of one block and part become one; a few rows are in memory at a time."""
    held: list | None = None
    for batch in batches:
        for k in range(batch.num_rows):
            block, part, n = (batch.column(i)[k].as_py() for i in range(3))
            mean, products = (batch.column(i)[k].values.to_numpy() for i in (3, 4))
            if held and held[0] != (block, part):
                yield _partial(held[0][0], 0, *held[1:])
                held = None
            if held is None:
                held = [(block, part), n, mean.copy(), products.copy()]
                continue
            if len(mean) != len(held[2]):
                raise ValueError(f"vectors of mixed length: {len(mean)} and {len(held[2])}")
            weight = held[1] * n / (held[1] + n)
            apart = mean - held[2]
            at = 0
            for i in _blocks(len(mean))[block]:
                width = len(mean) - i
                held[3][at : at + width] += products[at : at + width] + weight * apart[i] * apart[i:]
                at += width
            held[1] += n
            held[2] += apart * (n / held[1])
    if held:
        yield _partial(held[0][0], 0, *held[1:])


@dataclass(frozen=True)
class Components:
    """Principal axes, largest variance first; each axis's largest loading is positive."""

    mean: np.ndarray
    scale: np.ndarray
    axes: np.ndarray
    explained_variance: np.ndarray

    @property
    def cumulative(self) -> np.ndarray:
        return np.cumsum(self.explained_variance)

    def transform(
        self,
        df: DataFrame,
        k: int,
        input_col: str = "features",
        output_col: str = "vectors_pca",
        vector_col: str | None = "features_vectors",
        scaled_col: str | None = "features_scaled",
    ) -> DataFrame:
        """Add the first ``k`` components, and the raw and standardised vectors if named.

        Rows go to Python once, for both results: name no ``scaled_col`` where it is not needed.
        """
        if not 1 <= k <= self.axes.shape[1]:
            raise ValueError(f"k is {k}: want 1 to {self.axes.shape[1]}")
        inverse = _inverse(self.scale)
        spark = df.sparkSession
        out = df
        if vector_col:
            out = out.withColumn(vector_col, dense_vector(input_col))
        both = _affine(spark, self.mean, inverse, self.axes[:, :k], scaled_col is not None)
        out = out.withColumn(output_col, both(F.col(input_col)))
        made = {output_col: dense_vector(F.col(f"`{output_col}`.reduced"))}
        if scaled_col:
            made = {scaled_col: dense_vector(F.col(f"`{output_col}`.scaled")), **made}
        return out.withColumns(made)


def fit_components(
    df: DataFrame, input_col: str = "features", standardized: bool = True, **options: int
) -> Components:
    """All principal components of the standardised (or only centred) column, in one pass."""
    moments = column_moments(df, input_col, **options)
    matrix = moments.correlation if standardized else moments.covariance
    values, axes = np.linalg.eigh(matrix)
    values, axes = np.clip(values[::-1], 0, None), axes[:, ::-1]
    largest = np.abs(axes).argmax(axis=0)
    axes = axes * np.where(axes[largest, np.arange(len(values))] < 0, -1.0, 1.0)
    scale = moments.std if standardized else np.ones_like(moments.mean)
    if values.sum() == 0:
        raise ValueError(f"{input_col} does not vary")
    return Components(moments.mean, scale, axes, values / values.sum())


def fit_leading(
    df: DataFrame,
    k: int,
    input_col: str = "features",
    extra: int = 32,
    rounds: int = 2,
    seed: int = 21,
) -> Components:
    """The first ``k`` components of the standardised column, for any number ``d`` of features.

    A randomised range finder: the products matrix of all features (d x d) is never built. One pass
    gives the means and deviations. Each of ``rounds`` passes multiplies the matrix with ``d`` x
    ``k + extra`` axes, task by task, and makes the result orthogonal; a last pass gives the small
    matrix of products along them, whose eigenvectors turn them into components. Shuffle, driver and
    broadcast hold ``d * (k + extra)`` numbers. Later axes of a flat spectrum need more rounds:
    each shrinks the error by the ratio of the variances there. Shares are of the whole variance.
    """
    rows = df.select(F.col(input_col).alias("x")).where(F.col("x").isNotNull())
    context = df.sparkSession.sparkContext
    n, mean, squares = _summed(rows, _sums_of_columns)
    if n < 2:
        raise ValueError("components need at least two rows")
    d, width = len(mean), min(k + extra, len(mean))
    if not 1 <= k <= d:
        raise ValueError(f"k is {k}: want 1 to {d}")
    std = np.sqrt(squares / (n - 1))
    inverse = _inverse(std)
    whole = float(np.count_nonzero(inverse))  # each column that varies has a variance of 1
    if not whole:
        raise ValueError(f"{input_col} does not vary")
    axes = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    for _ in range(rounds):
        shared = context.broadcast((mean, inverse, axes))
        _, _, flat = _summed(rows, _times_axes(shared, along=False))
        axes = np.linalg.qr(flat.reshape(d, width))[0]
    shared = context.broadcast((mean, inverse, axes))
    _, _, flat = _summed(rows, _times_axes(shared, along=True))
    values, turn = np.linalg.eigh(flat.reshape(width, width) / (n - 1))
    order = np.argsort(-values)[:k]
    axes, values = axes @ turn[:, order], np.clip(values[order], 0, None)
    largest = np.abs(axes).argmax(axis=0)
    axes = axes * np.where(axes[largest, np.arange(k)] < 0, -1.0, 1.0)
    return Components(mean, std, axes, values / whole)


#: Numbers of a row in the sums of :func:`fit_leading`.
CHUNK = 1 << 16
_SUM = "chunk int, n long, mean array<double>, total array<double>"


def _matrix(lists: pa.Array) -> np.ndarray:
    d = len(lists[0])
    if not np.all(lists.value_lengths().to_numpy() == d):
        raise ValueError(f"vectors of mixed length: want {d}")
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    if not np.isfinite(x).all():
        raise ValueError("vectors hold NULL or values that aren't finite")
    return x


def _sum_rows(n: int, mean: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
    for chunk, at in enumerate(range(0, len(total), CHUNK)):
        parts = [x[at : at + CHUNK] for x in (mean, total)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk], pa.int32()), pa.array([n], pa.int64()),
                *(pa.ListArray.from_arrays(pa.array([0, len(p)], pa.int32()), p) for p in parts),
            ],
            names=["chunk", "n", "mean", "total"],
        )


def _sums_of_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task the count, the means and the squares about them."""
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(0))
        if not n:
            shift, total, squares = x[0].copy(), np.zeros(x.shape[1]), np.zeros(x.shape[1])
        x -= shift
        n += len(x)
        total += x.sum(axis=0)
        squares += (x * x).sum(axis=0)
    if n:
        yield from _sum_rows(n, shift + total / n, squares - total * total / n)


def _times_axes(shared: Any, along: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """Per task the products of the standardised rows with their places on the axes; ``along``
    gives those of the places with each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, inverse, axes = shared.value
        total, n = 0.0, 0
        for batch in batches:
            if batch.num_rows:
                x = (_matrix(batch.column(0)) - mean) * inverse
                places = x @ axes
                total, n = total + (places if along else x).T @ places, n + len(x)
        if n:
            flat = np.ascontiguousarray(total).ravel()
            yield from _sum_rows(n, np.zeros(0), flat)

    return run


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk become one: counts, means and squares merge pair by pair."""
    held: list | None = None

    def out() -> pa.RecordBatch:
        chunk, n, mean, total = held
        lists = [pa.ListArray.from_arrays(pa.array([0, len(p)], pa.int32()), p) for p in (mean, total)]
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), pa.array([n], pa.int64()), *lists],
            names=["chunk", "n", "mean", "total"],
        )

    for batch in batches:
        for k in range(batch.num_rows):
            chunk, n = (batch.column(i)[k].as_py() for i in range(2))
            mean, total = (batch.column(i)[k].values.to_numpy() for i in (2, 3))
            if held and held[0] != chunk:
                yield out()
                held = None
            if held is None:
                held = [chunk, n, mean.copy(), total.copy()]
                continue
            if len(mean) != len(held[2]) or len(total) != len(held[3]):
                raise ValueError("vectors of mixed length")
            held[3] += total
            if len(mean):
                apart = mean - held[2]
                held[3] += held[1] * n / (held[1] + n) * apart * apart
                held[2] += apart * (n / (held[1] + n))
            held[1] += n
    if held:
        yield out()


def _summed(rows: DataFrame, run: Callable) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, means and totals over all tasks, in one job: merged by groups of tasks, then wholly."""
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    sums = rows.mapInArrow(run, _SUM).repartition("chunk", part)
    sums = sums.sortWithinPartitions("chunk").mapInArrow(_add_sums, _SUM)
    sums = sums.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_add_sums, _SUM)
    table = sums.toArrow().sort_by("chunk")
    if not len(table):
        raise ValueError("no rows")
    mean, total = (
        np.concatenate([x.values.to_numpy() for x in table[c]]) for c in ("mean", "total")
    )
    return table["n"][0].as_py(), mean, total


def variance_curve(spark: SparkSession, model: Components) -> DataFrame:
    """``k, ratio, cumulative``: share of the variance of the k-th and of the first k axes."""
    return small_frame(
        spark,
        k=np.arange(1, len(model.explained_variance) + 1, dtype=np.int32),
        ratio=model.explained_variance,
        cumulative=model.cumulative,
    )


@dataclass(frozen=True)
class Choice:
    """``k`` components are enough; ``index`` = k - 1 is their position on the curve."""

    k: int
    index: int
    cumulative: float


def choose_k(model: Components, threshold: float = 0.95, width: int | None = None) -> Choice:
    """The fewest components, of the first ``width`` (None: of all), that reach ``threshold``."""
    curve = model.cumulative[:width]
    reached = np.flatnonzero(curve >= threshold)
    if not len(reached):
        raise ValueError(f"{len(curve)} components reach {curve[-1]:.6f}, not {threshold}")
    index = int(reached[0])
    return Choice(index + 1, index, float(curve[index]))


def _inverse(scale: np.ndarray) -> np.ndarray:
    return np.divide(1.0, scale, out=np.zeros_like(scale), where=scale > 0)


def _affine(
    spark: SparkSession, mean: np.ndarray, inverse: np.ndarray, axes: np.ndarray, scaled: bool
) -> Callable[[Column], Column]:
    """UDF for the struct of ``reduced``, ``(x - mean) * inverse @ axes``, and, if ``scaled``, the
    standardised vector; its arrays have at most MAX_DIMS rows, or the axes of a leading fit.

    Not deterministic in name, so that no filter on its result makes Spark compute it twice.
    """
    shared = spark.sparkContext.broadcast((mean, inverse, axes))
    kind = "struct<reduced: array<double>" + (", scaled: array<double>>" if scaled else ">")

    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mean, inverse, axes = shared.value
        matrix = inverse[:, None] * axes
        for lists in batches:
            lengths = lists.drop_null().value_lengths().to_numpy()
            if not np.all(lengths == len(mean)):
                raise ValueError(f"vectors of mixed length: want {len(mean)}")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean)) - mean
            present = lists.is_valid().to_numpy(zero_copy_only=False)

            def rows(y: np.ndarray, present: np.ndarray = present) -> pa.Array:
                offsets = np.concatenate([[0], np.cumsum(present * y.shape[1])])
                return pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(y.ravel()), mask=pa.array(~present)
                )

            fields = {"reduced": rows(x @ matrix)}
            if scaled:
                fields["scaled"] = rows(x * inverse)
            yield pa.StructArray.from_arrays(list(fields.values()), names=list(fields))

    return F.arrow_udf(apply, kind).asNondeterministic()
