"""Models for ``featurize``: factories that turn broadcast weights into ``batch -> features``.

A batch is (n, d) for vectors and (n, h, w, 3) in [-1, 1] for images. Anything with that shape
of interface plugs in; a pretrained network goes in through a factory of the user's own.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

Model = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class WeightFiles:
    """Arrays of any size that Spark hands out as files, once to each node.

    ``value`` maps them into memory, read only, so the workers of a node share one copy of what
    they touch. Made by :func:`weight_files`.
    """

    names: dict[str, str]

    @property
    def value(self) -> dict[str, np.ndarray]:
        return {
            key: np.load(SparkFiles.get(name), mmap_mode="r") for key, name in self.names.items()
        }


def weight_files(spark: SparkSession, arrays: dict[str, np.ndarray], name: str) -> WeightFiles:
    """Gives ``arrays`` to all nodes under ``name``; ``model_fn`` gets them as a dictionary.

    The driver writes them to a folder of its own, from which Spark's file server reads.
    """
    folder = Path(tempfile.mkdtemp(prefix="weights-"))
    names = {}
    for key, array in arrays.items():
        names[key] = f"{name}-{key}.npy"
        np.save(folder / names[key], array)
        spark.sparkContext.addFile(str(folder / names[key]))
    return WeightFiles(names)


def max_pool(_weights: object = None) -> Model:
    """The largest value: of each vector, or of each channel of an image."""

    def predict(batch: np.ndarray) -> np.ndarray:
        return batch.max(axis=tuple(range(1, max(batch.ndim - 1, 2))))

    return predict


def linear(weights: np.ndarray) -> Model:
    """Flattened input times ``weights`` (inputs, outputs), in the precision of the weights."""

    def predict(batch: np.ndarray) -> np.ndarray:
        return batch.reshape(len(batch), -1).astype(weights.dtype, copy=False) @ weights

    return predict


def projection_weights(n_in: int, n_out: int, seed: int = 21) -> np.ndarray:
    """Gaussian weights for :func:`linear`, which then keeps distances in expectation."""
    draws = np.random.default_rng(seed).standard_normal((n_in, n_out), dtype=np.float32)
    return draws / np.float32(np.sqrt(n_out))


def patch_filters(weights: np.ndarray) -> Model:
    """Filters over square patches, rectified, then the largest response of each filter.

    ``weights`` is (side, side, 3, filters). Images whose sides are no multiples of it are filled
    up with zeros on the right and below. One matrix product per batch.
    """
    side, _, channels, filters = weights.shape
    kernel = weights.reshape(-1, filters)

    def predict(batch: np.ndarray) -> np.ndarray:
        n, rows, cols = len(batch), -(-batch.shape[1] // side), -(-batch.shape[2] // side)
        more = (rows * side - batch.shape[1], cols * side - batch.shape[2])
        if any(more):
            batch = np.pad(batch, ((0, 0), (0, more[0]), (0, more[1]), (0, 0)))
        grid = batch.reshape(n, rows, side, cols, side, channels)
        patches = grid.transpose(0, 1, 3, 2, 4, 5).reshape(n, rows * cols, -1)
        return np.maximum(patches @ kernel, 0).max(axis=1)

    return predict


def filter_weights(side: int = 13, filters: int = 2048, seed: int = 21) -> np.ndarray:
    """Gaussian weights for :func:`patch_filters`."""
    draws = np.random.default_rng(seed).standard_normal((side, side, 3, filters), dtype=np.float32)
    return draws / np.float32(side)
