"""Run a model over a column in Arrow batches on the executors."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions import pixels as px
from vecloom.functions.models import Model, WeightFiles

Piece = tuple[np.ndarray, np.ndarray]  # row positions, and one array row for each of them

MAX_WEIGHT_BYTES = 1 << 30
PIXEL_BYTES = 256 << 20


def featurize(
    df: DataFrame,
    input_col: str,
    model_fn: Callable[[Any], Model],
    weights: Any = None,
    output_col: str = "features",
    size: tuple[int, int] | None = None,
    decode: Callable[[bytes], np.ndarray] | None = None,
    rows_per_batch: int | None = None,
    partitions: int | None = None,
    once: bool = True,
    pixel_bytes: int = PIXEL_BYTES,
) -> DataFrame:
    """Add ``output_col array<float>``: the model's output for each row, flattened.

    The input column is an image struct, file bytes (each turned into an RGB array by
    ``decode``) or a numeric array. Images are resized to ``size`` (height, width) if given and
    scaled to [-1, 1]. ``weights`` are broadcast, or :class:`models.WeightFiles`, which a node's
    workers share; ``model_fn(weights)`` is called once per task and the model then sees at most
    ``rows_per_batch`` rows at a time, and images of at most ``pixel_bytes`` decoded bytes together
    (one larger image alone): as bytes and again, resized, as 4-byte numbers. Rows
    without input (NULL, undecodable image, empty array) get NULL features; a ``decode`` of your
    own returns None for a file it can't read.

    The work is an iterator UDF over one column, not a whole-row map, so that Catalyst still
    prunes it when the features are not asked for and sends Python nothing but the input. It is
    marked as not deterministic, or a later filter on the features (even the one Spark derives
    from ``explode``) would run the model twice; so put filters on other columns before it. With
    ``once=False`` it is not marked, and Catalyst also moves later filters on other columns below.
    ``partitions`` shuffles the input first, image bytes included; sizing the scan's partitions
    (``session.scan_settings``) avoids that.
    """
    kind = df.schema[input_col].dataType
    if isinstance(kind, T.StructType):
        inputs = [F.col(f"{input_col}.{f}") for f in ("height", "width", "nChannels", "data")]
        pieces, default_rows = partial(_image_pieces, pixel_bytes=pixel_bytes), 64
    elif isinstance(kind, T.BinaryType):
        inputs = [F.col(input_col)]
        pieces, default_rows = _file_pieces(decode or px.decode_pillow, pixel_bytes), 64
    elif isinstance(kind, T.ArrayType):
        inputs = [F.col(input_col)]
        pieces, default_rows = _vector_pieces, 1024
    else:
        raise TypeError(f"{input_col} is {kind.simpleString()}: want an image, bytes or an array")

    shared = None
    if isinstance(weights, WeightFiles):
        shared = weights
    elif weights is not None:
        n_bytes = _weight_bytes(weights)
        if n_bytes > MAX_WEIGHT_BYTES:
            raise ValueError(f"{n_bytes} bytes of weights: give them as models.WeightFiles")
        shared = df.sparkSession.sparkContext.broadcast(weights)

    run = _runner(model_fn, shared, pieces, size, rows_per_batch or default_rows, len(inputs))
    if once:
        run = run.asNondeterministic()
    if partitions:
        df = df.repartition(partitions)
    return df.withColumn(output_col, run(*inputs))


def to_rgb(df: DataFrame, image_col: str = "image", output_col: str = "rgb") -> DataFrame:
    """Add the pixels as RGB bytes, row by row from the top; NULL for an undecodable image."""

    @F.arrow_udf("binary")
    def flip(
        height: pa.Array, width: pa.Array, channels: pa.Array, data: pa.Array
    ) -> pa.Array:
        out: list[bytes | None] = [None] * len(data)
        for rows, batch in _image_pieces(height, width, channels, data):
            for row, image in zip(rows, batch, strict=True):
                out[row] = image.tobytes()
        return pa.array(out, pa.binary())

    fields = (F.col(f"{image_col}.{f}") for f in ("height", "width", "nChannels", "data"))
    return df.withColumn(output_col, flip.asNondeterministic()(*fields))


def _runner(
    model_fn: Callable[[Any], Model],
    shared: Any,
    pieces: Callable[..., Iterable[Piece]],
    size: tuple[int, int] | None,
    rows_per_batch: int,
    n_inputs: int,
) -> Any:
    def run(batches: Iterator[Any]) -> Iterator[pa.Array]:
        model = model_fn(shared.value) if shared is not None else model_fn(None)
        for columns in batches:
            columns = columns if n_inputs > 1 else (columns,)
            n = len(columns[0])
            done = []
            for start in range(0, n, rows_per_batch):
                part = [c.slice(start, rows_per_batch) for c in columns]
                for rows, batch in pieces(*part):
                    if batch.ndim == 4:
                        batch = px.to_unit_range(px.resize(batch, *size) if size else batch)
                    result = np.asarray(model(batch), dtype=np.float32)
                    done.append((rows + start, result.reshape(len(rows), -1)))
            yield _float_lists(n, done)

    if n_inputs > 1:

        def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            return run(batches)

        return F.arrow_udf(many, "array<float>")

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(batches)

    return F.arrow_udf(one, "array<float>")


def _image_pieces(
    height: pa.Array,
    width: pa.Array,
    channels: pa.Array,
    data: pa.Array,
    pixel_bytes: int = PIXEL_BYTES,
) -> Iterator[Piece]:
    """Images of one shape together, as (n, h, w, 3) RGB of at most ``pixel_bytes``."""
    shapes = np.stack([_ints(c, -1) for c in (height, width, channels)], axis=1)
    for shape in np.unique(shapes, axis=0):
        if shape.min() > 0:
            same = np.flatnonzero((shapes == shape).all(axis=1))
            most = max(1, pixel_bytes // (int(shape[0]) * int(shape[1]) * 3))
            for rows in np.split(same, range(most, len(same), most)):
                joined = b"".join(data.take(pa.array(rows)).to_pylist())
                batch = np.frombuffer(joined, np.uint8).reshape(len(rows), *shape)
                yield rows, px.bgr_to_rgb(batch)


def _file_pieces(
    decode: Callable[[bytes], np.ndarray], pixel_bytes: int = PIXEL_BYTES
) -> Callable[[pa.Array], Iterable[Piece]]:
    """Decoded files of one shape together; no more than ``pixel_bytes`` are held at a time."""

    def pieces(content: pa.Array) -> Iterator[Piece]:
        by_shape: dict[tuple[int, ...], list[tuple[int, np.ndarray]]] = {}
        held = 0

        def out() -> Iterator[Piece]:
            while by_shape:
                found = by_shape.popitem()[1]
                yield np.array([r for r, _ in found]), np.stack([i for _, i in found])

        for row, file in enumerate(content):
            image = decode(file.as_py()) if file.is_valid else None
            if image is None:
                continue
            if held and held + image.nbytes > pixel_bytes:
                yield from out()
                held = 0
            by_shape.setdefault(image.shape, []).append((row, image))
            held += image.nbytes
        yield from out()

    return pieces


def _vector_pieces(vectors: pa.Array) -> Iterator[Piece]:
    """Vectors of one length together, as (n, length)."""
    lengths = _ints(vectors.value_lengths(), 0)
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        same = vectors if len(rows) == len(vectors) else vectors.take(pa.array(rows))
        yield rows, same.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length)


def _ints(values: pa.Array, missing: int) -> np.ndarray:
    return values.fill_null(missing).to_numpy(zero_copy_only=False)


def _float_lists(n: int, done: list[Piece]) -> pa.Array:
    """Result rows back in input order; rows in no piece become NULL."""
    lengths = np.zeros(n, np.int64)
    missing = np.ones(n, bool)
    for rows, result in done:
        lengths[rows] = result.shape[1]
        missing[rows] = False
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    values = np.empty(offsets[-1], np.float32)
    for rows, result in done:
        values[offsets[rows][:, None] + np.arange(result.shape[1])] = result
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(values), mask=pa.array(missing)
    )


def _weight_bytes(weights: Any) -> int:
    if isinstance(weights, dict):
        return sum(_weight_bytes(w) for w in weights.values())
    if isinstance(weights, list | tuple):
        return sum(_weight_bytes(w) for w in weights)
    if isinstance(weights, bytes | bytearray):
        return len(weights)
    if isinstance(weights, np.ndarray) and weights.dtype != object:
        return weights.nbytes
    return len(pickle.dumps(weights))
