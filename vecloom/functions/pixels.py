"""Pixel work on whole batches: channel order, resizing, scaling. Plain numpy, run in tasks."""

from __future__ import annotations

import io

import numpy as np


def bgr_to_rgb(pixels: np.ndarray) -> np.ndarray:
    """(n, h, w, c) as the image source gives it, to RGB; grey is repeated, alpha is left out."""
    if pixels.shape[-1] == 1:
        return np.repeat(pixels, 3, axis=-1)
    return pixels[..., 2::-1]


def resample_matrix(n_in: int, n_out: int) -> np.ndarray:
    """The (n_out, n_in) weights of a cubic resize, widened when it shrinks.

    Cubic convolution with a = -0.5: the kernel whose weights make the result exact for
    straight ramps. Each row sums to 1.
    """
    ratio = n_in / n_out
    width = max(ratio, 1.0)
    centers = (np.arange(n_out) + 0.5) * ratio
    t = np.abs(np.arange(n_in) + 0.5 - centers[:, None]) / width
    near = (1.5 * t - 2.5) * t * t + 1.0
    far = ((-0.5 * t + 2.5) * t - 4.0) * t + 2.0
    weights = np.where(t < 1, near, np.where(t < 2, far, 0.0))
    return (weights / weights.sum(axis=1, keepdims=True)).astype(np.float32)


def resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """(n, h, w, c) bytes to (n, height, width, c) bytes: two matrix products per batch."""
    n, h, w, c = pixels.shape
    planes = pixels.transpose(0, 1, 3, 2)  # rows of one colour, so that a product spans all
    if w != width:
        lines = planes.reshape(-1, w).astype(np.float32)
        planes = _to_bytes(lines @ resample_matrix(w, width).T)
    if h != height:
        rows = planes.reshape(n, h, c * width).astype(np.float32)
        planes = _to_bytes(resample_matrix(h, height) @ rows)
    return planes.reshape(n, height, c, width).transpose(0, 1, 3, 2)


def to_unit_range(pixels: np.ndarray) -> np.ndarray:
    """Bytes to floats in [-1, 1]."""
    return pixels.astype(np.float32) / np.float32(127.5) - np.float32(1.0)


def decode_pillow(content: bytes) -> np.ndarray | None:
    """File bytes to (h, w, 3) RGB, where Pillow is installed on the workers; None if broken."""
    try:
        from PIL import Image
    except ImportError as e:
        raise ImportError(
            "Pillow is needed to decode a content column; give decode=, or use read_images"
        ) from e
    try:
        return np.asarray(Image.open(io.BytesIO(content)).convert("RGB"))
    except OSError:  # what Pillow raises for files that are no image or cut short
        return None


def _to_bytes(values: np.ndarray) -> np.ndarray:
    """Rounded (halves up) and cut off to 0..255, in place but for the result."""
    values += np.float32(0.5)
    return np.clip(values, 0, 255, out=values).astype(np.uint8)
