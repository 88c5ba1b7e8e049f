"""Image files for tests."""

from __future__ import annotations

import struct
import zlib
from pathlib import Path

import numpy as np


def write_png(path: Path, pixels: np.ndarray) -> None:
    """(h, w, c) bytes; grey, RGB or RGBA by the number of channels."""
    h, w, c = pixels.shape
    color = {1: 0, 3: 2, 4: 6}[c]
    lines = b"".join(b"\0" + row.tobytes() for row in pixels)

    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(lines))
        + chunk(b"IEND", b"")
    )


def write_jpg(spark, path: Path, rgb: tuple[int, int, int], side: int = 8) -> None:
    """One colour, written by the JVM."""
    path.parent.mkdir(parents=True, exist_ok=True)
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(side, side, 1)
    value = (rgb[0] << 16) | (rgb[1] << 8) | rgb[2]
    for x in range(side):
        for y in range(side):
            image.setRGB(x, y, value)
    jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(path)))


def photo_folder(spark, root: Path) -> None:
    """Nine files: six .jpg, one .JPG, one .png and one .jpg that is no image."""
    for i in range(3):
        write_jpg(spark, root / "Apple-Red" / f"{i}_100.jpg", (200, 30, 40 + i))
        write_jpg(spark, root / "Kiwi" / f"{i}_100.jpg", (90, 140, 20 + i))
    write_jpg(spark, root / "Kiwi" / "9_100.JPG", (90, 140, 20))
    write_png(root / "Kiwi" / "x.png", np.full((8, 8, 3), 7, np.uint8))
    (root / "Kiwi" / "bad.jpg").write_bytes(b"no image")
