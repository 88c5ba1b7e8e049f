"""Column expressions; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F


def label_from_path(path: str | Column, level: int = -2) -> Column:
    """The name of the parent folder, or NULL where the path has no folder."""
    path = F.col(path) if isinstance(path, str) else path
    return F.try_element_at(F.split(path, "/"), F.lit(level))


def label_from_uri(uri: str | Column, level: int = -2) -> Column:
    """As :func:`label_from_path` where special characters are escaped, as in ``image.origin``.

    Escapes that can't be read are left as they are.
    """
    label = label_from_path(uri, level)
    plain = F.try_url_decode(F.replace(label, F.lit("+"), F.lit("%2B")))  # a plus is no blank here
    return F.coalesce(plain, label)


def dense_vector(values: str | Column) -> Column:
    """Numeric array to vector; NULL stays NULL."""
    values = F.col(values) if isinstance(values, str) else values
    return F.when(values.isNotNull(), array_to_vector(values))


def unit_hash(key: str | Column, seed: int | None = None) -> Column:
    """A number in [0, 1) that depends on the key only: md5's first 32 bits."""
    key = F.col(key) if isinstance(key, str) else key
    text = key.cast("string")
    if seed is not None:
        text = F.concat(F.lit(f"{seed}:"), text)
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return bits / F.lit(float(1 << 32))


def long_form(values: str | Column, position: str, value: str) -> Column:
    """Array to rows ``(position, value)``, positions from 0."""
    return F.posexplode(values).alias(position, value)
