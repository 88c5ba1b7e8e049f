"""Images decoded in the JVM: ``image: origin, height, width, nChannels, mode, data`` (BGR)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_images(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = None,
    recursive: bool = True,
    drop_invalid: bool = False,
) -> DataFrame:
    """One row per file; a file that cannot be decoded has height -1 unless it is dropped.

    The source decodes every image whatever fields are asked for, so take labels and counts
    from :func:`read_files`. ``image.origin`` is a URI: a space in a folder's name is ``%20`` in
    it, unlike in the ``path`` of :func:`read_files`.
    """
    reader = (
        spark.read.format("image")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("dropInvalid", str(drop_invalid).lower())
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths if isinstance(paths, str) else list(paths))


def split_invalid(df: DataFrame, image_col: str = "image") -> tuple[DataFrame, DataFrame]:
    """The decoded rows, and the rows whose file could not be decoded."""
    bad = F.col(f"{image_col}.height") < 0
    return df.where(~bad), df.where(bad)
