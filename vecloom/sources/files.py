"""Raw files as rows: ``path, modificationTime, length, content``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = "*.jpg",
    recursive: bool = True,
) -> DataFrame:
    """One row per file below ``paths``, whose base name matches ``glob`` (case matters).

    Give the root folder rather than ``root/*/*``: a path pattern is expanded on the driver
    into one listed path per file, a root is listed by a Spark job. Queries that leave out
    ``content`` never open the files, and filters on ``length`` and ``modificationTime`` reach
    the scan, which serves incremental loads.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths if isinstance(paths, str) else list(paths))


#: Fixed: the columns of Spark's source of raw files, which a stream does not infer.
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, root: str, glob: str | None = "*.jpg") -> DataFrame:
    """The files below ``root`` as a stream, whose checkpoint remembers those it has seen."""
    reader = spark.readStream.format("binaryFile").schema(FILE_COLUMNS)
    reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root)
