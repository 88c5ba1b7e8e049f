"""Image files made by Spark from a table of vectors, for the queries that scan images.

The given tables hold no images. Each vector of 64 becomes one 8 x 8 colour bitmap in the folder
of its class: by the text sink, as a bitmap whose bytes are all below 128 is valid text, or, in a
folder that the nodes mount, by the tasks themselves. (There Hadoop's client starts a process for
each file, and one for its checksum, to set the modes: some 60 ms of a core for an image of 247
bytes.)
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = 8
FILES_PER_TASK = 5000

# The 24-bit bitmap header. The size of the file (247) is rounded up to 256, as its
# bytes must be below 128 too; the optional fields at the end are 0.
HEADER = (
    b"BM"
    + (256).to_bytes(4, "little")
    + bytes(4)
    + (54).to_bytes(4, "little")
    + (40).to_bytes(4, "little")
    + SIDE.to_bytes(4, "little") * 2
    + (1).to_bytes(2, "little")
    + (24).to_bytes(2, "little")
    + bytes(24)
)


def gray_level(value: Column) -> Column:
    """[-1, 1] to 0..126."""
    level = F.floor((value.cast("double") + 1.0) * 63.0).cast("int")
    return F.greatest(F.lit(0), F.least(F.lit(126), level))


def write_bitmaps(df: DataFrame, vector_col: str, class_col: str, path: str) -> None:
    """One file per row at ``path/Classe=<class>/``: red g, green g div 2, blue 127 - g.

    The first value is the bottom left pixel, as rows are stored from the bottom. Vectors of any
    length but ``SIDE`` squared are an error.
    """
    whole = F.when(F.size(vector_col) == SIDE * SIDE, F.col(vector_col)).otherwise(
        F.raise_error(F.lit(f"want vectors of {SIDE * SIDE}")).cast("array<float>")
    )

    def pixel(value: Column) -> Column:
        g = gray_level(value)
        return F.concat(F.char(127 - g), F.char(F.floor(g / 2).cast("int")), F.char(g))

    pixels = F.transform(whole, pixel)
    value = F.concat(F.lit(HEADER.decode("ascii")), F.array_join(pixels, ""))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, df.count() // FILES_PER_TASK)
    folders = _class_folders(df, class_col, path)
    if all(f.startswith("file:") for f in folders.inputFiles()):
        # numbered before the shuffle: a task that is run again writes the same files
        numbered = df.select(F.col(class_col).alias("class"), value.alias("value"))
        numbered = numbered.withColumn("number", F.monotonically_increasing_id())
        placed = numbered.join(folders, F.col("class").eqNullSafe(F.col("own")))
        files = placed.repartition(tasks).select("folder", "number", "value")
        files.mapInArrow(_write_files, "files bigint").agg(F.sum("files")).collect()
    else:
        (
            df.repartition(tasks)
            .select(F.col(class_col).alias("Classe"), value.alias("value"))
            .write.mode("append")
            .partitionBy("Classe")
            .option("maxRecordsPerFile", 1)
            .text(path)
        )


def _class_folders(df: DataFrame, class_col: str, path: str) -> DataFrame:
    """``own, folder``: each class and its folder below ``path``, which a list of classes, left out
    by scans of ``*.txt``, is written to."""
    own = F.col(class_col)
    listed = df.groupBy(own.alias("own")).agg(F.first(own).alias("Classe"))
    listed.write.partitionBy("Classe").parquet(path)
    read = df.sparkSession.read.schema(listed.select("own").schema).parquet(path)
    return read.select("own", F.col("_metadata.file_path").alias("folder"))


def _write_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A file for each row, beside the file that ``folder`` names; ends with a line end, as text."""
    for batch in batches:
        folders, numbers, values = (c.to_pylist() for c in batch.columns)
        for folder, number, value in zip(folders, numbers, values, strict=True):
            place = unquote(urlsplit(folder).path).rpartition("/")[0]
            with open(f"{place}/image-{number}.txt", "wb") as out:
                out.write(value.encode("ascii") + b"\n")
        yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})


def decode_bitmap(content: bytes) -> np.ndarray:
    """A 24-bit bitmap whose rows need no padding, as (h, w, 3) RGB."""
    start, width, height = (int.from_bytes(content[i : i + 4], "little") for i in (10, 18, 22))
    pixels = np.frombuffer(content, np.uint8, 3 * width * height, start)
    return pixels.reshape(height, width, 3)[::-1, :, ::-1]
