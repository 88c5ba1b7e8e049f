"""Token ids in ORC files, in order of the documents.

ORC stores integers run-length encoded in stripes, with row indexes and, on the document id, Bloom
filters: readers take stripes in parallel and skip those that cannot hold a wanted id.

Documents are dealt out by ranges of their id before they are encoded, so each task encodes and
writes one run of ids in order. Each row carries its file's number and its place there; a
document's position in the whole corpus follows from the files' totals.

Defined results: a NULL or empty text has only its end id. NULL ids come first; rows that share an
id stand in order of their texts' checksum and text. An empty table gives no rows. Other input
columns, of whatever names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.common import small
from vecloom.llm.tokens import Encoder, slices

STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1000
BLOOM_FPP = 0.01


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: int | None = None,
) -> None:
    """Writes ``file, place, doc_id, ids`` to ``path``, in ascending order of ids.

    ``files`` is as many as the input has partitions unless given.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    files = files or max(1, rows.rdd.getNumPartitions())
    check = F.crc32(F.coalesce("text", F.lit("")))
    rows = (
        rows.withColumn("check", check)
        .repartitionByRange(files, "doc_id", "check")
        .sortWithinPartitions("doc_id", "check", "text")
        .select(F.spark_partition_id().alias("file"), "doc_id", "text")
    )
    schema = T.StructType(
        [
            T.StructField("file", T.IntegerType()),
            T.StructField("place", T.LongType()),
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = Encoder(tokenizer, end_id), 0
        for batch in batches:
            for part in slices(batch, 2):
                ids, counts = encoder.ids(part.column(2))
                ends = np.append(0, np.cumsum(counts)).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(ids.view(np.int32)),
                    type=pa.list_(pa.field("element", pa.int32(), False)),
                )
                places = pa.array(np.arange(place, place + len(counts)), pa.int64())
                place += len(counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), places, part.column(1), lists],
                    names=["file", "place", "doc_id", "ids"],
                )

    (
        rows.mapInArrow(encode, schema)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(BLOOM_FPP))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """``file, place, doc_id, ids``; with ``doc_ids`` only the stripes that may hold them."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


@F.arrow_udf(T.LongType())
def ids_crc32(ids: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers; NULL for NULL."""
    data = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(), "<i4")).cast("B")
    ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy()) * 4
    sums = [zlib.crc32(data[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=False)]
    return pa.array(sums, pa.int64(), mask=ids.is_null().to_numpy(zero_copy_only=False))


def positions(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before, to ``file, place, n_tokens``.

    One total per file is added up in one task; inside a file the sum runs in its order.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    firsts = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = (
        Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.withColumn("local", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    firsts = F.broadcast(firsts) if small(firsts) else firsts
    return (
        local.join(firsts, "file")
        .withColumn("start", F.col("first") + F.col("local"))
        .drop("first", "local")
    )
