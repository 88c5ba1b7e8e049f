"""Feature tables as parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_features(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """A saved table; vector columns come back as vectors."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return df.select(*columns) if columns else df


def write_features(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
) -> None:
    """Save ``df``, or only ``columns`` of it, in as many parts as it has partitions.

    Columns that are left out here are not computed either. ``mode="replace"`` with
    ``partition_by`` replaces the folders that ``df`` has rows for and leaves the others as they
    are, so one class can be written again. ``rebalance`` shuffles the rows into parts of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, whatever their number: by the columns of
    ``partition_by``, and folders that are too large for one part are split.
    """
    out = df.select(*columns) if columns else df
    if rebalance:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.partitionBy(*partition_by)
    if mode == "replace":
        if not partition_by:
            raise ValueError("mode replace needs partition_by")
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.mode(mode).parquet(path)
