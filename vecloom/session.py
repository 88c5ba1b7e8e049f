"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def scan_settings(
    mean_file_bytes: int,
    files_per_task: int = 10_000,
    arrow_rows: int = 1024,
    arrow_bytes: int = 64 << 20,
) -> dict[str, str]:
    """Settings for a scan of many small files, to be given to the session builder.

    Spark counts ``openCostInBytes`` (4 MiB unless set) for each file on top of its length, so
    at the default a task gets about 30 small images however large the folder is. Here the cost
    of opening equals the mean length and the partition size follows from the wanted number of
    files, so the scan itself yields tasks of the right size and no shuffle of image bytes is
    needed to spread them. (A folder too small for one such task per core is still spread over
    all cores.) 10,000 images with 2,048 features make a parquet part of 80 MB.
    """
    return {
        "spark.sql.files.openCostInBytes": str(mean_file_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * mean_file_bytes * files_per_task),
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(arrow_rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(arrow_bytes),
        "spark.sql.adaptive.enabled": "true",
    }


def small_frame(spark: SparkSession, **columns: Any) -> DataFrame:
    """A frame from columns the driver holds: arrays, as numpy types them, or lists."""
    return spark.createDataFrame(pa.table(columns))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, the folder all nodes share.

    Where that is unset it is the warehouse, if nodes share that too: in local mode, or where its
    path names a store other than local files. Else it is an error, since executors would write
    to disks of their own. Nothing is removed: the folder belongs to the caller.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir")
        store = base.partition(":")[0] if ":" in base else "file"
        local = spark.sparkContext.master.partition("[")[0] == "local"
        if store == "file" and not local:
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
