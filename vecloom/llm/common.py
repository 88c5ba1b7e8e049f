"""What several operators share: words, saved tables, components, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
BROADCAST_ROWS = 100_000


def words(text: Column | str) -> Column:
    """The words of a text: runs of anything but ASCII white space. NULL for a NULL text."""
    return F.array_remove(F.split(text, SPACE), "")


def lower_ascii(text: Column | str) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder all nodes share (see :func:`vecloom.session.scratch_path`)."""
    return scratch_path(spark, f"llm-{name}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def held_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings while the block runs; then they are as before."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def saved(frame: DataFrame, name: str, spare: list[str] | None = None) -> DataFrame:
    """The frame, written to the shared folder and read again: later jobs don't repeat its work,
    and a lost executor costs no more than its running tasks.

    The shuffle files of the write go as it ends, not only when the driver collects garbage.
    ``spare`` gets the path, for :func:`emptied` once nothing reads the table any more.
    """
    spark = frame.sparkSession
    path = scratch(spark, name)
    if spare is not None:
        spare.append(path)
    with held_conf(spark, {CLEANUP: "true"}):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def emptied(spark: SparkSession, spare: list[str]) -> None:
    """Writes no rows over the tables of these paths, and clears the list."""
    while spare:
        spark.range(0).write.mode("overwrite").parquet(spare.pop())


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``doc, row``: the rows in a struct of their columns, each with a number of its own.

    Written once, so that later jobs, and repeated tasks, see the same numbers.
    """
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    return saved(docs.select(doc, F.monotonically_increasing_id().alias("row")), name)


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame of short rows may be broadcast: it has ``rows`` rows at most."""
    return frame.limit(rows + 1).count() <= rows


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component``: the smallest node that each node of ``edges (a, b)`` reaches.

    Each round merges every node into its smallest neighbour's smallest neighbour, and goes on with
    the edges between what is left: a star takes one round, chains a logarithm of their length, and
    edges inside a merged part are not looked at again. NULL ends are left out.
    """
    edges = saved(edges.select("a", "b").where("a != b").distinct(), name)
    tops = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("a")).alias("up")
        )
        ends = low.select(F.col("node").alias("up"), F.col("up").alias("top"))
        top = saved(low.join(ends, "up").select("node", "top"), name)
        tops.append(top)
        edges = saved(
            edges.join(top.toDF("a", "top_a"), "a")
            .join(top.toDF("b", "top_b"), "b")
            .where("top_a != top_b")
            .select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
            .distinct(),
            name,
        )
    if not tops:
        return edges.toDF("node", "component")
    names = tops[0].toDF("node", "component")
    for top in tops[1:]:
        names = names.join(top.toDF("component", "top"), "component", "left").select(
            "node", F.coalesce("top", "component").alias("component")
        )
    return saved(names, name)
