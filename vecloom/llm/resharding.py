"""Resharding by minimum-cost flow.

From the bytes in each old shard and the capacities of the new ones, a minimum-cost flow gives the
bytes to send from each old shard to each new one such that the fewest move. Documents are grouped
into blocks (old shard, size class, checksum of the text); whole blocks are transferred until
the flow is met, the largest documents staying where they are, and single blocks then even out
what is left. Shards are stored as files (:func:`write_shards`). :func:`reshard` writes those that
blocks enter or leave anew, and the others are read where they are.

Texts are never shuffled: a row's place in its shard follows from the counts of the file splits
before its own and its place in its split, so each split is written by the task that reads it.

The driver sees the blocks' totals, at most ``old shards * 64 * BUCKETS`` of them, whatever the
size of the corpus: some hundred shards are its bound (``MAX_SHARDS``). A block that holds much more
than its part (a text with very many copies) is split by document, so copies stay together unless
they would fill a shard.

Defined results: a NULL text has no bytes and stays NULL. Rows without an id, or that repeat one,
are rows like any others. An empty table gives empty shards. Other input columns, of whatever names,
are not written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.common import saved, small

BUCKETS, PARTS = 256, 64
LARGE = 0.01  # of a new shard
MAX_SHARDS = 256


def min_cost_flow(
    supply: list[int], capacity: list[int], cost: list[list[int]]
) -> list[list[int]]:
    """Flows from old to new shards that send all supply at the least cost.

    Successive shortest paths in the residual network, by Bellman and Ford; a handful of nodes.
    """
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        distance = [0 if left[i] else None for i in range(n)] + [None] * m
        before: list[int | None] = [None] * (n + m)
        for _ in range(n + m):
            for i in range(n):
                for j in range(m):
                    out, back = distance[i], distance[n + j]
                    if out is not None and (back is None or out + cost[i][j] < back):
                        distance[n + j], before[n + j] = out + cost[i][j], i
                    back = distance[n + j]
                    if flow[i][j] and back is not None and (
                        distance[i] is None or back - cost[i][j] < distance[i]
                    ):
                        distance[i], before[i] = back - cost[i][j], n + j
        ends = [j for j in range(m) if room[j] and distance[n + j] is not None]
        if not ends:
            raise ValueError("the capacities are smaller than the supply")
        end = min(ends, key=lambda j: distance[n + j])
        path = [n + end]
        while before[path[-1]] is not None:
            path.append(before[path[-1]])
        path.reverse()
        amount = min(left[path[0]], room[end])
        for a, b in zip(path, path[1:], strict=False):
            if a >= n:
                amount = min(amount, flow[b][a - n])
        for a, b in zip(path, path[1:], strict=False):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end] -= amount
    return flow


@dataclass(frozen=True)
class Transfers:
    """``rows``: old, level, bucket, part (-1: whole block), shard."""

    rows: list[tuple[int, int, int, int, int]]
    affected: list[int]
    moved_bytes: int


def transfers(blocks: list[tuple], capacity: list[int], cost: list[list[int]]) -> Transfers:
    """Sends blocks ``(old, level, bucket, part, bytes, rows)`` to new shards."""
    m, n = len(capacity), len(cost)
    table = np.array(sorted(blocks, key=lambda b: (b[0], -b[1], *b[2:])), np.int64).reshape(-1, 6)
    sizes = table[:, 4]
    supply = [int(sizes[table[:, 0] == i].sum()) for i in range(n)]
    flow = min_cost_flow(supply, capacity, cost)
    shard = np.zeros(len(table), np.int64)
    for i in range(n):
        own = np.flatnonzero(table[:, 0] == i)
        order = sorted(range(m), key=lambda j: (cost[i][j], j))
        ends = np.cumsum([flow[i][j] for j in order])
        middle = np.cumsum(sizes[own]) - sizes[own] / 2
        shard[own] = np.array(order)[np.minimum(np.searchsorted(ends, middle), m - 1)]
    excess = np.bincount(shard, weights=sizes, minlength=m).astype(np.int64) - np.array(capacity)
    for _ in range(20 * m):  # even out what whole blocks could not meet
        a, b = int(excess.argmax()), int(excess.argmin())
        want = (excess[a] - excess[b]) / 2
        own = np.flatnonzero((shard == a) & (sizes < 2 * want))
        if a == b or not len(own):
            break
        best = own[np.abs(sizes[own] - want).argmin()]
        shard[best] = b
        excess[a] -= sizes[best]
        excess[b] += sizes[best]
    moved = shard != table[:, 0]
    affected = set(shard[moved].tolist()) | {int(x) for x in table[moved, 0] if x < m}
    rows = [(*map(int, table[k, :4]), int(shard[k])) for k in range(len(table))]
    return Transfers(rows, sorted(affected), int(sizes[moved].sum()))


def text_size(text: Column | str) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


SPLIT = ("file", "start")


def _splits(files: DataFrame) -> DataFrame:
    """Adds the file split a row is read from; its rows are read in order, by one task."""
    return files.withColumns(
        {
            "file": F.xxhash64("_metadata.file_path"),
            "start": F.col("_metadata.file_block_start"),
        }
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """Writes ``doc_id, text, shard`` (rows of files, with their split) as a folder for each shard,
    with ``slot``, gapless from 0 in each."""
    slim = saved(rows.groupBy(*SPLIT, "shard").agg(F.count("*").alias("n")), "split-counts")
    before = Window.partitionBy("shard").orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    firsts = saved(slim.select(*SPLIT, "shard", first), "split-firsts")
    if small(firsts):
        placed = rows.join(F.broadcast(firsts), [*SPLIT, "shard"])
    else:  # a shuffle of its own is never split, so a key's rows stay in one task
        placed = rows.repartition(*SPLIT, "shard").join(firsts, [*SPLIT, "shard"])
    columns = ["doc_id", "text", "slot", "shard"]
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            rows.schema["text"],
            T.StructField("slot", T.LongType()),
            T.StructField("shard", T.IntegerType()),
        ]
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            slot = batch.column(3).to_numpy().copy()
            for key in np.unique(keys, axis=0):
                own = np.flatnonzero((keys == key).all(axis=1))
                n = used.get(tuple(key), 0)
                slot[own] += n + np.arange(len(own))
                used[tuple(key)] = n + len(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(4), batch.column(5), pa.array(slot), pa.array(keys[:, 2], pa.int32())],
                names=columns,
            )

    ordered = placed.select(*SPLIT, "shard", "first", "doc_id", "text")
    ordered.mapInArrow(number, schema).write.partitionBy("shard").parquet(path)


def store(docs: DataFrame, shard: Column, path: str, id_col: str, text_col: str) -> None:
    """Writes a table as shards; one that isn't read from files is written once before."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), shard.alias("shard")
    )
    try:
        write_shards(_splits(rows), path)
    except AnalysisException:  # no files
        write_shards(_splits(saved(rows, "rows")), path)


def read_shards(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    return spark.read.schema(f"doc_id {id_type}, text string, slot bigint, shard int").parquet(path)


def _blocks(rows: DataFrame) -> DataFrame:
    """Adds ``size`` and the block: ``old, level, bucket`` and, in case it is split, ``own``."""
    body = F.coalesce("text", F.lit(""))
    return (
        rows.withColumnRenamed("shard", "old")
        .withColumn("size", text_size("text"))
        .withColumn("level", F.floor(F.log2("size")).cast("int"))
        .withColumn("bucket", F.pmod(F.xxhash64(body), F.lit(BUCKETS)).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("doc_id", body, F.lit(1)), F.lit(PARTS)).cast("int"))
    )


def plan(stored: DataFrame, old_shards: int, new_shards: int) -> Transfers:
    """The transfers from stored shards to ``new_shards`` of nearly equal bytes; a byte that stays
    in a shard of its number costs nothing, any other the same."""
    if max(old_shards, new_shards) > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards: reshard groups of them")
    slim = saved(_blocks(stored).select("old", "level", "bucket", "own", "size"), "sizes")
    block = ["old", "level", "bucket"]
    totals = (F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    whole = slim.groupBy(*block).agg(*totals).collect()  # a row per block
    total = sum(r["bytes"] for r in whole)
    large = {tuple(r[:3]) for r in whole if r["bytes"] > LARGE * total / new_shards}
    blocks = [(*r[:3], -1, r["bytes"], r["rows"]) for r in whole if tuple(r[:3]) not in large]
    if large:
        chosen = stored.sparkSession.createDataFrame(
            sorted(large), "old int, level int, bucket int"
        )
        parts = slim.join(F.broadcast(chosen), block).groupBy(*block, "own").agg(*totals)
        blocks += [tuple(r) for r in parts.collect()]
    capacity = [
        total * (j + 1) // new_shards - total * j // new_shards for j in range(new_shards)
    ]
    cost = [[int(i != j) for j in range(new_shards)] for i in range(old_shards)]
    return transfers(blocks, capacity, cost)


def reshard(
    spark: SparkSession,
    path: str,
    old_shards: int,
    new_shards: int,
    out: str,
    id_type: str = "bigint",
) -> Transfers:
    """Moves blocks between the shards stored in ``path``; affected shards are written to ``out``.

    :func:`resharded` then reads those and the others where they are.
    """
    stored = read_shards(spark, path, id_type)
    moves = plan(stored, old_shards, new_shards)
    if not moves.affected:
        return moves
    table = F.broadcast(  # a row per block, which the driver holds
        spark.createDataFrame(moves.rows, "old int, level int, bucket int, part int, to int")
    )
    block = ["old", "level", "bucket"]
    moved = _blocks(_splits(stored)).join(table, block)
    moved = moved.where((F.col("part") == -1) | (F.col("part") == F.col("own")))
    moved = moved.where(F.col("to").isin(moves.affected))
    write_shards(
        moved.select("doc_id", "text", F.col("to").alias("shard"), *SPLIT), out
    )
    return moves


def resharded(
    spark: SparkSession, path: str, out: str, moves: Transfers, id_type: str = "bigint"
) -> DataFrame:
    """``doc_id, text, slot, shard`` of all shards: the affected from ``out``, others from ``path``."""
    old = read_shards(spark, path, id_type)
    if not moves.affected:
        return old
    untouched = old.where(~F.col("shard").isin(moves.affected))
    return read_shards(spark, out, id_type).unionByName(untouched)
