"""Packing of documents into sequences of fixed length, as few as it can.

Documents become token ids (Arrow batches), long ones are cut into pieces. What a packing needs
is only how many pieces there are of each length: at most ``capacity`` counts, whatever the size
of the corpus. On these counts the driver runs the reduction by dominance (sets of up to three
pieces that no better packing can avoid are fixed for good, all copies at once) and best fit, in
decreasing order, for the rest. The plan is a list of patterns with their multiplicities; every
piece finds its place by its rank among the pieces of its length, so Spark places them all in
parallel and no token passes through the driver.

Defined results: a NULL or empty text is one piece, its end id. Rows with a NULL or repeated
``doc_id`` are packed like any others. An empty table gives no pieces. Other input columns, of
whatever names, are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.common import saved
from vecloom.llm.tokens import Encoder, slices

CAPACITY = 2048
BUCKETS = 64


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids``: ids are little-endian unsigned 32-bit integers.

    Only documents longer than ``capacity`` are cut; of their pieces the first may be shorter.
    ``tokenizer`` is a path that holds on every node.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, end_id)
        for batch in batches:
            for rows in slices(batch, 1):
                ids, counts = encoder.ids(rows.column(1))
                pieces = -(-counts // capacity)
                owner = np.repeat(np.arange(len(counts)), pieces)
                first = np.cumsum(pieces) - pieces
                number = np.arange(len(owner)) - first[owner]
                head = counts - (pieces - 1) * capacity
                length = np.where(number == 0, head[owner], capacity)
                start = np.where(number == 0, 0, head[owner] + (number - 1) * capacity)
                ends = np.append(0, np.cumsum(length)) * 4
                content = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(owner),
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(owner)),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        content.cast(pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return rows.mapInArrow(cut, schema)


class Stock:
    """Counts of pieces by length, with the lengths that are left in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def __getitem__(self, length: int) -> int:
        return self.counts.get(length, 0)

    def take(self, items: tuple[int, ...], times: int) -> None:
        for length in items:
            self.counts[length] -= times
            if not self.counts[length]:
                del self.counts[length]
                self.lengths.remove(length)

    def times(self, items: tuple[int, ...]) -> int:
        """How often the set can be taken at once."""
        return min(self[k] // items.count(k) for k in items)

    def largest(self, most: int, without: tuple[int, ...] = ()) -> int | None:
        """The largest length up to ``most`` that is left beside the set ``without``."""
        at = bisect_left(self.lengths, most + 1) - 1
        while at >= 0:
            length = self.lengths[at]
            if self[length] > without.count(length):
                return length
            at -= 1
        return None

    def smallest(self, n: int, without: tuple[int, ...] = ()) -> list[int]:
        found: list[int] = []
        for length in self.lengths:
            found += [length] * min(n - len(found), self[length] - without.count(length))
            if len(found) == n:
                break
        return found


def dominating_set(stock: Stock, length: int, capacity: int) -> tuple[int, ...] | None:
    """A set with a piece of ``length`` that dominates all feasible sets with it, if one is known.

    One set dominates another if its pieces can stand in for the other's: then some best packing
    holds it, and it can be fixed.
    """
    own, room = (length,), capacity - length
    partner = stock.largest(room, own)
    if partner is None:
        return own
    low = stock.smallest(3, own)
    if partner == room or len(low) < 2 or low[0] + low[1] > room:
        return (length, partner)  # it fills the rest, or no second partner fits beside any
    if len(low) == 3 and sum(low) <= room:
        return None  # sets of four pieces: not decided here
    pair_sum, best_low = 0, 0  # over the feasible pairs: largest sum, largest smaller piece
    for a in stock.lengths:
        if stock[a] <= own.count(a) or a + a > room:
            if a + a > room:
                break
            continue
        b = stock.largest(room - a, (*own, a))
        if b is not None and b >= a:
            pair_sum, best_low = max(pair_sum, a + b), a
    if pair_sum <= partner:
        return (length, partner)
    second = stock.largest(room - partner, (length, partner))
    if second is not None and second >= best_low:
        return (length, partner, second)
    return None


def reduce_stock(stock: Stock, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Takes dominating sets out of the stock, largest pieces first."""
    fixed = []
    for length in reversed(list(stock.lengths)):
        while stock[length]:
            chosen = dominating_set(stock, length, capacity)
            if chosen is None:
                break
            times = stock.times(chosen)
            stock.take(chosen, times)
            fixed.append((chosen, times))
    return fixed


def best_fit(stock: Stock, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest pieces first; equal pieces and bins with equal contents go together."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], free: int, times: int) -> None:
        if times:
            if free not in room:
                insort(rooms, free)
            room.setdefault(free, []).append((pattern, times))

    for length in reversed(stock.lengths):
        left = stock[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                free, pattern, bins = capacity, (), left
            else:
                free = rooms[at]
                pattern, bins = room[free].pop()
                if not room[free]:
                    del room[free]
                    rooms.pop(at)
            each = free // length  # a bin stays the best fit until it is full
            full = min(bins, left // each)
            put(pattern + (length,) * each, free - each * length, full)
            left -= full * each
            if full < bins:
                if left and left < each:
                    put(pattern + (length,) * left, free - left * length, 1)
                    full, left = full + 1, 0
                if pattern:
                    put(pattern, free, bins - full)
    return [x for group in room.values() for x in group]


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sets of lengths and how many sequences hold each."""
    stock = Stock(counts)
    return reduce_stock(stock, capacity) + best_fit(stock, capacity)


@dataclass(frozen=True)
class Plan:
    """Runs of equal pieces: those of ``length`` with ranks from ``rank`` on go to the sequences
    from ``sequence`` on, at ``offset``. Sorted by length and rank."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int

    @staticmethod
    def of(patterns: list[tuple[tuple[int, ...], int]]) -> Plan:
        runs, used, base = [], {}, 0
        for pattern, times in patterns:
            offset = 0
            for length in pattern:
                runs.append((length, used.get(length, 0), base, offset))
                used[length] = used.get(length, 0) + times
                offset += length
            base += times
        table = np.array(sorted(runs), np.int64).reshape(-1, 4)
        return Plan(*(table[:, k].copy() for k in range(4)), base)


def plan_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> Plan:
    """The plan for all pieces, from at most ``capacity`` counts."""
    counts = pieces.groupBy("length").count().collect()  # a row per length
    return Plan.of(plan_patterns({r["length"]: r["count"] for r in counts}, capacity))


def place_pieces(pieces: DataFrame, plan: Plan, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``sequence_id, offset`` to the pieces (``doc_id, piece, length`` and any others).

    The rank among equally long pieces is found in two steps, so that a length that many pieces
    have is dealt over ``buckets``. Leave the ids out of the frame: its rows are shuffled.
    """
    order = ["doc_id", "piece", *(c for c in pieces.columns if c not in ("doc_id", "piece"))]
    dealt = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    )
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        dealt.groupBy("length", "bucket")
        .agg(F.count("*").alias("n"))
        .select(
            "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
        )
    )
    within = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = (
        dealt.withColumn("nth", F.row_number().over(within) - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("nth"))
    ).select(*pieces.columns, "rank")
    schema = T.StructType(
        [
            *ranked.drop("rank").schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    at = ranked.columns.index("length")
    keys = plan.length << 48 | plan.rank  # ranks stay below 2^48

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy()
            run = np.searchsorted(keys, batch.column(at).to_numpy() << 48 | rank, "right") - 1
            columns = [
                *batch.columns[:-1],
                pa.array(plan.sequence[run] + rank - plan.rank[run]),
                pa.array(plan.offset[run]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.mapInArrow(place, schema)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, **names: str
) -> tuple[DataFrame, Plan]:
    """The pieces, written with their ids, and the plan that :func:`place_pieces` takes."""
    pieces = saved(cut_documents(docs, tokenizer, end_id, capacity, **names), "pieces")
    return pieces, plan_pieces(pieces, capacity)


def sequences(pieces: DataFrame, plan: Plan) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (little-endian 32-bit)."""
    placed = place_pieces(pieces.select("doc_id", "piece", "start", "length", "ids"), plan)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
