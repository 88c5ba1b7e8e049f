"""Phrase collocations: word sequences that stand together more often than their parts would.

Texts are split into pieces at punctuation and line ends, and pieces into words. Every n-gram of a
piece gets a Rabin-Karp fingerprint: prefix sums of a polynomial in the words' hashes give that of
any stretch with one subtraction and one product (numpy, modulo 2^64). Tasks add up equal
fingerprints before the shuffle.

* One scan for each length: an n-gram can be frequent only if the two n-grams one word shorter
  inside it are, so only places that pass a bit map of the frequent shorter ones are counted. The
  map has ``MAP_BITS`` bits whatever the corpus; a place that passes by chance costs a row in the
  shuffle and nothing else.
* A last scan verifies collisions against the text: of each frequent fingerprint's occurrences the
  first in a batch is the pointer, all others are compared with it word for word (by exact word
  codes), and those that differ are counted apart. Only these phrases become text, and counts are
  added up by the text itself together with a pointer to an occurrence, so they are exact.

Scores use decimals of 38 digits. Parts are joined to their counts by text; parts that stand in
over 1 / ``HOT`` of all cuts are fewer than ``HOT`` and are broadcast, the others are shuffled. The
best of a language are found in two steps, over ``SALTS`` parts of it first.

Defined results: NULL texts count as empty, a NULL language as ``und``. Rows are independent:
repeated rows and ids count as often as they occur, ids may be NULL. Texts are read whole, in slices
of about ``SLICE_BYTES`` (a longer text alone, at some 100 bytes for each word). An empty table
gives no rows. Other input columns, of whatever names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.common import held_conf, saved
from vecloom.llm.tokens import slices

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
COUNT_BITS = 40  # of a fingerprint that are counted; the last scan tells clashes apart
MAP_BITS = 26  # the first of them
MAP_BUCKET = 15  # bits of a place in one row of the map
SLICE_BYTES = 1 << 20
#: Rows and bytes that Spark hands to Python at once; its own 10,000 rows are some 32 MB of texts, and
#: the JVM and both ends of the pipe hold them twice and more.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
HELD = 1 << 20  # fingerprints or phrases that a task holds back before it emits them
HOT, SALTS = 1000, 64
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

WORD, BLANK, BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits of each number spread over all bits of the result; one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``values[i] * BASE**i``, and the powers of the inverse, modulo 2^64."""
    powers = np.full(len(values) + 1, BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    down = np.full(len(values) + 1, INVERSE)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[:-1], out=sums[1:])
    return sums, down


class Batch:
    """Texts cut into words: exact codes, and fingerprints of the n-grams inside pieces."""

    def __init__(self, texts: pa.Array, langs: pa.Array, print_bits: int = 64):
        self.cut = np.uint64(64 - print_bits)
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, content = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = _LOWER[np.frombuffer(content or b"", np.uint8)[bounds[0] : bounds[-1]]]
        bounds = bounds - bounds[0]
        kind = _KIND[data]
        inside = kind == WORD
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = bounds[:-1][bounds[1:] > bounds[:-1]]
        begins[edges] = inside[edges]
        starts = np.flatnonzero(begins)
        self.first = np.searchsorted(starts, bounds)
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.first))
        # running counts as narrow as the bytes allow: they are a number for each byte
        narrow = np.int32 if len(data) < 1 << 31 else np.int64
        breaks = np.cumsum(kind == BREAK, dtype=narrow)[starts]
        del kind, begins
        letters = data[inside]
        del data
        ends = np.cumsum(inside, dtype=narrow)[starts].astype(np.int64) - 1
        del inside
        ends = np.append(ends, len(letters))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]
        ).dictionary_encode()
        self.codes, self.words = words.indices.to_numpy(), words.dictionary
        # whether a word and the next one are in one piece
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = (breaks[1:] == breaks[:-1]) & (self.owner[1:] == self.owner[:-1])
        langs = langs.dictionary_encode()
        self.lang, self.langs = langs.indices.to_numpy(), langs.dictionary
        self.sums, self.down = prefix_sums(self._word_hashes()[self.codes])
        self.seed = mixed(self._hashes(self.langs.cast(pa.large_binary())))[self.lang][self.owner]

    @staticmethod
    def _hashes(values: pa.Array) -> np.ndarray:
        """A fingerprint of the bytes of each value."""
        _, offsets, content = values.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(values) + 1]
        data = np.frombuffer(content or b"", np.uint8)[: ends[-1]].astype(np.uint64)
        sums, down = prefix_sums(data + np.uint64(1))
        return mixed((sums[ends[1:]] - sums[ends[:-1]]) * down[ends[:-1]])

    def _word_hashes(self) -> np.ndarray:
        return self._hashes(self.words) if len(self.words) else np.zeros(0, np.uint64)

    def grams(self, n: int, among: np.ndarray | None = None) -> np.ndarray:
        """Places where an n-gram starts, of all or ``among`` places."""
        at = np.arange(len(self.codes)) if among is None else among
        at = at[at + n <= len(self.codes)]
        for k in range(n - 1):
            at = at[self.joined[at + k]]
        return at

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the n-grams at the places, language included."""
        whole = mixed((self.sums[at + n] - self.sums[at]) * self.down[at] ^ self.seed[at])
        return whole >> self.cut << self.cut

    def phrase(self, at: np.ndarray, n: int) -> pa.Array:
        """The words there, joined by one blank."""
        parts = [self.words.take(pa.array(self.codes[at + k])).cast(pa.large_string()) for k in range(n)]
        blank = pa.scalar(" ", pa.large_string())
        return pc.binary_join_element_wise(*parts, blank) if n > 1 else parts[0]


def passes(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether each fingerprint is in the map."""
    slot = prints >> np.uint64(64 - MAP_BITS)
    return bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 > 0


def _frequent_map(counted: DataFrame) -> np.ndarray:
    """The bit map of the fingerprints ``print``: ``2**MAP_BITS`` bits, however many there are."""
    slot = F.shiftright("print", COUNT_BITS - MAP_BITS)
    rows = (
        counted.select(
            F.shiftright(slot, MAP_BUCKET).alias("bucket"),
            slot.bitwiseAND(F.lit((1 << MAP_BUCKET) - 1)).alias("bit"),
        )
        .groupBy("bucket")
        .agg(F.call_function("bitmap_construct_agg", F.col("bit")).alias("bits"))
        .collect()  # 2^(MAP_BITS - MAP_BUCKET) rows of 4 KB at most
    )
    size = 1 << MAP_BUCKET >> 3
    bits = np.zeros(1 << MAP_BITS >> 3, np.uint8)
    for bucket, part in rows:
        bits[bucket * size : bucket * size + len(part)] = np.frombuffer(part, np.uint8)
    return bits


def _batches(batches: Iterator[pa.RecordBatch], text: int, lang: int, print_bits: int):
    for batch in batches:
        for part in slices(batch, text, SLICE_BYTES):
            yield part, Batch(part.column(text), part.column(lang), print_bits)
            pa.default_memory_pool().release_unused()  # what Arrow keeps counts as the task's


def added_up(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different fingerprints, in order, and the sum of each one's counts; empties ``held``."""
    prints, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    order = np.argsort(prints)
    prints, counts = prints[order], counts[order]
    del order
    first = np.flatnonzero(np.append(len(prints) > 0, prints[1:] != prints[:-1])[: len(prints)])
    return prints[first], np.add.reduceat(counts, first) if len(first) else counts


def _counted_prints(
    rows: DataFrame, n: int, shorter, min_count: int, print_bits: int
) -> DataFrame:
    """``print, n``: the first bits of the n-grams' fingerprints that occur often enough; ``shorter`` is the
    broadcast map of those of ``n - 1`` words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(prints: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(prints), 1 << 17):
                part = slice(a, a + (1 << 17))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[part].astype(np.int64)), pa.array(counts[part])],
                    names=["print", "n"],
                )

        for _, batch in _batches(batches, 0, 1, print_bits):
            at = batch.grams(n)
            if shorter is not None:
                for k in range(2):
                    at = at[passes(shorter.value, batch.prints(at + k, n - 1))]
            short = batch.prints(at, n) >> np.uint64(64 - COUNT_BITS)
            held.append(np.unique(short, return_counts=True))
            if sum(len(x) for x, _ in held) > HELD:
                held = [added_up(held)]
                if len(held[0][0]) > HELD // 2:
                    yield from out(*held.pop())
        if held:
            yield from out(*added_up(held))

    counts = rows.select("text", "lang").mapInArrow(count, "print bigint, n bigint")
    return counts.groupBy("print").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _phrase_counts(
    rows: DataFrame, maps: list, id_type: T.DataType, print_bits: int
) -> DataFrame:
    """``lang, words, phrase, n, at`` of all phrases whose fingerprints are in the maps.

    ``words`` is the phrase's number of words, 0 in the row that counts a language's words;
    ``at`` points to an occurrence: a document's id and the word's number there.
    """
    schema = T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("words", T.IntegerType()),
            T.StructField("phrase", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("doc_id", id_type),
            T.StructField("place", T.LongType()),
        ]
    )

    def table(batch: Batch, ids: pa.Array, at: np.ndarray, n: int, counts: np.ndarray) -> pa.Table:
        owner = batch.owner[at]
        return pa.table(
            {
                "lang": batch.langs.take(pa.array(batch.lang[owner])).cast(pa.string()),
                "words": pa.array(np.full(len(at), n, np.int32)),
                "phrase": batch.phrase(at, n).cast(pa.string()),
                "n": pa.array(counts.astype(np.int64)),
                "doc_id": ids.take(pa.array(owner)),
                "place": pa.array((at - batch.first[owner]).astype(np.int64)),
            }
        )

    def totals(batch: Batch, ids: pa.Array) -> pa.Table:
        counts = np.bincount(batch.lang[batch.owner], minlength=len(batch.langs))
        return pa.table(
            {
                "lang": batch.langs.cast(pa.string()),
                "words": pa.array(np.zeros(len(counts), np.int32)),
                "phrase": pa.array([""] * len(counts)),
                "n": pa.array(counts.astype(np.int64)),
                "doc_id": pa.nulls(len(counts), ids.type),
                "place": pa.nulls(len(counts), pa.int64()),
            }
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            whole = pa.concat_tables(held)
            held.clear()
            added = whole.group_by(["lang", "words", "phrase"], use_threads=False).aggregate(
                [("n", "sum"), ("doc_id", "first"), ("place", "first")]
            )
            return added.rename_columns(
                {"n_sum": "n", "doc_id_first": "doc_id", "place_first": "place"}
            ).select(schema.names)

        for part, batch in _batches(batches, 1, 2, print_bits):
            held.append(totals(batch, part.column(0)))
            at = batch.grams(1)
            for n, bits in enumerate(maps, 1):
                at = batch.grams(n, at)
                prints = batch.prints(at, n)
                on = passes(bits.value, prints)
                at, prints, left = at[on], prints[on], at[on]
                while len(left):
                    _, pointer, which = np.unique(prints, return_index=True, return_inverse=True)
                    same = np.ones(len(left), bool)
                    for k in range(n):
                        codes = batch.codes[left + k]
                        same &= codes == codes[pointer][which]
                    same &= batch.lang[batch.owner[left]] == batch.lang[batch.owner[left]][pointer][which]
                    held.append(
                        table(batch, part.column(0), left[pointer], n, np.bincount(which[same]))
                    )
                    left, prints = left[~same], prints[~same]  # another phrase's
            if sum(x.num_rows for x in held) > HELD // 4:
                held = [merged()]
                if held[0].num_rows > HELD // 8:
                    yield from held.pop().to_batches(1 << 16)
        if held:
            yield from merged().to_batches(1 << 16)

    # two tasks to a core: a phrase costs a row in each of them
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    counts = rows.select("doc_id", "text", "lang").coalesce(tasks).mapInArrow(count, schema)
    return counts.groupBy("lang", "words", "phrase").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "place")).alias("at")
    )


def phrase_counts(
    docs: DataFrame,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    print_bits: int = 64,
) -> DataFrame:
    """``lang, words, phrase, n, at``: exact counts of all phrases of up to ``longest`` words that
    occur ``min_count`` times in a language, and its words in all (``words`` = 0).

    Fingerprints of fewer ``print_bits`` clash more often and give the same result.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
    )
    context = docs.sparkSession.sparkContext
    maps = []
    try:
        with held_conf(docs.sparkSession, ARROW):
            for n in range(1, longest + 1):
                frequent = _counted_prints(rows, n, maps[-1] if maps else None, min_count, print_bits)
                maps.append(context.broadcast(_frequent_map(frequent)))
            counted = _phrase_counts(rows, maps, rows.schema["doc_id"].dataType, print_bits)
            return saved(
                counted.where((F.col("n") >= min_count) | (F.col("words") == 0)), "phrases"
            )
    finally:  # else Python workers keep the maps of earlier calls until the driver collects garbage
        for bits in maps:
            bits.destroy()


def _with_count(cuts: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """Adds the count of the phrase in column ``part``; hot phrases are joined by broadcast."""
    parts = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    used = cuts.groupBy("lang", part).agg(F.count("*").alias("uses"))
    most = F.lit(cuts.count() / HOT)
    hot = saved(parts.join(used.where(F.col("uses") > most), ["lang", part]).drop("uses"), "hot")
    met = cuts.join(F.broadcast(hot), ["lang", part], "left")
    cold = met.where(F.col(name).isNull()).drop(name)
    return met.where(F.col(name).isNotNull()).unionByName(cold.join(parts, ["lang", part]))


def _words(phrase: Column, a: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), a, n), " ")


def scored(counts: DataFrame, absorb_percent: int = 100) -> DataFrame:
    """``lang, phrase, a, l, r, n, score, at`` of the phrases that stay, from their counts.

    ``score`` is ``floor(1000 * a * n / (l * r))`` of the cut for which it is least, ``l`` and
    ``r`` the counts of the parts. A phrase goes if a longer one holds it and has at least
    ``absorb_percent`` of its count; then one that is a word longer does too, as it counts at
    least as much.
    """
    phrases = counts.where("words >= 2")
    inner = phrases.where("words >= 3").select(
        "lang",
        F.col("n").alias("n_longer"),
        F.explode(
            F.array(
                _words(F.col("phrase"), 1, F.col("words") - 1),
                _words(F.col("phrase"), 2, F.col("words") - 1),
            )
        ).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("n_longer").alias("n_longer"))
    stay = phrases.join(inner, ["lang", "phrase"], "left").where(
        F.col("n_longer").isNull()
        | (F.lit(100).cast("decimal(20,0)") * F.col("n_longer") < absorb_percent * F.col("n").cast("decimal(20,0)"))
    )
    cuts = saved(
        stay.select(
            "lang", "phrase", "at", F.col("n").alias("a"), "words",
            F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
        ).select(
            "lang", "phrase", "at", "a", "k",
            _words(F.col("phrase"), 1, F.col("k")).alias("left"),
            _words(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
        ),
        "cuts",
    )
    cuts = _with_count(_with_count(cuts, counts, "left", "l"), counts, "right", "r")
    totals = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    cuts = cuts.join(totals, "lang")
    score = F.expr(
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(total as decimal(18,0)))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    best = F.min(F.struct(score.alias("score"), "k", "l", "r", "total", "a", "at")).alias("best")
    return cuts.groupBy("lang", "phrase").agg(best).select(
        "lang", "phrase", "best.a", "best.l", "best.r", F.col("best.total").alias("n"),
        "best.score", "best.at",
    )


def best_phrases(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language, with ``rank`` from 1: by score, then count, both
    descending, then the phrase's bytes."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    inner = Window.partitionBy("lang", "salt").orderBy(*order)
    few = (
        phrases.withColumn("salt", salt)
        .withColumn("rank", F.row_number().over(inner))
        .where(F.col("rank") <= top)
        .drop("salt", "rank")
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return few.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    absorb_percent: int = 100,
    **options,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, at``: each language's best phrases."""
    counts = phrase_counts(docs, longest, min_count, **options)
    return best_phrases(saved(scored(counts, absorb_percent), "scored"), top)
