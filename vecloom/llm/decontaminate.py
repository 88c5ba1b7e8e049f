"""Benchmark decontamination by containment search.

Documents are searched for benchmark items: word shingles, MinHash with one permutation (the least
hash in each of 2^p bins), the documents' windows partitioned by size and the items by size. The
smaller an item and the larger a window, the more bins a window gets, so that in each pair of
partitions an item that is contained in a window meets one of its minima almost surely (see
``bins``). Long documents are cut into overlapping windows, so size partitions stay narrow. Each
pair found is then confirmed: at least ``share`` of the item's distinct shingles are in the whole
document.

Native: DataFrame functions only.

Items of fewer than five words are one shingle of their own length, looked up whole among the
documents' runs of that many words.

Defined results: items without words (NULL and empty texts) match nothing. Repeated rows are each judged, as are rows without an id. Repeated items with one id
count once per different text. An empty benchmark or table gives no pairs. The result has the
documents' id, not their other columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import saved, small

WORDS = 5
SHARE = (80, 100)
WINDOW = 1024
#: Upper bounds of the window sizes and lower bounds of the item sizes that are treated alike.
WINDOW_SIZES = (64, 256, WINDOW)
ITEM_SIZES = (1, 12, 32)
MISS = 1e-6


def bins(window: int, item: int, share: float) -> int:
    """Bits p of the number of bins for windows of at most ``window`` shingles and items of
    ``item`` or more.

    With f = window / 2^p shingles to a bin, one of the item's shingles is its bin's minimum with
    probability (1 - exp(-f)) / f; all share * item that are there fail together rarely enough.
    Items of so few shingles that this can't be had get the finest division: every shingle has a
    bin of its own.
    """
    there = math.ceil(share * item)
    for p in range(4, math.ceil(math.log2(window)) + 9):
        f = window / 2**p
        if (1 - (1 - math.exp(-f)) / f) ** there < MISS:
            return p
    return 64


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words, in place order: letters and digits in lower case."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _runs(hashes: str, n: int = WORDS) -> Column:
    run = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - n),
        lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(n))),
    )
    return F.when(F.size(hashes) >= n, run)


def with_shingles(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, NULL for texts of fewer than five words."""
    return rows.withColumn("_words", shingles(F.col(text))).withColumn(out, _runs("_words")).drop(
        "_words"
    )


def _slices(n: Column) -> Column:
    """Hashes of all runs of ``n`` hashes."""
    at = F.sequence(F.lit(1), F.size("hashes") - n + 1)
    return F.transform(at, lambda i: F.xxhash64(F.slice("hashes", i, n)))


def short_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``t, item``: the texts (``t, hashes``) that hold an item (``item, hashes``) of fewer than
    five words."""
    lengths = [r[0] for r in items.select(F.size("hashes")).distinct().collect()]  # four at most
    keys = items.select(
        "item",
        F.size("hashes").alias("n"),
        F.xxhash64("hashes").alias("key"),
    )
    keys = F.broadcast(keys) if small(keys) else keys
    found = docs.select("t", F.lit(None).cast("bigint").alias("item")).where("false")
    for n in sorted(lengths):
        run = _slices(F.lit(n))
        each = docs.where(F.size("hashes") >= n).select(
            "t", F.explode(F.array_distinct(run)).alias("key")
        )
        found = found.union(each.join(keys.where(F.col("n") == n), "key").select("t", "item"))
    return found.distinct()


def bits_of(size: Column, item_class: Column, classes: list[int], share: float) -> Column:
    """``bins`` for a window of ``size`` shingles and an item of the class."""
    p = F.lit(64)
    for c in classes:
        of_class = F.lit(bins(WINDOW_SIZES[-1], c, share))
        for bound in reversed(WINDOW_SIZES[:-1]):
            of_class = F.when(size <= bound, bins(bound, c, share)).otherwise(of_class)
        p = F.when(item_class == c, of_class).otherwise(p)
    return p


def is_minimum(apart: Column, bits: Column) -> Column:
    """Whether a hash is the least of its bin: ``apart`` is its exclusive or with the next smaller
    hash of the window, -1 where there is none, and shows if that lies in another bin."""
    return F.call_function("shiftrightunsigned", apart, F.lit(64) - bits) != 0


def minima(windows: DataFrame, bits: Column) -> DataFrame:
    """``t, size, x, apart``: the least hash of each bin of each window, from ``t`` and the sorted
    hashes ``s``."""
    apart = F.transform(
        "s",
        lambda x, i: F.struct(
            x.alias("x"),
            F.when(i == 0, F.lit(-1)).otherwise(x.bitwiseXOR(F.get("s", i - 1))).alias("apart"),
        ),
    )
    each = windows.select("t", F.size("s").alias("size"), F.inline(apart))
    return each.where(is_minimum(F.col("apart"), bits))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    share: tuple[int, int] = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, n_hits, n_item``: the items that documents contain.

    ``n_item`` is the number of the item's distinct shingles, ``n_hits`` of those in the document;
    ``share[1] * n_hits >= share[0] * n_item``.
    """
    return _search(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body")),
        benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("body")),
        share,
    ).select("doc_id", "item_id", "n_hits", "n_item")


def _search(docs: DataFrame, benchmark: DataFrame, share: tuple[int, int]) -> DataFrame:
    whole = F.array(F.xxhash64("hashes"))
    items = saved(
        benchmark.withColumn("hashes", shingles(F.col("body")))
        .withColumn("runs", _runs("hashes"))
        .where(F.size("hashes") > 0)
        .select(
            "item_id",
            F.least(F.size("hashes"), F.lit(WORDS)).alias("words"),
            "hashes",
            F.coalesce(F.array_distinct("runs"), whole).alias("items"),
        ),
        "item-words",
    )
    items = saved(
        items.select(
            "item_id",
            "words",
            F.when(F.col("words") < WORDS, F.col("hashes")).alias("hashes"),
            "items",
            F.size("items").cast("bigint").alias("n_item"),
            F.xxhash64("words", "items").alias("item"),
        ).distinct(),
        "items",
    )
    bodies = docs.select("body").withColumn("t", F.xxhash64("body"))
    short = items.where(F.col("words") < WORDS)
    pairs = short_pairs(
        bodies.select("t", shingles(F.col("body")).alias("hashes")), short.select("item", "hashes")
    )
    pairs = pairs.union(long_pairs(bodies, items.where(F.col("words") == WORDS), share))
    pairs = saved(pairs.distinct(), "pairs")
    pairs = F.broadcast(pairs) if small(pairs) else pairs
    found = docs.withColumn("t", F.xxhash64("body")).join(pairs, "t")
    found = found.join(items.drop("hashes"), "item").withColumn("hashes", shingles(F.col("body")))
    found = found.withColumn("runs", _runs("hashes"))
    n = F.col("words")
    found = found.withColumn("short", F.when((n < WORDS) & (F.size("hashes") >= n), _slices(n)))
    there = F.when(n == WORDS, F.col("runs")).otherwise(F.col("short"))
    counted = found.select(
        "doc_id", "item_id", "n_item", F.sha2("body", 256).alias("digest"),
        F.size(F.array_intersect("items", there)).cast("bigint").alias("n_hits"),
    )
    # written first: Spark would move the condition, and with it the whole search, into the scan
    return saved(counted, "counted").where(
        share[1] * F.col("n_hits") >= share[0] * F.col("n_item")
    )


def long_pairs(docs: DataFrame, items: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``t, item``: texts (``t, body``) and items of five words or more that may lie in them."""
    level = share[0] / share[1]
    bounds = items.agg(F.min("n_item"), F.max("n_item")).first()
    if bounds[0] is None:
        return docs.select("t", F.lit(None).cast("bigint").alias("item")).where("false")
    classes = [
        c for c, above in zip(ITEM_SIZES, (*ITEM_SIZES[1:], 1 << 62), strict=True)
        if bounds[0] < above and bounds[1] >= c
    ]
    item_class = F.lit(classes[0])
    for c in classes[1:]:
        item_class = F.when(F.col("n_item") >= c, c).otherwise(item_class)
    keys = items.select(
        "item", item_class.alias("of_class"), F.explode("items").alias("key")
    ).distinct()
    overlap = min(bounds[1], WINDOW // 2)  # longer items leave a large part in some window
    step = WINDOW - overlap
    windows = (
        with_shingles(docs, "body", "all")
        .withColumn(
            "at",
            F.explode(
                F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("all") - overlap - 1), F.lit(step))
            ),
        )
        .select("t", F.sort_array(F.slice("all", F.col("at") + 1, WINDOW)).alias("s"))
    )
    keys = F.broadcast(keys) if small(keys) else keys
    size = F.col("size")
    finest = bits_of(size, F.lit(classes[0]), classes, level)
    met = minima(windows, finest).join(keys, F.col("x") == F.col("key"))
    met = met.where(is_minimum(F.col("apart"), bits_of(size, F.col("of_class"), classes, level)))
    return met.select("t", "item")


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """The documents that contain no item, with their own columns."""
    share = options.pop("share", SHARE)
    found = _search(
        docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("body")),
        benchmark.select(
            F.col(options.get("item_col", "item_id")).alias("item_id"),
            F.col(options.get("item_text_col", "text")).alias("body"),
        ),
        share,
    )
    texts = saved(found.select(F.col("digest").alias("leaks")).distinct(), "leaks")
    texts = F.broadcast(texts) if small(texts) else texts
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    digest = F.sha2(F.col(f"doc.`{text_col}`"), 256)
    return rows.join(texts, digest == F.col("leaks"), "left_anti").select("doc.*")
