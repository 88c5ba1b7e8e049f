"""Periodic runs of words: where a text repeats itself word for word.

A run is a stretch of words with smallest period ``q`` that is at least ``max(MIN_WORDS, 2 * q)``
long and that no neighbouring word extends. At distance (lag) ``q`` its words equal themselves over
``max(MIN_WORDS - q, q)`` words or more: that much overlap is guaranteed. So it holds, whole, an
aligned block of half that length; blocks have lengths ``k`` that are powers of two, one for each
range of lags.

* Index: the ``k``-grams of all places, as ranks. Those of ``2k`` follow from pairs of ranks, so
  equality is exact, and places whose gram occurs once in their document leave the index for good.
* Seeds: each aligned block meets its gram's other occurrences at the lags of its range, at most
  ``2k`` of them: in all, less than two pairs for each word and range, whatever the text.
* Extend: on a diagonal (document and lag) a seed that starts where the last one ended belongs to
  a stretch that is covered that far and is not extended again; only a stretch's first seed is
  extended backwards and its last one forwards, by less than ``k`` words, over the ranks.
* Of stretches with the same ends only the smallest lag is a period; the others are its multiples.

Everything happens inside Arrow batches, whose documents are worked on together; slices of about
``SLICE_BYTES`` bound the memory. A document is never cut: one longer than that takes a slice
alone, at some 80 bytes for each of its words and 8 more for each range in which it repeats itself.

Defined results: NULL, empty and blank texts have no words and no runs. Rows are independent, so
repeated rows and ids, and rows without an id, are each searched. An empty table gives no rows.
Input columns travel in one struct, ``doc``, so their names never clash with the results'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.llm.tokens import slices

MIN_WORDS = 12
SLICE_BYTES = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of all words, the words by code, and each text's first word (and the end).

    Words are runs of anything but ASCII white space, compared byte by byte.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, content = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[1:] > bounds[:-1]]
    begins[edges] = inside[edges]  # texts stand one behind the other without a blank
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, bounds)
    letters = data[inside]
    ends = np.append(np.cumsum(inside)[starts] - 1, len(letters)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]
    )
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, first


def _named(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key occurs again, and their keys' ranks."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.ones(len(keys) + 1, bool)
    fresh[1:-1] = ordered[1:] != ordered[:-1]
    again = ~(fresh[:-1] & fresh[1:])
    rank = np.cumsum(fresh[:-1])[again]
    places = places[order[again]]
    back = np.argsort(places, kind="stable")
    return places[back], rank[back]


class _Grams:
    """Ranks, by place, of the grams of one length that occur again; 0 for all others."""

    def __init__(self, places: np.ndarray, ranks: np.ndarray):
        self.places, self.ranks = places, ranks

    def at(self, places: np.ndarray) -> np.ndarray:
        if not len(self.places):
            return np.zeros(len(places), np.int64)
        found = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[found] == places, self.ranks[found], 0)

    def doubled(self, k: int) -> _Grams:
        """Of twice the length ``k``: both halves occur again, and so does the pair."""
        follow = self.at(self.places + k)
        both = np.flatnonzero(follow)
        keys = self.ranks[both] * (int(self.ranks.max(initial=0)) + 1) + follow[both]
        return _Grams(*_named(self.places[both], keys)) if len(both) else _Grams(both, both)


def _seeds(grams: _Grams, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``place, lag``: aligned blocks and the lags from ``low`` to below ``high`` at which their
    gram occurs again."""
    span = int(grams.places[-1]) + high + 1
    index = grams.ranks * span + grams.places
    order = np.argsort(index, kind="stable")
    index, places = index[order], grams.places[order]
    blocks = np.flatnonzero(places % k == 0)
    a = np.searchsorted(index, index[blocks] + low)
    n = np.searchsorted(index, index[blocks] + high) - a
    place = np.repeat(places[blocks], n)
    met = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return place, places[met] - place


def _reach(levels: list[_Grams], x: np.ndarray, lag: np.ndarray, side: int) -> np.ndarray:
    """How far the words at ``x`` and ``lag`` behind go on to agree, forwards from ``x`` or
    backwards up to ``x``; less than the gram after the last level."""
    at = x.copy()
    for bits in range(len(levels) - 1, -1, -1):
        k = 1 << bits
        from_ = at if side > 0 else at - k
        one = levels[bits].at(from_)
        same = (one > 0) & (one == levels[bits].at(from_ + lag))
        at = np.where(same, at + side * k, at)
    return at


def find_runs(
    codes: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of all runs, by start and period, in words of the whole batch."""
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    width = int(codes.max(initial=0)) + 1
    # ranks never are the same in two documents, so nothing reaches over their ends
    grams = _Grams(*_named(np.arange(len(codes)), owner * width + codes))
    longest = int(sizes.max(initial=0))
    levels: list[_Grams] = []
    found = []
    k, low = 1, 1
    while 4 * k - 1 <= (min_words + 1) // 2:  # the least overlap of any lag
        levels.append(grams)
        grams, k = grams.doubled(k), 2 * k
    while len(grams.places) and 2 * low <= longest:
        place, lag = _seeds(grams, k, low, 4 * k)
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        goes_on = np.zeros(len(place) + 1, bool)  # from the seed before
        goes_on[1:-1] = (lag[1:] == lag[:-1]) & (place[1:] == place[:-1] + k)
        head, tail = np.flatnonzero(~goes_on[:-1]), np.flatnonzero(~goes_on[1:])
        lag = lag[head]
        start = _reach(levels, place[head], lag, -1)
        end = _reach(levels, place[tail] + k, lag, 1) + lag
        long = end - start >= np.maximum(min_words, 2 * lag)
        found.append(np.stack([start, end, lag])[:, long])
        levels.append(grams)
        low, grams, k = 4 * k, grams.doubled(k), 2 * k
    table = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    start, end, lag = table[:, np.lexsort((table[2], table[1], table[0]))]
    fresh = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, end, lag = start[fresh], end[fresh], lag[fresh]
    order = np.lexsort((lag, start))
    return start[order], (end - start)[order], lag[order]


def collapsed_words(n: int, start: np.ndarray, length: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Whether each word stays: all but those in a run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + lag, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change)[:n] == 0


def _joined(codes: np.ndarray, words: pa.Array, stay: np.ndarray, first: np.ndarray) -> pa.Array:
    """The words that stay, with one blank between them, by text."""
    kept = words.take(pa.array(codes[stay])).cast(pa.large_binary())
    _, offsets, content = kept.buffers()
    bounds = np.frombuffer(offsets, np.int64)[: len(kept) + 1]
    letters = np.frombuffer(content or b"", np.uint8)[: bounds[-1]]
    counts = np.append(0, np.cumsum(stay))[first]
    owner = np.repeat(np.arange(len(first) - 1), np.diff(counts))
    # a blank goes before each word but the first of a text
    inner = np.append(False, owner[1:] == owner[:-1])[: len(owner)]
    shift = np.cumsum(inner)
    out = np.full(len(letters) + int(inner.sum()), 32, np.uint8)
    out[np.arange(len(letters)) + np.repeat(shift, np.diff(bounds))] = letters
    blanks = np.append(0, shift)
    ends = bounds[counts] + blanks[counts]
    texts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(out)]
    )
    return texts.cast(pa.large_string()).cast(pa.string())


def periodic_runs(
    docs: DataFrame,
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    keep_columns: list[str] | None = None,
) -> DataFrame:
    """A row per input row: ``doc`` (struct of its columns), ``n_words``, ``runs`` and
    ``collapsed``.

    ``runs`` is an array of ``(start, length, period)`` in words, by start and period;
    ``collapsed`` the text without the words in runs behind their first period.
    """
    columns = docs.columns if keep_columns is None else keep_columns
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"), F.col(f"`{text_col}`").alias("text")
    )
    run = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
    schema = T.StructType(
        [
            rows.schema["doc"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run, False)),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                codes, words, first = split_words(part.column(1))
                start, length, lag = find_runs(codes, first, min_words)
                owner = np.searchsorted(first, start, "right") - 1
                counts = np.bincount(owner, minlength=part.num_rows)
                ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                fields = [start - first[owner], length, lag]
                runs = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in fields],
                    fields=[pa.field(c, pa.int64(), False) for c in ("start", "length", "period")],
                )
                stay = collapsed_words(len(codes), start, length, lag)
                lists = pa.ListArray.from_arrays(
                    ends, runs, type=pa.list_(pa.field("element", runs.type, False))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(first), pa.int64()),
                        lists,
                        _joined(codes, words, stay, first),
                    ],
                    names=["doc", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(search, schema)
