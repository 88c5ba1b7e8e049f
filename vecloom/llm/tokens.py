"""Token ids of whole texts by a given public tokenizer, inside Arrow batches.

A text is cut where white space follows anything else, and where ASCII punctuation other than the
apostrophe follows an ASCII letter. No pre-tokenizer of the given files lets a token reach over such
a place, so the ids of the parts are the ids of the text; parts that occur again in a batch are
encoded once.

The library spends more time on a call's overhead than on a word, so plain parts (white space, then
ASCII and Latin letters up to U+027F) are joined, ``JOINED`` to a string. Where each part's ids end
follows from what the ids stand for: in a byte-level vocabulary each has a number of bytes, in one
with word ends every pre-token closes with an id that ends in the mark. If that doesn't come out
even for a string, its parts are encoded alone.

Strings of special tokens inside a text get the special id, as in the library's plain call; texts
that hold one are encoded whole.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: First two bytes of the blocks that hold white space of three bytes.
_WIDE_SPACE = ((0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))
SLICE_BYTES = 16 << 20
CHUNK = 8192
JOINED = 256

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)  # ASCII punctuation but the apostrophe
_MARK[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
#: White space, then characters up to U+027F that are no white space, control or U+0130, whose lower
#: case is longer.
PLAIN = r"^[ \t\n\x0B\x0C\r]+(?:[\x21-\x7E]|[\x{A1}-\x{12F}]|[\x{131}-\x{27F}])+$"
#: The pre-tokens of the vocabulary with word ends.
WORD_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def part_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where parts start in UTF-8 bytes; ``starts`` are those of the texts that aren't empty.

    Behind a character that may be white space beyond ASCII there is no cut: fewer cuts are
    always right.
    """
    space = _SPACE[data]
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    wide = at[data[at - 1] >= 0x80]
    if len(wide):
        a, b, c = (data[np.maximum(wide - k, 0)] for k in (3, 2, 1))
        odd = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
        for first, second in _WIDE_SPACE:
            odd |= (a == first) & (b == second)
        at = np.setdiff1d(at, wide[odd], assume_unique=True)
    mark = np.zeros(len(data), bool)
    mark[1:] = _LETTER[data[:-1]] & _MARK[data[1:]]
    mark[at] = True
    mark[starts] = True
    return np.flatnonzero(mark)


class Encoder:
    """Ids of texts by the tokenizer file at ``path``, an end id behind each text."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        model = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in model["added_tokens"]]
        mark = model["model"].get("end_of_word_suffix")
        known = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            known[i] = token.endswith(mark) if mark else len(token)
        self.marked, self.known = bool(mark), known
        normal = [n["type"] for n in (model["normalizer"] or {}).get("normalizers", [])]
        splits = (model["pre_tokenizer"] or {}).get("pretokenizers", [model["pre_tokenizer"] or {}])
        # the two kinds whose parts' ends are known here
        words = mark == "</w>" and normal == ["NFC", "Replace", "Lowercase"]
        words = words and splits[0].get("pattern") == {"Regex": WORD_PARTS.pattern}
        plain = not mark and not model["normalizer"] and splits[0].get("type") == "ByteLevel"
        self.joins = words or (plain and splits[0]["use_regex"] and not splits[0]["add_prefix_space"])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another (uint32) and the number of each text's, its end id included.

        A NULL text counts as empty.
        """
        texts = texts.cast(pa.string()).fill_null("")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        held = np.zeros(len(texts), bool)
        for name in self.special:
            held |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        if held.any():
            return self._mixed(texts, held)
        _, offsets, content = texts.buffers()
        bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(content or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds.astype(np.int64) - bounds[0]
        flat, counts = self._parts(data, bounds) if len(data) else (None, None)
        if flat is None:
            flat, counts = np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        whole = np.full(len(flat) + len(texts), self.end_id, np.uint32)
        inside = np.ones(len(whole), bool)
        inside[np.cumsum(counts + 1) - 1] = False
        whole[inside] = flat
        return whole, counts + 1

    def _mixed(self, texts: pa.Array, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold a special token's string by the plain call, the others as ever."""
        whole = [
            np.array([*one.ids, self.end_id], np.uint32)
            for one in self.tokenizer.encode_batch_fast(
                texts.filter(pa.array(held)).to_pylist(), add_special_tokens=False
            )
        ]
        ids, counts = self.ids(texts.filter(pa.array(~held)))
        rest = iter(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else [])
        own = iter(whole)
        each = [next(own) if h else next(rest) for h in held]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def _encode(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids of each part, where they begin in the store, and the store of ids."""
        plain = np.zeros(len(parts), bool)
        if self.joins:
            plain = pc.match_substring_regex(parts, PLAIN).to_numpy(zero_copy_only=False)
        order: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        store: list[np.ndarray] = []
        alone = [np.flatnonzero(~plain)]
        at = np.flatnonzero(plain)
        lengths = pc.binary_length(parts).to_numpy(zero_copy_only=False)
        many = CHUNK // JOINED * JOINED
        for a in range(0, len(at), many):
            groups = [at[k : k + JOINED] for k in range(a, min(a + many, len(at)), JOINED)]
            texts = [parts.take(pa.array(g)).to_pylist() for g in groups]
            encoded = self.tokenizer.encode_batch_fast(
                ["".join(t) for t in texts], add_special_tokens=False
            )
            for group, text, one in zip(groups, texts, encoded, strict=True):
                found = np.array(one.ids, np.uint32)
                ends = self._ends(found, text, lengths[group])
                if ends is None:
                    alone.append(group)
                    continue
                order.append(group)
                sizes.append(np.diff(ends, prepend=0))
                store.append(found)
        rest = np.concatenate(alone)
        for a in range(0, len(rest), CHUNK):
            encoded = self.tokenizer.encode_batch_fast(
                parts.take(pa.array(rest[a : a + CHUNK])).to_pylist(), add_special_tokens=False
            )
            lists = [one.ids for one in encoded]
            order.append(rest[a : a + CHUNK])
            sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            store.append(np.fromiter(chain.from_iterable(lists), np.uint32, sizes[-1].sum()))
        at, counts = np.concatenate(order), np.concatenate(sizes)
        n, begins = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        n[at], begins[at] = counts, np.cumsum(counts) - counts
        return n, begins, np.concatenate(store)

    def _ends(
        self, ids: np.ndarray, parts: list[str], lengths: np.ndarray
    ) -> np.ndarray | None:
        """Where each part's ids end, or None where that can't be told."""
        reached = np.cumsum(self.known[ids])
        if self.marked:
            wanted = np.cumsum([len(WORD_PARTS.findall(p.lower())) for p in parts])
        else:
            wanted = np.cumsum(lengths)
        ends = np.searchsorted(reached, wanted) + 1
        if not len(reached) or reached[-1] != wanted[-1] or (reached[ends - 1] != wanted).any():
            return None
        return ends

    def _parts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = part_starts(data, bounds[:-1][bounds[1:] > bounds[:-1]])
        ends = np.append(starts, len(data)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
        coded = parts.dictionary_encode()
        sizes, begins, store = self._encode(coded.dictionary)
        which = coded.indices.to_numpy()
        lengths = sizes[which]
        shift = begins[which] - (np.cumsum(lengths) - lengths)
        flat = store[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)]
        before = np.append(0, np.cumsum(lengths))
        first = np.searchsorted(starts, bounds)  # the first part of each text
        return flat, np.diff(before[first])


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES):
    """Runs of rows with about ``most`` bytes of text each, at least a row."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy()
    group = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
    edges = np.append(np.flatnonzero(np.diff(group, prepend=-1)), batch.num_rows)
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)
