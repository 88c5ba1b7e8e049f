"""Periodic runs against brute force, and the contract's digests."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecloom.llm import runs
from vecloom.llm.queries import QUERIES


def all_runs(words, least=12):
    """Every lag, every stretch; of the same stretch the smallest lag."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((i, n, q) for (i, n), q in found.items())


def collapsed(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts_of(rng):
    for _ in range(rng.randrange(1, 6)):
        letters = rng.choice([1, 2, 3, 30])
        words = [chr(97 + rng.randrange(letters)) for _ in range(rng.choice([0, 1, 12, 13, 60, 90]))]
        if words and rng.random() < 0.5:
            a, p = rng.randrange(len(words)), rng.randrange(1, len(words) + 1)
            words[a:] = [words[a + (i - a) % p] for i in range(a, len(words))]
        if rng.random() < 0.1:  # a word with as many repetitions as can be
            x, y = "a", "ab"
            while len(y) < 90:
                x, y = y, y + x
            words = list(y)
        yield words


@pytest.mark.parametrize("least", [2, 3, 5, 12, 20])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(300):
        texts = list(texts_of(rng))
        blank = rng.choice([" ", "\n", " \t\x0b"])
        column = pa.array([blank + blank.join(t) for t in texts] + [None, ""])
        codes, words, first = runs.split_words(column)
        assert np.diff(first).tolist() == [*map(len, texts), 0, 0]
        got = runs.find_runs(codes, first, least)
        each = [all_runs(t, least) for t in texts]
        want = [(first[k] + a, n, q) for k, found in enumerate(each) for a, n, q in found]
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want
        stay = runs.collapsed_words(len(codes), *got)
        joined = runs._joined(codes, words, stay, first).to_pylist()
        assert joined[: len(texts)] == [collapsed(*x) for x in zip(texts, each, strict=True)]


def test_seeds_are_few_in_a_text_of_one_word():
    n = 5000
    got = runs.find_runs(np.zeros(n, np.int64), np.array([0, n]))
    assert [x.tolist() for x in got] == [[0], [n], [1]]
    grams = runs._Grams(np.arange(n), np.ones(n, np.int64))
    assert len(runs._seeds(grams, 8, 16, 32)[0]) <= 2 * n


def test_rows_of_any_kind(spark):
    loop = "a b c " * 2000 + "end"
    rows = [(1, loop, 9), (1, loop, 9), (2, None, 9), (3, "", 9), (None, " \n", 9), (None, "x " * 12, 9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    out = runs.periodic_runs(frame).collect()
    got = sorted(((r.doc.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out), key=repr)
    assert got == sorted([
        (1, 6001, [(0, 6000, 3)], "a b c end"), (1, 6001, [(0, 6000, 3)], "a b c end"),
        (2, 0, [], ""), (3, 0, [], ""), (0, 0, [], ""), (0, 12, [(0, 12, 1)], "x"),
    ], key=repr)
    assert out[0].doc.asDict().keys() == {"doc_id", "text", "runs"}
    assert runs.periodic_runs(frame.where("false")).count() == 0


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    lines = "".join(f"{a},{b},{q}\n" for a, b, q in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, found))]
    return (doc_id, len(found), *best, milli, *digests)


def test_the_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(120)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "\n one\x0btwo ")]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, path).collect()
    assert sorted(map(tuple, got)) == sorted(plain_row(*r) for r in rows)


def test_the_query_on_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.length("text") < 3000)
    want = {r.doc_id: plain_row(r.doc_id, r.text) for r in docs.collect()}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert all(got[i] == row for i, row in want.items()) and len(want) > 500
