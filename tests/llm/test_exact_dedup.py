"""Exact dedup against plain grouping: ties, NULLs, forced digest clashes, many runs."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vecloom.llm import exact_dedup


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept int, short string")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    pool = ["", "a", "b", "A", " a", "long " * 20_000, *(f"t{i}" for i in range(50))]
    rows = [(rng.choice([None, rng.randrange(300)]), rng.choice([None, *pool]), 7, "x") for _ in range(400)]
    return rows + [(5, "hot", 7, "x")] * 200 + rows[:20]


def check(got, rows, pick, form=lambda t: t):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[form(t or "")].append(i)
    assert len(got) == len(rows)
    stay = defaultdict(int)
    for r in got:
        text = form(r.doc.text or "")
        ids = [i for i in groups[text] if i is not None]
        assert r.keep_id == (pick(ids) if ids else None)
        assert r.group_size == len(groups[text])
        assert r.sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert not r.kept or r.doc.doc_id == r.keep_id
        stay[text] += r.kept
    assert all(stay[t] == 1 for t in groups)


@pytest.mark.parametrize("fan_in", [2, 16])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_equal_plain_grouping(spark, rows, keep, fan_in, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT", 10)  # hot and cold groups both occur
    frame = frame_of(spark, rows).repartition(13)
    got = exact_dedup.deduplicated(frame, keep=keep, fan_in=fan_in).collect()
    check(got, rows, min if keep == "smallest" else max)


def test_short_digests_that_clash_are_told_apart(spark, rows, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    check(exact_dedup.deduplicated(frame_of(spark, rows)).collect(), rows, min)


def test_normalised_texts(spark, rows):
    got = exact_dedup.deduplicated(
        frame_of(spark, rows), normalise=lambda t: F.lower(F.trim(F.coalesce(t, F.lit(""))))
    ).collect()
    check(got, rows, min, lambda t: t.strip(" ").lower())


def test_kept_documents(spark, rows):
    frame = frame_of(spark, rows)
    kept = exact_dedup.kept_documents(frame)
    assert kept.columns == frame.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t, *_ in rows})
    assert exact_dedup.kept_documents(frame.where("false")).count() == 0
    strings = exact_dedup.kept_documents(frame.withColumn("doc_id", F.col("doc_id").cast("string")))
    assert strings.count() == kept.count()
    with pytest.raises(ValueError):
        exact_dedup.deduplicated(frame, keep="some")


def test_runs_merge_in_rounds_without_python(spark, rows):
    frame = frame_of(spark, rows).repartition(9)
    found = exact_dedup.deduplicated(frame)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Window" not in plan
