"""NULLs, empty and long texts, repeated rows, empty tables and clashing names, by operator."""

from __future__ import annotations

import time
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vecloom.llm import (
    chat, classifier, common, decontaminate, line_dedup, near_dedup, packing, quality_rules, resharding,
    token_files, url_filter,
)
from vecloom.llm.common import scratch
from vecloom.llm.queries import tokenizer_path

PROSE = " ".join(f"word{i} thing{i * 7 % 31}" for i in range(60))
LONG = " ".join(f"long{i}" for i in range(40_000))
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean,"
    " h string, digest string, n_words string, body string, label int, size string, t string"
)
ROWS = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (None, PROSE), (None, None),
    (5, LONG), (6, " \t\n "), (7, "tiny"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "s", 0, False, "x", "x", "x", "x", 3, "x", "x") for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_near_dedup(docs, none):
    rows = near_dedup.near_duplicates(docs, shingle_words=3, share=(85, 100)).collect()
    assert len(rows) == len(ROWS)
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[1].component_id == of[2].component_id == 1 and not of[2].kept
    assert all(of[i].component_id == i and of[i].n_shingles == 0 for i in (3, 4, 6))
    assert of[7].n_shingles == 1 and of[5].n_shingles == 39_998
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3  # rows without an id too


def test_quality_rules(docs, none):
    rows = quality_rules.judge(docs).collect()
    assert len(rows) == len(ROWS) and set(rows[0].doc.asDict()) == set(docs.columns)
    assert all(r.base_failed == (r.n_words < 50) for r in rows)
    assert quality_rules.kept_documents(docs).columns == docs.columns
    assert quality_rules.kept_documents(none).count() == 0


def test_line_dedup(docs, none):
    rows = line_dedup.deduplicated(docs, "doc_id", "text").collect()
    assert len(rows) == len(ROWS)
    texts = sorted(((r.doc.doc_id or 0, r.doc.text) for r in rows), key=repr)
    # the first document is the one without an id; the others lose their only line
    assert texts.count((0, PROSE)) == 1 and texts.count((1, "")) == 1 and texts.count((2, "")) == 2
    assert (3, None) in texts and (4, "") in texts and (5, LONG) in texts and (7, "tiny") in texts
    dropped = line_dedup.deduplicate(docs, drop_empty=True)
    assert dropped.columns == docs.columns and dropped.count() == len(ROWS) - 3
    assert line_dedup.deduplicate(none).count() == 0


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame(
        [(1, " ".join(PROSE.upper().split()[20:40])), (2, "tiny"), (3, None), (4, LONG[:2000])],
        "item_id int, text string",
    )
    found = decontaminate.contaminated(docs, items).collect()
    got = sorted(((r.doc_id or 0, r.item_id) for r in found))
    assert got == [(0, 1), (1, 1), (2, 1), (2, 1), (5, 4), (7, 2)]
    clean = decontaminate.clean_documents(docs.withColumn("leaks", F.lit(1)), items)
    assert clean.columns == [*docs.columns, "leaks"] and clean.count() == len(ROWS) - 6
    assert decontaminate.clean_documents(docs, items.where("false")).count() == len(ROWS)
    assert decontaminate.contaminated(none, items).count() == 0
    nothing = decontaminate.contaminated(docs, items.where("false"))
    assert nothing.columns == ["doc_id", "item_id", "n_hits", "n_item"] and nothing.count() == 0


def test_short_items(spark, monkeypatch):
    """Items of one to four words, by broadcast and by shuffle."""
    rows = [(1, "What is the Capital of France, again"), (2, "the capital"), (3, None), (4, "a b c d e f g")]
    items = [(1, "the capital of France"), (2, "the"), (3, ""), (4, "capital the"), (5, "b c d e f g"), (6, "d e")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    want = [(1, 1, 1, 1), (1, 2, 1, 1), (2, 2, 1, 1), (4, 5, 2, 2), (4, 6, 1, 1)]
    for _ in range(2):
        assert sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect())) == want
        assert [r.doc_id for r in decontaminate.clean_documents(docs, benchmark).collect()] == [3]
        monkeypatch.setattr(decontaminate, "small", lambda *a: False)


def test_large_tables_are_not_broadcast(spark, docs, monkeypatch):
    """The other branch of every size check gives the same rows."""
    items = spark.createDataFrame([(1, " ".join(PROSE.split()[20:40])), (4, LONG[:2000])], "item_id int, text string")
    rules = spark.createDataFrame([("example.org", "/a", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://example.org/a/b"), (2, "http://x.org/a")], "page_id int, url string")

    def results():
        yield decontaminate.contaminated(docs, items)
        yield near_dedup.kept_documents(docs).select("doc_id", "text")
        yield line_dedup.deduplicate(docs).select("doc_id", "text")
        yield quality_rules.judge(docs, min_host_docs=1, host_rate=0.1).select("doc.doc_id", "n_words", "kept")
        yield url_filter.judge_urls(pages, rules).select("page.page_id", "rule", "verdict")

    whole = [sorted(map(tuple, r.collect()), key=repr) for r in results()]
    for module in (decontaminate, near_dedup, line_dedup, quality_rules, url_filter):
        monkeypatch.setattr(module, "small", lambda *a: False)
    assert [sorted(map(tuple, r.collect()), key=repr) for r in results()] == whole


def test_rule_prefixes_that_clash(spark, monkeypatch):
    """The join is on a digit of the digest; the whole digest confirms, and the plan shows it."""
    monkeypatch.setattr(url_filter, "PREFIX_DIGITS", 1)
    rules = spark.createDataFrame(
        [(f"h{i}.org", "/", "block") for i in range(60)], "host string, path string, verdict string"
    )
    pages = spark.createDataFrame([(i, f"http://h{i}.org/x") for i in range(80)], "page_id int, url string")
    judged = url_filter.judge_urls(pages, rules)
    assert {r.page.page_id: r.verdict for r in judged.collect()} == {
        i: "block" if i < 60 else "allow" for i in range(80)
    }
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join Inner" in x and "digest" in x)
    assert "(digest_prefix" in join and "digest#" in join and " >= " in join


def test_packing(docs, none):
    path = tokenizer_path("byte_bpe_50k.json")
    pieces, plan = packing.pack(docs, path)
    placed = packing.place_pieces(pieces.drop("ids"), plan)
    by_doc = {r.doc_id: r.n for r in placed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert by_doc[3] == by_doc[4] == 1 and placed.count() == pieces.count()
    assert sum(len(r.ids) for r in packing.sequences(pieces, plan).collect()) == 4 * sum(
        r.length for r in pieces.select("length").collect()
    )
    assert packing.place_pieces(*packing.pack(none, path)).count() == 0


def test_token_files(spark, docs, none):
    path = scratch(spark, "edge")
    token_files.write_tokens(docs, path, tokenizer_path("word_bpe_49k.json"), files=3)
    rows = token_files.read_tokens(spark, path).withColumn("n_tokens", F.size("ids").cast("bigint"))
    placed = token_files.positions(rows).orderBy("start", "n_tokens").collect()
    assert len(placed) == len(ROWS) and placed[0].doc_id is None and placed[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(placed, placed[1:], strict=False))
    assert [r.doc_id for r in placed[2:]] == sorted(r[0] for r in ROWS if r[0])
    assert token_files.read_tokens(spark, path, [5]).count() == 1
    empty = scratch(spark, "edge")
    token_files.write_tokens(none, empty, tokenizer_path("word_bpe_49k.json"), files=2)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_classifier(spark, docs, none):
    labels = spark.createDataFrame(
        [(i, q) for i in (1, 2, 3, 4, 5, 6, 7) for q in [int(i in (1, 2, 5))]] + [(8, None)],
        "doc_id bigint, quality int",
    )
    rows = classifier.classify(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
               for r in rows if r.doc_id is not None)
    unknown = classifier.classify(docs, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in unknown} == {(0.5, 1)}
    assert classifier.classify(none, labels).count() == 0


def test_resharding(spark, docs, none):
    old, new = scratch(spark, "edge"), scratch(spark, "edge")
    resharding.store(docs, F.lit(0), old, "doc_id", "text")
    moves = resharding.reshard(spark, old, 1, 3, new)
    rows = resharding.resharded(spark, old, new, moves).collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(ROWS, key=repr)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    empty = scratch(spark, "edge")
    resharding.store(none, F.lit(0), empty, "doc_id", "text")
    moves = resharding.reshard(spark, empty, 1, 3, new)
    assert resharding.resharded(spark, empty, new, moves).count() == 0 and moves.affected == []


def test_only_affected_shards_are_written(spark):
    """A shard that no block enters or leaves is read where it is; moves are near the flow's cost."""
    import pathlib

    rows = [(i, f"{i:06d}" * 5, 0 if i < 300 else 1 if i < 500 else 2) for i in range(700)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, old int").repartition(5)
    old, new = scratch(spark, "edge"), scratch(spark, "edge")
    resharding.store(frame, F.col("old"), old, "doc_id", "text")
    total = 31 * 700
    moves = resharding.reshard(spark, old, 3, 3, new)
    least = 31 * (300 - 700 // 3)
    assert least <= moves.moved_bytes <= least + 0.02 * total
    got = resharding.resharded(spark, old, new, moves).collect()
    assert sorted(r.doc_id for r in got) == list(range(700))
    written = {p.name for p in pathlib.Path(new.removeprefix("file:")).glob("shard=*")}
    assert written == {f"shard={j}" for j in moves.affected}
    again, none = scratch(spark, "edge"), scratch(spark, "edge")
    even = spark.createDataFrame([(i, f"{i:03d}", i % 2) for i in range(100)], "doc_id bigint, text string, old int")
    resharding.store(even, F.col("old"), again, "doc_id", "text")
    moves = resharding.reshard(spark, again, 2, 2, none)
    assert (moves.affected, moves.moved_bytes) == ([], 0) and not pathlib.Path(none).exists()
    assert resharding.resharded(spark, again, none, moves).count() == 100


def test_chat(spark):
    schema = "tree int, node int, parent int, role string, text string, score double"
    rows = [
        (1, 1, None, "user", None, None), (1, 2, 1, "assistant", "a\\<[", 1.0),
        (1, 2, 1, "assistant", "a\\<[", 1.0), (1, 3, 1, "assistant", "</s>", 2.0),
        (1, None, 1, "user", "lost", 0.0), (None, 1, 9, None, "alone", None),
        (2, 1, 2, "user", "circle", 0.0), (2, 2, 1, "user", "circle", 0.0),
    ]
    out = chat.format_trees(spark.createDataFrame(rows, schema), branches=None)
    read = out.select("tree", "leaf", "branch", chat.read_turns("formatted").alias("turns"),
                      chat.read_loss_text("formatted", "loss_mask").alias("loss")).collect()
    got = {(r.tree, r.leaf): (r.branch, [tuple(t) for t in r.turns], r.loss) for r in read}
    assert got == {
        (1, 2): (2, [("user", ""), ("assistant", "a\\<[")], "a\\<["),
        (1, 3): (1, [("user", ""), ("assistant", "</s>")], "</s>"),
        (None, 1): (1, [("", "alone")], ""),
    }
    assert chat.format_trees(spark.createDataFrame([], schema)).count() == 0


def test_long_replies_take_few_rounds(spark):
    n = 300
    rows = [(1, i, i - 1 if i else None, "user", f"t{i}", 0.0) for i in range(n)]
    frame = spark.createDataFrame(
        rows, "tree int, node int, parent int, role string, text string, score double"
    )
    turns = chat.format_trees(frame).select(chat.read_turns("formatted").alias("t")).first().t
    assert [t.text for t in turns] == [f"t{i}" for i in range(n)]


def test_url_filter(spark):
    rules = spark.createDataFrame(
        [("Example.org", "/a", "block"), ("example.org", "/a/b", "allow"), ("org", None, "block")],
        "host string, path string, verdict string",
    )
    urls = ["http://X.EXAMPLE.org/a/b/c?q", "http://example.org/ab", "http://notexample.org", None,
            "no scheme", "x://q.net/a", "x://", "http://example.org/ab"]
    pages = spark.createDataFrame(
        [(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, rule string"
    )
    rows = sorted(url_filter.judge_urls(pages, rules).collect(), key=lambda r: r.page.page_id)
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("x.example.org", "/a/b/c", "example.org/a/b", "allow"),
        ("example.org", "/ab", "example.org/a", "block"),
        ("notexample.org", "", "org", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("q.net", "/a", None, "allow"),
        ("", "", None, "allow"), ("example.org", "/ab", "example.org/a", "block"),
    ]
    assert url_filter.judge_urls(pages, rules.where("false")).where("rule is null").count() == 8
    assert url_filter.judge_urls(pages.where("false"), rules).count() == 0


def test_pipeline_stages_keep_the_columns(spark, docs, sf_dir):
    current = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, sf_dir)
        assert current.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, current, sf_dir).count() > 0


def test_saved_leaves_no_shuffle_files(spark):
    """What a write has shuffled goes with it; the setting is as before."""

    def shuffled():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f.name for d in disk.localDirs() for f in Path(str(d)).rglob("shuffle_*.data")}

    before, set_before = shuffled(), spark.conf.get(common.CLEANUP, None)
    frame = common.saved(spark.range(1000).repartition(7).groupBy(F.col("id") % 50).count(), "x")
    end = time.time() + 20  # they are removed in the background
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(common.CLEANUP, None) == set_before
    assert frame.count() == 50
