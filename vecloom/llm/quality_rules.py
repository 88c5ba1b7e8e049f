"""Quality rules with verdicts on whole hosts.

Rules on each document give failures. Failures are counted by host, the hosts' rates are shrunk
towards the corpus by a beta prior fitted to all hosts, and the hosts whose shrunk rate is too
high are joined back, so that their other documents go too.

Native: DataFrame functions only. Each text is read once; nothing leaves its row but counts.

Defined results: a NULL or empty text has no words and so fails. Documents without a host (NULL)
belong to no host and are judged alone. Repeated rows count as often as they occur. Input columns
travel in one struct, ``doc``, so their names never clash with the results'. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import SPACE, saved, small, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 50
HOST_RATE = 0.75
MIN_HOST_DOCS = 20
SALTS = 16


def _repeated_words(frame: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``w``: words inside a 3-word window that occurs again.

    Windows are sorted by hash, then words, then place: equal ones become neighbours, and so they
    do where hashes clash. Words are compared only where hashes are equal.
    """
    window = F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.struct(
            F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"),
            F.get("w", i).alias("a"),
            F.get("w", i + 1).alias("b"),
            F.get("w", i + 2).alias("c"),
            i.alias("i"),
        ),
    )
    frame = frame.withColumn("s", F.when(F.size("w") >= 3, F.sort_array(window)))

    def same(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for c in "abc":
            equal &= x[c] == y[c]
        return F.coalesce(equal, F.lit(False))

    again = F.filter(
        "s", lambda x, i: same(x, F.get("s", i - 1)) | same(x, F.get("s", i + 1))
    )
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, x: F.struct(
            x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return frame.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("s")


def text_counts(frame: DataFrame, text: Column) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` (long)."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    frame = frame.withColumn("w", words(text)).withColumn("l", lines)
    frame = frame.withColumns(
        {
            "n_words": F.size("w").cast("bigint"),
            "word_chars": F.length(F.array_join("w", "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint"),
            "n_lines": F.size("l").cast("bigint"),
            "n_dup_lines": (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint"),
        }
    ).drop("l")
    return _repeated_words(frame).drop("w")


def host_verdicts(judged: DataFrame, host_rate: float, min_docs: int) -> DataFrame:
    """``host, host_docs, host_failures, shrunk_rate, host_rejected`` from ``host, failed``.

    The prior's mean is the corpus rate m; its strength 1 / rho - 1 follows from the spread of
    the hosts' rates beyond that of chance (the method of moments for a beta-binomial).
    """
    hosts = (
        judged.where("host is not null")
        .groupBy("host")
        .agg(
            F.count("*").alias("host_docs"),
            F.sum(F.col("failed").cast("bigint")).alias("host_failures"),
        )
    )
    n, f = F.col("host_docs").cast("double"), F.col("host_failures").cast("double")
    moments = hosts.agg(
        F.count("*").cast("double").alias("k"),
        F.sum(n).alias("n"),
        F.sum(f).alias("f"),
        F.sum(n * n).alias("n2"),
        F.sum(f * f / n).alias("spread"),
    )
    mean = F.col("f") / F.col("n")
    chance = F.col("spread") - F.col("f") * mean
    room = F.col("n") - F.col("n2") / F.col("n") - (F.col("k") - 1)
    rho = F.when(
        (F.col("f") > 0) & (F.col("f") < F.col("n")) & (room > 0),
        (chance / (mean * (1 - mean)) - (F.col("k") - 1)) / room,
    ).otherwise(F.lit(0.5))
    rho = F.greatest(F.lit(0.001), F.least(F.lit(0.5), rho))
    prior = moments.select(mean.alias("mean"), (1 / rho - 1).alias("strength"))
    shrunk = (f + F.col("mean") * F.col("strength")) / (n + F.col("strength"))
    return hosts.join(F.broadcast(prior)).select(  # one row
        "host",
        "host_docs",
        "host_failures",
        shrunk.alias("shrunk_rate"),
        ((shrunk > host_rate) & (n >= min_docs)).alias("host_rejected"),
    )


def judge(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    keep_columns: list[str] | None = None,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    host_rate: float = HOST_RATE,
    min_host_docs: int = MIN_HOST_DOCS,
) -> DataFrame:
    """One row per document: ``doc`` (struct of its columns), counts, verdicts, ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of them
    in repeated windows. ``failed`` is that or too many symbols or repeated lines, and is what
    hosts are judged by. ``kept``: not ``base_failed``, on a host that is not rejected.
    """
    columns = docs.columns if keep_columns is None else keep_columns
    carried = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"),
        F.col(host_col).cast("string").alias("host"),
        F.col(text_col).alias("body"),
    )
    counted = text_counts(carried, F.col("body")).drop("body")
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")
    lines = 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    judged = saved(
        counted.withColumn("base_failed", base).withColumn("failed", base | symbols | lines),
        "judged",
    )
    verdicts = saved(host_verdicts(judged, host_rate, min_host_docs), "hosts")
    rejected = verdicts.where("host_rejected").select(F.col("host").alias("bad_host"))
    if small(rejected):
        found = judged.join(F.broadcast(rejected), F.col("host") == F.col("bad_host"), "left")
    else:  # a hot host's documents are dealt out over salts
        salted = rejected.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")
        found = judged.withColumn("own", own).join(
            salted, (F.col("host") == F.col("bad_host")) & (F.col("own") == F.col("salt")), "left"
        )
    host_rejected = F.col("bad_host").isNotNull()
    return found.select(
        "doc", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        "n_repeat_words", "base_failed", "failed", host_rejected.alias("host_rejected"),
        (~F.col("base_failed") & ~host_rejected).alias("kept"),
    )


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return judge(docs, **options).where("kept").select("doc.*")
