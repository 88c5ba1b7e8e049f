"""Exact dedup: one row of each group of equal texts stays.

Each input partition makes a run: its rows' digests in order, equal ones already merged. The runs
then merge as a tree. In round ``k`` the runs whose numbers agree beyond their first ``k`` digits
(to the base ``FAN_IN``, so a binomial tree for two) are exchanged and merged into one, and at
every level only one entry of each digest goes on: the group's size and its smallest (or largest)
identifier. After a logarithm of the number of runs one run is left. A run is dealt out by digest
over all partitions at every level, so no task gathers a run.

Entries meet by a short digest and merge only if the SHA-256 of the whole texts and their lengths
agree too, again at every level. Copies merge inside the scan first, so a text that a third of all
rows share costs one entry per run. Groups are joined back to the rows in two parts: those with
over 1 / ``HOT`` of all rows are fewer than ``HOT`` and are broadcast, the others are shuffled.

Native: DataFrame functions only.

Defined results: a NULL text counts as empty. Rows that repeat an id with the same text, and rows
without an id (NULL), are told apart by their place in a table that is written once, so exactly one
row of each group stays; an id goes before NULL. Ids of any type that can be ordered are taken.
Very long texts are digested whole. An empty table gives no rows. Input columns travel in one
struct, ``doc``, so their names never clash with the results'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import saved

FAN_IN = 16
HOT = 1000


def _entries(docs: DataFrame, id_col: str, text: Column, carried: list[str]) -> DataFrame:
    """``doc, id, row, run, short, sha, size``: written once, so that rows keep their numbers."""
    body = F.coalesce(text, F.lit(""))
    number = F.monotonically_increasing_id()
    slim = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carried)).alias("doc"),
        F.col(f"`{id_col}`").alias("id"),
        number.alias("row"),
        F.xxhash64(body).alias("short"),
        F.sha2(body, 256).alias("sha"),
        F.octet_length(body).cast("bigint").alias("size"),
    )
    return saved(slim.withColumn("run", F.shiftright("row", 33).cast("int")), "entries")


def merged_runs(entries: DataFrame, keep: str = "smallest", fan_in: int = FAN_IN) -> DataFrame:
    """``short, sha, size, copies, best``: the last run, an entry for each different text.

    ``best`` is a struct ``(none, id, row)``, the entry of the row that stays.
    """
    none = F.col("id").isNull()
    if keep == "smallest":
        least = F.min(F.struct(none.alias("none"), "id", "row"))
    elif keep == "largest":  # ties and rows without an id still go to the first row
        least = F.max(F.struct((~none).alias("some"), "id", (-F.col("row")).alias("row")))
    else:
        raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")
    better = F.min if keep == "smallest" else F.max
    key = ["run", "short", "sha", "size"]
    top = entries.agg(F.max("run")).first()[0]
    level = entries.groupBy(*key).agg(F.count("*").alias("copies"), least.alias("best"))
    while top:
        top //= fan_in
        # the sort by key makes each partition's part of a run sorted, and the merge a sweep
        level = (
            saved(level, "runs")
            .withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy(*key)
            .agg(F.sum("copies").alias("copies"), better("best").alias("best"))
        )
    last = saved(level.drop("run"), "last-run")
    row = F.abs(F.col("best.row"))
    return last.select(
        "short", "sha", "size", "copies", F.col("best.id").alias("keep_id"), row.alias("keep_row")
    )


def deduplicated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise=None,
    keep_columns: list[str] | None = None,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """A row per input row: ``doc`` (struct of its columns), ``keep_id, group_size, kept, sha256``.

    ``normalise`` is a function from the text column to the text that is compared.
    """
    text = F.col(f"`{text_col}`")
    text = normalise(text) if normalise else text
    entries = _entries(docs, id_col, text, keep_columns or docs.columns)
    groups = merged_runs(entries, keep, fan_in)
    hot = groups.agg(F.floor(F.sum("copies") / HOT)).first()[0] or 0
    rows = entries.select("doc", "row", "short", "sha", "size")
    key = ["short", "sha", "size"]
    rows = rows.join(F.broadcast(groups.where(F.col("copies") > hot)), key, "left")
    met = rows.where("copies is not null")
    cold = rows.where("copies is null").drop("copies", "keep_id", "keep_row")
    met = met.unionByName(cold.join(groups.where(F.col("copies") <= hot), key))
    return met.select(
        "doc",
        "keep_id",
        F.col("copies").cast("bigint").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("sha256"),
    )


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with their own columns."""
    return deduplicated(docs, **options).where("kept").select("doc.*")
