"""Chat formatting of reply trees.

Messages point to the message they reply to. Iterated self-joins give each message its depth and
the sum of scores on the way from the root (pointer doubling: the k-th join reaches 2^k replies
up), leaves are ranked by it, and each chosen leaf's path is walked back the same way and
formatted as one conversation. Rounds grow with the logarithm of the longest path.

Native: DataFrame functions only. The one place where the rows of a conversation meet is the row
that holds its text.

Defined results: a NULL text or role is empty; a NULL score is 0. A message whose parent is NULL
or missing is a root. Ties in score go to the smaller leaf. Messages that reply in a circle
have no root and are left out. Rows that repeat a node (same tree and node) count once: the least
by role and text stays. Rows without a node id are left out. NULL trees are one tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.llm.common import saved

# The marks of the template.
ROLE_MARK, TEXT_MARK, END_MARK = "<|role|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(text: Column | str) -> Column:
    """A backslash behind each ``<``, ``[`` and backslash: no control string is left whole."""
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column | str) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def turn(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit(ROLE_MARK), escape(role), F.lit(TEXT_MARK), escape(text), F.lit(END_MARK)
    )


def with_paths(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Messages ``tree, node, parent, score`` with ``depth`` and ``total``, and the tables of
    ancestors: the k-th has ``tree, node, up``, the ancestor 2^k replies up where there is one."""
    up = messages.alias("m").join(
        messages.alias("p"),
        F.col("m.tree").eqNullSafe(F.col("p.tree")) & (F.col("m.parent") == F.col("p.node")),
        "left",
    )
    hops = saved(
        up.select(
            "m.tree", "m.node", F.col("p.node").alias("up"),
            F.when(F.col("p.node").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
            F.col("m.score").alias("total"),
        ),
        "hops",
    )
    tables, most = [], messages.count()
    while True:
        near = hops.where("up is not null")
        if near.isEmpty() or 1 << len(tables) > most:  # beyond that only circles go on
            break
        tables.append(near.select("tree", "node", "up"))
        a, b = hops.alias("a"), hops.alias("b")
        hops = saved(
            a.join(
                b,
                F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.up") == F.col("b.node")),
                "left",
            ).select(
                "a.tree", "a.node", F.col("b.up").alias("up"),
                (F.col("a.depth") + F.coalesce("b.depth", F.lit(0))).alias("depth"),
                (F.col("a.total") + F.coalesce("b.total", F.lit(0.0))).alias("total"),
            ),
            "hops",
        )
    return hops.where("up is null").select("tree", "node", "depth", "total"), tables


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """``tree, leaf, branch, node, depth`` for every message on a chosen root-to-leaf path.

    ``branch`` ranks the leaves of a tree from 1 by their path's total score, highest first;
    ``branches`` keeps the best so many of each tree, None all.
    """
    reached, tables = with_paths(messages)
    parents = messages.where("parent is not null").select("tree", F.col("parent").alias("node"))
    a, b = reached.alias("a"), parents.distinct().alias("b")
    leaves = a.join(
        b,
        F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node")),
        "left_anti",
    )
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    ranked = leaves.withColumn("branch", F.row_number().over(order))
    if branches is not None:
        ranked = ranked.where(F.col("branch") <= branches)
    on_path = ranked.select("tree", F.col("node").alias("leaf"), "branch", "node", "depth")
    for k in reversed(range(len(tables))):
        a, b = on_path.alias("a"), tables[k].alias("b")
        further = a.join(
            b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node"))
        ).select(
            "a.tree", "a.leaf", "a.branch", F.col("b.up").alias("node"),
            (F.col("a.depth") - (1 << k)).alias("depth"),
        )
        on_path = saved(on_path.union(further), "paths")
    return on_path


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """One row per chosen path: ``tree, leaf, branch, formatted, loss_mask``.

    ``messages`` has ``tree, node, parent, role, text, score``. ``loss_mask`` lists the places
    (start from 0, length, in code points) of the assistant's texts in ``formatted``.
    """
    empty = F.lit("")
    one = Window.partitionBy("tree", "node").orderBy("role", "text", "parent")
    messages = saved(
        messages.where("node is not null")
        .select(
            "tree", "node", "parent",
            F.coalesce(F.col("role"), empty).alias("role"),
            F.coalesce(F.col("text"), empty).alias("text"),
            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        )
        .withColumn("nth", F.row_number().over(one))
        .where("nth = 1")
        .drop("nth"),
        "messages",
    )
    a = paths(messages.select("tree", "node", "parent", "score"), branches).alias("a")
    b = messages.alias("b")
    rows = a.join(
        b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node"))
    ).select("a.tree", "a.leaf", "a.branch", "a.depth", "b.role", "b.text")
    return assemble(rows)


def assemble(rows: DataFrame) -> DataFrame:
    """``tree, leaf, branch, formatted, loss_mask`` from ``..., depth, role, text``."""
    rows = rows.select(
        "tree", "leaf", "branch", "depth",
        turn(F.col("role"), F.col("text")).alias("block"),
        F.length(F.concat(F.lit(ROLE_MARK), escape("role"), F.lit(TEXT_MARK))).alias("head"),
        F.length(escape("text")).alias("body"),
        (F.col("role") == LOSS_ROLE).alias("learned"),
    ).withColumn("size", F.length("block"))
    turns = F.array_sort(F.collect_list(F.struct("depth", "block", "head", "body", "learned", "size")))
    whole = rows.groupBy("tree", "leaf", "branch").agg(turns.alias("turns"))
    zero = F.lit(0).cast("bigint")
    spans = F.aggregate(
        "turns",
        F.struct(
            zero.alias("at"),
            F.array().cast("array<struct<start:bigint,length:bigint>>").alias("mask"),
        ),
        lambda acc, t: F.struct(
            (acc["at"] + t["size"]).alias("at"),
            F.when(
                t["learned"],
                F.concat(
                    acc["mask"],
                    F.array(
                        F.struct(
                            (acc["at"] + t["head"]).alias("start"),
                            t["body"].cast("bigint").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["mask"])
            .alias("mask"),
        ),
        lambda acc: acc["mask"],
    )
    return whole.select(
        "tree", "leaf", "branch",
        F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
        spans.alias("loss_mask"),
    )


def read_turns(formatted: Column | str) -> Column:
    """The turns of a formatted conversation, as an array of ``role, text``."""
    blocks = F.split(formatted, r"<\|end\|>")
    return F.transform(
        F.slice(blocks, 1, F.size(blocks) - 1),
        lambda block: F.struct(
            unescape(F.regexp_extract(block, r"(?s)^<\|role\|>(.*?)<\|text\|>", 1)).alias("role"),
            unescape(F.regexp_extract(block, r"(?s)<\|text\|>(.*)$", 1)).alias("text"),
        ),
    )


def read_loss_text(formatted: Column | str, loss_mask: Column | str) -> Column:
    """All text under the loss mask, in order, with nothing between."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    return F.array_join(
        F.transform(
            loss_mask,
            lambda span: unescape(
                F.substring(
                    formatted, (span["start"] + 1).cast("int"), span["length"].cast("int")
                )
            ),
        ),
        "",
    )
