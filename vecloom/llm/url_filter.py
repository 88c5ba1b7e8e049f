"""URL filter by host and path rules, looked up by hash.

Each URL is expanded into host suffixes and path prefixes. The expressions' SHA-256 digests meet
the rules' in an equi-join on a short prefix of the digest; the whole digest then confirms the
rule, and the longest rule that fits gives the verdict.

Defined results: a NULL URL or one without ``://`` has an empty host and path, and no rule fits.
Every input row gives one output row, repeated rows and NULL ids included. Input columns travel
in the struct ``page``. An empty table, or no rules, gives the default verdict for each row. Rules
without a host or a verdict (NULL) are left out, a NULL path is an empty one; rules that repeat a
host and path give the verdict that comes last in the alphabet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import lower_ascii, saved, small

PREFIX_DIGITS = 8
SALTS = 16


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, in lower case."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column | str) -> Column:
    return F.split(host, r"\.")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
    keep_columns: list[str] | None = None,
) -> DataFrame:
    """``page`` (struct of the columns), ``host, path, rule, verdict``, a row per page.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains
    where the URL's path starts with the rule's. Of several the longest wins; of equal ones the
    verdict that comes last in the alphabet (block before allow). Only suffixes with as many
    labels, and prefixes as long, as some rule has are looked up.
    """
    rules = rules.where("host is not null and verdict is not null").select(
        lower_ascii(F.col("host")).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    )
    shapes = rules.agg(
        F.array_sort(F.collect_set(F.size(_labels("rule_host")))).alias("label_counts"),
        F.array_sort(F.collect_set(F.length("rule_path"))).alias("path_lengths"),
    )  # one row of small numbers
    whole = F.concat_ws("\n", "rule_host", "rule_path")
    keyed = rules.select(
        F.concat("rule_host", "rule_path").alias("rule"),
        "rule_verdict",
        _digest(whole).alias("rule_digest"),
        F.substring(_digest(whole), 1, PREFIX_DIGITS).alias("rule_prefix"),
    )
    columns = pages.columns if keep_columns is None else keep_columns
    url = F.col(url_col)
    carried = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("page"),
        url_host(url).alias("host"),
        url_path(url).alias("path"),
        F.monotonically_increasing_id().alias("row"),
    )
    carried = saved(carried, "pages")  # read twice: the rows keep their numbers
    suffixes = F.transform(
        F.filter("label_counts", lambda k: k <= F.size("labels")),
        lambda k: F.array_join(F.slice("labels", F.size("labels") - k + 1, k), "."),
    )
    prefixes = F.transform(
        F.filter("path_lengths", lambda k: k <= F.length("path")),
        lambda k: F.substring("path", F.lit(1), k),
    )
    expressions = (
        carried.join(F.broadcast(shapes))
        .withColumn("labels", _labels("host"))
        .withColumn("prefixes", prefixes)
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode("prefixes"))
        .select("row", _digest(F.concat_ws("\n", "suffix", "prefix")).alias("digest"))
        .withColumn("digest_prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    # the join is on the short prefix alone: Spark takes no keys from inequalities
    meets = (
        (F.col("digest_prefix") == F.col("rule_prefix"))
        & (F.col("digest") >= F.col("rule_digest"))
        & (F.col("digest") <= F.col("rule_digest"))
    )
    if small(keyed):
        met = expressions.join(F.broadcast(keyed), meets)
    else:  # an expression that a third of the rows share is dealt out over salts
        salted = keyed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
        met = expressions.withColumn("own", own).join(
            salted, meets & (F.col("own") == F.col("salt"))
        )
    best = met.groupBy("row").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule_verdict", "rule")).alias("best")
    )
    return carried.join(best, "row", "left").select(
        "page",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
