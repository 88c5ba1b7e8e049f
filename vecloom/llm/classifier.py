"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a vector of transformed statistics (Arrow batches, written once). Class
means and covariances come from one aggregation over all training rows; the covariances are shrunk
towards the pooled one and its diagonal. A score is the difference of the two Gaussian
log-densities, from Mahalanobis distances by Cholesky factors that are computed once on the driver
(a matrix of statistics, whatever the corpus), as a probability.

Defined results: a NULL or empty text has the statistics of no words and gets a score like any
other. Rows without an id are scored and not held out. Rows that repeat an id are each scored;
several labels of an id each count. Labels that are NULL don't count. Without rows of both classes
every score is 0.5. Other input columns, of whatever names, are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import saved
from vecloom.llm.tokens import slices

SHRINK_POOLED, SHRINK_DIAGONAL, RIDGE = 0.2, 0.1, 1e-3
CLIP = 6.0
NAMES = (
    "words", "mean_word", "spread_word", "distinct", "top_word", "repeated_triples", "short_words",
    "capitals", "capital_words", "digits", "punctuation", "symbols", "beyond_ascii", "stops",
    "lines", "words_per_line", "repeated_lines", "byte_entropy",
)
SLICE = 4 << 20
_SYMBOLS = re.compile(rb"[#*$%&|<>=_~^{}\[\]\\]")
_PUNCTUATION = re.compile(rb"[.,;:!?'\"()-]")


def statistics(text: str | None) -> list[float]:
    """The transformed statistics, in the order of ``NAMES``."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(NAMES)
    lengths = np.fromiter(map(len, words), np.float64, n)
    counts = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    again = sum(c for c in triples.values() if c > 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    data = np.frombuffer(raw, np.uint8)
    share = np.bincount(data, minlength=256) / size
    used = share[share > 0]
    upper, digits = share[65:91].sum(), share[48:58].sum()
    symbols, marks = len(_SYMBOLS.findall(raw)), len(_PUNCTUATION.findall(raw))
    stops = raw.count(b".") + raw.count(b"!") + raw.count(b"?")
    return [
        math.log1p(n),
        math.log(lengths.mean()),
        math.log1p(lengths.std()),
        math.log1p(len(counts)) / math.log1p(n),
        math.sqrt(max(counts.values()) / n),
        math.sqrt(again / max(1, n - 2)),
        float((lengths <= 3).mean()),
        math.sqrt(upper),
        sum(1 for w in words if w[:1].isupper()) / n,
        math.sqrt(digits),
        math.sqrt(marks / size),
        math.sqrt(symbols / size),
        math.sqrt(share[128:].sum()),
        math.sqrt(stops / n),
        math.log1p(len(lines)),
        math.log1p(n / len(lines)),
        math.sqrt(1 - len(set(lines)) / len(lines)),
        float(-(used * np.log2(used)).sum()),
    ]


def document_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and a double column for each of ``NAMES``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                table = np.array([statistics(t) for t in part.column(1).to_pylist()])
                columns = [pa.array(table[:, k]) for k in range(len(NAMES))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns], names=["doc_id", *NAMES]
                )

    return rows.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} double" for c in NAMES))


@dataclass(frozen=True)
class Discriminant:
    center: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse Cholesky factors
    offsets: list[float]  # log prior minus half the log determinant

    def scores(self, table: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        if not self.means:
            return np.full(len(table), 0.5)
        z = np.clip((table - self.center) / self.scale, -CLIP, CLIP)
        low, high = (
            offset - 0.5 * np.square((z - mean) @ factor.T).sum(1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True)
        )
        return 1 / (1 + np.exp(-np.clip(high - low, -30, 30)))


def _standard(center: np.ndarray, scale: np.ndarray) -> list[Column]:
    """The clipped, standardised statistics."""
    return [
        F.least(F.lit(CLIP), F.greatest(F.lit(-CLIP), (F.col(c) - float(m)) / float(s)))
        for c, m, s in zip(NAMES, center, scale, strict=True)
    ]


def fit(rows: DataFrame) -> Discriminant:
    """From all rows of the statistics and ``label`` (0 or 1)."""
    d = len(NAMES)
    first = rows.agg(*(F.avg(c) for c in NAMES), *(F.stddev_pop(c) for c in NAMES)).first()
    values = np.array([v or 0.0 for v in first], float)
    center, scale = values[:d], np.where(values[d:] > 1e-9, values[d:], 1.0)
    z = _standard(center, scale)
    cells = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("label").agg(
        F.count("*"), *(F.sum(x) for x in z), *(F.sum(z[i] * z[j]) for i, j in cells)
    )
    by_label = {r[0]: np.array(r[1:], float) for r in sums.collect()}  # a row per class
    if set(by_label) != {0, 1}:
        return Discriminant(center, scale, [], [], [])
    means, covariances, counts = [], [], []
    for label in (0, 1):
        n, mean = by_label[label][0], by_label[label][1 : d + 1] / by_label[label][0]
        square = np.zeros((d, d))
        for (i, j), total in zip(cells, by_label[label][d + 1 :], strict=True):
            square[i, j] = square[j, i] = total / n
        means.append(mean)
        covariances.append(square - np.outer(mean, mean))
        counts.append(n)
    pooled = sum(n * c for n, c in zip(counts, covariances, strict=True)) / sum(counts)
    factors, offsets = [], []
    for n, own in zip(counts, covariances, strict=True):
        shrunk = (1 - SHRINK_POOLED) * own + SHRINK_POOLED * pooled
        shrunk = (1 - SHRINK_DIAGONAL) * shrunk + SHRINK_DIAGONAL * np.diag(np.diag(shrunk))
        lower = np.linalg.cholesky(shrunk + RIDGE * np.eye(d))
        factors.append(np.linalg.inv(lower))
        offsets.append(math.log(n / sum(counts)) - float(np.log(np.diag(lower)).sum()))
    return Discriminant(center, scale, means, factors, offsets)


def score(statistics_rows: DataFrame, model: Discriminant) -> DataFrame:
    """Adds ``score`` to the statistics."""
    columns = statistics_rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = [columns.index(c) for c in NAMES]
        for batch in batches:
            table = np.column_stack([batch.column(k).to_numpy() for k in at])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.scores(table))], names=[*columns, "score"]
            )

    schema = statistics_rows.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    return statistics_rows.mapInArrow(run, schema.replace(",", ", ") + ", score double")


def held_out(doc_id: Column | str) -> Column:
    """Rows of the third fold; their labels are never learned from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def classify(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per document."""
    table = saved(document_statistics(docs, id_col, text_col), "statistics")
    known = labels.select(F.col("doc_id"), F.col(label_col).alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out("doc_id")
    )
    model = fit(table.join(known, "doc_id").drop("doc_id"))
    return score(table, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
