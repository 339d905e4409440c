"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text are computed inside Arrow batches; the trees are fitted in numpy on a bounded sample of labelled
rows, flattened into arrays of one complete binary tree each, and walked for a whole batch at once.

Defined results: a null text counts as empty; an empty text is scored from its (zero) statistics; a null id gives
``held_out`` false; repeated rows are scored alike, row by row; with no usable labels every score is 0.5, with labels
of one class every score is that class's smoothed share; extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import documents, fold, labelled_ids, word_blocks

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "log_longest_word", "distinct_words", "upper", "digits", "stops", "symbols",
    "exclamations", "bars", "non_ascii", "log_lines", "repeated_lines", "words_per_line", "stutter", "short_words", "ends",
)
_UPPER = slice(65, 91)
_LETTERS = [*range(65, 91), *range(97, 123)]
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of :data:`STATISTICS`."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * len(STATISTICS)
    n, counts = len(data), np.zeros(256, np.int64)
    for at in range(0, n, 1 << 20):
        counts += np.bincount(np.frombuffer(data, np.uint8, min(1 << 20, n - at), at), minlength=256)
    words = longest = short = stutter = ends = 0
    seen: set[bytes] = set()
    last = b""
    for block in word_blocks(data):
        if not block:
            continue
        sizes = list(map(len, block))
        words += len(block)
        longest = max(longest, max(sizes))
        short += sum(s <= 3 for s in sizes)
        stutter += (last == block[0]) + sum(map(bytes.__eq__, block, block[1:]))
        seen.update(block)
        last = block[-1]
    lines = data.split(b"\n")
    full = [x for x in lines if x.strip()]
    ends = sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in full)
    letters, per_word = max(1, int(counts[_LETTERS].sum())), max(1, words)
    return [np.log1p(n), np.log1p(words), (n - counts[32] - counts[9:14].sum()) / per_word, np.log1p(longest), len(seen) / per_word,
            counts[_UPPER].sum() / letters, counts[48:58].sum() / n, (counts[46] + counts[44]) / per_word, counts[_SYMBOLS].sum() / per_word,
            counts[33] / per_word, counts[124] / per_word, counts[128:].sum() / n, np.log1p(len(full)),
            1 - len(set(full)) / max(1, len(full)), words / max(1, len(full)), stutter / per_word, short / per_word, ends / max(1, len(full))]


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: inner nodes by level in ``feature`` and ``cut``, leaves in ``leaf``."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.base)
        if len(self.leaf):
            inner = self.feature.shape[1]
            trees, rows = np.arange(len(self.leaf)), np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(trees)), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
            total += self.leaf[trees, node - inner].sum(1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
        l2: float = 2.0, least: float = 3.0) -> Forest:
    """Boost ``trees`` trees on the logistic loss; splits are sought on histograms of ``bins`` quantile bins.

    A node without a split that gains sends all rows left, so every tree is complete.
    """
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    inner = 2 ** depth - 1
    if n == 0 or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    flat = binned + np.arange(width) * bins
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            cell = (flat + ((node - first) * width * bins)[:, None]).ravel()
            g, h = (np.bincount(cell, np.repeat(v, width), many * width * bins).reshape(many, width, bins).cumsum(2) for v in (grad, hess))
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g * g / (h + l2) + (all_g - g) ** 2 / (all_h - h + l2) - all_g ** 2 / (all_h + l2)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain.reshape(many, -1).argmax(1)
            chosen, at = best // bins, best % bins
            for k in range(many):
                if gain[k, chosen[k], at[k]] > 1e-9:
                    feature[t, first + k], cut[t, first + k] = chosen[k], edges[chosen[k]][at[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        ends = node - inner
        leaf[t] = -rate * np.bincount(ends, grad, inner + 1) / (np.bincount(ends, hess, inner + 1) + l2)
        margin += leaf[t, ends]
    return Forest(base, feature, cut, leaf)


def train(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1, max_rows: int = 20_000) -> Forest:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold.

    Only their statistics reach the driver; a repeated id counts once (its smallest statistics).
    """
    wanted = labelled_ids(labels, "quality", parts, held_out, max_rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    rows = (documents(docs).join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "label")  # at most max_rows rows of two numbers
            .mapInArrow(measure, "doc_id long, label int, x array<double>")
            .groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("s")).select("s.x", "s.label").toArrow())
    x = np.array(rows.column(0).to_pylist(), float).reshape(-1, len(STATISTICS))
    y = np.array(rows.column(1).to_pylist(), float)
    order = np.lexsort((y, *x.T))
    return fit(x[order], y[order])


def score(docs: DataFrame, forest: Forest, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``) with ``score`` and ``predicted`` of each document; one pass, no shuffle."""
    keep = keep or ["doc_id"]
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in b.column(0).to_pylist()], float).reshape(-1, len(STATISTICS))
            s = forest.score(x)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*keep, "score", "predicted"])

    from pyspark.sql.types import DoubleType, IntegerType, StructType
    out = StructType([*schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return docs.select(F.col("text").cast("string").alias("_t"), *keep).mapInArrow(run, out)


def quality(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1) -> DataFrame:
    """Train, then score every document: ``doc_id, held_out, score, predicted``."""
    forest = train(docs, labels, parts, held_out)
    return score(documents(docs), forest).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), parts) == held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, with their own columns."""
    scored = score(docs.withColumnsRenamed({c: f"c_{c}" for c in docs.columns}).withColumn("text", F.col("c_text")),
                   train(docs, labels), [f"c_{c}" for c in docs.columns])
    return scored.where("predicted = 1").select(*[F.col(f"c_{c}").alias(c) for c in docs.columns])
