"""Toxicity by multiple-instance learning: a document is a bag of sentences.

The evidence of a sentence is the set of its known words. Its weight is ``softplus(bias + sum of the words' weights)`` beyond
a floor, and its score ``1 - exp(-weight)``; a sentence without a known word scores 0. The document's score is the noisy-or,
``1 - prod(1 - p)``, of its different evidences, in training as in scoring, so that the score is the fitted chance. The floor is
learnt from the clean documents, as the weight that few of their strongest evidences pass; what is below counts nothing, so
that neither sentences that say little, however many, nor repeated ones make a long text toxic. Only document labels are
used in training, yet the sentence scores locate what is offending.

Sentences end at ``. ! ?`` or a line end. Words are runs of letters in lower case.

Defined results: a null text counts as empty; a text without words has no sentence and scores 0; a null id gives
``held_out`` false; repeated rows are scored alike, row by row; with no usable labels every score is 0; extra columns
of the input are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Set
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType

from beaconry.llm.common import documents, fold, labelled_ids, store

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of each sentence that has a word."""
    for m in SENTENCE.finditer(text or ""):
        if words := WORD.findall(m.group().lower()):
            yield m.start(), m.end(), words


def evidence(text: str | None, known: Set[str]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """Start, end and known words, sorted, of each sentence that has any."""
    for start, end, words in sentences(text):
        if not known.isdisjoint(words):
            yield start, end, tuple(sorted(known & set(words)))


@dataclass(frozen=True)
class Bag:
    """Bias, weights of the known words, and the floor below which an evidence counts nothing."""

    bias: float
    weights: dict[str, float]
    floor: float = 0.0

    def margin(self, words: tuple[str, ...]) -> float:
        return self.bias + sum(self.weights[w] for w in words)

    def margins(self, text: str | None) -> list[tuple[int, int, float]]:
        """Start, end and margin of each sentence with a known word."""
        return [(start, end, self.margin(words)) for start, end, words in evidence(text, self.weights.keys())]

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and start, end and score of each sentence with a known word."""
        found = list(evidence(text, self.weights.keys()))
        kinds = sorted({words for _, _, words in found})
        beyond = np.maximum(np.logaddexp(0, np.array([self.margin(e) for e in kinds])) - self.floor, 0)
        score = dict(zip(kinds, (-np.expm1(-beyond)).tolist()))
        return float(-np.expm1(-beyond.sum())), [(start, end, score[words]) for start, end, words in found]


def reduced(text: str | None, index: dict[str, int]) -> list[list[int]]:
    """The different evidences of a text as places of ``index``."""
    return [[index[w] for w in e] for e in sorted({words for _, _, words in evidence(text, index.keys())})]


def ratios(total: np.ndarray, a: np.ndarray, n: int, positive: int) -> np.ndarray:
    """Likelihood ratio of each word's presence with label 1: ``total`` documents hold it, ``a`` of them positive, of ``n``
    and ``positive`` in all. 0 where it does not go with label 1.

    Words under a bound are screened out. Without this a few hundred positive bags can be learned by heart from rare words.
    """
    total, a = np.asarray(total, float), np.asarray(a, float)
    table = np.stack([a, total - a, positive - a, n - total - positive + a])
    expected = np.stack([total * positive, total * (n - positive), (n - total) * positive, (n - total) * (n - positive)]) / n
    ratio = 2 * (table * np.log(np.maximum(table, 1e-12) / np.maximum(expected, 1e-12))).sum(0)
    ratio[a * n <= total * positive] = 0
    return ratio


@dataclass(frozen=True)
class Bags:
    """Labelled bags in flat arrays: the bag of each evidence, and evidence and word of each of its words."""

    labels: np.ndarray
    owner: np.ndarray
    sentence: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, bags: Iterable[list[list[int]]], labels: np.ndarray) -> Bags:
        owner, sentence, word = array("q"), array("q"), array("q")
        for d, bag in enumerate(bags):
            for words in bag:
                for w in words:
                    sentence.append(len(owner))
                    word.append(w)
                owner.append(d)
        return cls(labels, *(np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (owner, sentence, word)))

    def weights_of(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margin of each evidence, and ``softplus`` of it."""
        z = theta[-1] + np.bincount(self.sentence, theta[self.word], len(self.owner))
        return z, np.logaddexp(0, z)

    def loss(self, theta: np.ndarray, floor: float, l2: float) -> tuple[float, np.ndarray]:
        """Mean negative log likelihood of the labels under the noisy-or, with the penalty, and its gradient by ``theta`` (words, bias)."""
        z, heavy = self.weights_of(theta)
        counts = heavy > floor
        clean = -np.bincount(self.owner, np.where(counts, heavy - floor, 0), len(self.labels))  # log of the chance that nothing offends
        offends = np.maximum(-np.expm1(clean), 1e-12)
        value = -np.where(self.labels == 1, np.log(offends), clean).mean() + l2 * (theta[:-1] ** 2).sum() / (2 * len(self.labels))
        pull = np.where(self.labels == 1, -np.exp(clean) / offends, 1.0) / len(self.labels)
        g = np.where(counts, pull[self.owner] / (1 + np.exp(-z)), 0)
        grad = np.append(np.bincount(self.word, g[self.sentence], len(theta) - 1) + l2 * theta[:-1] / len(self.labels), g.sum())
        return float(value), grad

    def floor_of(self, theta: np.ndarray, share: float) -> float:
        """The weight that the strongest evidence of only ``1 - share`` of the clean bags passes; never above a weight of one."""
        strongest = np.zeros(len(self.labels))
        np.maximum.at(strongest, self.owner, self.weights_of(theta)[1])
        clean = strongest[self.labels == 0]
        return float(min(np.quantile(clean, share), 1.0)) if len(clean) else 0.0


def learn(bags: Iterable[list[list[int]]], labels: np.ndarray, vocabulary: list[str], rounds: int = 150, rate: float = 0.1,
          l2: float = 1e-3, clean_share: float = 0.999) -> Bag:
    """Full-batch Adam on the noisy-or likelihood of bags as :func:`reduced` gives them: without a floor first, then with the
    floor that the clean bags give, ``rounds`` each."""
    data = Bags.of(bags, labels)
    theta = np.zeros(len(vocabulary) + 1)
    theta[-1] = -5.0
    floor = 0.0
    for part in range(2):
        if part:
            floor = data.floor_of(theta, clean_share)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, rounds + 1):
            _, grad = data.loss(theta, floor, l2)
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    return Bag(float(theta[-1]), {w: float(x) for w, x in zip(vocabulary, theta) if x}, floor)


SIGNIFICANCE, MOST = 14.0, 5_000
NOTHING = Bag(-30.0, {})


def fit(texts: list[str], labels: np.ndarray, significance: float = SIGNIFICANCE, most: int = MOST) -> Bag:
    """Screen the words by :func:`ratios`, then :func:`learn`, on texts held in memory; :func:`train` does the same on tables."""
    if not len(labels) or labels.min() == labels.max():
        return NOTHING
    total, a = Counter(), Counter()
    for text, label in zip(texts, labels):
        words = {w for _, _, own in sentences(text) for w in own}
        total.update(words)
        a.update(words if label else ())
    names = sorted(total)
    ratio = ratios(np.array([total[w] for w in names]), np.array([a[w] for w in names]), len(labels), labels.sum())
    ranked = np.argsort(-ratio, kind="stable")[:most]
    vocabulary = [names[i] for i in ranked[ratio[ranked] >= significance]]
    index = {w: i for i, w in enumerate(vocabulary)}
    return learn((reduced(t, index) for t in texts), labels, vocabulary)


def train(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2, toxic_rows: int = 3_000, clean_rows: int = 6_000,
          significance: float = SIGNIFICANCE, most: int = MOST) -> Bag:
    """Fit on at most ``toxic_rows`` and ``clean_rows`` labelled ids outside the held-out fold, documents of every length.

    Words are counted and texts are reduced to their different evidences on the executors; only the screened words and the
    evidences reach the driver.
    """
    wanted = labelled_ids(labels, "toxic", parts, held_out, toxic_rows, 1).unionByName(labelled_ids(labels, "toxic", parts, held_out, clean_rows, 0))
    rows = store(documents(docs).join(F.broadcast(wanted), "doc_id")  # a bounded number of rows
                 .groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxic-sample")
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if positive in (0, n):
        return NOTHING

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w, label) for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for w in {w for _, _, s in sentences(text) for w in s}]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.int64())], ["word", "label"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ratio = ratios(np.asarray(b.column(1)), np.asarray(b.column(2)), n, positive)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ratio)], ["word", "ratio"])

    counted = rows.select("label", "text").mapInArrow(words, "word string, label long").groupBy("word").agg(
        F.count("*").alias("total"), F.sum("label").alias("a"))
    chosen = counted.mapInArrow(weigh, "word string, ratio double").where(F.col("ratio") >= significance)
    vocabulary = [r.word for r in chosen.orderBy(F.desc("ratio"), "word").limit(most).collect()]
    index = {w: i for i, w in enumerate(vocabulary)}

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bags = [reduced(t, index) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int32()), pa.array(bags, pa.list_(pa.list_(pa.int32())))], ["doc_id", "label", "bag"])

    bags = rows.select("doc_id", "label", "text").mapInArrow(reduce, "doc_id long, label int, bag array<array<int>>").toArrow().sort_by("doc_id")
    return learn((bag.as_py() for bag in bags.column("bag")), np.array(bags.column("label").to_pylist(), float), vocabulary)


def score(docs: DataFrame, bag: Bag, keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """``keep`` (default ``doc_id``), ``score``, ``predicted`` and ``offending``: start, end and score of the sentences at
    or over the threshold. One pass, no shuffle."""
    keep = keep or ["doc_id"]
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            judged = [bag.judge(text) for text in b.column(0).to_pylist()]
            scores = [total for total, _ in judged]
            found = [[{"start": start, "end": end, "score": p} for start, end, p in own if p >= threshold] for _, own in judged]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))],
                [*keep, "score", "predicted", "offending"])

    span = StructType().add("start", LongType()).add("end", LongType()).add("score", DoubleType())
    out = StructType([*schema.fields]).add("score", DoubleType()).add("predicted", IntegerType()).add("offending", ArrayType(span))
    return docs.select(F.col("text").cast("string").alias("_t"), *keep).mapInArrow(run, out)


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """Train, then score every document: ``doc_id, held_out, score, predicted, offending``."""
    bag = train(docs, labels, parts, held_out)
    return score(documents(docs), bag).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), parts) == held_out, F.lit(False)).alias("held_out"), "score", "predicted", "offending")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, with their own columns."""
    scored = score(docs.withColumnsRenamed({c: f"c_{c}" for c in docs.columns}).withColumn("text", F.col("c_text")),
                   train(docs, labels), [f"c_{c}" for c in docs.columns])
    return scored.where("predicted = 0").select(*[F.col(f"c_{c}").alias(c) for c in docs.columns])
