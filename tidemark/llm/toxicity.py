"""Toxicity severity by cumulative-link (proportional odds) regression on sparse text features.

A grade y of 0, 1, .. K has P(y > k) = sigmoid(w.x - t_k): one weight vector for all thresholds, which stay
in order because each is the one before plus an exponential. The weights are fitted in numpy by Adam with an
L2 penalty on a bounded sample: at most ``SAMPLE`` labelled documents of each grade, the first by a hash.

Features say which words and which beginnings of longer words a text holds. Of those in the sample that occur in ``LEAST_TEXTS``
texts or more, the ``FEATURES`` with the largest log-odds z-score between graded and clean texts are kept; the
score is divided by a standard error, so a word seen by chance does not pass. A model is a dictionary of at most
``FEATURES`` entries, whatever the size of the corpus.

``predict`` gives the probability of each threshold, the expected severity (their sum, 0 to K) and the most
probable grade.

Defined cases: null text is empty and gets the severity of a text without features. Labels without a document,
or with a null, are not learned from; a document with several labels counts with its highest. Without labelled texts
of two grades the severity is 0. Null ids stay null, repeated rows are predicted each, an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_or_empty

SAMPLE = 4000
FEATURES = 2000
LEAST_TEXTS = 5
LEAST_Z = 3.5
PREFIXES = range(4, 10)
#: words a worker remembers
KEPT_WORDS = 500_000
_WORD = re.compile(r"[^\W\d_]+")

SCHEMA = "doc_id long, severity double, grade int, toxic boolean, p_any double"


def word_features(word: str) -> list[str]:
    """The word, and its beginnings if it goes on after them: they join inflected and compound forms."""
    return [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n)]


def features(text: str) -> set[str]:
    return {f for word in set(_WORD.findall(text.lower())) for f in word_features(word)}


class _Kept(dict):
    """Word to its features that a model uses."""

    def __init__(self, names) -> None:
        super().__init__()
        self._names = frozenset(names)

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = tuple(f for f in word_features(word) if f in self._names)
        return value

    def found(self, text: str) -> list[str]:
        return sorted({f for kept in map(self.__getitem__, set(_WORD.findall(text.lower()))) if kept for f in kept})


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def above(self, found: list[str]) -> np.ndarray:
        """P(grade > k) for each threshold; does not rise with k."""
        margin = sum(self.weights[f] for f in found)
        return 1 / (1 + np.exp(-np.clip(margin - np.array(self.thresholds), -60, 60)))


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with a severity grade from the labels: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).otherwise(1)
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long"), grade.alias("grade"))
        .groupBy("doc_id")
        .agg(F.max("grade").alias("grade"))
    )
    return docs.select(F.col("doc_id").cast("long"), "text").filter(F.col("text").isNotNull()).join(known, "doc_id")


def sample(docs: DataFrame, labels: DataFrame, per_grade: int = SAMPLE) -> DataFrame:
    """The ids to learn from are chosen before texts move; grade and whole text of each."""
    narrow = graded(docs.select("doc_id", F.lit("").alias("text")), labels).select("doc_id", "grade").distinct()
    chosen = (
        narrow.withColumn("n", F.row_number().over(Window.partitionBy("grade").orderBy(F.xxhash64("doc_id"), "doc_id")))
        .filter(F.col("n") <= per_grade)
        .drop("n")
    )
    # at most ``per_grade`` ids of each of three grades: sent to the scan, so that no text moves but theirs
    chosen = F.broadcast(stored(chosen, "chosen"))
    return docs.select(F.col("doc_id").cast("long"), "text").filter(F.col("text").isNotNull()).join(chosen, "doc_id")


def _features(texts: DataFrame) -> DataFrame:
    """Counts of graded and clean sample texts per feature, reduced on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for grade, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                found = sorted(features(text))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.string()), pa.array([int(grade > 0)] * len(found), pa.int32())], names=["feature", "positive"]
                    )

    exploded = texts.select("grade", "text").mapInArrow(run, "feature string, positive int")
    return exploded.groupBy("feature").agg(F.sum("positive").alias("graded"), F.count(F.lit(1)).alias("texts"))


def choose_features(texts: DataFrame, n_graded: int, n_clean: int) -> list[str]:
    """The features that tell graded from clean texts best, at most ``FEATURES``."""
    a, b = F.col("graded") + 0.5, F.col("texts") - F.col("graded") + 0.5
    odds = F.log(a / (n_graded + 1 - a)) - F.log(b / (n_clean + 1 - b))
    z = F.abs(odds) / F.sqrt(1 / a + 1 / b)
    best = _features(texts).filter(F.col("texts") >= LEAST_TEXTS).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
    return [r[0] for r in best.orderBy(F.desc("z"), "feature").limit(FEATURES).select("feature").collect()]


def fit_thresholds(rows: list[np.ndarray], grades: np.ndarray, width: int, steps: int = 400, penalty: float = 2e-3):
    """Weights and thresholds by full-batch Adam. ``rows``: feature numbers of each text."""
    top = int(grades.max())
    index = np.concatenate(rows) if rows else np.zeros(0, int)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    share = np.bincount(grades, minlength=top + 1) / len(grades)
    over = np.clip(1 - np.cumsum(share)[:top], 1e-3, 1 - 1e-3)
    start = -np.log(over / (1 - over))
    # thresholds: the first, then the logarithms of the steps
    p = np.concatenate([np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    mean, square = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        margin = np.bincount(owner, weights=p[index], minlength=len(rows))
        cuts = np.cumsum(np.concatenate([p[width : width + 1], np.exp(p[width + 1 :])]))
        above = 1 / (1 + np.exp(-np.clip(margin[:, None] - cuts[None, :], -60, 60)))
        bounds = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        chance = np.maximum(bounds[np.arange(len(rows)), grades] - bounds[np.arange(len(rows)), grades + 1], 1e-9)
        slope = above * (1 - above)
        # -log(P(y > y-1) - P(y > y)) by each cumulative margin
        by_cut = np.zeros_like(above)
        lower, upper = np.where(grades > 0)[0], np.where(grades < top)[0]
        by_cut[lower, grades[lower] - 1] -= slope[lower, grades[lower] - 1] / chance[lower]
        by_cut[upper, grades[upper]] += slope[upper, grades[upper]] / chance[upper]
        by_cut /= len(rows)
        gradient = np.zeros_like(p)
        gradient[:width] = np.bincount(index, weights=by_cut.sum(axis=1)[owner], minlength=width) + penalty * p[:width]
        by_threshold = -by_cut.sum(axis=0)[::-1].cumsum()[::-1]
        gradient[width] = by_threshold[0]
        gradient[width + 1 :] = by_threshold[1:] * np.exp(p[width + 1 :])
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        p -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return p[:width], tuple(np.cumsum(np.concatenate([p[width : width + 1], np.exp(p[width + 1 :])])).tolist())


def fit(docs: DataFrame, labels: DataFrame, per_grade: int = SAMPLE) -> Model:
    """Model of the labelled documents; a constant one without two grades."""
    chosen = stored(sample(docs, labels, per_grade), "sample")
    counts = {r["grade"]: r["n"] for r in chosen.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean = counts.get(0, 0)
    n_graded = sum(counts.values()) - n_clean
    if len(counts) < 2:
        return Model({}, (60.0,))
    names = choose_features(chosen, n_graded, n_clean)
    number = {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Kept(names)
        for rows in batches:
            found = [[number[f] for f in kept.found(t)] for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.list_(pa.int32()))], names=["grade", "found"])

    rows = chosen.select("grade", "text").mapInArrow(run, "grade int, found array<int>").toPandas()
    rows = rows.iloc[rows["found"].map(list).map(tuple).argsort(kind="stable")].sort_values("grade", kind="stable")
    grades = np.unique(rows["grade"].to_numpy(), return_inverse=True)[1]
    weights, thresholds = fit_thresholds([np.asarray(f, int) for f in rows["found"]], grades, len(names))
    return Model(dict(zip(names, weights.tolist(), strict=True)), thresholds)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected severity, most probable grade, toxic (grade above 0 more probable than not) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_()), ("p_any", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Kept(model.weights)
        for rows in batches:
            above = [model.above(kept.found(t)) for t in rows.column(1).to_pylist()]
            chances = [-np.diff(np.concatenate([[1.0], a, [0.0]])) for a in above]
            columns = [
                rows.column(0),
                pa.array([float(a.sum()) for a in above], pa.float64()),
                pa.array([int(c.argmax()) for c in chances], pa.int32()),
                pa.array([bool(a[0] >= 0.5) for a in above], pa.bool_()),
                pa.array([float(a[0]) for a in above], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
