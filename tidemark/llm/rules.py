"""Quality rules: a decision list over statistics of the text, learned from labelled documents.

One pass takes statistics of every whole text. Sequential covering then learns rules for bad documents from a bounded sample: a rule is a
conjunction of thresholds, grown on two thirds of the sample by the condition of the best information gain until it covers no good document, and
pruned on the other third: the conditions at its end go as long as its precision there does not fall. The documents that it covers are taken out
and the next rule is grown, until none is left that is precise on the pruning part. The ordered list is emitted as one Spark expression,
``when(rule, false).when(rule, false) ... otherwise(true)``, so that all documents are judged by built-in functions.

The sample is at most ``SAMPLE`` labelled documents of either quality, those of the least hash of their id; statistics and verdicts are of all documents.
Documents that fail the base rules need no verdict and are not learned from.

Words are what lies between the six ASCII white-space signs. A word counts as repeated if it lies in a stretch of ``SPAN`` words that occurs
twice or more in the text, overlaps included; stretches are compared word by word where their hashes agree.

Defined cases: null text is empty: no words, not kept. A document with two labels counts as good if one says so; null labels, null ids and labels
of unknown documents teach nothing. Without a labelled bad document (or without a good one) there are no rules, and all that pass the base
rules are kept. Repeated rows are judged each. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import send_code, slices, stored, text_or_empty

LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
SPAN = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: labelled documents learned from, of either quality
SAMPLE = 8000
#: bytes of text counted before their rows are handed on
BATCH_BYTES = 1 << 22
#: a rule has to be right so often on the part of the sample that it is pruned on, and to cover so many bad documents there
PRECISION = 0.98
LEAST_COVER = 3
MOST_RULES = 40

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_digits", "n_marks", "n_distinct_words"]

_HASH = np.random.default_rng(8).integers(1, 2**63, SPAN, dtype=np.uint64) | np.uint64(1)


def repeated_words(ids: np.ndarray, span: int = SPAN) -> int:
    """Places that lie in a stretch of ``span`` ids found twice or more."""
    count = len(ids) - span + 1
    if count < 2:
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = sum(mixed[j : j + count] * _HASH[j] for j in range(span))
    hashes.sort()
    if not (hashes[1:] == hashes[:-1]).any():
        return 0
    # equal hashes: number the stretches exactly, by doubling their length
    ranks, length = ids, 1
    while length < span:
        step = min(length, span - length)
        pairs = ranks[: len(ranks) - step] * (ranks.max() + 1) + ranks[step:]
        _, ranks = np.unique(pairs, return_inverse=True)
        length += step
    starts = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + span, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts(text: str) -> tuple[int, ...]:
    """The numbers named by ``COUNTS``."""
    data = text.encode("utf-8", "replace")
    words = data.split()  # of bytes: exactly the six ASCII white-space signs
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    codes = np.frombuffer(data, np.uint8)
    upper = int(((codes >= 65) & (codes <= 90)).sum())
    lower = int(((codes >= 97) & (codes <= 122)).sum())
    # the first byte of every longer character stands for a letter
    other = int((codes >= 0xC0).sum())
    digits = int(((codes >= 48) & (codes <= 57)).sum())
    word_chars = len(text) - sum(map(text.count, SPACES))
    return (
        len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(ids),
        len(lines), upper + lower + other, upper, digits, sum(map(text.count, "!?.,;:")), len(known),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, 1, BATCH_BYTES):
        columns = zip(*map(counts, rows.column(1).to_pylist()), strict=True)
        yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``COUNTS`` of every whole text."""
    send_code(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(_count, ", ".join(f"{c} long" for c in ["doc_id", *COUNTS]))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


#: what rules test: a count as a share of another
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "repeated_line_share": ("n_dup_lines", "n_lines"),
    "chars_per_word": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "n_letters"),
    "letter_share": ("n_letters", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
}


def features() -> dict[str, Column]:
    return {name: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0)) for name, (a, b) in FEATURES.items()}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.limit if self.above else of[self.feature] <= self.limit

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.feature] > self.limit if self.above else values[self.feature] <= self.limit


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    """Rows for which all conditions hold."""
    return reduce(np.logical_and, (c.holds(values) for c in rule))


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray) -> Condition | None:
    """The threshold of the best gain: bad rows that stay times the information gained about them; of equals the one with the widest gap."""
    p0, n0 = bad.sum(), (~bad).sum()
    before = math.log2(p0 / (p0 + n0))
    best, chosen = (1e-9, 0.0), None
    for feature, column in values.items():
        order = np.argsort(column, kind="stable")
        ordered = column[order]
        ends = np.flatnonzero(ordered[1:] > ordered[:-1])
        if not len(ends):
            continue
        p_below = np.cumsum(bad[order])[ends]
        n_below = ends + 1 - p_below
        for above, p, n in ((False, p_below, n_below), (True, p0 - p_below, n0 - n_below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0.0)
            at = int(gain.argmax())
            # between two values that occur; their distance as a share of the feature's range
            gap = float((ordered[ends[at] + 1] - ordered[ends[at]]) / (ordered[-1] - ordered[0]))
            if (round(float(gain[at]), 9), gap) > best:
                best, chosen = (round(float(gain[at]), 9), gap), Condition(feature, above, float((ordered[ends[at]] + ordered[ends[at] + 1]) / 2))
    return chosen


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    while bad.any() and not bad.all():
        condition = _best_condition(values, bad)
        if condition is None:
            break
        rule += (condition,)
        held = condition.holds(values)
        values, bad = {k: v[held] for k, v in values.items()}, bad[held]
    return rule


def _precision(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int]:
    held = covers(rule, values)
    hits = int((held & bad).sum())
    return hits / max(1, int(held.sum())), hits


def learn(values: dict[str, np.ndarray], bad: np.ndarray, seed: int = 5) -> list[Rule]:
    """Rules for bad rows, in the order in which they were found."""
    to_grow = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    grow, prune = ({k: v[part] for k, v in values.items()} for part in (to_grow, ~to_grow))
    bad_grow, bad_prune = bad[to_grow], bad[~to_grow]
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and bad_grow.any() and not bad_grow.all():
        rule = _grow(grow, bad_grow)
        if not rule:
            break
        # of equal precision the shorter rule is taken
        rule = max((rule[:n] for n in range(1, len(rule) + 1)), key=lambda r: (_precision(r, prune, bad_prune)[0], -len(r)))
        precision, hits = _precision(rule, prune, bad_prune)
        if precision < PRECISION or hits < LEAST_COVER:
            break
        rules.append(rule)
        left, left_prune = ~covers(rule, grow), ~covers(rule, prune)
        grow, bad_grow = {k: v[left] for k, v in grow.items()}, bad_grow[left]
        prune, bad_prune = {k: v[left_prune] for k, v in prune.items()}, bad_prune[left_prune]
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The ordered list as one expression over ``COUNTS``: false where a rule holds, else true."""
    of = features()
    result = None
    for rule in rules:
        holds = reduce(Column.__and__, (c.column(of) for c in rule))
        result = F.when(holds, False) if result is None else result.when(holds, False)
    return F.lit(True) if result is None else result.otherwise(True)


def sample(counted: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``COUNTS`` and ``good`` of at most ``size`` labelled documents of either quality that pass the base rules.

    Two counts come first, so that a document whose hash is beyond four times the expected limit goes before anything is sorted.
    """
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = stored(marked.agg((F.max("quality") > 0).alias("good")), "qualities")
    counts_of = {r.good: r.n for r in marked.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) / F.lit(2.0**31)
    limit = F.when(F.col("good"), 4 * size / max(1, counts_of.get(True, 0))).otherwise(4 * size / max(1, counts_of.get(False, 0)))
    drawn = marked.withColumn("draw", draw).filter(F.col("draw") < limit)
    rows = counted.filter(~base_failed()).join(drawn, "doc_id").select("good", "draw", "doc_id", *COUNTS)
    halves = [rows.filter(F.col("good") == good).orderBy("draw", "doc_id", *COUNTS).limit(size) for good in (True, False)]
    return halves[0].union(halves[1]).select("good", "doc_id", *COUNTS)


def fit(counted: DataFrame, labels: DataFrame, size: int = SAMPLE) -> list[Rule]:
    rows = sample(counted, labels, size).select("good", "doc_id", *(c.alias(n) for n, c in features().items())).toPandas()
    rows = rows.sort_values(list(rows.columns), kind="stable")
    bad = ~rows["good"].to_numpy(bool)
    return learn({name: rows[name].to_numpy(np.float64) for name in FEATURES}, bad)


def judge(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """Every document with its statistics, ``base_failed`` and ``kept``."""
    counted = stored(statistics(docs), "statistics")
    rules = fit(counted, labels, size)
    failed = base_failed().alias("base_failed")
    return counted.select("doc_id", *COUNTS, failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
