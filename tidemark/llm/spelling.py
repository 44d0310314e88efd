"""Spelling variants by a variable-length gram index.

Two words are near if one inserted, deleted or replaced code point makes one of the other. For words of a length ``c`` and those one
longer (a class), grams have between ``LEAST_GRAM`` and ``c / 2`` code points, ``MOST_GRAM`` at most. The gram dictionary of a class holds all grams of the least
length, and a longer one only if the gram without its last sign occurs more than ``FREQUENT`` times: frequent grams are replaced by longer, rarer ones.
A word is decomposed by the longest gram of the dictionary at each place; a gram that lies inside an earlier one is left out.

One edit changes only grams near it. Whether a gram is in the decomposition depends on the signs from its end minus the longest length to its start plus that
length, so for every word the largest number of grams that any one edit can affect is counted: ``b``. Near words have all
but ``b`` of their grams in common. Only the lists of the ``b + 1`` rarest grams of a word need merging: in any order of grams that both words share, the rarest
unaffected gram is among these in both. As grams are at most half as long as a word, one always is unaffected. What lies on its side away from the edit is equal as
well, so a list holds the words that agree in the gram with all before it, or with all behind it. Pairs of a list are
verified by their edit distance. A list of more than ``LONG_LIST`` words is divided first: two words of it agree in the rest, or in the rest without one sign each, so they
meet in the lists by those rests, which are short. Nothing is left out.

Words are counted natively, with map-side sums. Forms lead to words that are at least ``RATIO`` times as frequent, so chains are short; roots are
found by pointer doubling over stored tables.

Defined cases: null text has no words. A null id counts as the empty string in front of the colon. Repeated rows count each. Ties of forms go to the smallest word in
code-point order. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import send_code, stored, text_or_empty

# What a word is, which letters are lowered, and which runs lose a letter.
LETTER = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGED = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5

LEAST_GRAM = 2
MOST_GRAM = 6
FREQUENT = 64
LONG_LIST = 400


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and how often it occurs (``n``), after the damage that the hash of id and run decides."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    # a run of at least so many letters is matched whole; shorter ones cannot become words and are passed over
    pattern = f"{LETTER}{{{least_length},}}"
    run = F.explode(F.regexp_extract_all(text_or_empty(), F.lit(pattern), F.lit(0))).alias("run")
    runs = docs.select(doc_id, run).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    hash_ = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    place = (hash_ % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(hash_ % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _longest(shorter: Column) -> Column:
    """Longest gram of a class: half of its shorter words."""
    return F.least(F.floor(shorter / 2), F.lit(MOST_GRAM)).cast("int")


def _classes(words: DataFrame) -> DataFrame:
    """Each word in the class of its own length and in that of the next shorter words."""
    length = F.length("word")
    both = words.select("word", length.alias("length"), F.explode(F.array(length, length - 1)).alias("class"))
    least = words.agg(F.min(F.length("word")).alias("l")).scalar()
    return both.filter(F.col("class") >= least)


def _frequent(classed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences of grams that may be extended, and those grams that occur often in their class."""
    sizes = F.sequence(F.lit(LEAST_GRAM), _longest(F.col("class")) - 1)
    sized = classed.filter(_longest(F.col("class")) > LEAST_GRAM).select("class", "word", "length", F.explode(sizes).alias("size"))
    placed = sized.filter(F.col("size") < F.col("length")).select(
        "class", "word", "size", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size") - 1)).alias("place")
    )
    occurrences = placed.select("class", "word", "size", "place", F.substring("word", F.col("place") + 1, F.col("size")).alias("gram"))
    often = occurrences.groupBy("class", "gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FREQUENT)
    return occurrences, stored(often, "grams")


def decompose(length: int, longest: int, often: dict[tuple[int, int], int], least: int = LEAST_GRAM) -> list[tuple[int, int, int]]:
    """Start, stop and frequency (0 for rare ones) of the grams of a word; ``often`` has the frequent grams by place and size."""
    grams, reached = [], 0
    for start in range(length - least + 1):
        size = least
        while size < longest and start + size < length and (start, size) in often:
            size += 1
        if start + size > reached:
            grams.append((start, start + size, often.get((start, size), 0)))
            reached = start + size
    return grams


def affected(grams: list[tuple[int, int, int]], length: int, longest: int) -> int:
    """The largest number of grams that one edit can affect.

    A gram depends on the signs of ``[stop - longest, start + longest)``. A sign that is replaced or deleted affects it if it lies there, an
    inserted one if it comes between two places of that stretch, which may reach beyond the word.
    """
    # odd places are the signs, even ones the gaps beside them
    edges = [0] * (2 * length + 2)
    for start, stop, _ in grams:
        edges[max(0, 2 * (stop - longest) + 1)] += 1
        edges[min(2 * length, 2 * (start + longest) - 1) + 1] -= 1
    return max(accumulate(edges))


def chosen(length: int, longest: int, often: dict[tuple[int, int], int], text: str) -> list[tuple[int, int]]:
    """Start and stop of the grams whose lists have to be merged."""
    grams = decompose(length, longest, often)
    most = affected(grams, length, longest) + 1
    ranked = sorted(grams, key=lambda g: (g[2], text[g[0] : g[1]], g[0]))
    return [(start, stop) for start, stop, _ in ranked[:most]]


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = pa.list_(pa.list_(pa.int32()))
    for rows in batches:
        found = []
        for word, cls, often in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            by_place = {(g["place"], g["size"]): g["n"] for g in often or ()}
            found.append(chosen(len(word), min(cls // 2, MOST_GRAM), by_place, word))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found, pair)], names=["word", "class", "grams"])


def _lists(words: DataFrame) -> DataFrame:
    """key, class, word, rest: a row for each list that a word is in."""
    classed = _classes(words)
    occurrences, often = _frequent(classed)
    placed = occurrences.join(often, ["class", "gram"]).groupBy("class", "word").agg(F.collect_list(F.struct("place", "size", "n")).alias("often"))
    known = classed.select("word", "class").join(placed, ["class", "word"], "left").select("word", "class", "often")
    grams = known.mapInArrow(_emit, "word string, class int, grams array<array<int>>")
    one = grams.select("word", "class", F.explode("grams").alias("g"))
    start, stop = F.col("g")[0], F.col("g")[1]
    sides = F.array(
        F.struct(F.substring("word", F.lit(1), stop).alias("side"), F.substring("word", stop + 1, F.length("word")).alias("rest"), F.lit(0).alias("end")),
        F.struct(F.substring("word", start + 1, F.length("word")).alias("side"), F.substring("word", F.lit(1), start).alias("rest"), F.lit(1).alias("end")),
    )
    parts = one.select("word", "class", F.explode(sides).alias("s"))
    key = F.xxhash64("class", "s.end", "s.side").alias("key")
    return stored(parts.select(key, "class", "word", "s.rest"), "lists")


def _meet(lists: DataFrame) -> DataFrame:
    """Different words of a list that are near, each two once."""
    a = lists.select("key", "class", F.col("word").alias("u"))
    b = lists.select("key", F.col("word").alias("v"))
    shorter = (F.length("u") == F.col("class")) | (F.length("v") == F.col("class"))
    pairs = a.join(b, "key").filter((F.col("u") < F.col("v")) & shorter)
    return pairs.filter(F.levenshtein("u", "v", 1) == 1).select("u", "v")


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs (u, v) of near words, u < v. ``words`` has distinct ones of at least ``2 * LEAST_GRAM`` code points."""
    send_code(words.sparkSession)
    lists = _lists(words)
    long_ = stored(lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LONG_LIST).select("key"), "long-lists")
    short = lists.join(long_, "key", "left_anti")
    # two rests that differ by one edit are equal once the sign is left out of both, or out of the longer one
    places = F.sequence(F.lit(0), F.length("rest"))
    without = F.transform(places, lambda i: F.concat(F.substring("rest", F.lit(1), i), F.substring("rest", i + 2, F.length("rest"))))
    divided = lists.join(long_, "key").select(F.explode(F.array_distinct(without)).alias("left"), "key", "class", "word")
    divided = divided.select(F.xxhash64("key", "left").alias("key"), "class", "word")
    return stored(_meet(short).union(_meet(divided)).distinct(), "near")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    if least_length < 2 * LEAST_GRAM:
        raise ValueError(f"words need {2 * LEAST_GRAM} code points at least")
    words = stored(word_counts(docs, least_length, least_count), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("other")).union(pairs.select(F.col("v").alias("word"), F.col("u").alias("other")))
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    around = stored(counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best), "around")
    frequent = -F.col("best.minus") >= ratio * F.col("n")
    formed = words.join(around, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.minus")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    roots = _roots(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(pointers: DataFrame) -> DataFrame:
    """Where the pointers (word, root) end; each step doubles their length."""
    pointers = stored(pointers, "pointers")
    while True:
        on = pointers.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = stored(pointers.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "pointers")
        pointers = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return pointers
