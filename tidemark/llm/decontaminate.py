"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask picks some of the words of a stretch and ignores the others, so a hash of the picked words still agrees
when an ignored word was replaced. Every stretch of every text is hashed under each mask and joined to the
hashes of the test items. A hit fixes how item and text lie on each other; along that line the words
are compared one by one. A text holds an item if among ``OVERLAP`` consecutive item words (all, if the item is
shorter) ``SHARE`` or more are equal.

The seeds lose none of these: the masks of each item length are chosen so that wherever the words lie that may differ, one mask
fits between them (a test enumerates all patterns). Masks begin and end with a picked word, so a stretch that
agrees lies inside the text. Items of up to four words have to be equal and are hashed whole. Texts are hashed under the masks of
those lengths only that the items have. ``SQL`` states the rule over all lines, without seeds.

The test side is broadcast only while it has at most ``BROADCAST_SEEDS`` seeds; beyond that both sides are
shuffled by hash. Hits are reduced map-side to one row per text, item and line before they move.

Defined cases: null text is empty. Items without words, or with null text or id, are no evidence and match nothing. Equal items under two ids are both found. Equal texts have equal results; rows of one
doc_id give one row per item, with the best overlap, the first of equals. A null doc_id stays null. Empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, picked_hashes, text_key, text_or_empty, words

# The masks for items of so many words; the last ones are for all longer items too.
MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "110011"),
    7: ("1111", "1110111"),
    8: ("11111", "11100111"),
    9: ("111111", "111000111"),
    10: ("111011", "11001011", "10100111"),
}
#: a mask's number keeps its hashes apart from those of the others
NUMBERS = {mask: n for n, mask in enumerate(dict.fromkeys(m for masks in MASKS.values() for m in masks))}
OVERLAP = 20
SHARE = 0.8
BROADCAST_SEEDS = 2_000_000

KEYS = ["key_a", "key_b"]


def _seeds(df: DataFrame, keep: list[str], masks: list[str]) -> DataFrame:
    """``keep``, place and hash of every stretch of ``text`` under each of the masks."""
    hashed = df.select(*keep, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    seeds = [picked_hashes("hashes", [i for i, c in enumerate(m) if c == "1"], NUMBERS[m]) for m in masks]
    arrays = hashed.select(*keep, F.size("hashes").alias("n"), F.concat(*seeds).alias("seeds"))
    # the masks' hashes stand one behind the other
    place, start = F.lit(None).cast("int"), F.lit(0)
    for m in masks:
        place = F.when(F.col("i") >= start, F.col("i") - start).otherwise(place)
        start = start + F.greatest(F.col("n") - (len(m) - 1), F.lit(0))
    # an outer generator, as the filter that belongs to an inner one is tested below and cuts each text again
    return (
        arrays.select(*keep, "n", F.posexplode_outer("seeds").alias("i", "seed"))
        .filter("seed IS NOT NULL")
        .select(*keep, place.alias("place"), "seed")
    )


def _candidates(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct text key, item and line (place of the item's first word in the text) of all hits."""
    length = F.least(F.size(words(F.col("text"))), F.lit(max(MASKS)))
    lengths = sorted(r.length for r in items.select(length.alias("length")).distinct().collect() if r.length) or [max(MASKS)]
    probe = reduce(DataFrame.union, [_seeds(items.filter(length == n), ["item"], MASKS[n]) for n in lengths])
    probe = probe.withColumnRenamed("place", "item_place")
    if probe.count() <= BROADCAST_SEEDS:
        probe = F.broadcast(probe)
    masks = list(dict.fromkeys(m for n in lengths for m in MASKS[n]))
    hits = _seeds(texts.select(*text_key(F.col("text")), "text"), KEYS, masks).join(probe, "seed")
    return hits.select(*KEYS, "item", (F.col("place") - F.col("item_place")).alias("line")).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps: key of the text, doc_id, item_id, n_equal of n_compared words, first word in the text.

    A row for each place in the item where enough words are equal.
    """
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    known = (
        benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .select("item_id", F.col("text").cast("string"))
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "text"))
    )
    item_words = known.select("item", "item_id", words(F.col("text")).alias("item_words")).filter(F.size("item_words") > 0)
    lines = (
        _candidates(texts, known.select("item", "text"))
        .join(item_words.select("item", F.size("item_words").alias("n")), "item")
        .groupBy(*KEYS)
        .agg(F.collect_list(F.struct("item", "line", "n")).alias("lines"))
    )
    held = texts.select("doc_id", *text_key(F.col("text")), "text").join(lines, KEYS)
    held = held.select("doc_id", *KEYS, "lines", words(F.col("text")).alias("doc_words"))

    def under(c):
        """The words of the text that lie under the item."""
        return F.transform(F.sequence(F.lit(0), c["n"] - 1), lambda i: F.get("doc_words", c["line"] + i))

    laid = held.select(
        "doc_id",
        *KEYS,
        F.explode_outer(F.transform("lines", lambda c: F.struct(c["item"].alias("item"), c["line"].alias("line"), under(c).alias("under")))).alias("c"),
    ).select("doc_id", *KEYS, "c.*")
    size = F.least(F.size("item_words"), F.lit(OVERLAP))
    equal = F.zip_with("under", "item_words", lambda a, b: F.when(a == b, 1).otherwise(0))
    sums = F.transform(
        F.sequence(F.lit(0), F.size("equal") - F.col("n_compared")),
        lambda s: F.struct(
            F.aggregate(F.slice("equal", s + 1, F.col("n_compared")), F.lit(0), lambda a, x: a + x).alias("n_equal"),
            (F.col("line") + s).alias("first_word"),
        ),
    )
    compared = laid.join(item_words, "item").select("doc_id", *KEYS, "item_id", "line", equal.alias("equal"), size.alias("n_compared"))
    enough = F.filter(sums, lambda s: s["n_equal"] >= F.ceil(F.col("n_compared") * F.lit(SHARE)))
    return compared.select("doc_id", *KEYS, "item_id", "n_compared", F.explode_outer(enough).alias("s")).filter("s IS NOT NULL").select(
        "doc_id", *KEYS, "item_id", "s.n_equal", "n_compared", "s.first_word"
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it holds."""
    best = F.max(F.struct("n_equal", (-F.col("first_word")).alias("at"), "n_compared")).alias("best")
    return (
        overlaps(docs, benchmark)
        .groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.n_equal", "best.n_compared", (-F.col("best.at")).alias("first_word"))
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, as they are."""
    own = [free_name(docs, key) for key in KEYS]
    held = overlaps(docs, benchmark).select(*(F.col(key).alias(name) for key, name in zip(KEYS, own, strict=True))).distinct()
    a, b = text_key(text_or_empty())
    return docs.join(held, (a == F.col(own[0])) & (b == F.col(own[1])), "left_anti")


#: the rule over all lines, without seeds: words that are equal make the lines, those with enough of them are laid out
SQL = rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, w, row_number() OVER () AS item, len(w) AS n, least(len(w), {OVERLAP}) AS n_compared FROM (
    SELECT DISTINCT item_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
  )
), dw AS (
  SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) u(p)
), bw AS (
  SELECT item, item_id, n, n_compared, i, w[i] AS word FROM b, unnest(range(1, len(w) + 1)) u(i)
), lines AS (
  SELECT doc_id, item, item_id, n, n_compared, p - i AS line, list(i) AS places
  FROM dw JOIN bw USING (word) GROUP BY ALL HAVING count(*) >= ceil(n_compared * {SHARE})
), s AS (
  SELECT doc_id, item_id, n_compared, line + first AS first_word,
    len(list_filter(places, lambda i: i > first AND i <= first + n_compared)) AS n_equal
  FROM lines, unnest(range(n - n_compared + 1)) u(first)
), v AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, first_word) AS r
  FROM s WHERE n_equal >= ceil(n_compared * {SHARE})
)
SELECT doc_id, item_id, CAST(n_equal AS INTEGER) AS n_equal, CAST(n_compared AS INTEGER) AS n_compared,
       CAST(first_word AS INTEGER) AS first_word
FROM v WHERE r = 1
"""
