"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is its five-word shingles, once each with the weight 1 and once with the weight 1 + ln(count). Every shingle sends arrivals, a Poisson process
at the rate of its weight, to random registers; a register keeps the shingle that arrives first. A shingle stops
when its next arrival is later than all registers' first ones, so most stop at once. Two texts agree in a register with the
probability of their probability Jaccard likeness. With the weight 1 that is the Jaccard likeness of their sets, which is verified, however
often a text repeats a passage. A text that repeats no shingle has the same registers both times.

``BANDS`` bands of ``ROWS`` registers put texts into buckets, ``BANDS`` more of the other weights those that repeat shingles: a pair
whose sets are alike by 0.8 shares one with a probability of 1 - (1 - 0.8^6)^32 > 0.9999. In each bucket all members are compared with the one that shares most buckets with others
(an original lies closer to its copies than they lie to each other) and with another one, chosen by hash. Verified links
(Jaccard likeness of the shingle sets of at least 0.8) make components. Where a bucket still holds several, the members
outside its largest component are compared with one more of its members. For those that are still outside, candidates come in two
ways. Order the shingles of a text from rare to frequent: two alike texts share one of their first ``0.2 size + 1``, the rarest
common one. If at most ``RARE`` texts hold it, the pair meets at it. Otherwise all common shingles are more frequent, and the
numbers of such shingles bound the likeness: only pairs of a bucket that this bound lets through are compared. So no pair that
shares a bucket is left untested, but those that one class already holds and those that cannot be alike. No bucket is
gathered, no text is compared with its own copies.

Defined cases: equal texts are one class, whatever their words. Texts shorter than five words are one shingle of
all their words, texts without words are like their exact copies only. Null and empty texts have nothing in common: each such
row is a class of its own. ``class_id`` is the least doc_id of the class (null if it has none); repeated rows are
returned each. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SHINGLE_WORDS, SIMILAR, distinct_texts, free_name, keeps, only, send_code, slices, stored, text_digest, text_or_empty
from tidemark.llm.components import components

BANDS = 32
ROWS = 6
REGISTERS = BANDS * ROWS
#: shingles handled at once: bounds a worker's memory
BATCH_SHINGLES = 100_000
KEPT_WORDS = 100_000
#: bytes of text signed before their bands are handed on
BATCH_BYTES = 1 << 22
#: a shingle that at most so many texts hold brings each two of them together; parts the candidates, drops none
RARE = 16

_WORD = re.compile(r"\w+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word)
        # frequent words come early
        if len(self) < KEPT_WORDS:
            self[word] = value
        return value


_HASHES = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Hash of every stretch of five words, in order."""
    words = _WORD.findall(text.lower())
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE_WORDS, len(hashes))
    if not size:
        return hashes
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for j in range(size):
        total = _mix(total + hashes[j : len(hashes) - size + 1 + j] + _GOLDEN)
    return total


def registers(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """First element to arrive in each register, a row for each of ``count`` texts.

    ``owner`` is the text of each distinct element.
    """
    first = np.full(count * REGISTERS, np.inf)
    chosen = np.zeros(count * REGISTERS, np.uint64)
    time, step = np.zeros(len(element)), 0
    while len(element):
        step += 1
        draw = _mix(element + np.uint64(step * int(_GOLDEN) % 2**64))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        place = owner * REGISTERS + (_mix(draw ^ _GOLDEN) % np.uint64(REGISTERS)).astype(np.int64)
        early = time < first[place]
        np.minimum.at(first, place[early], time[early])
        won = early & (time == first[place])
        chosen[place[won]] = element[won]
        alive = time < first.reshape(count, REGISTERS).max(axis=1)[owner]
        owner, element, weight, time = owner[alive], element[alive], weight[alive], time[alive]
    return chosen.reshape(count, REGISTERS)


def bands(texts: list[str]) -> list[np.ndarray | None]:
    """Different band hashes of each text, by both weights; None where it has no words."""
    result: list[np.ndarray | None] = [None] * len(texts)
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []

    def finish() -> None:
        owner = np.repeat(np.arange(len(waiting)), [len(e) for _, e, _ in waiting])
        found = registers(owner, np.concatenate([e for _, e, _ in waiting]), np.concatenate([w for *_, w in waiting]), len(waiting))
        total = np.arange(BANDS, dtype=np.uint64)[None, :] * _GOLDEN
        for j in range(ROWS):
            total = _mix(total + found.reshape(len(waiting), BANDS, ROWS)[:, :, j])
        for (i, *_), row in zip(waiting, total, strict=True):
            result[i] = row.view(np.int64) if result[i] is None else np.union1d(result[i], row.view(np.int64))
        waiting.clear()

    held = 0
    for i, text in enumerate(texts):
        element, times = np.unique(shingles(text), return_counts=True)
        if len(element):
            weights = [np.ones(len(element))] + ([1 + np.log(times)] if times.max() > 1 else [])
            waiting.extend((i, element, weight) for weight in weights)
            held += len(element) * len(weights)
            if held >= BATCH_SHINGLES:
                finish()
                held = 0
    if waiting:
        finish()
    return result


def _drop_kept() -> None:
    _HASHES.clear()
    _set.cache_clear()


keeps("near copies", _drop_kept)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only("near copies")
    for rows in slices(batches, 1, BATCH_BYTES):
        yield pa.RecordBatch.from_arrays(
            [rows.column(0).cast(pa.binary()), pa.array(bands(rows.column(1).to_pylist()), pa.list_(pa.int64()))], names=["key", "bands"]
        )


def _buckets(docs: DataFrame) -> DataFrame:
    """bucket, key, n (texts in the bucket) for all buckets of two different texts or more."""
    send_code(docs.sparkSession)
    texts = docs.select(text_or_empty().alias("text")).filter("text != ''")
    signed = texts.select(text_digest(F.col("text")).alias("key"), "text").mapInArrow(_signed, "key binary, bands array<long>")
    members = stored(signed.groupBy("key").agg(F.first("bands").alias("bands")).filter("bands IS NOT NULL"), "signatures").select(
        F.explode("bands").alias("bucket"), "key"
    )
    # sums are written before they are joined: a join right above an aggregate cannot split a hot key
    shared = stored(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    return stored(members.join(shared, "bucket"), "buckets")


@lru_cache(maxsize=16)
def _set(text: str) -> np.ndarray:
    return np.unique(shingles(text))


def likeness(a: str, b: str) -> float:
    """Jaccard likeness of the shingle sets."""
    x, y = _set(a), _set(b)
    if min(len(x), len(y)) < SIMILAR * max(len(x), len(y)) or not len(x):
        return 0.0
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common / (len(x) + len(y) - common)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only("near copies")
    for rows in slices(batches, 2, BATCH_BYTES):
        alike = [likeness(a, b) >= SIMILAR for a, b in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True)]
        kept = rows.filter(pa.array(alike, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column(0).cast(pa.binary()), kept.column(1).cast(pa.binary())], names=["u", "v"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of text keys that are alike."""
    with_v = pairs.join(texts.select(F.col("key").alias("v"), F.col("text").alias("text_v")), "v")
    both = with_v.join(texts.select(F.col("key").alias("u"), F.col("text").alias("text_u")), "u")
    return both.select("u", "v", "text_u", "text_v").mapInArrow(_verified, "u binary, v binary")


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, key, root, main of the buckets that hold several components; main is the largest."""
    placed = members.join(roots.withColumnRenamed("vertex", "key"), "key", "left")
    placed = stored(placed.select("bucket", "key", F.coalesce("root", "key").alias("root")), "placed")
    by_root = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = by_root.groupBy("bucket").agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("main"))
    main = stored(main.filter("roots > 1").select("bucket", F.col("main.root").alias("main")), "main")
    return stored(placed.join(main, "bucket"), "mixed")


def _ordered(u: str, v: str) -> list:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links (u, v) between keys of different texts, and the components that they make."""
    members = _buckets(docs)
    shared = members.select("key").distinct()
    texts = stored(distinct_texts(docs).join(shared, "key", "left_semi"), "texts")
    degrees = stored(members.groupBy("key").agg(F.sum("n").alias("degree")), "degrees")
    centres = stored(members.join(degrees, "key").groupBy("bucket").agg(F.max(F.struct("degree", "key")).alias("c")), "centres")
    centres = centres.select("bucket", F.col("c.key").alias("centre"))
    tested, found = [], []

    def test(pairs: DataFrame, roots: DataFrame | None = None) -> DataFrame:
        """Compares the new ones of the pairs and gives the components so far."""
        new = pairs.filter(F.col("u") != F.col("v")).distinct()
        for earlier in tested:
            new = new.join(earlier, ["u", "v"], "left_anti")
        tested.append(stored(new, "pairs"))
        found.append(stored(verified(tested[-1], texts), "verified"))
        return roots if roots is not None and found[-1].isEmpty() else components(reduce(DataFrame.union, found))

    # the second member is another one in each bucket
    other = F.min(F.struct(F.xxhash64("bucket", "key"), "key"))["key"].alias("other")
    both = stored(centres.join(members.groupBy("bucket").agg(other), "bucket").select("bucket", F.explode(F.array("centre", "other")).alias("centre")), "both")
    roots = test(members.join(both, "bucket").select(*_ordered("key", "centre")))
    mixed = _mixed(members, roots)
    chosen = F.min(F.struct(F.xxhash64(F.lit(1), "bucket", "key"), "key"))["key"].alias("centre")
    centres = stored(mixed.filter(F.col("root") == F.col("main")).groupBy("bucket").agg(chosen), "centres")
    roots = test(mixed.filter(F.col("root") != F.col("main")).join(centres, "bucket").select(*_ordered("key", "centre")), roots)
    mixed = _mixed(members, roots)
    roots = test(_candidates(mixed, texts), roots)
    return reduce(DataFrame.union, found), roots


def _emit_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, 1, BATCH_BYTES):
        for key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            found = np.unique(shingles(text)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(found), pa.binary()), pa.array(found)], names=["key", "shingle"])


def _candidates(mixed: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) of different components that may be alike, one of them outside the main component of a bucket of both.

    A pair is left out only if its likeness is below 0.8: its rarest common shingle would stand among the first ones of both texts,
    and where that shingle is held by more than ``RARE`` texts, the common shingles are no more than either text has of such frequent ones.
    """
    # common shingles of two alike texts are at least this share of the sum of their sizes
    share = SIMILAR / (1 + SIMILAR)
    outside = mixed.filter(F.col("root") != F.col("main"))
    roots = stored(mixed.groupBy("key").agg(F.first("root").alias("root"), F.max(F.col("root") != F.col("main")).alias("outside")), "roots")
    held = texts.join(roots.select("key"), "key", "left_semi").select("key", "text").mapInArrow(_emit_shingles, "key binary, shingle long")
    held = stored(held, "shingles")
    by_shingle = stored(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")).filter(F.col("n") <= RARE), "rare")
    alone = stored(by_shingle.filter("n = 1").groupBy("key").agg(F.count(F.lit(1)).alias("alone")), "alone")
    rare = stored(held.join(by_shingle.filter("n > 1").select("shingle", "n"), "shingle"), "shared")
    few = stored(rare.groupBy("key").agg(F.count(F.lit(1)).alias("few")), "few")
    sizes = stored(held.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "sizes")
    sized = sizes.join(alone, "key", "left").join(few, "key", "left").join(roots, "key").na.fill(0, ["alone", "few"])
    sized = stored(sized.withColumn("frequent", F.col("size") - F.col("alone") - F.col("few")), "sized")

    rank = F.row_number().over(Window.partitionBy("key").orderBy("n", "shingle"))
    ranked = rare.withColumn("rank", rank).join(sized, "key")
    first = stored(ranked.filter(F.col("alone") + F.col("rank") <= F.floor(F.col("size") * F.lit(1 - SIMILAR) + 1e-9) + 1), "first")
    a = first.filter("outside").select("shingle", F.col("key").alias("a"), F.col("root").alias("a_root"))
    meet = a.join(first.select("shingle", F.col("key").alias("b"), F.col("root").alias("b_root")), "shingle")

    # the other text has 0.8 times the shingles at least
    able = sized.filter(F.col("frequent") >= share * (1 + SIMILAR) * F.col("size") - 1e-9).select("key", "size", "frequent")
    a = outside.join(able, "key").select("bucket", F.col("key").alias("a"), F.col("root").alias("a_root"), F.col("size").alias("a_size"), F.col("frequent").alias("a_frequent"))
    b = mixed.join(able, "key").select("bucket", F.col("key").alias("b"), F.col("root").alias("b_root"), F.col("size").alias("b_size"), F.col("frequent").alias("b_frequent"))
    common = F.least("a_frequent", "b_frequent")
    near = (F.col("a_root") != F.col("b_root")) & (common >= share * (F.col("a_size") + F.col("b_size")) - 1e-9)
    across = stored(a, "able").join(stored(b, "able"), "bucket").filter(near)
    return meet.filter(F.col("a_root") != F.col("b_root")).select(*_ordered("a", "b")).union(across.select(*_ordered("a", "b")))


def class_of(docs: DataFrame) -> DataFrame:
    """doc_id, key, class_key of every row with text."""
    _, roots = links(docs)
    rows = docs.select("doc_id", text_or_empty().alias("text")).filter("text != ''").select("doc_id", text_digest(F.col("text")).alias("key"))
    return rows.join(roots.select(F.col("vertex").alias("key"), "root"), "key", "left").select("doc_id", "key", F.coalesce("root", "key").alias("class_key"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_members of every row."""
    placed = stored(class_of(docs.select(F.col("doc_id").cast("long"), "text")), "classes")
    named = placed.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_members"))
    named = stored(named, "named")
    empty = docs.filter(text_or_empty() == "").select(F.col("doc_id").cast("long")).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_members"))
    return placed.join(named, "class_key").select("doc_id", "class_id", "n_members").union(empty)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one row of each class: the least doc_id, then the least text key."""
    placed = stored(class_of(docs), "classes")
    stay = placed.groupBy("class_key").agg(F.min(F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id"), "key")).alias("s"))
    keys = [free_name(docs, "text_key"), free_name(docs, "number")]
    stay = stay.select(F.col("s.key").alias(keys[0]), F.col("s.id").alias(keys[1]))
    number, digest = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), text_digest(text_or_empty())
    with_text = docs.filter(text_or_empty() != "").withColumns(dict(zip(keys, (digest, number), strict=True)))
    # rows that repeat a document wholly
    kept = with_text.join(stay, keys, "left_semi").dropDuplicates(keys)
    return kept.select(docs.columns).union(docs.filter(text_or_empty() == ""))
