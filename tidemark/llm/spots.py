"""SpotSigs fingerprints: chains of content words that follow common words.

Common words (the anchors) are spread evenly over running text and rare in menus and lists. Each anchor
makes one signature of itself and the ``CHAIN`` content words after it. A fingerprint is the set of
signatures, written as sorted 32-bit numbers in hexadecimal, so equal texts have equal fingerprints. Two
fingerprints are compared by Jaccard likeness; the number of signatures bounds it from above
(min / max), so ``jaccard`` can rule out unlike lengths before it compares sets.

``near_documents`` searches a table for like documents. Different fingerprints are partitioned by the number of their signatures, each partition
reaching from a length to that length divided by the likeness asked for, so that two like ones lie in one partition or in neighbours. Inside, they meet through
their rarest signatures: two like sets share one of the first ``size - ceil(likeness * size) + 1`` of either in any common order. Pairs whose lengths
or remaining signatures rule the likeness out are dropped before sets are compared. Documents of equal fingerprints are one entry of the search.

The registered query compares given pairs (a text with its edited text and with the next one) and returns each likeness, so it prunes none.

Where more than ``GAP`` words follow each other without an anchor (tables, other languages), every word of which
the hash is divisible by three is an anchor too: that depends on the words around it only, so an edit elsewhere
leaves it alone. A text without any chain makes one signature of all its words; a text without words has the
empty fingerprint, like to itself (1) and unlike to any other (0).

``neighbour_likeness`` compares every text with its edited text and with the next document's. The table is
range-partitioned by id over cut points (as many as partitions, from approximate percentiles) and streamed in
order; each range's first text is sent to the range before it, so no task needs more than two texts at once.

Defined cases: null text is empty. Null ids come last, rows of equal id in the order of their text. Repeated
rows follow each other. With one row, it is its own next document. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SIMILAR, send_code, stored, text_or_empty
from tidemark.session import shuffle_width

CHAIN = 2
GAP = 12

# Common function words of English, French, German and Spanish.
COMMON = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was with
    au aux avec ce dans des du en est et il la le les ou par pas pour que qui sur un une
    auf das dem den der des die ein eine für im ist mit nicht sich sie und von zu
    al como con de del el es esta las lo los más no para por se su sus una y
    """.split()
)

_WORD = re.compile(r"[^\W\d_]+")
#: word hashes a worker keeps
KEPT_WORDS = 500_000

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_signatures long"
)


class _Hashes(dict):
    """Word to a 64-bit hash whose lowest bit marks a common word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = (xxhash.xxh64_intdigest(word) & ~1) | (word in COMMON)
        return value


_HASHES = _Hashes()


def _mix(*parts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        total = (total ^ part) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total >> np.uint64(32)


def signatures(text: str, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct signatures."""
    words = _WORD.findall(text.lower())
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    common = (hashes & np.uint64(1)).astype(bool)
    # the words between the anchors before and after each word
    places = np.concatenate([[-1], np.flatnonzero(common), [len(hashes)]])
    gap = np.repeat(np.diff(places) - 1, np.diff(places))[: len(hashes)]
    anchor = common | ((gap > GAP) & ((hashes >> np.uint64(1)) % np.uint64(3) == 0))
    content = hashes[~common]
    # how many content words stand up to each anchor: the chain starts there
    first = np.cumsum(~common)[anchor]
    full = first + chain <= len(content)
    first = first[full]
    if len(first):
        return np.unique(_mix(hashes[anchor][full], *(content[first + j] for j in range(chain))))
    return _mix(*hashes[:, None])


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Likeness of two sorted sets; 0 where their sizes rule ``least`` out."""
    small, large = sorted((len(a), len(b)))
    if large == 0:
        return 1.0
    if small == 0 or small < least * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def written(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _ranges(docs: DataFrame, count: int) -> DataFrame:
    """``docs`` with ``part``, the number of its range of ids, descending; null ids are in the last ones.

    An id that fills several ranges, and null, is divided by the hash that orders its rows.
    """
    found = docs.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10_000)).first()[0] or []
    cuts = sorted(set(found))
    hot = [c for c in cuts if found.count(c) > 1]
    # search the cut points by halving; the expression is as deep as their logarithm
    def place(low: int, high: int):
        if low == high:
            return F.lit(len(cuts) - low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") < cuts[middle], place(low, middle)).otherwise(place(middle + 1, high))

    # a hot id is the least of its range, so its rows come after the others
    order = F.expr("xxhash64(text) >> 1") + F.lit(2**62)  # 0 to 2^63
    within = 1 + F.floor(order / F.lit(2.0**63 / count))
    sub = F.when(F.col("doc_id").isNull() | F.col("doc_id").isin(hot), within).otherwise(0)
    part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(place(0, len(cuts)))
    return docs.withColumn("part", part * (count + 2) + sub)


def neighbour_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, with their likeness and that of the next text."""
    send_code(docs.sparkSession)
    width = shuffle_width(docs.sparkSession)
    rows = _ranges(docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")), 2 * width)
    first = rows.groupBy("part").agg(F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))), F.expr("-1 * (xxhash64(text) >> 1)"), "text")).alias("head"))
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy()))
    # a row per range
    heads = first.select(F.lit(1).alias("kind"), "part", "head.text").withColumn("part", before)
    own = rows.select(F.lit(0).alias("kind"), "part", "doc_id", "text")
    together = (
        own.unionByName(heads, allowMissingColumns=True)
        .repartition(width, "part")
        .sortWithinPartitions("part", "kind", F.col("doc_id").desc_nulls_last(), F.expr("xxhash64(text) >> 1"), "text")
    )
    return together.select("part", "kind", "doc_id", "text").mapInArrow(_compare, SCHEMA)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    schema = pa.schema(list(zip(names, types, strict=True)))
    last = None
    for rows in batches:
        done = []
        for _, kind, doc_id, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            found = signatures(text)
            if last is not None:
                done.append(_row(*last, text, found))
            last = None if kind else (doc_id, text, found)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], schema=schema)


def _row(doc_id, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    changed = edited(text, following)
    after = own if changed == text else signatures(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
    return doc_id, len(text), digest, written(own), written(after), jaccard(own, after), jaccard(own, other), len(own)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        found = [signatures(t).astype(np.int64) for t in rows.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "signatures"])


def near_documents(docs: DataFrame, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Links (u, v, likeness) between different fingerprints that are alike by ``least`` or more, and the fingerprint (``entry``) of each doc_id.

    Texts without signatures are like their own kind only, which is one entry. Nulls, repeated rows and empty tables as above.
    """
    if not 0 < least <= 1:
        raise ValueError(f"the likeness must be above 0 and at most 1, got {least}")
    send_code(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(_fingerprints, "doc_id long, signatures array<long>")
    digest = F.md5(F.concat_ws(",", F.col("signatures").cast("array<string>")).cast("binary")).alias("entry")
    placed = stored(rows.select("doc_id", digest, "signatures"), "fingerprints")
    # copies meet map-side
    entries = placed.filter(F.size("signatures") > 0).groupBy("entry").agg(F.first("signatures").alias("signatures"))
    entries = stored(entries.withColumn("size", F.size("signatures")), "entries")
    length = F.floor(F.log("size") / F.lit(float(-np.log(least)) if least < 1 else 1e-9) + 1e-9).cast("long")
    members = entries.select("entry", "size", length.alias("partition"), F.explode("signatures").alias("signature"))
    counts = stored(members.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "counts")
    # a signature of one document leads nowhere but counts in the order: it stands first
    shared = members.join(counts, "signature")
    rank = F.row_number().over(Window.partitionBy("entry").orderBy("n", "signature"))
    many = F.count(F.lit(1)).over(Window.partitionBy("entry"))
    ranked = shared.withColumn("rank", rank).withColumn("alone", F.col("size") - many)
    prefix = F.col("size") - F.ceil(F.col("size") * F.lit(least) - 1e-9) + 1
    first = stored(ranked.filter(F.col("alone") + F.col("rank") <= prefix).withColumn("place", F.col("alone") + F.col("rank")), "first")
    u = first.select("signature", F.col("entry").alias("u"), F.col("size").alias("u_size"), F.col("place").alias("u_place"), "partition")
    v = first.select("signature", F.col("entry").alias("v"), F.col("size").alias("v_size"), F.col("place").alias("v_place"), F.explode(F.array("partition", F.col("partition") - 1)).alias("partition"))
    # the larger set lies in the same partition or in the next
    smaller = (F.col("u_size") < F.col("v_size")) | ((F.col("u_size") == F.col("v_size")) & (F.col("u") < F.col("v")))
    needed = F.ceil((F.col("u_size") + F.col("v_size")) * F.lit(least / (1 + least)) - 1e-9)
    # common signatures: no more than stand up to this one in either set, and behind it in either
    bound = F.least("u_place", "v_place") + F.least(F.col("u_size") - F.col("u_place"), F.col("v_size") - F.col("v_place"))
    met = u.join(v, ["signature", "partition"]).filter(smaller & (F.col("u_size") >= F.col("v_size") * F.lit(least) - 1e-9))
    candidates = stored(met.filter(bound >= needed).select("u", "v").distinct(), "candidates")
    with_v = candidates.join(entries.select(F.col("entry").alias("v"), F.col("signatures").alias("b")), "v")
    both = with_v.join(entries.select(F.col("entry").alias("u"), F.col("signatures").alias("a")), "u")
    common = F.size(F.array_intersect("a", "b"))
    likeness = common / (F.size("a") + F.size("b") - common)
    return both.select("u", "v", likeness.alias("likeness")).filter(F.col("likeness") >= F.lit(least) - 1e-12), placed.select("doc_id", "entry")
