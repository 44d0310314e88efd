"""Exact repeats of ``LENGTH`` bytes by hash-compared suffix sorting.

Sorting every suffix of a corpus would move each text many times over. Two 200-byte strings that are equal choose the
same anchor, though: of all stretches of ``ANCHOR`` bytes inside, the one with the least hash, the first of equals. So every
position of every text is assigned to its anchor, anchors that occur once anywhere are dropped (their positions
repeat nowhere), and only positions of repeated anchors are looked at. Consecutive positions with one anchor are a run; the
bytes that its strings cover are its context.

1. Runs whose whole context occurs again at the same anchor are repeats: the polynomial hashes of anchor and context and an independent digest of the
   context's bytes have to agree.
2. Of the other runs of an anchor, together with one run for each repeated context, the context bytes are fetched. They are
   sorted forwards from the anchor and backwards from it by mergesort. Suffixes are compared through prefix polynomial
   hashes: binary search finds the length of the common start in logarithmic time, the byte after it decides. Neighbours'
   common lengths are checked byte by byte, and a group with a collision is sorted by its bytes instead. Strings
   that agree far enough on both sides of the anchor are repeats.
3. Anchors with more than ``HOT`` different contexts are not sorted in one task: their strings are counted by Spark, with map-side sums, by
   their polynomial hash and an independent digest of their bytes.

Hashes are 64-bit polynomials with odd multipliers (prefix sums of byte codes times powers); an anchor and
its context use different codes. Equality in step 1 rests on 192 bits, in step 3 on the anchor's 64 and 128 more; of these 64 are no polynomial.

Defined cases: null text is empty. Texts shorter than ``LENGTH`` have no repeats and are nobody's. Equal texts of at least that
length are removed wholly. Null ids stay null; repeated rows are copies of each other. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import distinct_texts, free_name, keeps, only, send_code, slices, stored, text_digest, text_or_empty

LENGTH = 200
ANCHOR = 40
REACH = LENGTH - ANCHOR + 1
#: a text is hashed in stretches of so many positions, whatever its length
STRETCH = 1 << 19
HOT = 10_000
#: contexts sorted at once
BATCH = 8_000
#: bytes of text cut before their rows are handed on
BATCH_BYTES = 1 << 22

_RANDOM = np.random.default_rng(20240229)
_CODES = _RANDOM.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15 | 5, 0xD1342543DE82EF95 | 5)
_POWERS: dict[tuple[int, int], np.ndarray] = {}
keeps("repeats", _POWERS.clear)


def _powers(base: int, count: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64; kept for the longest stretch asked for."""
    known = _POWERS.get((base, 0))
    if known is None or len(known) < count:
        known = np.full(max(count, 1 << 14), base, np.uint64)
        known[0] = 1
        _POWERS[base, 0] = known = np.cumprod(known, dtype=np.uint64)
    return known[:count]


def _prefix(data: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of code times power, and the inverse powers that make sums comparable."""
    base = _BASES[which]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[which][data] * _powers(base, len(data)), dtype=np.uint64, out=sums[1:])
    return sums, _powers(pow(base, -1, 2**64), len(data) + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each stretch of ``width`` values."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def runs(data: bytes) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, first position, last position and anchor of each run of positions."""
    found = []
    values = np.frombuffer(data, np.uint8)
    for start in range(0, len(values) - LENGTH + 1, STRETCH):
        part = values[start : start + STRETCH + LENGTH - 1]
        sums, inverse = _prefix(part, 0)
        count = len(part) - ANCHOR + 1
        grams = _mix((sums[ANCHOR:] - sums[:count]) * inverse[:count])
        # hash above, place below: the least is the first of equal hashes
        packed = (grams & ~np.uint64(0xFFFFF)) | np.arange(count, dtype=np.uint64)
        chosen = (_window_minimum(packed, REACH) & np.uint64(0xFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
        last = np.concatenate([first[1:] - 1, [len(chosen) - 1]])
        anchor = chosen[first]
        sums, inverse = _prefix(part, 1)
        context = (sums[last + LENGTH] - sums[first]) * inverse[first]
        context = _mix(context + (anchor - first).astype(np.uint64) * np.uint64(257) + (last - first).astype(np.uint64))
        found.append((grams[anchor], context, first + start, last + start, anchor + start))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _digests(data: bytes, starts: list[int], stops: list[int]) -> np.ndarray:
    """Digest of each stretch, of another kind than the polynomial hashes: what is structured in one is not in the other."""
    view = memoryview(data)
    return np.array([xxhash.xxh3_64_intdigest(view[i:j]) for i, j in zip(starts, stops, strict=True)], np.uint64).view(np.int64)


def _emit_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run; ``place`` holds the first position, and behind it the run's length and its way to the anchor, ``proof`` is a digest of the
    context's bytes."""
    only("repeats")
    for rows in slices(batches, 1, BATCH_BYTES):
        keys, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
        held: list[tuple] = []
        size = 0
        for i, (key, text) in enumerate(zip(keys, texts, strict=True)):
            data = text.encode("utf-8", "replace")
            anchor, context, first, last, at = runs(data)
            proof = _digests(data, first.tolist(), (last + LENGTH).tolist())
            held.append(([key] * len(anchor), anchor.view(np.int64), context.view(np.int64), first << 16 | (last - first) << 8 | (at - first), proof))
            size += len(anchor)
            if size >= 200_000 or i == len(keys) - 1:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for h in held for k in h[0]], pa.binary()),
                        *(pa.array(np.concatenate([h[j] for h in held])) for j in (1, 2, 3, 4)),
                    ],
                    names=["key", "anchor", "context", "place", "proof"],
                )
                held, size = [], 0


def _emit_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked runs of each text."""
    for rows in batches:
        for key, text, asked in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            data = text.encode("utf-8", "replace")
            starts = [a["place"] >> 16 for a in asked]
            lengths = [(a["place"] >> 8 & 255) + LENGTH for a in asked]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * len(asked), pa.binary()),
                    pa.array([a["anchor"] for a in asked], pa.int64()),
                    pa.array([a["place"] for a in asked], pa.int64()),
                    pa.array([a["known"] for a in asked], pa.bool_()),
                    pa.array([data[s : s + n] for s, n in zip(starts, lengths, strict=True)], pa.binary()),
                ],
                names=["key", "anchor", "place", "known", "bytes"],
            )


class Suffixes:
    """Strings of bounded length that are compared through hashes of their prefixes."""

    def __init__(self, strings: list[bytes], width: int) -> None:
        self.bytes = np.zeros((len(strings), width), np.uint8)
        self.length = np.array([len(s) for s in strings], np.int64)
        for i, s in enumerate(strings):
            self.bytes[i, : len(s)] = np.frombuffer(s, np.uint8)
        self.width = width
        codes = _CODES[0][self.bytes] * _powers(_BASES[0], width)[None, :]
        self.prefix = np.zeros((len(strings), width + 1), np.uint64)
        np.cumsum(codes, axis=1, dtype=np.uint64, out=self.prefix[:, 1:])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common start of each pair, by binary search over prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.minimum(self.length[a], self.length[b])
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.prefix[a, middle] == self.prefix[b, middle]
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a sorts before b: the byte after the common start decides, then the shorter."""
        common = self.common(a, b)
        ends = (common >= self.length[a]) | (common >= self.length[b])
        at = np.minimum(common, self.width - 1)
        return np.where(ends, self.length[a] < self.length[b], self.bytes[a, at] < self.bytes[b, at])

    def order(self, group: np.ndarray) -> np.ndarray:
        """Mergesort of all groups at once; ``group`` is ascending. Runs of one group are merged by rank:
        a string's place is its place in its own run and the number of strings of the other before it."""
        order = np.arange(len(group))
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
        sizes = np.diff(np.concatenate([starts, [len(group)]]))
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        inside = np.arange(len(group)) - start
        width = 1
        while (active := np.flatnonzero(size > width)).size:
            begin, n, place = start[active], size[active], inside[active]
            pair = place // (2 * width) * (2 * width)
            left = place - pair < width
            other_low = np.where(left, np.minimum(pair + width, n), pair)
            other_high = np.where(left, np.minimum(pair + 2 * width, n), np.minimum(pair + width, n))
            low, high = other_low.copy(), other_high.copy()
            mine = order[active]
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                theirs = order[begin[open_] + middle]
                # equal strings of the left run stay before those of the right
                smaller = np.where(
                    left[open_], self.before(theirs, mine[open_]), ~self.before(mine[open_], theirs)
                )
                low[open_] = np.where(smaller, middle + 1, low[open_])
                high[open_] = np.where(smaller, high[open_], middle)
            own = place - np.where(left, pair, pair + width)
            merged = order.copy()
            merged[begin + pair + own + (low - other_low)] = mine
            order = merged
            width *= 2
        return order

    def neighbours(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order, and the common length of each string with the one before it (-1 at the start of a group)."""
        order = self.order(group)
        a, b = order[:-1], order[1:]
        hashed = np.concatenate([[-1], self.common(a, b)])
        limit = np.minimum(self.length[a], self.length[b])
        differs = self.bytes[a] != self.bytes[b]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), self.width)
        exact = np.concatenate([[-1], np.minimum(first, limit)])
        if (hashed != exact).any() or (self.bytes[a, np.minimum(exact[1:], self.width - 1)] > self.bytes[b, np.minimum(exact[1:], self.width - 1)])[
            (exact[1:] < limit) & (group[1:] == group[:-1])
        ].any():
            # a collision: sort by the bytes themselves
            keys = [(int(g), self.bytes[i, : self.length[i]].tobytes()) for i, g in enumerate(group)]
            order = np.array(sorted(range(len(group)), key=keys.__getitem__), np.int64)
            a, b = order[:-1], order[1:]
            differs = self.bytes[a] != self.bytes[b]
            first = np.where(differs.any(axis=1), differs.argmax(axis=1), self.width)
            exact = np.concatenate([[-1], np.minimum(first, np.minimum(self.length[a], self.length[b]))])
        exact[1:][group[1:] != group[:-1]] = -1
        return order, exact


def repeated_strings(group: np.ndarray, contexts: list[bytes], run: np.ndarray, to_anchor: np.ndarray) -> np.ndarray:
    """For each context and distance to the anchor, whether that string occurs in another context of its group.

    ``run`` is the number of positions less one, ``to_anchor`` the distance of the first to the anchor.
    """
    after = Suffixes([c[t:] for c, t in zip(contexts, to_anchor.tolist(), strict=True)], LENGTH)
    ahead = Suffixes([c[:t][::-1] for c, t in zip(contexts, to_anchor.tolist(), strict=True)], REACH)
    after_order, after_common = after.neighbours(group)
    ahead_order, ahead_common = ahead.neighbours(group)
    result = np.zeros((len(contexts), REACH), bool)
    for distance in range(REACH):
        present = (to_anchor >= distance) & (to_anchor - run <= distance)
        if not present.any():
            continue
        kind = np.empty(len(contexts), np.int64)
        other = np.empty(len(contexts), np.int64)
        kind[after_order] = np.cumsum(after_common < LENGTH - distance)
        other[ahead_order] = np.cumsum(ahead_common < distance)
        code = kind[present] * (len(contexts) + 1) + other[present]
        _, place, times = np.unique(code, return_inverse=True, return_counts=True)
        result[present, distance] = times[place] > 1
    return result


def _spans(key, place: int, flags: np.ndarray) -> list[tuple]:
    """Covered bytes of the flagged strings of a run."""
    first, to_anchor = place >> 16, place & 255
    positions = np.flatnonzero(flags[::-1])
    if not len(positions):
        return []
    at = first + to_anchor - (REACH - 1) + positions
    cut = np.flatnonzero(np.diff(at) > 1)
    return [(key, int(s), int(e) + LENGTH) for s, e in zip(at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])], strict=True)]


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive group by group; whole groups are sorted together in batches."""
    held: list[tuple] = []

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        group = np.unique([r[1] for r in rows], return_inverse=True)[1]
        # equal anchors stand together already; number them in order
        group = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
        place = np.array([r[2] for r in rows], np.int64)
        flags = repeated_strings(group, [r[4] for r in rows], place >> 8 & 255, place & 255)
        spans = [s for r, f in zip(rows, flags, strict=True) if not r[3] for s in _spans(r[0], r[2], f)]
        return pa.RecordBatch.from_arrays(
            [pa.array([s[0] for s in spans], pa.binary()), pa.array([s[1] for s in spans], pa.int64()), pa.array([s[2] for s in spans], pa.int64())],
            names=["key", "start", "stop"],
        )

    for rows in batches:
        for row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if len(held) >= BATCH and row[1] != held[-1][1]:
                yield finish(held)
                held = []
            held.append(row)
    if held:
        yield finish(held)


def _hash_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a hot anchor as two hashes."""
    for rows in batches:
        for key, anchor, place, known, data in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            values = np.frombuffer(data, np.uint8)
            count = (place >> 8 & 255) + 1
            at = np.arange(count)
            sums, inverse = _prefix(values, 0)
            hashes = [_mix((sums[at + LENGTH] - sums[at]) * inverse[at]).view(np.int64), _digests(data, at.tolist(), (at + LENGTH).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * count, pa.binary()), pa.array([anchor] * count, pa.int64()), pa.array((place >> 16) + at),
                 pa.array([known] * count, pa.bool_()), pa.array(hashes[0]), pa.array(hashes[1])],
                names=["key", "anchor", "start", "known", "h1", "h2"],
            )


def repeats(docs: DataFrame) -> DataFrame:
    """key (of a text), start, stop: bytes covered by repeated strings; spans may overlap."""
    send_code(docs.sparkSession)
    texts = docs.select(text_or_empty().alias("text")).filter(F.octet_length("text") >= LENGTH)
    # used twice: written, as the runs of a text cost far more to find than to read
    found = stored(
        texts.select(text_digest(F.col("text")).alias("key"), "text").mapInArrow(_emit_runs, "key binary, anchor long, context long, place long, proof long"), "found"
    )
    # sums are written before they are joined: a join right above an aggregate cannot split a hot key
    again = stored(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "again")
    candidates = stored(found.join(again, "anchor"), "runs")

    contexts = stored(
        candidates.groupBy("anchor", "context", "proof").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("one")), "contexts"
    )
    whole = contexts.filter("n > 1").select("anchor", "context", "proof")
    first = F.shiftright("place", 16)
    covered = (
        candidates.join(whole, ["anchor", "context", "proof"])
        .select("key", first.alias("start"), (first + F.shiftright("place", 8).bitwiseAND(255) + LENGTH).alias("stop"))
        .distinct()
    )
    # anchors that have a run with a context of its own, beside other contexts
    mixed = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least")).filter("contexts > 1 AND least = 1")
    asked = (
        contexts.join(mixed.select("anchor", "contexts"), "anchor")
        .select("one.key", F.struct("anchor", "one.place", (F.col("n") > 1).alias("known")).alias("run"))
        .groupBy("key")
        .agg(F.collect_list("run").alias("runs"))
    )
    pieces = distinct_texts(docs).join(asked, "key").select("key", "text", "runs")
    fetched = stored(pieces.mapInArrow(_emit_contexts, "key binary, anchor long, place long, known boolean, bytes binary"), "pieces")

    sizes = mixed.select("anchor", (F.col("contexts") > HOT).alias("hot"))
    sized = fetched.join(sizes, "anchor").select("key", "anchor", "place", "known", "bytes", "hot")
    cool = sized.filter("NOT hot").drop("hot")
    sorted_ = (
        cool.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_groups, "key binary, start long, stop long")
    )
    strings = (
        sized.filter("hot")
        .drop("hot")
        .mapInArrow(_hash_strings, "key binary, anchor long, start long, known boolean, h1 long, h2 long")
    )
    twice = (
        strings.groupBy("anchor", "h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("anchor", "h1", "h2")
    )
    counted = strings.filter("NOT known").join(twice, ["anchor", "h1", "h2"]).select("key", "start", (F.col("start") + LENGTH).alias("stop"))
    return covered.union(sorted_).union(counted)


def merged(spans) -> list[list[int]]:
    """Maximal runs of covered bytes."""
    result: list[list[int]] = []
    for s in sorted((s["start"], s["stop"]) for s in ([] if spans is None else spans)):
        if result and s[0] <= result[-1][1]:
            result[-1][1] = max(result[-1][1], s[1])
        else:
            result.append(list(s))
    return result


def _kept(data: bytes, spans: list[list[int]]) -> bytes:
    at, kept = 0, []
    for start, stop in spans:
        kept.append(data[at:start])
        at = stop
    return b"".join([*kept, data[at:]])


def with_spans(docs: DataFrame, name: str = "__spans") -> DataFrame:
    """``docs`` with a column of start and stop pairs, null where nothing repeats; ``name`` is free in ``docs``."""
    key = free_name(docs, "text_key")
    spans = stored(repeats(docs), "repeats").distinct().groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct("start", "stop")).alias(name))
    # written before they are joined, so that the copies of one text can be split over tasks
    spans = stored(spans, "spans")
    return docs.withColumn(key, text_digest(text_or_empty())).join(spans, key, "left").select(*docs.columns, name)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.list_(pa.int64()))
        for rows in batches:
            found = []
            for text, spans in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                data, cut = text.encode("utf-8", "replace"), merged(spans)
                found.append((len(data), sum(e - s for s, e in cut), len(cut), hashlib.sha256(_kept(data, cut)).hexdigest(), cut))
            columns = list(zip(*found, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pair]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return with_spans(rows).select("doc_id", "text", "__spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the repeated bytes; what is left of a cut character goes too. Documents of which
    nothing but white space is left are dropped, untouched ones stay as they are.

    One pass reads every row once.
    """
    name, columns = free_name(docs, "spans"), docs.columns
    at = columns.index(docs.schema["text"].name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, at, BATCH_BYTES):
            texts, keep = rows.column(at).to_pylist(), []
            for i, spans in enumerate(rows.column(len(columns)).to_pylist()):
                if spans is not None:
                    texts[i] = _kept(texts[i].encode("utf-8", "replace"), merged(spans)).decode("utf-8", "ignore")
                keep.append(spans is None or bool(texts[i].strip()))
            cut = rows.columns[:-1]
            cut[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cut, names=columns).filter(pa.array(keep, pa.bool_()))

    return with_spans(docs, name).mapInArrow(run, docs.schema)
