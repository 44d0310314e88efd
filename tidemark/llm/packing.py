"""Packing documents into training windows by multiway differencing (Karmarkar-Karp).

Every document is coded, closed with an end id and cut at window size; the full pieces are windows of
their own. What is left over is cut into short pieces, which differencing spreads over windows: each
piece starts as a partition of its own, and the two partitions with the largest imbalance are merged,
heavy windows of one onto light windows of the other, until one is left. All windows of a group then
have nearly the same length. If one is above capacity, the group gets one more window and is dealt anew.

A group takes pieces until ``GROUP_WINDOWS`` windows are filled to ``FILL``, so memory does not depend on
the input. Packing goes on inside the input's partitions: no shuffle, and an executor that is lost only
repeats its own partitions. ``sequence_id`` is the partition number and a count inside it.

Defined cases: null text is empty (one piece: the end id). Null ids are packed and stay null. Repeated
rows are packed as often as they occur. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import send_code, slices, text_or_empty
from tidemark.llm.pieces import coder

WINDOW = 2048
END_ID = 1
#: left-over pieces are at most a quarter of a window, so that differencing can level them
PIECE = WINDOW // 4
GROUP_WINDOWS = 48
FILL = 0.985
#: bytes of text coded before their pieces are handed on
BATCH_BYTES = 1 << 22

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], ways: int) -> list[list[int]]:
    """Indexes of ``sizes`` in ``ways`` sets of nearly equal sums."""
    heap = []
    for number, size in enumerate(sizes):
        sums = np.zeros(ways, np.int64)
        sums[0] = size
        heap.append((-size, number, sums, [[number]] + [[]] * (ways - 1)))
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, left, left_sets = heapq.heappop(heap)
        _, _, right, right_sets = heap[0]
        # heaviest of one with lightest of the other
        sums = left + right[::-1]
        order = np.argsort(-sums, kind="stable")
        sets = [a + b for a, b in zip(left_sets, reversed(right_sets), strict=True)]
        sums = sums[order]
        number += 1
        heapq.heapreplace(heap, (int(sums[-1] - sums[0]), number, sums, [sets[i] for i in order]))
    return heap[0][3] if heap else [[] for _ in range(ways)]


def deal(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Sets of at most ``window``: as few as fit, one more whenever capacity is exceeded."""
    ways = max(1, -(-sum(sizes) // window))
    while True:
        sets = difference(sizes, ways)
        if all(sum(sizes[i] for i in s) <= window for s in sets):
            return [s for s in sets if s]
        ways += 1


class _Packer:
    def __init__(self, partition: int, window: int) -> None:
        self.window, self.piece = window, max(1, window * PIECE // WINDOW)
        self.next_id = partition << 40
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []
        self.waiting_tokens = 0

    def add(self, doc_id, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        view = memoryview(ids)
        while at < total:
            left = total - at
            length = self.window if left >= self.window else min(left, self.piece)
            piece = (doc_id, at, length, zlib.crc32(view[4 * at : 4 * (at + length)]), total)
            if length == self.window:
                self.rows.append((*piece, self.next_id, 0))
                self.next_id += 1
            else:
                self.waiting.append(piece)
                self.waiting_tokens += length
                if self.waiting_tokens >= GROUP_WINDOWS * self.window * FILL - self.piece / 2:
                    self.deal_waiting()
            at += length

    def deal_waiting(self) -> None:
        for chosen in deal([p[2] for p in self.waiting], self.window) if self.waiting else []:
            offset = 0
            for i in chosen:
                self.rows.append((*self.waiting[i], self.next_id, offset))
                offset += self.waiting[i][2]
            self.next_id += 1
        self.waiting, self.waiting_tokens = [], 0

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it comes from (``doc_id``, ``start``, ``length``) and where it lies
    (``sequence_id``, ``offset``). ``tokenizer`` is a word tokenizer's file on every machine."""
    send_code(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(f, pa.int64()) for f in fields])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer, "words").encode
        packer = _Packer(TaskContext.get().partitionId(), window)
        for rows in slices(batches, 1, BATCH_BYTES):
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                packer.add(doc_id, code(text) + end)
            if done := packer.take():
                yield batch(done)
        packer.deal_waiting()
        if done := packer.take():
            yield batch(done)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
