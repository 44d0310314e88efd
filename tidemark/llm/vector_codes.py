"""Vector codes: every part of a vector becomes the number of its nearest codebook entry, found by Orchard's search.

Components become integers, so all sums and distances are exact and the codebooks do not depend on row order. A
codebook starts with the parts of the vectors of the least ids; each round assigns all parts and moves every entry to the mean
of its parts.

Orchard's search holds for every entry the list of all entries by their distance to it. A part walks the list of its best entry so
far. An entry that is nearer takes over, and the walk goes on in its list; entries that were met before are passed over. The walk ends at an entry
that is more than twice as far from the best one as the part itself is: by the triangle inequality none behind it is nearer. (An entry at exactly
twice the distance may be as near, so it is still looked at: of equals the lower index is taken.) All parts of a batch walk together in numpy.

A round is one scan: tasks send sums and counts of their parts for each entry, Spark adds them up, and the codebooks, whose size the
parameters fix, go through the driver. No vector moves.

Defined cases: rows whose vector is null or holds a null or a non-finite component are dropped, and rows whose length is
not that of the kept vector of the least id, or no multiple of ``parts``. A null id is coded but does not start a codebook unless no other is
left. Of equal ids the smaller vector comes first. With fewer vectors than entries there are fewer entries. Components of any size are exact; an error beyond a
64-bit integer is null. Null labels share one sum. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import send_code, stored

ENTRIES = 16
PARTS = 8
ROUNDS = 6
SCALE = 4096
#: vectors that walk together: bounds a worker's memory
BATCH = 4096
#: sums travel as digits of this base, so that Spark's 64-bit sums of them cannot overflow
DIGIT_BITS = 31
#: components below this leave 64-bit room for squares and sums
SMALL = 2**24
LONG = 2**63 - 1

SCHEMA = "vec_id long, label long, code string, error long"


def _usable(vector: Column, parts: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0) & finite


def _integers(vectors: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the kept vectors and their components as integers."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False))
    rows = np.flatnonzero(lengths == size)
    flat = vectors.take(pa.array(rows)).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)  # nulls become nan
    fine = np.isfinite(values).all(axis=1)
    return rows[fine], integers(values[fine], scale)


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as Python integers where 64 bits may not do for sums of squares."""
    if values.size == 0 or np.abs(values).max() * scale < SMALL:
        return np.floor(values * scale).astype(np.int64)
    exact = [int(x) * scale if x.is_integer() else int(x * scale // 1) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    step = a - b
    return (step * step).sum(axis=-1)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each point, the lower index of equals, by Orchard's search."""
    if points.dtype == object or entries.dtype == object:
        points, entries = points.astype(object), entries.astype(object)
    count, size = len(points), len(entries)
    between = _squares(entries[:, None, :], entries[None, :, :])
    lists = np.stack([np.array(sorted(range(size), key=lambda e, row=row: (row[e], e))) for row in between.tolist()])
    ordered = np.take_along_axis(between, lists, axis=1)
    best = np.zeros(count, np.int64)
    found = _squares(points, entries[0])
    met = np.zeros((count, size), bool)
    met[:, 0] = True
    at, walking = np.zeros(count, np.int64), np.arange(count)
    while len(walking):
        mine, place = best[walking], at[walking]
        # twice the distance is four times its square
        go = (ordered[mine, place] <= 4 * found[walking]).astype(bool)
        walking, mine, place = walking[go], mine[go], place[go]
        entry = lists[mine, place]
        new = ~met[walking, entry]
        met[walking, entry] = True
        at[walking] += 1
        rows, entry = walking[new], entry[new]
        distance = _squares(points[rows], entries[entry])
        nearer = ((distance < found[rows]) | ((distance == found[rows]) & (entry < best[rows]))).astype(bool)
        rows = rows[nearer]
        best[rows], found[rows], at[rows] = entry[nearer], distance[nearer], 0
        walking = walking[at[walking] < size]
    return best, found


def _digits(total: int) -> list[int]:
    """Digits of a number from the lowest, the last one signed."""
    digits = []
    while not -(2**DIGIT_BITS) <= total < 2**DIGIT_BITS:
        digits.append(total & (2**DIGIT_BITS - 1))
        total >>= DIGIT_BITS
    return [*digits, total]


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` has a row of integers for each entry."""

    entries: list[np.ndarray]
    scale: int = SCALE

    @property
    def size(self) -> int:
        """Components of a vector."""
        return len(self.entries) * self.entries[0].shape[1]

    def parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        return np.split(vectors, len(self.entries), axis=1)

    def digest(self) -> str:
        numbers = (str(int(x)) for book in self.entries for x in book.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> Codebooks | None:
    """The parts of the vectors of the least ids; None without any."""
    kept = vectors.select("vec_id", "embedding").filter(_usable(F.col("embedding"), parts))
    order = [F.asc_nulls_last("vec_id"), F.asc("embedding")]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return None
    size = len(first[0].embedding)
    rows = kept.filter((F.size("embedding") == size) & (F.col("vec_id").isNotNull() | F.lit(first[0].vec_id is None)))
    values = np.array([r.embedding for r in rows.orderBy(*order).limit(entries).collect()], np.float64)
    return Codebooks(np.split(integers(values, scale), parts, axis=1), scale)


def _in_batches(batches: Iterator[pa.RecordBatch], column: int, books: Codebooks) -> Iterator[tuple]:
    """Rows, their numbers and integer vectors."""
    for rows in batches:
        for start in range(0, rows.num_rows, BATCH):
            part = rows.slice(start, BATCH)
            numbers, vectors = _integers(part.column(column), books.size, books.scale)
            yield part, numbers, vectors


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[0] * len(book) for book in books.entries]
        sums = [[[0] * book.shape[1] for _ in book] for book in books.entries]
        for _, _, kept in _in_batches(batches, 0, books):
            for p, (points, book) in enumerate(zip(books.parts(kept), books.entries, strict=True)):
                best, _ = nearest(points, book)
                for e in np.unique(best).tolist():
                    mine = points[best == e]
                    counts[p][e] += len(mine)
                    sums[p][e] = [a + int(b) for a, b in zip(sums[p][e], mine.sum(axis=0).tolist(), strict=True)]
        out = []
        for p, by_entry in enumerate(counts):
            for e, n in enumerate(by_entry):
                if n:
                    out.append((p, e, -1, 0, n))
                    out += [(p, e, j, k, d) for j, total in enumerate(sums[p][e]) for k, d in enumerate(_digits(total))]
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "digit", "total"])

    sent = vectors.select("embedding").mapInArrow(run, "part long, entry long, place long, digit long, total long")
    totals: dict[tuple[int, int, int], int] = {}
    for r in sent.groupBy("part", "entry", "place", "digit").agg(F.sum("total").alias("total")).collect():
        key = (r.part, r.entry, r.place)
        totals[key] = totals.get(key, 0) + (r.total << DIGIT_BITS * r.digit)
    moved = []
    for p, book in enumerate(books.entries):
        new = book.astype(object)
        for e in range(len(book)):
            if n := totals.get((p, e, -1)):
                new[e] = [totals[p, e, j] // n for j in range(book.shape[1])]
        small = all(abs(x) < SMALL for x in new.ravel().tolist())
        moved.append(new.astype(np.int64) if small else new)
    return Codebooks(moved, books.scale)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of all vectors; None if no vector is kept."""
    send_code(vectors.sparkSession)
    books = first_codebooks(vectors, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = _moved(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, label, code and error of every kept row."""
    spark = vectors.sparkSession
    if books is None:
        return spark.createDataFrame([], SCHEMA)
    send_code(spark)
    fields = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, kept in _in_batches(batches, 2, books):
            found = [nearest(points, book) for points, book in zip(books.parts(kept), books.entries, strict=True)]
            codes = np.stack([f[0] for f in found], axis=1).tolist()
            errors = sum(f[1] for f in found).tolist()
            taken = part.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column(0), taken.column(1), pa.array(["".join(f"{c:02x}" for c in code) for code in codes], pa.string()),
                    pa.array([e if e <= LONG else None for e in errors], pa.int64()),
                ],
                schema=fields,
            )

    return vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").mapInArrow(run, SCHEMA)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every kept row."""
    books = fit(vectors, parts, entries, rounds, scale)
    coded = stored(encode(vectors, books), "codes")
    # an error too large for a long makes its label's sum null
    total = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error")
    # written before it is joined: a join right above an aggregate cannot split a hot label
    sums = stored(coded.groupBy(F.col("label").alias("of_label")).agg(total), "label-errors")
    digest = F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256")
    joined = coded.join(sums, coded["label"].eqNullSafe(sums["of_label"]))
    return joined.select("vec_id", "label", "code", "error", "label_error", digest)


def decode(code: str, books: Codebooks) -> np.ndarray:
    """The vector that a code stands for, in scaled integers."""
    numbers = [int(code[i : i + 2], 16) for i in range(0, len(code), 2)]
    return np.concatenate([book[n] for n, book in zip(numbers, books.entries, strict=True)])


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codebooks and codes by comparing all entries."""
    square = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""usable AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), kept AS MATERIALIZED (
  SELECT * FROM usable WHERE len(v) = (SELECT len(v) FROM usable ORDER BY vec_id NULLS LAST, v LIMIT 1)
), pieces AS MATERIALIZED (
  SELECT r, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) AS x FROM kept, range({parts}) t(part)
), c0 AS MATERIALIZED (
  SELECT part, e, x FROM pieces JOIN (
    SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id, v LIMIT {entries}
  ) USING (r)
)"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (
  SELECT p.r, p.part, min({square} * {entries} + c.e) AS best FROM pieces p JOIN c{n} c ON c.part = p.part GROUP BY p.r, p.part
)"""
        )
        if n < rounds:
            steps.append(
                f"""s{n} AS (
  SELECT part, best % {entries} AS e, i, sum(x[i]) AS total, count(*) AS n
  FROM a{n} JOIN pieces USING (r, part), unnest(range(1, len(x) + 1)) u(i) GROUP BY 1, 2, 3
), m{n} AS (
  SELECT part, e, list(CAST((total - ((total % n) + n) % n) // n AS HUGEINT) ORDER BY i) AS x FROM s{n} GROUP BY part, e
), c{n + 1} AS MATERIALIZED (
  SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN m{n} m ON m.part = c.part AND m.e = c.e
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f""", codes AS (
  SELECT r, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r
), books AS (
  SELECT sha256(string_agg(CAST(x[i] AS VARCHAR), ',' ORDER BY part, e, i)) AS codebooks_sha256 FROM c{rounds}, unnest(range(1, len(x) + 1)) u(i)
)
SELECT vec_id, CAST(label AS BIGINT) AS label, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), books"""
    )


SQL = _sql()
