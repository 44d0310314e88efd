"""Language identification with a small byte convolutional network, trained here in numpy.

Training takes a bounded sample: at most ``SAMPLE_PER_LANGUAGE`` labelled texts of each language, those
that come first by a hash of id and text, and of each text one stretch at a hashed place. The network
embeds bytes, runs filters of several widths over a window, keeps each filter's maximum and ends in a
softmax.

For prediction a trained filter is a sum of one table per filter position, looked up by byte. Every whole
text is cut into windows of fixed length; the log-probabilities of its windows are averaged by length.
Windows of many texts are scored together in batches of bounded size.

Defined cases: null text, or text without a letter, is ``und`` with score 0; so is every text when no
labelled text exists. With one learned language all other texts get it with score 1. Null ids stay null and
count as not held out. Repeated rows are predicted each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import only, send_code, slices, text_or_empty

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 1500
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 12
#: windows scored at once: bounds a worker's memory whatever the length of a text
BATCH = 64
#: bytes of text scored before their rows are handed on
BATCH_BYTES = 1 << 22

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def held_out():
    """Documents that training must not see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` stretches of text for each language, those of the least hashes.

    A scan of ``lang`` counts the rows of each language (a short list, as the model has weights for each), so that a row whose hash
    is beyond four times the expected limit goes before anything moves: what is ranked does not grow with a language.
    """
    usable = docs.filter(F.col("lang").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    limits = [F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 4 * per_language / n))]
    # a language that the scan has not met is empty
    limit = F.coalesce(F.create_map(*limits)[F.col("lang")], F.lit(0.0)) if limits else F.lit(0.0)
    place = 1 + F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - 2 * WINDOW, F.lit(1)))
    drawn = usable.filter(F.col("text").rlike(r"\p{L}")).select(
        "lang",
        "doc_id",
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**31)).alias("draw"),
        F.substring("text", place.cast("int"), F.lit(2 * WINDOW)).alias("text"),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    return drawn.filter(F.col("draw") < limit * F.lit(2.0**31)).withColumn("n", rank).filter(F.col("n") <= per_language).select("lang", "n", "text")


def windows(data: bytes, length: int = WINDOW) -> list[np.ndarray]:
    """Windows of one text; bytes of value 0 fill the last."""
    values = _LOWER[np.frombuffer(data, np.uint8)]
    count = max(1, -(-len(values) // length))
    padded = np.zeros(count * length, np.uint8)
    padded[: len(values)] = values
    return list(padded.reshape(count, length))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    tables: dict[int, np.ndarray]  # width -> position, byte, filter
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """A row per window."""
        pooled = []
        for width, table in self.tables.items():
            span = x.shape[1] - width + 1
            total = table[0][x[:, :span]]
            for j in range(1, width):
                total += table[j][x[:, j : j + span]]
            pooled.append(total.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return _log_softmax(hidden @ self.weights + self.offset)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(texts: list[str], labels: list[str], rounds: int = 12, seed: int = 7) -> Model:
    """Adam on cross-entropy; windows are cut to random lengths so that short texts are learned too."""
    random = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.array([languages.index(v) for v in labels])
    x = np.zeros((len(texts), WINDOW), np.uint8)
    for i, text in enumerate(texts):
        x[i] = windows(text.encode("utf-8", "replace")[:WINDOW])[0]
    weight = 1 / np.bincount(target, minlength=len(languages))[target]
    weight = (weight / weight.mean()).astype(np.float32)
    p = {"embed": random.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)}
    for w in WIDTHS:
        p[f"kernel{w}"] = random.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)).astype(np.float32)
    p["bias"] = np.zeros(FILTERS * len(WIDTHS), np.float32)
    p["weights"] = random.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
    p["offset"] = np.zeros(len(languages), np.float32)
    p["embed"][0] = 0
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for _ in range(rounds):
        order = random.permutation(len(texts))
        for start in range(0, len(order), 64):
            rows = order[start : start + 64]
            batch = x[rows].copy()
            keep = random.choice([12, 24, 48, 96, WINDOW], len(rows))
            batch[np.arange(WINDOW)[None, :] >= keep[:, None]] = 0
            grads = _gradients(p, batch, target[rows], weight[rows])
            step += 1
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                p[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)
            p["embed"][0] = 0
    tables = {w: np.stack([p["embed"] @ p[f"kernel{w}"][j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(w)]) for w in WIDTHS}
    return Model(languages, tables, p["bias"], p["weights"], p["offset"])


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    n, embedded = len(x), p["embed"][x]
    rows = np.arange(n)[:, None]
    places, pooled = {}, []
    for w in WIDTHS:
        span = x.shape[1] - w + 1
        columns = np.concatenate([embedded[:, j : j + span] for j in range(w)], axis=2)
        response = columns @ p[f"kernel{w}"]
        places[w] = response.argmax(axis=1)
        pooled.append(np.take_along_axis(response, places[w][:, None], axis=1)[:, 0])
    hidden = np.concatenate(pooled, axis=1) + p["bias"]
    active = np.maximum(hidden, 0)
    delta = np.exp(_log_softmax(active @ p["weights"] + p["offset"]))
    delta[np.arange(n), target] -= 1
    delta *= (weight / n)[:, None]
    grads = {"weights": active.T @ delta, "offset": delta.sum(axis=0), "embed": np.zeros_like(p["embed"])}
    back = (delta @ p["weights"].T) * (hidden > 0)
    grads["bias"] = back.sum(axis=0)
    for number, w in enumerate(WIDTHS):
        part = back[:, number * FILTERS : (number + 1) * FILTERS]
        kernel = np.zeros_like(p[f"kernel{w}"])
        for j in range(w):
            seen = x[rows, places[w] + j]
            block = slice(j * EMBEDDING, (j + 1) * EMBEDDING)
            kernel[block] = np.einsum("nfe,nf->ef", p["embed"][seen], part)
            np.add.at(grads["embed"], seen, part[:, :, None] * p[f"kernel{w}"][block].T[None])
        grads[f"kernel{w}"] = kernel
    return grads


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Model of the labelled texts that are not held out; None without any."""
    rows = training_rows(docs, per_language).orderBy("lang", "n").toPandas()
    return train(rows["text"].tolist(), rows["lang"].tolist()) if len(rows) else None


def _texts_to_scores(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    results: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    totals: dict[int, np.ndarray] = {}
    batch: list[tuple[int, int, np.ndarray]] = []

    def score() -> None:
        found = model.log_probabilities(np.stack([w for _, _, w in batch]))
        for (i, length, _), row in zip(batch, found, strict=True):
            totals[i] = totals.get(i, 0) + length * row
        batch.clear()

    for i, text in enumerate(texts):
        if text is None or not any(map(str.isalpha, text)):
            continue
        data = text.encode("utf-8", "replace")
        for at in range(0, len(data), WINDOW * BATCH):
            part = data[at : at + WINDOW * BATCH]
            for number, window in enumerate(windows(part)):
                batch.append((i, min(WINDOW, len(part) - number * WINDOW), window))
                if len(batch) == BATCH:
                    score()
        totals.setdefault(i, np.zeros(len(model.languages)))
        results[i] = ("", float(len(data)))
    if batch:
        score()
    for i, total in totals.items():
        shares = np.exp(_log_softmax(total[None] / results[i][1]))[0]
        best = int(shares.argmax())
        results[i] = (model.languages[best], float(min(1.0, shares[best])))
    return results


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; only the text is looked at."""
    send_code(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 2, BATCH_BYTES):
            texts = rows.column(2).to_pylist()
            found = _texts_to_scores(model, texts) if model else [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                schema=schema,
            )

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)


def label(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """The documents whose language is known with a score of ``least`` or more, ``lang`` as predicted.

    One pass scores every text once and hands on the rows that stay.
    """
    send_code(docs.sparkSession)
    kind, names = docs.schema["lang"].dataType, docs.columns
    text, at = names.index(docs.schema["text"].name), names.index(docs.schema["lang"].name)
    fields = [T.StructField("lang", T.StringType()) if i == at else f for i, f in enumerate(docs.schema.fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language")
        for rows in slices(batches, text, BATCH_BYTES):
            texts = rows.column(text).to_pylist()
            found = _texts_to_scores(model, texts) if model else [(UNKNOWN, 0.0)] * len(texts)
            columns = list(rows.columns)
            columns[at] = pa.array([f[0] for f in found], pa.string())
            known = pa.array([f[0] != UNKNOWN and f[1] >= least for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(known)

    kept = docs.mapInArrow(run, T.StructType(fields))
    return kept.withColumn(names[at], F.col(names[at]).cast(kind))
