import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from odd import ODD
from tidemark.llm import language, packing, spots, token_counts, toxicity
from tidemark.llm.common import table
from tidemark.llm.pieces import PieceCoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

NASTY = [
    "don't it'S we'll !!'s ''s", "naïve Σας ΑΣ", "a  b\n\n c \t", "<|endoftext|> x <|startoftext|>y", "日本語 テスト",
    "İstanbul é ½ x²  a\x85b\xa0c", "", "   ", " 12 345abc", "Été ŸŽ ſs \x1c \x0b", "é ª º ​",
]


# language


def test_held_out_accuracy(spark, data):
    docs = table(spark, data, "documents")
    found = {r.doc_id: r for r in language.predict(docs, language.fit(docs)).collect()}
    rows = docs.filter(docs.lang.isNotNull()).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and all(found[r.doc_id].held_out == (r in held) for r in rows)
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_training_never_sees_held_out_or_unlabelled_rows(documents):
    docs = documents([(i, f"text {i}", "en" if i % 2 else None) for i in range(60)])
    seen = {r.text for r in language.training_rows(docs, 1000).collect()}
    assert seen == {f"text {i}" for i in range(1, 60, 2) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert language.training_rows(docs, 5).count() == 5


def test_language_of_odd_rows(odd, empty):
    model = language.train(["hello there my friend"] * 4 + ["über öl grüße straße"] * 4, ["en"] * 4 + ["de"] * 4, rounds=3)
    rows = language.predict(odd, model).collect()
    assert len(rows) == len(ODD)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 4)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows) and {r.lang_pred for r in rows} <= {"en", "de", "und"}
    assert language.predict(empty, model).count() == 0 and language.fit(empty) is None
    assert {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}


def test_numbers_are_no_letters(documents):
    model = language.train(["hello there my friend"] * 4 + ["über öl grüße straße"] * 4, ["en"] * 4 + ["de"] * 4, rounds=3)
    rows = language.predict(documents([(1, "½ ² Ⅻ ٣ 12"), (2, "½ a"), (3, "日"), (4, "_")]), model).collect()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 4}


def test_labelled_documents_keep_their_rows(documents, odd, empty):
    model = language.train(["hello there my friend"] * 9 + ["über öl grüße straße"] * 9, ["en"] * 9 + ["de"] * 9, rounds=8)
    docs = documents([(1, "hello there my friend hello", "de"), (2, "über öl grüße straße", None), (3, "12", "en"), (4, None, "en")])
    kept = language.label(docs, model, 0.5)
    assert kept.schema == docs.schema and {r.doc_id: r.lang for r in kept.collect()} == {1: "en", 2: "de"}
    assert {r.spans for r in kept.collect()} == {"spans"}
    # one node scores each text once
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    assert language.label(empty, model, 0.5).count() == 0 and language.label(docs, None, 0.5).count() == 0
    left = language.label(odd, model, 0.0).collect()
    assert len(left) == len(ODD) - 5


def test_tables_equal_filters():
    """Looking filters up by byte is the trained network itself."""
    model = language.train(["abc abc", "xyz xyz"] * 3, ["a", "b"] * 3, rounds=2)
    x = np.stack([language.windows(t.encode())[0] for t in ("abc abc", "xyz", "q")])
    slow = []
    for w, kernel in model.tables.items():
        response = [[sum(kernel[j][row[i + j]] for j in range(w)) for i in range(len(row) - w + 1)] for row in x]
        slow.append(np.max(response, axis=1))
    hidden = np.maximum(np.concatenate(slow, axis=1) + model.bias, 0) @ model.weights + model.offset
    assert np.allclose(model.log_probabilities(x), hidden - np.log(np.exp(hidden).sum(axis=1, keepdims=True)), atol=1e-4)


# spots


def plain_edit(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    result = {}
    for (i, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        t, n = t or "", n or ""
        k = len(t) // 3
        result[i] = (len(t), t[: len(t) - k] + n[:k], n)
    return result


@pytest.mark.parametrize("count", [1, 2, 40])
def test_edited_texts_and_likeness(documents, count):
    rows = [(3 * i, None if i == 5 else f"the {i} house of the river {'é' * i} and a boat in green water " * (i % 7)) for i in range(count)]
    expected = plain_edit(rows)
    for r in spots.neighbour_likeness(documents(rows)).collect():
        n, changed, following = expected[r.doc_id]
        a, b, c = (set(spots.signatures(t).tolist()) for t in (dict(rows)[r.doc_id] or "", changed, following))
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{v:08x}" for v in sorted(a)) and r.edited_fingerprint == "".join(f"{v:08x}" for v in sorted(b))
        assert math.isclose(r.near_edited, len(a & b) / len(a | b) if a | b else 1.0)
        assert math.isclose(r.near_next, len(a & c) / len(a | c) if a | c else 1.0)


def test_rows_of_null_and_hot_ids_are_spread(documents, spark):
    """A third of the rows has no id, a third one id; their order is that of the hashes of their texts."""
    rows = [(None if i % 3 == 0 else 50 if i % 3 == 1 else i, f"the {i} house of the river and {i * i} boats in water") for i in range(300)]
    docs = documents(rows)
    sizes = [r[0] for r in spots._ranges(docs.select("doc_id", "text"), 8).groupBy("part").count().select("count").collect()]
    assert len(sizes) > 20 and max(sizes) < 60
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), _signed_hash(r[1]) >> 1))
    texts = [t for _, t in ordered]
    expected = sorted(hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest() for t, n in zip(texts, texts[1:] + texts[:1], strict=True))
    assert sorted(r.edited_sha256 for r in spots.neighbour_likeness(docs).collect()) == expected


def _signed_hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_near_documents_against_all_pairs(documents, least):
    r = np.random.default_rng(5)
    names = [f"w{i}" for i in range(40)] + ["the", "of", "and", "in"] * 4
    texts = []
    for i in range(60):
        if i % 3 and texts:
            words = texts[int(r.integers(len(texts)))].split()
            for _ in range(int(r.integers(0, 6))):
                words[int(r.integers(len(words)))] = str(r.choice(names))
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(r.choice(names, int(r.integers(5, 80)))))
    rows = list(enumerate([*texts, texts[0], None, "", "..."]))
    links, entries = spots.near_documents(documents(rows), least)
    entry = {row.doc_id: row.entry for row in entries.collect()}
    sets = {entry[i]: set(spots.signatures(t or "").tolist()) for i, t in rows}
    assert len({frozenset(s) for s in sets.values()}) == len(sets) and len(entry) == len(rows)
    expected = {}
    for u in sets:
        for v in sets:
            if u < v and sets[u] and sets[v] and (near := len(sets[u] & sets[v]) / len(sets[u] | sets[v])) >= least:
                expected[u, v] = near
    found = {(min(row.u, row.v), max(row.u, row.v)): row.likeness for row in links.collect()}
    assert found.keys() == expected.keys() and all(math.isclose(found[k], expected[k]) for k in found)
    assert expected or least == 1.0


def test_near_documents_of_odd_rows(odd, empty):
    links, entries = spots.near_documents(odd)
    assert links.count() == 0 and entries.count() == len(ODD)
    links, entries = spots.near_documents(empty)
    assert links.count() == 0 and entries.count() == 0
    with pytest.raises(ValueError):
        spots.near_documents(odd, 0)


def test_chains_by_hand():
    mixed = spots.signatures("The river house was green water")
    assert len(mixed) == 2  # the+river+house, was+green+water
    assert set(spots.signatures("the river house").tolist()) < set(mixed.tolist())
    assert len(spots.signatures("boat")) == 1 and len(spots.signatures("")) == 0


def test_pruning_by_length_keeps_what_can_be_alike():
    a, b = np.arange(10, dtype=np.uint64), np.arange(8, dtype=np.uint64)
    assert spots.jaccard(a, b, 0.8) == 0.8 and spots.jaccard(a, b[:7], 0.8) == 0.0


def test_spots_of_odd_rows(odd, empty):
    rows = spots.neighbour_likeness(odd).collect()
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(repr(i) for i, _ in ODD)
    assert spots.neighbour_likeness(empty).count() == 0


# tokens


@pytest.mark.parametrize("path,kind", [(WORDS, "words"), (BYTES, "bytes")])
def test_ids_are_the_librarys(path, kind):
    own, library = PieceCoder(path, kind), Tokenizer.from_file(path)
    for text in NASTY + [t for _, t in ODD if t]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids and own.count(text) == len(ids)


def test_packing_is_a_partition_of_all_ids(documents):
    rows = ODD + [(100 + i, t) for i, t in enumerate(NASTY)] + [(200 + i, "some words here " * (i * 37 % 900)) for i in range(120)]
    rows = [r for r in rows if r[0] not in (7, 8, None)]
    library = Tokenizer.from_file(WORDS)
    pieces = packing.pack(documents(rows), WORDS).collect()
    by_doc, by_window = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_window.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == {i for i, _ in rows}
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    for window in by_window.values():
        at = 0
        for p in sorted(window, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048


def test_differencing_levels_and_raises_the_count():
    sizes = [(i * 7919) % 500 + 1 for i in range(300)]
    sets = packing.difference(sizes, 20)
    sums = [sum(sizes[i] for i in s) for s in sets]
    assert sorted(i for s in sets for i in s) == list(range(300)) and max(sums) - min(sums) < 20
    assert sorted(map(len, packing.deal([1500, 1500, 1500]))) == [1, 1, 1]


def test_packing_odd_tables(odd, empty):
    assert packing.pack(empty, WORDS).count() == 0
    assert packing.pack(odd, WORDS).select("doc_id").distinct().count() == 10


def test_counts_and_cache(spark, odd, empty, tmp_path, monkeypatch):
    library, cache = Tokenizer.from_file(BYTES), str(tmp_path / "cache")
    assert token_counts.count_tokens(empty, BYTES, cache).count() == 0
    found = sorted(tuple(r)[:4] for r in token_counts.count_tokens(odd.filter("doc_id IS NOT NULL"), BYTES, cache).collect())
    expected = []
    for i, t in ODD:
        if i is not None:
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            expected.append((i, len((t or "").encode()), n, n > 1024))
    assert found == sorted(expected)
    stored = token_counts.read_cache(spark, cache, token_counts.tokenizer_version(BYTES))
    before = stored.count()
    assert before == len({t or "" for i, t in ODD if i is not None})
    missed = []
    encode = token_counts._encode
    monkeypatch.setattr(token_counts, "_encode", lambda df, path: missed.append(df.count()) or encode(df, path))
    token_counts.count_tokens(odd, BYTES, cache).collect()
    token_counts.count_tokens(odd, BYTES, cache).collect()
    assert missed == [1, 0]


# toxicity


def test_severity_grades(spark, documents):
    words = ["stone", "river", "house", "green", "water", "light", "paper", "cloud"]
    rows, labels = [], []
    for i in range(400):
        grade = 0 if i % 4 else 1 + (i // 4) % 2
        extra = ["", "awful", "awful vile"][grade]
        rows.append((i, " ".join(words[(i * k) % 8] for k in range(1, 12)) + " " + extra))
        labels.append((i, 0 if grade == 2 else 1, int(grade > 0)))
    docs, known = documents(rows), spark.createDataFrame(labels + [(None, 1, 1), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    found = {r.doc_id: r for r in toxicity.predict(docs, model).collect()}
    for i, quality, toxic in labels:
        assert found[i].grade == (0 if not toxic else 2 - quality) and found[i].toxic == bool(toxic)
    assert found[0].severity < found[4].severity and found[1].severity < found[0].severity


def test_toxicity_of_odd_rows(spark, odd, empty, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, none)
    rows = toxicity.predict(odd, model).collect()
    assert len(rows) == len(ODD) and all(r.severity < 1e-6 and not r.toxic for r in rows)
    assert toxicity.predict(empty, model).count() == 0
    one = spark.createDataFrame([(7, 1, 1), (7, 0, 1), (9, None, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.predict(odd, toxicity.fit(odd, one)).count() == len(ODD)


def test_gradient_of_the_ordinal_loss():
    """The fitted thresholds without features are the log-odds of the grades."""
    grades = np.array([0] * 60 + [1] * 30 + [2] * 10)
    _, cuts = toxicity.fit_thresholds([np.zeros(0, int)] * 100, grades, 0)
    assert np.allclose(cuts, [np.log(60 / 40), np.log(90 / 10)], atol=0.05)
