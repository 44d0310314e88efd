import hashlib
import random

import numpy as np
import pytest

from odd import ODD
from tidemark.llm import suffixes
from tidemark.llm.suffixes import LENGTH


def brute(rows):
    """Result rows by counting every string of 200 bytes."""
    data = [(d, (t or "").encode()) for d, t in rows]
    counts = {}
    for _, b in data:
        for i in range(len(b) - LENGTH + 1):
            counts[b[i : i + LENGTH]] = counts.get(b[i : i + LENGTH], 0) + 1
    result = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - LENGTH + 1):
            if counts[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        result.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=repr)


def result(docs):
    return sorted((tuple(r)[:5] for r in suffixes.report(docs).collect()), key=repr)


def made(seed, count=60):
    """Texts that share passages of 150 to 450 bytes with all kinds of neighbours."""
    r = random.Random(seed)

    def noise(n):
        return "".join(r.choice("abcdé ") for _ in range(n))

    shared = [noise(r.randint(150, 450)) for _ in range(8)] + ["a" * 260, "ab" * 150]
    rows = []
    for i in range(count):
        text = "".join(noise(r.randint(0, 120)) + r.choice(shared)[r.randint(0, 60) :] for _ in range(r.randint(0, 4)))
        rows.append((i, text + noise(r.randint(0, 50))))
    return rows + [(1000, rows[3][1]), (1001, rows[3][1])]


@pytest.mark.parametrize("hot", [suffixes.HOT, 1])
def test_equals_counting_all_strings(documents, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = made(5)
    assert result(documents(rows)) == brute(rows)


def test_common_passage_between_unlike_neighbours(documents):
    r = random.Random(1)
    passage = "".join(r.choice("abcdefgh ") for _ in range(320))
    rows = [(i, "".join(r.choice("xyz ") for _ in range(80)) + passage[i % 3 :] + f" {i} tail") for i in range(90)]
    assert result(documents(rows)) == brute(rows)


def test_odd_rows_and_empty_table(odd, empty):
    assert result(odd) == brute(ODD)
    assert result(empty) == []


def test_stretches_do_not_change_the_result(documents, monkeypatch):
    rows = made(8, 20)
    found = sorted(tuple(map(int, r)) for _, t in rows for r in zip(*suffixes.runs(t.encode()), strict=True))
    monkeypatch.setattr(suffixes, "STRETCH", 97)
    # the same anchor for every position, only the runs are shorter
    short = [tuple(map(int, r)) for _, t in rows for r in zip(*suffixes.runs(t.encode()), strict=True)]
    positions = lambda runs: sorted((p, r[0], r[4]) for r in runs for p in range(r[2], r[3] + 1))
    assert positions(found) == positions(short)


def test_suffix_order_is_byte_order():
    r = random.Random(3)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) for _ in range(300)]
    group = np.sort(np.array([r.randint(0, 9) for _ in strings]))
    order, common = suffixes.Suffixes(strings, 12).neighbours(group)
    assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings, strict=True))
    for n in range(1, len(order)):
        a, b = strings[order[n - 1]], strings[order[n]]
        same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert common[n] == (same if group[order[n]] == group[order[n - 1]] else -1)


def test_colliding_hashes_are_found_out(monkeypatch):
    strings = [b"ba", b"ab", b"bb", b"aa", b"ab"]
    monkeypatch.setattr(suffixes, "_CODES", np.ones((2, 256), np.uint64))
    order, common = suffixes.Suffixes(strings, 2).neighbours(np.zeros(5, int))
    assert [strings[i] for i in order] == sorted(strings) and common.tolist() == [-1, 1, 2, 0, 1]


def test_cut_documents_keep_their_columns(documents):
    passage = "xyz" * 100
    docs = documents([(1, "head é" + passage), (2, passage + " tail"), (3, passage), (4, None), (5, "short")])
    kept = suffixes.without_repeats(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "head é", 2: " tail", 4: None, 5: "short"}


def test_cut_stage_on_odd_rows(odd, empty):
    kept = suffixes.without_repeats(odd)
    assert kept.schema == odd.schema
    # nothing of 200 bytes repeats between documents; the long one repeats itself and what is left of it stays
    expected = sorted(((i, t) for i, t in ODD if i != 6), key=repr)
    assert sorted(((r.doc_id, r.text) for r in kept.collect() if r.doc_id != 6), key=repr) == expected
    assert suffixes.without_repeats(empty).count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_copies_of_one_text_are_split_over_tasks(spark, documents):
    """A third of the rows is one text: the join with its spans may split them."""
    text = "one text that is long enough to be looked at " * 8
    docs = documents([(i, text if i % 3 == 0 else f"{i} other " + chr(97 + i % 26) * 50) for i in range(3000)])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = suffixes.with_spans(docs.select("doc_id", "text"))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
