import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import ODD
from tidemark.llm import rules, spelling, vector_codes

# spelling variants


def plain_words(rows, least_length, least_count):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at:] == b[at + 1 :] or (len(a) == len(b) and a[at + 1 :] == b[at + 1 :])


def plain_variants(rows, least_length=6, least_count=5, ratio=5):
    words = plain_words(rows, least_length, least_count)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def found_variants(docs, **how):
    rows = spelling.variants(docs, **how).collect()
    result = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(result) == len(rows)
    return result


def made_words(seed, signs="abcé", count=60, length=(4, 14)):
    r = random.Random(seed)
    words = ["".join(r.choice(signs) for _ in range(r.randint(*length))) for _ in range(count)]
    rows = []
    for i in range(300):
        text = []
        for _ in range(30):
            w = words[min(int(r.expovariate(0.15)), count - 1)]
            if r.random() < 0.4:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice(signs) + w[at:], w[:at] + r.choice(signs) + w[at + 1 :]])
            text.append(w.title() if r.random() < 0.1 else w)
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed,signs,frequent,long_list", [(1, "abcé", 64, 400), (2, "ab", 3, 4), (3, "abcdefgh", 2, 400), (4, "abc", 1000, 3)])
def test_variants_against_all_pairs(documents, monkeypatch, seed, signs, frequent, long_list):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    monkeypatch.setattr(spelling, "LONG_LIST", long_list)
    rows = made_words(seed, signs)
    expected = plain_variants(rows, 4, 2, 3)
    assert any(v[0] for v in expected.values())
    assert found_variants(documents(rows), least_length=4, least_count=2, ratio=3) == expected


def test_roots_end_long_chains(documents):
    """abcdef, abcdeg, abcdhg, ...: each is near the next, which is twice as frequent."""
    words = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg"]
    rows = [(None, " ".join([w] * 2 ** (n + 1))) for n, w in enumerate(words)]
    found = found_variants(documents(rows), least_count=1, ratio=2)
    assert {w: found[w][1] for w in words} == {w: plain_variants(rows, 6, 1, 2)[w][1] for w in words}
    assert len({found[w][1] for w in words}) == 1


def test_variants_with_the_given_limits(documents):
    rows = made_words(9, "abcdeé", 40)
    assert found_variants(documents(rows)) == plain_variants(rows)


def test_shared_grams_reach_the_bound():
    """Near words have all but the affected grams in common, whatever the dictionary."""
    r = random.Random(4)
    for _ in range(3000):
        length = r.randint(4, 14)
        a = "".join(r.choice("abc") for _ in range(length))
        at = r.randrange(length + 1)
        b = r.choice([a[:at] + r.choice("abc") + a[at:], a[:at] + r.choice("abc") + a[at + 1 :]])
        longest = min(length // 2, spelling.MOST_GRAM)
        frequent = {"".join(r.choice("abc") for _ in range(r.randint(2, 5))) for _ in range(r.choice([0, 5, 40, 200]))}
        grams, bounds = [], []
        for w in (a, b):
            often = {(p, q): 1 for q in range(2, longest) for p in range(len(w) - q) if w[p : p + q] in frequent}
            found = spelling.decompose(len(w), longest, often)
            grams.append(Counter(w[s:e] for s, e, _ in found))
            bounds.append(len(found) - spelling.affected(found, len(w), longest))
        assert (grams[0] & grams[1]).total() >= max(bounds) >= 1


def test_damage_follows_the_hash(documents):
    rows = [(i, "Wonderful ÀÉwörd!" * 3) for i in range(400)]
    assert {r.word: r.n for r in spelling.word_counts(documents(rows), 6, 1).collect()} == plain_words(rows, 6, 1)


def test_words_of_odd_rows(odd, empty):
    assert found_variants(odd, least_count=1) == plain_variants(ODD, 6, 1)
    assert spelling.variants(empty).count() == 0
    with pytest.raises(ValueError, match="4 code points"):
        spelling.variants(odd, least_length=3)


# quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


TEXTS = [
    "a b c d e f g h " * 3 + "x", "one\n one\none\n\n \n \none\r\none\x0b", "# $5 <a> | é% ** \x85a\xa0b \x1cc", "same " * 40,
    "p q r s t u v w x p q r s t u v w y", "a b c d e f g h\ta b c d e f g h", "\x0c\x0b", "日本 " * 9,
]


def test_base_counts(documents, odd):
    rows = list(enumerate(TEXTS))
    found = {r.doc_id: tuple(r)[1:6] for r in rules.statistics(documents(rows)).collect()}
    assert found == {i: plain_counts(t) for i, t in rows}
    assert sorted(tuple(r)[1:6] for r in rules.statistics(odd).collect()) == sorted(plain_counts(t) for _, t in ODD)


def test_repeated_stretches_by_hand():
    r = random.Random(2)
    for _ in range(300):
        words = [r.choice("abc") for _ in range(r.randint(0, 60))]
        assert rules.repeated_words(np.unique(words, return_inverse=True)[1].ravel().astype(np.int64)) == plain_counts(" ".join(words))[4]


def test_equal_hashes_of_different_words_do_not_count(monkeypatch):
    monkeypatch.setattr(rules, "_HASH", np.zeros(8, np.uint64))
    assert rules.repeated_words(np.arange(30)) == 0
    assert rules.repeated_words(np.array([*range(9), *range(8)])) == 16


def made_documents(count=900):
    r = random.Random(6)
    rows, bad = [], []
    for i in range(count):
        words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(r.randint(30, 90))]
        kind = i % 6
        if kind == 0:
            words = [w + "##" for w in words]
        if kind == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        bad.append(kind < 2)
    return rows, bad


def test_rules_hold_on_documents_without_labels(spark, documents):
    rows, bad = made_documents()
    labels = spark.createDataFrame([(i, int(not b), 0) for i, b in enumerate(bad) if i < 600], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in rules.judge(documents(rows), labels).collect()}
    assert len(found) == len(rows) and not any(r.base_failed for r in found.values())
    assert [not found[i].kept for i in range(len(rows))] == bad


def test_sample_is_bounded(spark, documents):
    rows, bad = made_documents(300)
    labels = spark.createDataFrame([(i, int(not b)) for i, b in enumerate(bad)] * 2 + [(None, 1), (3, None), (9999, 0)], "doc_id long, quality int")
    counted = rules.statistics(documents(rows))
    taken = rules.sample(counted, labels, 20).collect()
    assert sum(r.good for r in taken) == 20 and sum(not r.good for r in taken) == 20
    assert sorted(r.doc_id for r in rules.sample(counted, labels, 10_000).collect()) == list(range(300))


def test_expression_is_the_list(documents):
    rows, bad = made_documents(400)
    counted = rules.statistics(documents(rows)).toPandas().sort_values("doc_id")
    values = {name: (counted[a] / counted[b].where(counted[b] > 0)).fillna(0.0).to_numpy(float) for name, (a, b) in rules.FEATURES.items()}
    learned = rules.learn(values, np.array(bad))
    assert learned
    first = {r.doc_id: r.kept for r in rules.statistics(documents(rows)).withColumn("kept", rules.verdict(learned)).collect()}
    caught = np.any([rules.covers(rule, values) for rule in learned], axis=0)
    assert [not first[i] for i in range(len(rows))] == caught.tolist() == bad


def test_grown_conditions_split_best():
    values = {"x": np.array([1.0, 2, 3, 4, 5, 6]), "y": np.array([1.0, 1, 1, 2, 2, 2])}
    assert rules._grow(values, np.array([False, False, False, False, True, True])) == (rules.Condition("x", True, 4.5),)
    assert rules._grow(values, np.array([False, False, False, True, False, False])) == (
        rules.Condition("y", True, 1.5), rules.Condition("x", False, 4.5),
    )


def test_rules_of_odd_rows(spark, odd, empty):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    more = odd.union(odd.limit(1).withColumn("doc_id", F.lit(50).cast("long")).withColumn("text", F.lit(" ".join(map(str, range(30))))))
    found = rules.judge(more, no_labels).collect()
    # the very long text repeats itself
    assert len(found) == len(ODD) + 1 and {r.doc_id for r in found if r.kept} == {50}
    assert rules.judge(empty, no_labels).count() == 0


# vector codes

VECTOR = "vec_id long, embedding array<float>, label int, error string, code string, of_label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 3) for i, v, label in rows], VECTOR).repartition(3)


def plain_codes(rows, parts=8, entries=16, rounds=6):
    rows = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and np.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    whole = [[int(np.float32(x)) * 4096 if abs(x) > 1e12 else int(np.floor(4096 * float(np.float32(x)))) for x in r[1]] for r in rows]
    if not rows:
        return [], ""
    m = len(whole[0]) // parts
    cut = [[v[p * m : (p + 1) * m] for p in range(parts)] for v in whole]
    starters = [v for r, v in zip(rows, cut, strict=True) if r[0] is not None or rows[0][0] is None][:entries]
    books = [[v[p] for v in starters] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    totals = Counter()
    for r, e in zip(rows, errors, strict=True):
        totals[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    result = []
    for r, f, e in zip(rows, found, errors, strict=True):
        fits = all(x < 2**63 for q, x in zip(rows, errors, strict=True) if q[2] == r[2]) and totals[r[2]] < 2**63
        result.append((r[0], "".join(f"{k:02x}" for _, k in f), e if e < 2**63 else None, totals[r[2]] if fits else None, digest))
    return sorted(result, key=repr), digest


def found_codes(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("count,size", [(200, 16), (9, 8), (60, 64)])
def test_codes_against_plain_search(spark, count, size):
    r = random.Random(count)
    rows = [(i * 3 % 101, [r.choice([-0.5, 0.25, r.gauss(0, 0.2)]) for _ in range(size)], r.choice([None, 1, 2])) for i in range(count)]
    rows += rows[:5]
    assert found_codes(vector_codes.compress(vectors(spark, rows))) == plain_codes(rows)[0]


def test_orchard_finds_the_lower_index_of_equals():
    r = np.random.default_rng(3)
    for size, reach in ((1, 3), (16, 2), (40, 6)):
        points, entries = r.integers(-reach, reach + 1, (500, 3)), r.integers(-reach, reach + 1, (size, 3))
        distance = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        best, found = vector_codes.nearest(points, entries)
        assert best.tolist() == distance.argmin(axis=1).tolist() and found.tolist() == distance.min(axis=1).tolist()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    fine = [float(i) for i in range(8)]
    rows = [
        (5, None, 1), (4, [], 1), (3, [1.0] * 7, 1), (2, [nan] + [0.0] * 7, 1), (1, [inf] + [0.0] * 7, 1), (0, [None] + [0.0] * 7, 1), (6, [1.0] * 16, 1),
        (None, fine, None), (None, fine, None), (7, [-0.1] * 8, None), (8, [3e38] * 8, 2), (9, [-3e38, 1e-40, 0.5, -0.0, 1e10, -1e10, 7.0, 8.0], 2), (5, [0.5] * 8, 3), (5, fine, 3),
    ]
    usable = [r for r in rows if r[0] != 6]
    assert found_codes(vector_codes.compress(vectors(spark, usable))) == plain_codes(usable)[0]
    # of other length than the vector of the least id
    assert found_codes(vector_codes.compress(vectors(spark, rows))) == plain_codes(usable)[0]
    assert found_codes(vector_codes.compress(vectors(spark, [(None, fine, 1)] * 3))) == plain_codes([(None, fine, 1)] * 3)[0]
    empty = vector_codes.compress(vectors(spark, rows[:3]))
    assert empty.count() == 0 and set(empty.columns) >= {"vec_id", "code", "error", "label_error", "codebooks_sha256"}


def test_codes_stand_for_vectors_near_them(spark):
    r = random.Random(8)
    df = vectors(spark, [(i, [r.gauss(0, 0.2) for _ in range(16)], 1) for i in range(100)])
    books = vector_codes.fit(df)
    for row in vector_codes.encode(df, books).join(df.select("vec_id", F.col("embedding").alias("v")), "vec_id").collect():
        step = vector_codes.integers(np.array(row.v, np.float64)) - vector_codes.decode(row.code, books)
        assert (step * step).sum() == row.error
