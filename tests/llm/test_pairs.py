import itertools
import math
import random

import pytest

import corpus_pipeline
from odd import ODD
from tidemark.llm import decontaminate, licenses, nearcopies, quotes
from tidemark.llm.components import components


def near_rows(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = [r.choice(words) for _ in range(r.choice([3, 40, 120]))]
        for _ in range(r.randint(1, 9)):
            text = list(base)
            for _ in range(r.randint(0, 3)):
                text[r.randrange(len(text))] = r.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows + [(900 + i, rows[0][1]) for i in range(20)]


def brute_classes(rows):
    sets = [set(nearcopies.shingles(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            alike = a == rows[j][1] or (sets[i] & sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
            if a and alike:
                root[find(i)] = find(j)
    members = {}
    for i, (d, _) in enumerate(rows):
        members.setdefault(find(i), []).append(d)
    return {d: (min(m), len(m)) for m in members.values() for d in m}


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(documents, seed):
    rows = near_rows(seed)
    found = {r.doc_id: (r.class_id, r.n_members) for r in nearcopies.classes(documents(rows)).collect()}
    assert found == brute_classes(rows)


@pytest.mark.parametrize("rare", [2, 16])
def test_classes_in_a_group_around_the_limit(documents, monkeypatch, rare):
    r = random.Random(rare)
    texts = [[f"w{r.randrange(400)}" for _ in range(150)]]
    for _ in range(110):
        text = list(texts[r.choice([0, 0, 0, r.randrange(len(texts))])])
        for _ in range(r.randint(1, 8)):
            text[r.randrange(len(text))] = f"e{r.randrange(30)}"
        texts.append(text)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    monkeypatch.setattr(nearcopies, "RARE", rare)
    found = {d.doc_id: (d.class_id, d.n_members) for d in nearcopies.classes(documents(rows)).collect()}
    expected = brute_classes(rows)
    assert 5 < len({c for c, _ in expected.values()}) < 100
    assert found == expected


def repeating_rows():
    """Pairs of texts, one of which repeats a passage; their sets of shingles are alike by 0.8 or a little less."""
    r = random.Random(6)
    rows = []
    for family, times in enumerate([10, 30, 100, 300, 1000] * 4):
        base = [f"f{family}w{i}" for i in range(204)]
        more = [f"f{family}e{i}" for i in range(r.choice([10, 35, 40, 60]))]
        at = r.randrange(150)
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base[:at] + base[at : at + 40] * times + base[at + 40 :] + more))]
    return rows


def test_classes_of_texts_that_repeat_passages(documents):
    rows = repeating_rows()
    expected = brute_classes(rows)
    assert 20 < len({c for c, _ in expected.values()}) < 35
    found = {d.doc_id: (d.class_id, d.n_members) for d in nearcopies.classes(documents(rows)).collect()}
    assert found == expected


def test_one_of_each_class_stays(documents, odd, empty):
    rows = near_rows(3)
    expected = {c for c, _ in brute_classes(rows).values()}
    kept = nearcopies.one_of_each(documents(rows))
    assert {r.doc_id for r in kept.collect()} == expected
    left = nearcopies.one_of_each(odd)
    assert left.columns == odd.columns and left.count() == len(ODD) - 1
    assert nearcopies.one_of_each(empty).count() == 0


def test_classes_of_odd_rows(odd, empty):
    rows = nearcopies.classes(odd).collect()
    assert len(rows) == len(ODD) and {r.n_members for r in rows if r.doc_id == 7} == {2}
    assert all(r.class_id == r.doc_id for r in rows)
    assert nearcopies.classes(empty).count() == 0


def test_components_of_a_long_chain(spark):
    pairs = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"\x80", b"\x90")]
    found = {bytes(r.vertex): bytes(r.root) for r in components(spark.createDataFrame(pairs, "u binary, v binary")).collect()}
    assert found == {bytes([i]): b"\x00" for i in range(41)} | {b"\x80": b"\x80", b"\x90": b"\x80"}


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon phi chi"


def test_overlaps_tolerate_replaced_words(documents, spark):
    words = ITEM.split()
    changed = [w if i % 6 else "other" for i, w in enumerate(words)]
    docs = documents(
        [
            (1, "before it " + ITEM.upper() + " after it"),
            (2, "x " * 30 + " ".join(changed)),
            (3, " ".join(words[::-1])),
            (4, " ".join(words[:12])),
            (5, " ".join(words[2:])),
            (6, None),
        ]
    )
    items = spark.createDataFrame([(1, ITEM), (2, "too short an item"), (3, None), (None, ITEM)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.n_equal, r.first_word) for r in decontaminate.leaks(docs, items).collect()}
    assert found == {(1, 1): (20, 2), (2, 1): (17, 31), (5, 1): (20, 0)}
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 6]


def test_overlaps_of_odd_rows(odd, empty, spark):
    items = spark.createDataFrame([(1, "the same row twice is still the same row")], "item_id long, text string")
    none = items.filter("item_id < 0")
    assert [tuple(r)[:3] for r in decontaminate.leaks(odd, items).collect()] == [(7, 1, 9)]
    assert decontaminate.leaks(empty, items).count() == 0 and decontaminate.leaks(odd, none).count() == 0
    assert decontaminate.without_leaks(odd, none).count() == len(ODD)


def test_seeds_are_shuffled_beyond_the_size(odd, spark, monkeypatch):
    items = spark.createDataFrame([(1, "the same row twice is still the same row")], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert decontaminate.leaks(odd, items).count() == 1


def test_masks_fit_every_pattern_of_the_rule():
    for n in range(1, decontaminate.OVERLAP + 1):
        least = math.ceil(n * decontaminate.SHARE)
        for equal in itertools.combinations(range(n), least):
            places = [
                {p + i for i, c in enumerate(mask) if c == "1"}
                for mask in decontaminate.MASKS[min(n, max(decontaminate.MASKS))]
                for p in range(n - len(mask) + 1)
            ]
            assert any(place <= set(equal) for place in places), (n, equal)


def brute_leaks(rows, items):
    """The rule itself: every line on which item and text can lie."""
    found = {}
    for doc, text in rows:
        for item, known in items:
            t, w = text.split(), known.split()
            size = min(len(w), decontaminate.OVERLAP)
            for line in range(-len(w), len(t)):
                equal = [0 <= line + i < len(t) and t[line + i] == w[i] for i in range(len(w))]
                for s in range(len(w) - size + 1):
                    n = sum(equal[s : s + size])
                    if n >= math.ceil(size * decontaminate.SHARE):
                        found[doc, item] = max(found.get((doc, item), (0, 0)), (n, -line - s))
    return {k: (n, -at) for k, (n, at) in found.items()}


def test_leaks_equal_the_rule_for_items_of_every_length(documents, spark):
    r = random.Random(5)
    items = [(n, " ".join(f"i{n}w{j}" for j in range(n))) for n in range(1, 25)]
    rows = []
    for n, item in items:
        for _ in range(12):
            text = item.split()
            most = min(n, 20) - math.ceil(min(n, 20) * decontaminate.SHARE)
            for j in r.sample(range(n), min(n, most + r.choice([0, 0, 0, 1]))):
                text[j] = "other"
            before, after = (" ".join(r.choice("abc") for _ in range(r.choice([0, 3]))) for _ in range(2))
            cut = r.choice([0, 0, most])
            rows.append((len(rows), f"{before} {' '.join(text[cut:])} {after}"))
    # either end of an item of nine words
    rows += [(len(rows), "other " + items[8][1].split(" ", 1)[1]), (len(rows) + 1, items[8][1].rsplit(" ", 1)[0] + " other")]
    expected = brute_leaks(rows, items)
    assert {i for _, i in expected} == set(range(1, 25)) and len(expected) > 150
    known = spark.createDataFrame([*items, (99, " . ")], "item_id long, text string")
    found = {(d.doc_id, d.item_id): (d.n_equal, d.first_word) for d in decontaminate.leaks(documents(rows), known).collect()}
    assert found == expected


def test_license_scan(documents, odd, empty):
    apache = "Licensed under the Apache License, Version 2.0"
    notice = licenses.TEMPLATES[2][1].split()
    changed = " ".join(w if i != 3 else "other" for i, w in enumerate(notice))
    docs = documents(
        [
            (1, "text before. " * 9 + apache + " and after"),
            (2, "Licensed under the Apache Treaty, Version 2.0"),
            (3, changed),
            (4, "released UNDER the mit-license"),
            (5, " ".join(notice[:12])),
        ]
    )
    found = {(r.doc_id, r.license): round(r.containment, 2) for r in licenses.scan(docs).collect()}
    assert found[1, "Apache-2.0"] == 1 and found[4, "MIT"] == 1 and 0.8 <= found[3, "MIT"] < 1
    assert {d for d, _ in found} == {1, 3, 4}
    assert licenses.scan(odd).count() == 0 and licenses.scan(empty).count() == 0


MESSAGES = [
    (1, 0, "a", "Shall we meet on Monday at noon?\nBring the map."),
    (1, 1, "b", "On Friday A wrote:\n> Shall we meet on   monday at noon?\n> Bring the map.\n\nYes, gladly we will."),
    (1, 2, "a", ">> Bring the map.\n> yes, gladly we will\n\nThe new one, that is."),
    (2, 0, "c", "> Shall we meet on Monday at noon?\nI will come to that place too."),
    (2, 1, "d", "> nobody said this at all\nWhat?"),
    (2, 2, "d", "> Yes\nshort foreign words do not link"),
    (None, 1, "x", "> Bring the map.\nno conversation"),
    (3, None, "x", None),
]


def test_quotes_link_to_their_origin(spark):
    df = spark.createDataFrame([(*m, 1) for m in MESSAGES] + [(*MESSAGES[0], 1)], "conv_id long, turn long, role string, text string, body int")
    found = quotes.conversations(df).collect()
    assert len(found) == len(MESSAGES) + 1
    by = {(r.conv_id, r.turn): r for r in found}
    parent = {k: (r.parent_conv, r.parent_turn) for k, r in by.items() if r.parent_conv is not None}
    assert parent == {(1, 1): (1, 0), (1, 2): (1, 1), (2, 0): (1, 0)}
    assert [tuple(p) for p in by[1, 2].reply_path] == [(1, 0), (1, 1), (1, 2)]
    assert (by[1, 2].thread_conv, by[1, 2].thread_turn, by[1, 2].max_level, by[1, 2].n_linked) == (1, 0, 2, 2)
    assert by[1, 1].body.strip() == "Yes, gladly we will." and by[2, 1].body.strip() == "What?"
    assert by[1, 0].body == MESSAGES[0][3] and by[3, None].body == "" and by[None, 1].parent_conv is None
    assert quotes.conversations(df.filter("conv_id > 9")).count() == 0


def linked(spark, messages):
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    return {(r.conv_id, r.turn): r for r in quotes.conversations(df).collect()}


def test_quotes_of_sentences_and_of_larger_conversations(spark):
    long = " ".join(f"Sentence number {i} has its words here." for i in range(20))
    found = linked(
        spark,
        [
            (1, 0, "a", "We met at the old mill. The river was high that day! Go. On. Then. We. Left. Nobody came."),
            (1, 1, "b", "> The river was high that day!\nWas it so?"),
            (1, 2, "c", "> The river was high\n> that day! Go.\nIndeed it was."),
            (2, 0, "d", "> Go. On. Then. We. Left.\nNo."),
            (3, 0, "e", "> This passage stands in a larger conversation.\nIt does."),
            (7, 0, "f", "A start. This passage stands in a larger conversation. An end."),
            (8, 0, "g", long),
            (9, 0, "h", "> " + " ".join(long.split()[7 * 3 : 7 * 14])),
            # each quotes the other one, a third quotes one of them
            (11, 0, "i", "> What the second one has to say here.\nWhat the first one has to say here."),
            (12, 0, "j", "> What the first one has to say here.\nWhat the second one has to say here. Something for the third one, too."),
            (10, 0, "k", "> Something for the third one, too.\nThanks."),
            # a long chain without a cycle
            *((20, t, "l", (f"> This is the {t - 1}th message here.\n" if t else "> This is where all begins.\n") + f"This is the {t}th message here.") for t in range(10)),
            (30, 0, "m", "This is where all begins."),
        ],
    )
    parent = {k: (r.parent_conv, r.parent_turn) for k, r in found.items() if r.parent_conv is not None}
    chain = {(20, 0): (30, 0)} | {(20, t): (20, t - 1) for t in range(1, 10)}
    assert parent == {(1, 1): (1, 0), (1, 2): (1, 0), (2, 0): (1, 0), (3, 0): (7, 0), (9, 0): (8, 0), (12, 0): (11, 0), (10, 0): (12, 0), **chain}
    assert [tuple(p) for p in found[10, 0].reply_path] == [(11, 0), (12, 0), (10, 0)]


def test_pipeline_on_a_small_corpus(spark, documents, tmp_path):
    r = random.Random(4)
    english = "the of and to in is that for it was on are with they this have from".split()
    german = "der die und in den von zu das mit sich des auf für ist im dem nicht".split()

    def text(words, n):
        return " ".join(r.choice(words) + r.choice(["", "s", "ton", "ly"]) for _ in range(n))

    passage = text(english, 60)
    rows = [(i, text(english if i % 2 else german, 80), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, rows[0][1], "de"), (101, rows[1][1] + " end", "en"), (102, None, "en"), (103, "123 456", None)]
    rows += [(110 + i, text(english, 50) + " " + passage + " " + text(english, 50), "en") for i in range(2)]
    item = text(english, 30)
    rows += [(120, text(english, 40) + " " + item + " " + text(english, 40), "en")]
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    state, seen = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, str(tmp_path))
        assert state.columns == docs.columns, name
        path = f"{tmp_path}/{len(seen)}"
        state.write.parquet(path)
        state = spark.read.parquet(path)
        seen.append({r.doc_id: r.text for r in state.collect()})
    ids = {r[0] for r in rows}
    assert ids - seen[0].keys() == {102, 103}
    assert seen[0].keys() - seen[1].keys() == {100, 101}
    assert seen[2].keys() == seen[1].keys() and all(passage not in seen[2][i] for i in (110, 111))
    assert all(seen[2][i] == seen[1][i] for i in seen[1] if i not in (110, 111))
    assert seen[2].keys() - seen[3].keys() == {120}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in packed} == seen[3].keys()


def test_version_of_a_license_that_fits_best(documents):
    two = "this work is licensed under the GNU General Public License, version 2 and more"
    three = "some words. This work is licensed under the GNU General Public License, version 3"
    part = " ".join(licenses.TEMPLATES[2][1].split()[:-3])  # a notice cut short
    docs = documents([(1, two), (2, three), (3, f"{two} {'other words here ' * 40} {three}"), (4, part), (5, "Licensed under CC BY-NC 4.0")])
    found = {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}
    assert found == {(1, "GPL-2.0"), (2, "GPL-3.0"), (3, "GPL-2.0"), (3, "GPL-3.0"), (4, "MIT"), (5, "CC-BY-NC-4.0")}


def test_bands_are_an_equi_join(documents):
    plan = licenses.scan(documents([(1, "a b c d e f")]))._jdf.queryExecution().executedPlan().toString()
    joined = next(line for line in plan.splitlines() if "HashJoin" in line)
    assert "band" in joined and "hash" in joined and "size" in joined


def plain_links(rows):
    """Every quoted passage against every unit of every message, without hashes or joins."""
    parsed = {}
    for conv, turn, text in rows:
        parts = quotes.passages(text or "")
        body = "\n".join(t for level, t in parts if level == 0) if any(level for level, _ in parts) else text or ""
        own = set(quotes.units(body))
        for level, t in parts:
            if level == 0 and t != body:
                own |= set(quotes.units(t))
        parsed[conv, turn] = (own, [(i, level, quotes.units(t)) for i, (level, t) in enumerate(parts) if level])
    found = {}
    for (conv, turn), (_, quoted) in parsed.items():
        for i, level, units in quoted:
            best = None
            for unit, words in units.items():
                own = min((t for (c, t), (mine, _) in parsed.items() if c == conv and unit in mine), default=None)
                others = [(c, t) for (c, t), (mine, _) in parsed.items() if c != conv and unit in mine]
                if own is not None and own < turn:
                    origin = (conv, own)
                elif others and words >= quotes.FOREIGN_WORDS:
                    origin = min(others)
                else:
                    continue
                best = max(best, (words, *origin)) if best else (words, *origin)
            if best:
                found[conv, turn, i] = (level, *best)
    return found


def test_links_against_all_units(spark):
    """Generated conversations with nested, rewrapped and partial quotes."""
    r = random.Random(3)
    names = [f"word{i}" for i in range(60)]
    rows, said = [], {}
    for conv in range(12):
        for turn in range(6):
            lines = [" ".join(r.choice(names) for _ in range(r.randint(3, 9))) + "." for _ in range(r.randint(1, 4))]
            text = "\n".join(lines) if r.random() < 0.5 else " ".join(lines)
            if turn and r.random() < 0.8:
                source = said[(conv if r.random() < 0.7 else r.randrange(conv + 1), r.randrange(turn))] if conv else said[conv, r.randrange(turn)]
                words = source.split()
                kind = r.randrange(4)
                if kind == 0:  # whole, quotes of quotes get deeper
                    quoted = source.splitlines()
                elif kind == 1:  # wrapped anew
                    quoted = [" ".join(words[i : i + 5]) for i in range(0, len(words), 5)]
                elif kind == 2:  # a sentence
                    quoted = [r.choice([s for s in source.replace("\n", " ").split(".") if s.strip()] or [source]).strip() + "."]
                else:  # unknown words
                    quoted = ["nobody ever said these words in any message"]
                text = "\n".join([f"> {line}" for line in quoted] + [text])
            said[conv, turn] = text
            rows.append((conv, turn, text))
    messages = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    links = quotes.links(quotes.parse(messages)).collect()
    found = {(x.conv_id, x.turn, x.passage): (x.level, x.words, x.origin_conv, x.origin_turn) for x in links}
    assert found == plain_links(rows) and len(found) > 20


def test_stages_keep_rows_of_odd_tables(documents, odd, empty, spark):
    items = spark.createDataFrame([(1, "an id with two texts of its own here")], "item_id long, text string")
    left = decontaminate.without_leaks(odd, items)
    assert left.schema == odd.schema and left.count() == len(ODD) - 1
    assert decontaminate.without_leaks(empty, items).count() == 0
    # the caller's columns of internal names come back as they were
    for kept in (left, nearcopies.one_of_each(odd)):
        assert {(r["__key"], r.text_key, r.key_a, r.spans) for r in kept.collect()} == {("__key", "text_key", "key_a", "spans")}


def test_pipeline_of_an_empty_table(spark, tmp_path, empty):
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "an item")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
