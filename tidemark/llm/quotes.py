"""Quotation linking: who answers whom, from the passages that messages quote.

A line that starts with ``>`` signs is quoted, as deep as it has signs. Consecutive lines of one depth are a
passage. Each passage, its paragraphs, its lines, its sentences and runs of sentences are hashed after normalisation (lower
case, words only) and joined to the hashes of the same units in the messages' own text. Sentences end at ``.``, ``!``, ``?`` and
blank lines, and once with and once without line ends, as quoting programs wrap lines anew. Runs have up to ``FOREIGN_WORDS``
sentences, so every run of that many words holds one that counts, and 8, 16, 32 and so on, to prefer who holds more of it.

A quoted unit belongs to the earliest message that holds it unquoted: before the message in the same conversation, else in another
one if it has ``FOREIGN_WORDS`` words or more. Numbers of conversations state no order in time: the least other one that
holds it is taken, be its number smaller or larger. Within a conversation links go back in turns; where links between
conversations make a cycle, its least message (by conversation and turn) answers none.

The parent of a message is the origin of its least deep linked passage; of several, the one with most linked
words, then the first. Parents are followed to the first message by pointer doubling, in as many rounds as the
logarithm of the longest chain. ``thread`` names that first message; ordered by ``thread_conv`` and ``reply_path``, replies
stand behind what they answer. ``body`` is the text without quotes and without the line that introduces one.

Originals are reduced to one row per hash map-side before any join, so a line that a third of all messages
repeat costs one row. Conversations are never gathered in one task.

Defined cases: null text is empty. Messages with a null conversation or turn are returned but not linked. Repeated
rows are returned each, with the links of their key. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import send_code, stored, text_or_empty

FOREIGN_WORDS = 5

_MARKS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
_WORD = re.compile(r"\w+")
_SENTENCE_ENDS = (re.compile(r"(?<=[.!?])\s+|\n\s*\n"), re.compile(r"(?<=[.!?])\s+|\n"))
# How mail programs introduce a quote in four languages.
_INTRODUCTION = re.compile(r"\s*(On|Am|Le|El)\b.*\b(wrote|schrieb.*|a écrit|escribió)\s*:\s*", re.IGNORECASE)

PARSED = (
    "conv_id long, turn long, role string, body string, max_level int, "
    "units array<long>, "
    "quotes array<struct<passage: int, level: int, hash: long, words: int>>"
)


def passages(text: str) -> list[tuple[int, str]]:
    """(depth, text) of the message's passages in order; depth 0 is its own."""
    found: list[tuple[int, list[str]]] = []
    for line in text.splitlines():
        marks = _MARKS.match(line)
        level = marks.group(1).count(">") if marks else 0
        rest = line[marks.end() :] if marks else line
        if level and found and found[-1][0] == 0:
            while found[-1][1] and (not found[-1][1][-1].strip() or _INTRODUCTION.fullmatch(found[-1][1][-1])):
                found[-1][1].pop()
        if found and found[-1][0] == level:
            found[-1][1].append(rest)
        else:
            found.append((level, [rest]))
    return [(level, "\n".join(lines)) for level, lines in found if "".join(lines).strip()]


def _hash(words: str) -> int:
    return xxhash.xxh64_intdigest(words) - 2**63


def runs(sentences: list[str]) -> dict[int, int]:
    """Hash and word count of every run of up to ``FOREIGN_WORDS`` sentences, and of 8, 16 and so on."""
    found = {}
    total = list(accumulate((s.count(" ") + 1 for s in sentences), initial=0))
    hashes: list[int] = []
    for n in range(1, min(FOREIGN_WORDS, len(sentences)) + 1):
        each = [_hash(" ".join(sentences[i : i + n])) for i in range(len(sentences) - n + 1)]
        found.update({h: total[i + n] - total[i] for i, h in enumerate(each)})
        hashes = each if n == 4 else hashes
    n = 8
    while n <= len(sentences):
        hashes = [_hash(f"{hashes[i]} {hashes[i + n // 2]} of {n}") for i in range(len(sentences) - n + 1)]
        found.update({h: total[i + n] - total[i] for i, h in enumerate(hashes)})
        n *= 2
    return found


def units(text: str) -> dict[int, int]:
    """Hash and word count of a passage, its paragraphs, its lines, its sentences and runs of sentences."""
    found, earlier = {}, None
    lines = "\n".join(text.lower().splitlines())
    for ends in _SENTENCE_ENDS:
        sentences = [s for s in (" ".join(_WORD.findall(part)) for part in ends.split(lines)) if s]
        if sentences != earlier:
            found.update(runs(sentences))
        earlier = sentences
    for part in [text, *re.split(r"\n\s*\n", text), *text.splitlines()]:
        words = _WORD.findall(part.lower())
        if words:
            found[_hash(" ".join(words))] = len(words)
    return found


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    quote = pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("hash", pa.int64()), ("words", pa.int32())])
    for rows in batches:
        bodies, levels, own, quoted = [], [], [], []
        for text in rows.column(3).to_pylist():
            parts = passages(text)
            bodies.append("\n".join(t for level, t in parts if level == 0) if any(level for level, _ in parts) else text)
            levels.append(max((level for level, _ in parts), default=0))
            mine = units(bodies[-1])
            for level, t in parts:
                if level == 0 and t != bodies[-1]:
                    mine.update(units(t))
            own.append(list(mine))
            quoted.append(
                [
                    {"passage": i, "level": level, "hash": h, "words": n}
                    for i, (level, t) in enumerate(parts)
                    if level
                    for h, n in units(t).items()
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), rows.column(2), pa.array(bodies, pa.string()), pa.array(levels, pa.int32()),
             pa.array(own, pa.list_(pa.int64())), pa.array(quoted, pa.list_(quote))],
            names=["conv_id", "turn", "role", "body", "max_level", "units", "quotes"],
        )


def parse(messages: DataFrame) -> DataFrame:
    """Own text, units and quoted units of each message."""
    send_code(messages.sparkSession)
    return messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), text_or_empty().alias("text")
    ).mapInArrow(_parse, PARSED)


def links(parsed: DataFrame) -> DataFrame:
    """One row per message and linked passage: conv_id, turn, passage, level, words, origin_conv, origin_turn."""
    known = parsed.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quoted = known.filter(F.size("quotes") > 0).select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*").distinct()
    quoted = stored(quoted, "quoted")
    # what is reduced is written before it is joined: a join right above an aggregate cannot split a hot line
    wanted = stored(quoted.select("hash").distinct(), "wanted")
    # a line is one row for each conversation, map-side, before any join
    first = known.select("conv_id", "turn", F.explode("units").alias("hash")).groupBy("hash", "conv_id").agg(F.min("turn").alias("near_turn"))
    near = stored(first.join(wanted, "hash", "left_semi"), "near")
    # the two least conversations, of which one is another; Spark drops the others before the shuffle
    rank = F.row_number().over(Window.partitionBy("hash").orderBy("conv_id"))
    least = near.withColumn("rank", rank).filter("rank <= 2")
    least = least.groupBy("hash").agg(F.sort_array(F.collect_list(F.struct("conv_id", F.col("near_turn").alias("turn")))).alias("least"))
    least = stored(least, "least")
    own = F.col("near_turn") < F.col("turn")
    other = F.get(F.filter("least", lambda c: c["conv_id"] != F.col("conv_id")), F.lit(0))
    foreign = (F.col("words") >= FOREIGN_WORDS) & other.isNotNull()
    found = (
        quoted.join(near, ["hash", "conv_id"], "left")
        .join(least, "hash", "left")
        .withColumn(
            "origin",
            F.when(own, F.struct("conv_id", F.col("near_turn").alias("turn"))).when(foreign, other),
        )
        .filter(F.col("origin").isNotNull())
    )
    # the whole passage if it is known, else the origin of its longest known part
    return (
        found.groupBy("conv_id", "turn", "passage", "level")
        .agg(F.max(F.struct("words", "origin")).alias("best"))
        .select("conv_id", "turn", "passage", "level", "best.words", F.col("best.origin.conv_id").alias("origin_conv"), F.col("best.origin.turn").alias("origin_turn"))
    )


def parents(found: DataFrame) -> DataFrame:
    """conv_id, turn, parent of each linked message."""
    best = F.min(F.struct("level", -F.col("words"), "passage", F.struct(F.col("origin_conv").alias("conv_id"), F.col("origin_turn").alias("turn")).alias("parent")))
    return found.groupBy("conv_id", "turn").agg(best.alias("b"), F.count(F.lit(1)).alias("n_linked")).select(
        F.struct("conv_id", "turn").alias("message"), "b.parent", "n_linked"
    )


def without_cycles(direct: DataFrame) -> DataFrame:
    """The links but those of the least message of each cycle."""
    # without a link to a larger conversation every link goes to a lesser message
    if direct.filter(F.col("parent.conv_id") > F.col("message.conv_id")).isEmpty():
        return direct
    # each message's ancestor after so many steps, and the least message on the way; those that reach a first message leave
    state = stored(direct.select("message", F.col("parent").alias("top"), F.col("message").alias("least")), "cycles")
    steps, total = 1, state.count()
    # beyond the number of links only cycles, and what leads to them, have ancestors
    while steps <= total and not state.isEmpty():
        above = state.select(F.col("message").alias("top"), F.col("top").alias("higher"), F.col("least").alias("upper"))
        joined = state.join(above, "top")
        state = stored(joined.select("message", F.col("higher").alias("top"), F.least("least", "upper").alias("least")), "cycles")
        steps *= 2
    # so many steps end inside a cycle and lead around it
    inside = state.select(F.col("top").alias("message")).distinct()
    cut = state.join(inside, "message").select(F.col("least").alias("message")).distinct()
    return stored(direct.join(cut, "message", "left_anti"), "parents")


def threads(direct: DataFrame) -> DataFrame:
    """Each linked message with its first ancestor and the path from it, by pointer doubling."""
    state = stored(direct.select("message", F.col("parent").alias("top"), F.array("parent", "message").alias("path")), "threads")
    while True:
        above = state.select(F.col("message").alias("top"), F.col("top").alias("higher"), F.col("path").alias("upper"))
        joined = state.join(above, "top", "left")
        state = stored(
            joined.select(
                "message",
                F.coalesce("higher", "top").alias("top"),
                F.when(F.col("higher").isNotNull(), F.concat("upper", F.slice("path", 2, 2**30))).otherwise(F.col("path")).alias("path"),
                F.col("higher").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if state.filter("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def conversations(messages: DataFrame) -> DataFrame:
    """Every message without quotes, with its parent, thread and place in reply order."""
    parsed = stored(parse(messages), "messages")
    direct = without_cycles(stored(parents(links(parsed)), "parents"))
    paths = threads(direct).join(direct, "message").withColumnsRenamed({"parent": "p"})
    linked = paths.select(
        F.col("message.conv_id").alias("conv_id"), F.col("message.turn").alias("turn"), "p", "top", "path", "n_linked"
    )
    own = F.struct("conv_id", "turn")
    return parsed.join(linked, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "body",
        "max_level",
        F.coalesce("n_linked", F.lit(0)).cast("int").alias("n_linked"),
        F.col("p.conv_id").alias("parent_conv"),
        F.col("p.turn").alias("parent_turn"),
        F.coalesce("top", own)["conv_id"].alias("thread_conv"),
        F.coalesce("top", own)["turn"].alias("thread_turn"),
        F.coalesce("path", F.array(own)).alias("reply_path"),
    )
