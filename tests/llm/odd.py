"""Rows that every operator has to take."""

LONG = " ".join(f"word{i * i % 977}" for i in range(30_000))

#: nulls, empty texts, a very long text, ties and repeated rows
ODD = [
    (1, None),
    (2, ""),
    (3, "   \n "),
    (4, "!!! ... ###"),
    (5, "one"),
    (None, "no id has this text but it has words enough to count"),
    (None, None),
    (6, LONG),
    (7, "the same row twice is still the same row"),
    (7, "the same row twice is still the same row"),
    (8, "an id with two texts of its own here"),
    (8, "another text under the same id as before"),
    (9, "Ünïcödé 日本語 テキスト \U0001f600 text with signs"),
]
