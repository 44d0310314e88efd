import pytest

from odd import ODD

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside
INSIDE = ["text_key", "number", "spans", "__spans", "text_to_label", "key_a", "KEY_B", "words", "found", "digest", "__key", "__id"]


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns whose names operators use inside."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0, 7, "x", 1.5, *INSIDE) for r in rows]
        schema = DOCUMENT + ", n_removed long, `key` string, score double, " + ", ".join(f"{name} string" for name in INSIDE)
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture
def odd(documents):
    return documents(ODD)


@pytest.fixture
def empty(documents, spark):
    return spark.createDataFrame([], documents([(1, "a")]).schema)
