"""Small tables with the cases every operator must handle."""

import pytest

WORDS = ("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra "
         "tango uniform victor whiskey xray yankee zulu").split()
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, kept string, component_id string, _doc string, row string, key string"


def prose(seed: int, words: int) -> str:
    """Words without repeated runs, fixed by the seed."""
    state, out = seed * 7919 + 1, []
    for _ in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)] + str((state >> 4) % 997))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, one very long text and word, ties, repeated rows."""
    texts = [None, "", " \n\t ", "one", "two words", prose(1, 60), prose(1, 60), prose(2, 20_000), "x" * 100_000, "é ü ñ\n" * 60, prose(3, 80)]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or ""), "no", "c", "d", "r", "k") for i, t in enumerate(texts)]
    return [*rows, rows[-1], rows[5], (None, "no id here", None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None,
                                                                                                             None, None, None)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows, with extra columns whose names operators use inside."""
    return spark.createDataFrame(odd_rows, ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def corpus(documents):
    """(doc_id, text) of the smallest documents table."""
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
