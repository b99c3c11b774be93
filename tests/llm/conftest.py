import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import two_letter_words

from crmweave.llm.frames import workers_find_package
from crmweave.session import configure

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return workers_find_package(configure(spark))


@pytest.fixture(scope="session")
def odd(llm):
    """Rows that are out of the ordinary: nulls, nothing, white space, one long text, repeated rows, other scripts."""
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(words)
    long = " ".join(f"term{i % 9973} plain" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", None, None, 7), (4, long, "en", "a", len(long)),
        (5, passage, "en", "b", 9), (6, passage, "en", "b", 9), (6, passage, "en", "b", 9), (7, passage + " tail", None, None, 9),
        (8, "ONE two\none TWO\n\n" + passage.upper(), "de", "é", 9), (9, "Слово и дело в городе", "ru", "z", 9),
        (10, "1234 5678 !?   %% 90", "en", "a", 9), (11, "word", "en", "a", 4), (None, passage, "en", "a", 9),
        (None, None, None, None, None), (12, "nul\0byte   \U0001F600 café déjà  vu　x", "fr", "c", 9),
        (-3, "the cc by license; CC-BY all rights reserved", "en", "a", 9), (13, "a" * 5000, "en", "a", 9), (14, "a\0" * 2600, "en", "a", 9),
    ]
    for i, steps in enumerate((10, 12, 13)):
        rows += [(20 + 2 * i + j, word, "en", "a", 1 << steps) for j, word in enumerate(two_letter_words(steps))]
    return llm.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named as results and helpers are."""
    from pyspark.sql import functions as F

    names = (
        "hits", "language", "licences", "profile", "dropped", "shard", "slot", "members", "size", "taken", "kept", "component",
        "id", "n", "part", "row", "start", "g", "key", "label", "Score",
    )
    return odd.select("*", *(F.lit(f"{x}!").alias(x) for x in names))


@pytest.fixture(scope="session")
def documents(llm):
    return llm.read.parquet(f"{SMALL}/documents.parquet")
