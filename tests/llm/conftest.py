import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL

DOCS = "doc_id bigint, text string"

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew strong potions".split()


def sentence(n, start=0):
    return " ".join(f"{WORDS[(start + i) % len(WORDS)]}{(start + i) // 3}" for i in range(n))


ROWS = [
    (1, None),
    (2, ""),
    (3, "   \t\n "),
    (4, "one two three"),
    (5, "ONE two THREE"),
    (6, "one two three"),
    (7, sentence(300)),
    (8, sentence(300).upper()),
    (9, sentence(290) + " changed ending of this text"),
    (10, sentence(40, 500)),
    (11, sentence(39, 500) + " other"),
    (12, sentence(60, 500)),
    (13, "é è ß ümlaut 漢字 " * 20 + "   x\r\n\n\n  y"),
    (14, "x" * 5000 + " " + sentence(20000, 9)),
    (15, sentence(20000, 9) + " y"),
    (16, "'ll don't  stop\tnow ...  \n\n end "),
    (17, sentence(25, 900)),
    (17, sentence(25, 900)),
    (None, sentence(25, 900)),
    (None, "nobody's text, which has at least five words"),
    (None, None),
]

# Names that operators use inside or return.
CLASHING = (
    "score", "keep_id", "kept", "group_size", "component_id", "n_shingles", "shard", "slot", "ids", "rep", "bands",
    "bucket", "row", "blocks", "labels", "words", "sequence_id", "offset", "start", "length", "_digest", "host", "path",
    "rule", "verdict", "payload", "refers_to", "vector", "weight", "home", "cells", "toxic", "n", "a", "b", "d1", "d2",
)


def cluttered(df):
    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING if name not in df.columns})


@pytest.fixture(scope="session")
def docs(spark):
    return cluttered(spark.createDataFrame(ROWS, DOCS).repartition(3))


@pytest.fixture(scope="session")
def no_docs(spark):
    return cluttered(spark.createDataFrame([], DOCS))


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def ascii_lower(text):
    return (text or "").translate({i: i + 32 for i in range(ord("A"), ord("Z") + 1)})
