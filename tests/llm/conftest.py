import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"

#: Names the operators use inside, as extra columns.
CLASHES = ("rid", "name", "level", "size", "rank", "rate", "u", "t", "sig", "rng", "rkey", "key",
           "cls", "root", "runs", "p", "score", "w", "i", "nb", "blk", "held_out", "piece")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"{c} string" for c in CLASHES))


def table(spark, rows):
    """Documents (doc_id, text, source) with all the clashing columns."""
    full = [(d, t, "en", s, len(t) if t is not None else None, *["x"] * len(CLASHES))
            for d, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = "lorem ipsum dolor sit amet " * 40_000 + "x" * 100_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing names."""
    return table(spark, [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one", "b"), (5, "one", "b"),
        (5, "one", "b"), (None, "one", "a"), (None, None, None), (6, LONG, "c"), (7, LONG, "c"),
        (8, "mail me at a.b@c.example.org or +1 (555) 123-4567.", "b"), (9, "é ü ñ 漢字 \U0001f600", None)])


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
