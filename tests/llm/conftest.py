import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, found string, leaks string, shard int, node long, ids string, key long, component int, block string, body string, host string, kept boolean"
EXTRA = ("x", 0.5, "f", "l", 3, 7, "i", 9, 1, "b", "body", "host", True)


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary):x}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and ids, copies and near copies."""
    rnd = random.Random(11)
    base = words(rnd, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (None, "text without an id", "en", "s", 18), (None, None, None, None, None),
        (4, base, "en", "s", len(base)), (5, base, "en", None, len(base)), (5, base, "en", None, len(base)), (6, " ".join(near), "fr", "s", None),
        (7, words(rnd, 30000), "en", "t", None), (8, "One", "en", "s", 3), (9, "é’日本 \U0001f642 ß", "xx", "s", 9), (9, "another text of the same id", "en", "s", 1),
        (10, "a\x00b\x1cc", "en", "s", 5), (11, "same line\n" * 40, "en", "s", 400),
    ]
    rows += [(100 + i, words(rnd, 40 + i), "en", "s", None) for i in range(20)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in odd_rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
