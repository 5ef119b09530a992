from __future__ import annotations

import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, start int, digest string, spans string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def table(spark):
    """Documents of (doc_id, text) with columns whose names operators use themselves."""
    from larder.llm.shared import ship_package

    ship_package(spark)

    def make(rows, langs=None):
        full = [
            (i, t, (langs or {}).get(i), "src0", len(t or ""), 7, "x", "y") for i, t in rows
        ]
        return spark.createDataFrame(full, COLUMNS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and blank texts, a very long one, a repeated row, a missing id."""
    rng = random.Random(5)
    long = words(rng, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (4, long),
        (5, "short"),
        (6, "é ß 日本 😀  x"),
        (7, "twice the same row"),
        (7, "twice the same row"),
        (None, "no id here"),
        (8, "." * 5000),
    ]
