from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import database, difference
from llm_cases import SF_SMALL, odd_rows, table, words  # noqa: F401 - fixtures

import __spark_entry__ as entry_module
from larder.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def plain(docs, items, k):
    """(item, rank, doc_id, score) by scoring every document for every item."""
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items.items():
        found = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(TERM.findall((text or "").translate(LOWER)))
                if t in c
            )
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, rank, i, -score) for rank, (score, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()))


@pytest.fixture(scope="module")
def some_docs():
    rng = random.Random(4)
    common = words(rng, 40).split()
    docs = [(i, " ".join(rng.choice(common) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # ties
    docs += [(2000, "ÄÖ ä K \x00x_y 12,3"), (2001, common[0].upper())]
    return docs


@pytest.mark.parametrize("block, batch_terms", [(1 << 16, 1 << 19), (16, 1 << 19), (50, 5000)])
def test_equals_scoring_everything(spark, table, odd_rows, some_docs, block, batch_terms):
    docs = some_docs + odd_rows
    rng = random.Random(8)
    items = {i: " ".join(rng.choice(some_docs)[1].split()[:9]) for i in range(12)}
    items |= {20: None, 21: "", 22: "never-seen words", 23: "Ä x 12 3 k K", 24: some_docs[7][1], 25: odd_rows[3][1]}
    asked = spark.createDataFrame([(i, t, "clash") for i, t in items.items()], "item_id bigint, text string, doc_id string")
    assert rows(ranked_search.search(table(docs), asked, 10, batch_terms, block)) == plain(docs, items, 10)


def test_repeated_items_and_rows(spark, table):
    docs = [(1, "a b"), (1, "a b"), (2, "a c"), (3, "d"), (None, "a")]
    asked = spark.createDataFrame([(5, "z"), (5, "a"), (None, "a"), (6, None)], "item_id int, text string")
    assert rows(ranked_search.search(table(docs), asked)) == plain(docs, {5: "a"}, 50)


def test_empty_tables(spark, table):
    asked = spark.createDataFrame([(5, "z")], "item_id int, text string")
    assert rows(ranked_search.search(table([]), asked)) == []
    assert rows(ranked_search.search(table([(1, "z")]), asked.limit(0))) == []


def test_accumulators_stop_and_survivors_are_exact():
    """Three documents hold the rare term; the common one can lift no other document above them."""
    n = 3000
    owner = np.concatenate(([10, 20, 30], np.arange(n)))
    terms = np.concatenate((np.zeros(3, int), np.ones(n, int)))
    block = ranked_search.Block(np.arange(n), np.full(n, 5), owner, terms, np.ones(n + 3, np.int64), n, 5 * n)
    places, scores = block.search(np.array([0, 1]), np.array([9000, 5]), 3)
    assert places.tolist() == [10, 20, 30] and len(set(scores.tolist())) == 1
    assert scores[0] == 9005 * block.impact[0] and not block.score.any()
    # equal to the floor may still win by a smaller id, below it may not
    assert len(block.search(np.array([1]), np.array([5]), 3, int(5 * block.impact[0]))[0]) == n
    assert len(block.search(np.array([1]), np.array([5]), 3, int(5 * block.impact[0]) + 1)[0]) == 0


def test_matches_sql(spark):
    name = "op12_ranked_search"
    assert difference(entry_module.queries()[name](spark, SF_SMALL), database(SF_SMALL), entry_module.oracle_sql()[name]) is None
