from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_cases import SF_SMALL, odd_rows, table  # noqa: F401 - fixtures
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import jaccard_join as J

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_sets(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return sets


def brute(rows):
    sets = brute_sets(rows)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if i is not None)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.components(df).collect() if r.doc_id is not None}


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def corpus():
    """Near copies at every distance around the bound, chains, a passage that most documents share."""
    rng = random.Random(7)
    rows, at = [], 0
    passage = words(rng, 40)
    for _ in range(6):
        base = words(rng, rng.choice([30, 60, 120]))
        for k in range(12):
            copy = list(base)
            for _ in range(k // 2):
                copy[rng.randrange(len(copy))] = "x" + str(rng.random())
            rows.append((at, " ".join(copy)))
            at += 1
    for _ in range(60):
        rows.append((at, " ".join([*words(rng, rng.randint(5, 30)), *passage])))
        at += 1
    return rows


def test_components_equal_brute_force(table, odd_rows, monkeypatch):
    monkeypatch.setattr(J, "WINDOW", 20)  # so that the shared passage counts as frequent
    rows = corpus() + [(i + 1000, t) for i, t in odd_rows if i is not None] + [(1000000, "A b"), (1000001, "a\tB")]
    assert got(table(rows)) == brute(rows)


def test_rows_without_id_and_repeated_rows(table):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f")]
    out = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in J.components(table(rows)).collect())
    assert out == [(-1, 2, None), (2, 2, 2), (3, 2, 2), (3, 2, 2)]
    kept = J.one_of_each(table(rows))
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2]
    assert kept.columns == table(rows).columns


def test_empty_table(table):
    assert J.components(table([])).collect() == []


def test_small_documents_of_the_test_data(spark, table):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got(table(rows)) == brute(rows)


@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=12), st.sets(st.integers(0, 30), min_size=1))
@settings(max_examples=200, deadline=None)
def test_divide_skip_finds_what_counting_finds(sets, query):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    wanted = [i for i, s in enumerate(sets) if 100 * len(s & query) >= 80 * len(s | query)]
    assert sorted(J.search(np.array(sorted(query), np.uint64), arrays)) == wanted


@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1))
@settings(max_examples=200, deadline=None)
def test_bitmaps_never_reject_a_similar_pair(one, two):
    a, b = (J.mixed(np.array(sorted(s), np.uint64) + np.uint64(1)) for s in (one, two))
    if 100 * len(one & two) >= 80 * len(one | two):
        assert J.can_share(len(a), len(b), J.bitmap(a), J.bitmap(b))


@pytest.mark.parametrize("x,y", [(1, 1), (5, 4), (10, 8), (7, 9), (100, 81)])
def test_required_overlap(x, y):
    need = J.required(x, y)
    assert 100 * need >= 80 * (x + y - need) and 100 * (need - 1) < 80 * (x + y - need + 1)
