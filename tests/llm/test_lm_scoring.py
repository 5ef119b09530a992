from __future__ import annotations

import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import SF_SMALL, odd_rows, table, words  # noqa: F401 - fixtures

from larder.llm import lm_scoring as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
SMALL = dict(classes=2, width=4, rest=3, rows=256, rounds=3)


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def plain(rows):
    """The base columns, read from the contract."""
    tokens = [(i, [*WORD.findall((t or "").translate(LOWER)), None]) for i, t in rows]
    counts = Counter(t for i, ts in tokens if learned(i) for t in ts)
    n, v = sum(counts.values()), len(counts)
    return n, {
        i: (len(ts), sum(counts[t] > 0 for t in ts), sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
        for i, ts in tokens
    }


def some_rows(odd_rows):
    rng = random.Random(2)
    vocabulary = words(rng, 30).split()
    rows = [(100 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    return rows + odd_rows + [(300, "Ünï \x00 K " + "long" * 50 + " \x85x"), (301, "long" * 50)]


@pytest.mark.parametrize("known", [1 << 17, 3])
def test_base_columns(table, odd_rows, known):
    rows = some_rows(odd_rows)
    got = lm.score_documents(table(rows), known=known, **SMALL).collect()
    n, expected = plain(rows)
    assert len(got) == len(rows)
    for row in got:
        n_tokens, n_known, base = expected[row.doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n_tokens, n_known, n), row
        assert row.base_score == pytest.approx(base, abs=1e-9 * n_tokens)
        assert row.held_out == (row.doc_id is not None and not learned(row.doc_id))
        assert row.score < 0


def test_score_does_not_depend_on_the_table_of_known_words(table, odd_rows):
    docs = table(some_rows(odd_rows))
    one, two = ({(r.doc_id, r.n_tokens): r.score for r in lm.score_documents(docs, known=k, **SMALL).collect()} for k in (9, 1 << 17))
    assert one.keys() == two.keys()
    assert all(one[k] == pytest.approx(two[k], rel=1e-5) for k in one)


def model_of(counts, **parameters):
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    p = {**SMALL, **parameters}
    mass = np.zeros(p["rest"], np.int64)
    for word, n in top[p["classes"] * p["width"] :]:
        mass[lm.rest_class(word, p["rest"])] += n + 1
    return lm.Model(top, sum(counts.values()), len(counts), mass, p["classes"], p["width"], p["rows"])


def test_model_is_a_distribution():
    """Over all words seen in training and the unseen word, the probabilities after any history add up to 1."""
    rng = np.random.default_rng(1)
    counts = {bytes([97 + i % 26, 97 + i // 26, 98]): 60 - i for i in range(50)}
    model = model_of(counts)
    model.class_weights += rng.normal(size=model.class_weights.shape).astype(np.float32)
    model.word_weights += rng.normal(size=model.word_weights.shape).astype(np.float32)
    total = 0.0
    for word in counts:
        batch = lm.Batch(model, lm.Described(model), [([b"x", b"abb", b"y"], [word])])
        p = batch.class_shares()[0, batch.groups[0]]
        if len(batch.inner):
            p *= batch.word_shares()[0, batch.places[0]]
        else:
            p *= (counts[word] + 1) / model.norm / 10 ** model.log_rest[batch.groups[0] - model.classes]
        total += p
    batch = lm.Batch(model, lm.Described(model), [([b"x", b"abb", b"y"], [b"zzz"])])
    total += batch.class_shares()[0, model.classes] / model.norm / 10 ** model.log_rest[0]
    assert total == pytest.approx(1, abs=1e-4)


def test_without_weights_the_score_is_the_base():
    counts = Counter(b"a b c d e f g h i j k l m a b c a b".split())
    model = model_of(counts)
    batch = lm.Batch(model, lm.Described(model), [([lm.START] * 3, [b"a", b"l", b"b"])])
    shares, inner = batch.class_shares(), batch.word_shares()
    assert batch.inner.tolist() == [0, 2]
    for at, place in zip(batch.inner, range(2), strict=True):
        word = [b"a", b"l", b"b"][at]
        p = shares[at, batch.groups[at]] * inner[place, batch.places[place]]
        assert p == pytest.approx((counts[word] + 1) / model.norm, rel=1e-4)


def test_a_batch_makes_no_python_call_per_word():
    words = [b"%daa" % (i % 15_000) for i in range(20_000)]
    known, calls = lm.Described(model_of(Counter(words[:50]))), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        batch = lm.Batch(known.model, known, [([lm.START] * 3, words)])
    finally:
        sys.setprofile(None)
    assert calls < 1000
    assert batch.words.take(batch.numbers).to_pylist() == words


@pytest.mark.parametrize("width", [5, 6])
def test_sums_of_features_are_those_of_single_additions(width):
    rng = np.random.default_rng(3)
    rows, values = rng.integers(0, 7, 500), rng.normal(size=(500, width)).astype(np.float32)
    sums, plain = lm.Sums((8, width)), np.zeros((8, width), np.float32)
    sums.add_rows(rows, values)
    for row, value in zip(rows, values, strict=True):
        plain[row] += value
    sums.settle()
    assert (sums.whole == plain).all() and not sums.part.any()


def test_shares_do_not_depend_on_how_many_rows_are_worked_on_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    model = model_of(Counter(b"a b c d e f g h i j k l m a b c a b".split()))
    model.class_weights += rng.normal(size=model.class_weights.shape).astype(np.float32)
    model.word_weights += rng.normal(size=model.word_weights.shape).astype(np.float32)
    batch = lm.Batch(model, lm.Described(model), [([lm.START] * 3, b"a b x c l m a b c d e".split()), ([lm.START] * 3, [])])
    whole = batch.class_shares(), batch.word_shares()
    assert all(shares.sum(axis=1) == pytest.approx(1, abs=1e-5) for shares in whole)
    monkeypatch.setattr(lm, "AT_ONCE", 3)
    assert all((one == two).all() for one, two in zip(whole, (batch.class_shares(), batch.word_shares()), strict=True))


def test_counts_of_more_words_than_a_task_remembers(spark, table):  # noqa: F811
    """Every word stands three times, a few four times, far apart: their counts meet across what the task gave out."""
    from pyspark.sql import functions as F

    each, distinct = 4000, 3 * lm.REMEMBERED
    words = F.expr(f"transform(sequence(0, {each - 1}), i -> concat('w', (id * {each} + i) % {distinct}, ' '))")
    docs = spark.range(0, 3 * distinct // each + 1, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws("", words).alias("text"))
    got = dict(lm.unigrams(docs).groupBy("count").agg(F.count("*")).collect())
    rows = 3 * distinct // each + 1
    more = rows * each - 3 * distinct
    assert got == {3: distinct - more, 4: more, rows: 1}


def test_parts_of_a_long_text_keep_their_history(monkeypatch):
    text = b"one two three four five six seven eight nine"
    whole = [(n, b, w) for n, b, w, _ in lm.pieces_of(iter([(0, text)]))]
    monkeypatch.setattr(lm, "TOGETHER", 2)
    parts = [(n, b, w) for n, b, w, _ in lm.pieces_of(iter([(0, text)]))]
    flat = [w for _, _, ws in parts for w in ws]
    assert flat == [w for _, _, ws in whole for w in ws] and flat[-1] == lm.END
    at = 0
    for _, before, part in parts:
        assert before == ([lm.START] * 3 + flat[:at])[-3:]
        at += len(part)


def test_learns_what_follows(spark):
    """On held-out documents of the test table, and on a pattern, the model beats the unigrams."""
    docs = spark.createDataFrame([(i, "tick tock " * 30) for i in range(200)], "doc_id bigint, text string")
    for row in lm.score_documents(docs, rounds=4).filter("held_out").collect():
        assert row.score > 0.6 * row.base_score
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    from pyspark.sql import functions as F

    score, base = lm.score_documents(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def test_empty_tables(table):
    assert lm.score_documents(table([]), **SMALL).collect() == []
    (row,) = lm.score_documents(table([(None, "a b")]), **SMALL).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.held_out) == (3, 0, 0, 0.0, False)
    assert row.score == pytest.approx(0, abs=1e-6)
