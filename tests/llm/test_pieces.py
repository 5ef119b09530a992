from __future__ import annotations

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF_SMALL, odd_rows, table  # noqa: F401 - fixtures

from larder.llm import pieces, token_counts, transducer
from larder.llm.shared import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def check(library, text):
    ids = library.encode(text)
    coder = transducer.codec(PATH)
    assert coder.encode(text).tolist() == ids
    assert coder.decode(ids) == library.decode(ids)
    assert token_counts.counter(PATH)(text)[0] == len(ids)


@given(st.lists(st.sampled_from(["a", "b", "the", " ", "  ", "\n", "\r", ";", "{", "}", "é", "日", "☃", "▁", "\t", "12", "ing"]), max_size=30))
@settings(max_examples=400, deadline=None)
def test_like_the_tokenizer(library, parts):
    check(library, "".join(parts))


def test_pieces_glued_together(library):
    rng = random.Random(3)
    vocabulary = [p for p, _, kind in pieces.load(PATH).pieces if kind == pieces.NORMAL]
    for _ in range(1500):
        check(library, "".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6))).replace("▁", " "))
    for n in range(0, 50):
        check(library, " " * n + "x" + " " * (50 - n))


UNIGRAM_PIECES = [("<unk>", 0.0, 2), ("a", -1.0, 1), ("b", -1.5, 1), ("ab", -2.5, 1), ("ba", -2.0, 1), ("aa", -2.0, 1), ("▁", -1.0, 1), ("▁a", -1.75, 1), ("abab", -5.0, 1)]


def brute_unigram(model, text):
    """Best score and fewest changes by trying all ways to cut the text."""
    best = None
    for cuts in itertools.product([0, 1], repeat=max(0, len(text) - 1)):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        parts = [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        if all(p in model.scores or len(p) == 1 for p in parts):
            score = sum(model.scores.get(p, model.unknown_score) for p in parts)
            # of equal scores the one whose last piece starts first, then its second last, ...
            key = (score, [len(p) for p in reversed(parts)])
            if best is None or key > best[0]:
                best = (key, parts)
    return best[1] if best else []


@given(st.text(alphabet="ab c", max_size=9))
@settings(max_examples=300, deadline=None)
def test_unigram_models(text):
    model = pieces.PieceModel(UNIGRAM_PIECES, pieces.UNIGRAM)
    wanted = brute_unigram(model, model.normalised(text)) if text else []
    ids = transducer.Codec(model).encode(text).tolist()
    assert ids == [model.ids.get(p, 0) for p in wanted]
    assert token_counts.Counter(model)(text) == (len(wanted), len(wanted))


def test_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "PAIRS", 4)
    text = "several words of a text that are more than three and of several kinds"
    assert transducer.Codec(pieces.load(PATH)).encode(text).tolist() == library.encode(text)


def test_documents(spark, table, odd_rows, library):
    rows = [*odd_rows, *(tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 100", "text").collect())]
    encoded = transducer.encode(table(rows), PATH)
    out = encoded.collect()
    assert [(r.doc_id, list(r.ids), r.n_ids) for r in out] == [
        (i, ids := library.encode(t or ""), len(ids)) for i, t in rows
    ]
    assert all(r.round_trip for r in out)
    back = {r.doc_id: r.text for r in transducer.decode(encoded, PATH).collect()}
    assert back == {i: t or "" for i, t in rows}
    counts = token_counts.count_tokens(table(rows), PATH).collect()
    assert [r.n_tokens for r in counts] == [r.n_ids for r in out]
    assert all(r.n_by_score >= (r.n_tokens > 0) for r in counts)
    assert transducer.encode(table([]), PATH).collect() == [] == token_counts.count_tokens(table([]), PATH).collect()
