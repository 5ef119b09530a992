from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import odd_rows, table  # noqa: F401 - fixtures

from larder.llm import packing
from larder.llm.shared import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@given(st.lists(st.integers(1, 60), max_size=80))
@settings(max_examples=150, deadline=None)
def test_bins_hold_everything_once(lengths):
    bins = packing.best_two_fit(np.array(lengths, int), 60)
    assert sorted(at for held in bins for at in held) == list(range(len(lengths)))
    assert all(sum(lengths[at] for at in held) <= 60 for held in bins)


def test_two_smaller_pieces_replace_the_smallest():
    # greedy takes 60 + 35 and leaves a gap of 5; 21 + 19 fill the place of 35 exactly
    bins = packing.best_two_fit(np.array([60, 35, 21, 19]), 100)
    assert sorted(sorted([60, 35, 21, 19][at] for at in held) for held in bins) == [[19, 21, 60], [35]]


def test_close_to_the_least_number_of_bins():
    rng = random.Random(1)
    lengths = np.array([rng.randint(1, 4096) for _ in range(3000)])
    assert len(packing.best_two_fit(lengths, 4096)) <= 1.02 * lengths.sum() / 4096 + 1


@given(st.text(alphabet=st.sampled_from(list("abAB éİΣςK'’.,!5 \n\t ́日😀<|>")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_tokenizers(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH) if not hasattr(test_ids_are_the_tokenizers, "t") else test_ids_are_the_tokenizers.t
    test_ids_are_the_tokenizers.t = whole
    got = np.frombuffer(packing.WordIds(PATH)(text), "<u4").tolist()
    assert got == whole.encode(text, add_special_tokens=False).ids


def test_table_of_words_starts_anew():
    text = "one two three four five six one seven eight two"
    small = packing.WordIds(PATH, limit=700)
    assert [small(text) for _ in range(3)] == [packing.WordIds(PATH)(text)] * 3
    assert small.words_bytes <= 700 + 10 * (packing.ENTRY_BYTES + 20)


def test_many_words_in_one_call():
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzßàéöÿ") for _ in range(rng.randint(1, 30))) for _ in range(9000)]
    table = packing.WordIds(PATH)
    assert table.letters(parts) == table.others(parts)


def test_letters_reach_the_tokenizer_once_whatever_marks_follow(monkeypatch):
    rng = random.Random(5)
    runs = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))) for _ in range(300)})
    marked = [run + mark for run in runs for mark in ("", ".", ",", "$$$", "***")] + [run.upper() + "!" for run in runs]
    texts = [" ".join(marked[at::7]) for at in range(7)] + [None, ""]
    seen = []
    plain = packing.WordIds.plain
    monkeypatch.setattr(packing.WordIds, "plain", lambda self, parts: seen.extend(parts) or plain(self, parts))
    table = packing.WordIds(PATH)
    ids = list(table.of_texts(pa.array(texts)))
    assert sorted(seen) == runs
    assert table.plain(runs) == table.letters(runs) == table.others(runs)
    assert ids == [b"".join(table.others((text or "").split())) for text in texts]


def plain_best_two_fit(lengths, capacity):
    """The rule read literally: the longest that fits, again and again; then two for the smallest."""
    waiting = sorted(((n, -at) for at, n in enumerate(lengths)), reverse=True)
    bins = []
    while waiting:
        held, gap = [], capacity
        while (fits := [x for x in waiting if x[0] <= gap]) and gap:
            waiting.remove(fits[0])
            held.append(fits[0])
            gap -= fits[0][0]
        if gap and len(held) > 1:
            room = gap + held[-1][0]
            totals = {a[0] + b[0] for i, a in enumerate(waiting) for b in waiting[i + 1 :] if a[0] + b[0] <= room}
            if totals and max(totals) > held[-1][0]:
                pair = min(
                    (min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(waiting) for b in waiting[i + 1 :] if a[0] + b[0] == max(totals)
                )
                last = held.pop()
                for n in pair:
                    held.append(next(x for x in waiting if x[0] == n))
                    waiting.remove(held[-1])
                waiting = sorted([*waiting, last], reverse=True)
        bins.append(sorted(n for n, _ in held))
    return bins


@given(st.lists(st.integers(1, 30), max_size=25))
@settings(max_examples=150, deadline=None)
def test_bins_are_those_of_the_plain_rule(lengths):
    bins = packing.best_two_fit(np.array(lengths, int), 30)
    assert [sorted(lengths[at] for at in held) for held in bins] == plain_best_two_fit(lengths, 30)


def test_pieces_of_equal_length(table):
    rows = [(i, "a b c") for i in (3, 1, 2)] + [(1, "a b c")]
    out = sorted((r.sequence_id, r.offset, r.doc_id) for r in packing.pack_documents(table(rows), PATH, capacity=8).collect())
    assert [i for *_, i in out] == [1, 1, 2, 3] and [o for _, o, _ in out] == [0, 4, 0, 4]


def test_pieces_and_places(table, odd_rows, tokenizer):
    out = packing.pack_documents(table(odd_rows), PATH, group_rows=4).collect()
    texts = dict(odd_rows)
    by_sequence = defaultdict(list)
    for row in out:
        ids = [*tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids, 1]
        part = ids[row.start : row.start + row.length]
        assert row.start == 4096 * row.piece and row.length == min(4096, len(ids) - row.start)
        assert row.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        by_sequence[row.sequence_id].append((row.offset, row.length))
    pieces = Counter((row.doc_id, row.piece) for row in out)
    assert pieces[(7, 0)] == 2 and pieces[(None, 0)] == 1 and pieces[(1, 0)] == 1
    assert len([p for p in pieces if p[0] == 4]) == -(-(len(tokenizer.encode(texts[4], add_special_tokens=False).ids) + 1) // 4096)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096


def test_ids_go_along(table):
    (row,) = packing.pack_documents(table([(1, "a b")]), PATH, with_ids=True).collect()
    assert np.frombuffer(bytes(row.ids), "<u4").tolist()[-1] == 1 and row.length == len(row.ids) // 4


def test_empty_table(table):
    assert packing.pack_documents(table([]), PATH).collect() == []
