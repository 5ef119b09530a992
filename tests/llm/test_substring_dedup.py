from __future__ import annotations

import random

import numpy as np

from larder.llm import substring_dedup as S

from llm_cases import odd_rows, table, words  # noqa: F401 - fixtures


def test_chunks_cover_the_text_and_cuts_are_local():
    rng = random.Random(2)
    text = words(rng, 500)
    starts, ends, digests, before, after, again = S.chunks_of(text)
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] == ends[:-1]).all() and (ends > starts).all()
    assert after[-1] == 500 and (before[1:] == after[:-1]).all()
    moved = S.chunks_of("inserted words here " + text)
    assert len(set(digests.tolist()) & set(moved[2].tolist())) >= len(digests) - 4
    assert np.diff(S.cuts(S.codes_of("".join(chr(0x4E00 + i) for i in range(10_000))))).max() <= S.LONGEST


def test_every_passage_of_over_50_words_is_found():
    rng = random.Random(3)
    for _ in range(150):
        passage = words(rng, 51)
        one = S.chunks_of(words(rng, 30) + " " + passage + " " + words(rng, 20))
        two = S.chunks_of(words(rng, 9) + " " + passage + " " + words(rng, 33))
        known, best, run = set(one[2].tolist()), 0, 0
        for digest, n in zip(two[2].tolist(), (two[4] - two[3]).tolist(), strict=True):
            run = run + n if digest in known else 0
            best = max(best, run)
        assert best >= S.MIN_WORDS


def plain_runs(rows, min_words=S.MIN_WORDS, min_chars=S.MIN_CHARS):
    """Runs of repeated chunks by one dictionary of all chunks' texts."""
    texts = {}
    for i, t in rows:
        if i is not None and t and i not in texts:
            texts[i] = t
    first = {}
    for i in sorted(texts):
        edges = S.cuts(S.codes_of(texts[i])).tolist()
        for a, b in zip(edges[:-1], edges[1:]):
            first.setdefault(texts[i][a:b], (i, a))
    out = set()
    for i, text in texts.items():
        edges, run = S.cuts(S.codes_of(text)).tolist(), None
        for a, b in zip([*edges[:-1], len(text)], [*edges[1:], None]):
            if b is not None and first[text[a:b]] != (i, a):
                run = (run[0], b) if run else (a, b)
            elif run:
                part = text[run[0] : run[1]]
                starts = sum(not c.isspace() and (run[0] + k == 0 or text[run[0] + k - 1] in " \t\n\r\x0b\x0c") for k, c in enumerate(part))
                if starts >= min_words or len(part) >= min_chars:
                    out.add((i, run[0], len(part)))
                run = None
    return out


def test_runs_equal_those_of_a_dictionary(table):
    rng = random.Random(14)
    passages = [words(rng, 60) for _ in range(4)]
    rows = [
        (i, " ".join(rng.choice(passages) if rng.random() < 0.3 else words(rng, rng.randint(5, 30)) for _ in range(5)))
        for i in range(40)
    ]
    rows += [(50 + i, "trash " * (200 + 31 * i) + words(rng, 5)) for i in range(4)] + [(60, ""), (61, None), (62, "=" * 900)]
    found = {(r.doc_id, r.start, r.length) for r in S.repeated_spans(table(rows)).collect()}
    assert found == plain_runs(rows) and len(found) > 20


def test_texts_without_spaces_and_with_a_period(table):
    """Scripts without spaces, one long word, and a periodic passage in different places are repeats too."""
    rng = random.Random(15)
    chinese = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(3000))
    word = "".join(rng.choice("abcdefghij") for _ in range(4000))
    periodic = ("trash " * 300)[:1800]
    rows = [(1, chinese), (2, chinese), (3, word), (4, word)]
    rows += [(5, words(rng, 40) + " " + periodic + words(rng, 7)), (6, words(rng, 33) + " xy " + periodic + words(rng, 9))]
    found = {}
    for r in S.repeated_spans(table(rows)).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found[2] == 3000 and found[4] == 4000 and found[6] > 1600 and 1 not in found and 3 not in found


def test_repeats_are_cut_and_clean_documents_stay(table, odd_rows):
    rng = random.Random(4)
    passage = words(rng, 60)
    rows = [
        (11, words(rng, 50) + " " + passage + " " + words(rng, 50)),
        (12, words(rng, 30) + " " + passage + " " + words(rng, 30)),
        (13, words(rng, 120)),
        (14, words(rng, 100)),
        (15, "same copy " + words(rng, 80)),
    ]
    rows += [(16, rows[4][1]), *((i + 100 if i else None, t) for i, t in odd_rows)]
    docs = table(rows)
    spans = {r.doc_id: r for r in S.by_document(S.repeated_spans(docs)).collect()}
    assert set(spans) - {108} == {12, 16} and spans[12].first_doc_ids == [11] and spans[16].first_doc_ids == [15]
    kept = S.remove_repeats(docs).collect()
    texts = {r.doc_id: r.text for r in kept}
    assert 16 not in texts and len(texts[12].split()) < 100
    for i, text in rows:
        if i not in (12, 16, 108):
            assert texts[i] == text
    assert sum(r.doc_id == 107 for r in kept) == 2
    assert all(r.n_chars == len(r.text) for r in kept if r.text is not None)
    middle = " ".join(passage.split()[20:40])
    assert sum(middle in (t or "") for t in texts.values()) == 1


def test_spans_are_drawn_in_to_words():
    assert S.without_spans("one two three four", [(5, 9)]) == "one two  four"
    assert S.without_spans("one two", [(0, 7)]) == ""


def test_empty_table(table):
    docs = table([])
    assert S.repeated_spans(docs).collect() == [] and S.remove_repeats(docs).collect() == []
