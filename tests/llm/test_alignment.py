from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from llm_cases import odd_rows, table, words  # noqa: F401 - fixtures

from larder.llm import alignment
from larder.llm.shared import tokenizer_file, tokenizer_pattern

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    """The contract read literally: tokens, their byte ranges, all overlapping pairs."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    found = []
    for doc_id, text in rows:
        a, b, raw = [], [], (" " + (text or "")).encode()
        if text:
            encoded = first.encode(" " + text, add_special_tokens=False)
            at = 0
            for number in encoded.ids:
                size = len(alignment_bytes()[number])
                a.append((number, at, at + size))
                at += size
            assert at == len(raw)
            at, spelled = 0, b""
            for number in second.encode(text):
                piece = second.id_to_piece(number)
                part = bytes([int(piece[3:5], 16)]) if second.is_byte(number) else piece.replace("▁", " ").encode()
                spelled += part
                b.append((number, at, at + len(part)))
                at += len(part)
            if spelled != raw:
                a, b = [], []
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, lo = [], 0
        for hi in ends:
            groups.append(
                "|".join(",".join(str(i) for i, s, e in tokens if lo < e <= hi) for tokens in (a, b))
            )
            lo = hi
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((doc_id, a, b, groups, links, digest))
    counts = Counter(link for *_, links, _ in found for link in links)
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (i, len(a), len(b), len(g), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), d)
        for i, a, b, g, links, d in found
    ]


def alignment_bytes(cache={}):  # noqa: B006 - one table for the module
    if not cache:
        cache["t"] = alignment.ByteLevel(A, None, None).tokens
    return cache["t"]


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


@pytest.mark.parametrize("known, fast", [(1 << 19, True), (5, True), (0, False)])
def test_equals_all_pairs(table, odd_rows, known, fast):
    rng = random.Random(3)
    some = words(rng, 60)
    rows = [(i, t) for i, t in odd_rows if i != 4]
    rows += [(100 + i, " ".join(rng.choice(some.split()) for _ in range(rng.randint(1, 30)))) for i in range(25)]
    rows += [
        (200, "<|endoftext|> <s></s> <unk> <0x41>"),
        (201, "a▁b"),
        (202, "  two  spaces\n\n\tand\r\nlines  "),
        (203, "naïve café — “quoted” 12345 don't we'll"),
        (204, "日本語テキスト 😀😀 é ​﻿ x"),
        (205, "a" * 3000 + " " * 500 + "1" * 2500),
        (206, "\x00\x01"),
    ]
    extra = (tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern()) if fast else (None, None)
    got = [tuple(r) for r in alignment.align(table(rows), A, B, *extra, known=known).select(COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_very_long_text(table, odd_rows):
    rows = [r for r in odd_rows if r[0] == 4]
    (got,) = alignment.align(table(rows), A, B).collect()
    assert got.n_links == got.n_a + got.n_b - got.n_groups and got.count_sum > got.n_links >= got.n_best > 0


def test_fast_and_exact_encoders_agree():
    fast, exact = alignment.ByteLevel(A, tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern()), alignment.ByteLevel(A, None, None)
    assert fast.fast is not None and exact.fast is None
    rng = random.Random(9)
    letters = "abcXYZ 019  .,'’\n\téßÖ-_ñ<|>"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))
        assert fast(text).tolist() == exact(text).tolist()


def test_empty_table(table):
    assert alignment.align(table([]), A, B).collect() == []
    (row,) = alignment.align(table([(1, None)]), A, B).collect()
    assert tuple(row[c] for c in COLUMNS) == (1, 0, 0, 0, 0, 0, 0, "")
