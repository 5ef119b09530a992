from __future__ import annotations

import random
import zlib

import numpy as np
from llm_cases import SF_SMALL, odd_rows, table, words  # noqa: F401 - fixtures

from larder.llm import language_id as L


def text_of(rng, syllables):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(40))


def test_gaps_and_letters():
    assert L.letters_and_gaps("Ab, 1c").tolist() == [0, 97, 98, 0, 99, 0]
    assert L.letters_and_gaps("12 !").tolist() == [] == L.letters_and_gaps(None).tolist()
    assert L.letters_and_gaps("𝒜").tolist() == [0, ord("𝒜"), 0]


def test_masks_name_the_languages_and_chance_is_taken_off():
    masks = np.zeros(L.SLOTS, np.uint64)
    masks[::2] = 1  # half of all slots are set for the first language: a quarter of all n-grams by chance
    filters = L.LanguageFilters(["xx", "yy"], masks)
    assert filters.chance.tolist() == [0.25, 0.0]
    lang, score = filters.decide(text_of(random.Random(1), ["ab", "cd", "ef", "gh"]))
    assert 0.0 <= score <= 1.0 and lang in ("xx", "yy")
    assert filters.decide("...") == ("und", 0.0) and L.LanguageFilters([], masks).decide("abc") == ("und", 0.0)


def test_learns_only_from_its_folds(table, odd_rows):
    rng = random.Random(2)
    kinds = {"aa": ["ka", "to", "mi", "re"], "bb": ["xu", "ïz", "qo", "vy"], "cc": ["ent", "ous", "ing"]}
    rows, langs = [], {}
    for i in range(100, 220):
        lang = sorted(kinds)[i % 3]
        rows.append((i, text_of(rng, kinds[lang])))
        # labels of held-out documents are wrong: they must not be read
        langs[i] = "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang
    docs = table([*rows, *odd_rows], langs)
    out = L.predict_held_out(docs).collect()
    assert len(out) == len(rows) + len(odd_rows)
    for row in out:
        if row.doc_id in langs:
            assert row.lang_pred == sorted(kinds)[row.doc_id % 3] and 0 < row.score <= 1
            assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        elif row.doc_id in (1, 2, 3, 8):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        else:
            assert row.lang_pred in kinds
    kept = L.identify(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([*langs, 4, 5, 6, 7, 7, 0])


def test_nothing_to_learn_from(table):
    (row,) = L.predict_held_out(table([(1, "abc")])).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert [r.doc_id for r in L.identify(table([(1, "abc"), (2, "."), (3, None)])).collect()] == [1]
    assert L.predict_held_out(table([])).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = L.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    rows = out.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_more_languages_than_a_mask_word_holds(spark, table):
    """70 labels, each with letters of its own alphabet."""
    def text(lang, n):
        return "".join(chr(0x4E00 + 40 * lang + (7 * k + n) % 40) for k in range(120))

    rows = [(100 * lang + n, text(lang, n)) for lang in range(70) for n in range(6)]
    docs = table(rows, {i: f"l{i // 100:02d}" for i, _ in rows})
    found = L.predict_held_out(docs).collect()
    assert len(found) == 420 and all(r.lang_pred == f"l{r.doc_id // 100:02d}" for r in found)


def test_equals_counting_by_hand(spark, table):
    """Filters and decisions against sets of n-grams, computed slot by slot."""
    rng = random.Random(12)
    rows = [(i, words(rng, 30) if i % 2 else words(rng, 30).upper().replace("A", "é")) for i in range(40)]
    docs = table(rows, {i: "ab"[i % 2] for i, _ in rows})
    model = L.fit(docs)
    counts = {lang: np.zeros(L.SLOTS, int) for lang in "ab"}
    grams = dict.fromkeys("ab", 0)
    for lang in "ab":
        # texts that a task counts together stand in a row, a gap between them; here one task per language is not certain
        for i, text in rows:
            if "ab"[i % 2] == lang:
                symbols = L.letters_and_gaps(text)
                first, second = L.slots(symbols)
                np.add.at(counts[lang], first, 1)
                np.add.at(counts[lang], second, 1)
                grams[lang] += len(first)
    for j, lang in enumerate(model.languages):
        bits = (model.masks[0] >> np.uint64(j) & np.uint64(1)).astype(bool)
        plain = counts[lang] >= max(2, L.USUAL_SHARE * grams[lang])
        assert (bits & ~plain).sum() + (plain & ~bits).sum() <= 0.002 * plain.sum() + 40
    for _, text in rows[:10]:
        symbols = L.letters_and_gaps(text)
        first, second = L.slots(symbols)
        hits, n = model.hits(text)
        for j in range(2):
            held = [bool(model.masks[0][a] >> np.uint64(j) & np.uint64(1)) and bool(model.masks[0][b] >> np.uint64(j) & np.uint64(1)) for a, b in zip(first, second)]
            assert hits[j] == sum(held) and n == len(first)
        share = np.clip((hits / n - model.chance) / (1 - model.chance), 0, 1)
        assert model.decide(text) == (model.languages[int(share.argmax())], float(share.max()))
