from __future__ import annotations

import re

from llm_cases import SF_SMALL, odd_rows, table  # noqa: F401 - fixtures

from larder.llm import license_scan as L

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"
CASES = [
    (20, "CC-BY, cc  by; General\nPublic License. ALL RIGHTS RESERVED all rights"),
    (21, "ccby cc byx general public licenses"),
    (22, "Released under the MIT License."),
    (23, MIT),
    (24, "free of charge, permission to any person"),
    (25, "cc Kby cc by"),
    (26, "all rights reserved " * 400),
    (27, "Redistribution and use in source and binary forms, with or without modification, are permitted"),
]


def test_base_matches_and_labels(spark, table, odd_rows):
    rows = [*CASES, *odd_rows]
    rows += [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 100", "text").collect()]
    out = L.summary(L.scan(table(rows))).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    by_id = {r.doc_id: r for r in out}
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert by_id[22].labels == by_id[23].labels == "mit" and by_id[24].labels == "" and by_id[27].labels == "bsd"
    assert by_id[5].score == 0.0


def grant(label, n=0):
    return [text for found, text, _ in L.TEMPLATES if found == label][n]


def test_no_label_is_lost_to_other_words(table):
    prose = "waived domain binary proprietary confidential redistribution modification conditions forms associated person charge "
    everything = " ".join(text + " x y" for _, text, _ in L.TEMPLATES)
    rows = [
        (1, f"{grant('mit', 2)}. {grant('bsd')}; {grant('isc')}"),
        (2, prose * 2 + "released under the mit license"),
        (3, everything),
        (4, ("waived copyright domain public " * 50_000) + grant("unlicense")),
        (5, "mit license"),
    ] + [(100 + i, prose) for i in range(5)]
    by_id = {r.doc_id: r.labels for r in L.summary(L.scan(table(rows))).collect()}
    assert by_id[1] == "bsd,isc,mit" and by_id[2] == "mit" and by_id[4] == "unlicense"
    assert set(by_id[3].split(",")) == {label for label, _, _ in L.TEMPLATES}
    assert by_id[100] == ""


def plain_labels(texts):
    """The rule read literally, text by text."""
    split = {i: re.findall(L.WORD, (t or "")) for i, t in texts.items()}
    split = {i: [w.translate(LOWER) if w.isascii() else w for w in ws] for i, ws in split.items()}
    frequency = {w: sum(w in ws for ws in split.values()) for w in L.VOCABULARY}
    out = {}
    for i, words in split.items():
        found = set()
        for label, text, keys in L.TEMPLATES:
            template = text.split()
            rarest = sorted(set(template) - L.COMMON, key=lambda w: (frequency[w], w))[: L.RARE_WORDS]
            at = {}
            for p, w in enumerate(words):
                for q, t in enumerate(template):
                    if w == t and w in rarest:
                        at.setdefault(p - q, set()).add(q)
            best = max(map(len, at.values()), default=0)
            phrases = all(any(words[p : p + len(k.split())] == k.split() for p in range(len(words))) for k in keys)
            if best >= min(2, len(rarest)) and best >= L.MIN_ALIGNED * len(rarest) and phrases:
                found.add(label)
        base = {label for phrase, label in L.BASE.items() if f" {phrase} " in f" {' '.join(words)} "}
        out[i] = ",".join(sorted(found | base))
    return out


def test_labels_equal_the_plain_rule(table):
    import random

    rng = random.Random(11)
    texts = {}
    for i in range(60):
        words = [w for _ in range(rng.randint(0, 3)) for w in rng.choice(L.TEMPLATES)[1].split()]
        words = [rng.choice(L.VOCABULARY) if rng.random() < 0.12 else w for w in words]
        texts[i] = " ".join(words + [rng.choice(L.VOCABULARY) for _ in range(rng.randint(0, 6))])
    got = {r.doc_id: r.labels for r in L.summary(L.scan(table(list(texts.items())))).collect()}
    assert got == plain_labels(texts)


def test_empty_table(table):
    assert L.summary(L.scan(table([]))).collect() == []


def test_main_path_is_native(table):
    words = L.licence_words(table(CASES))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", words)
    plan = L.summary(L.scan(table(CASES)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
