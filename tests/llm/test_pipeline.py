from __future__ import annotations

import random
from collections import defaultdict

import corpus_pipeline
import pytest
from llm_cases import odd_rows, table, words  # noqa: F401 - fixtures

import __spark_entry__ as entry_module
from larder.llm.shared import settled


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_module.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 11)) and "pipeline" in names


def test_stages(spark, table, odd_rows):
    rng = random.Random(6)
    base, passage = words(rng, 200), words(rng, 80)
    rows = [
        (100, base),
        (101, base + " one"),
        (102, base.upper()),
        (103, words(rng, 60) + " " + passage),
        (104, words(rng, 50) + " " + passage + " " + words(rng, 50)),
        (105, words(rng, 80) + " token = abcdef123456 " + words(rng, 10)),
        (106, words(rng, 90)),
        *odd_rows,
    ]
    docs = table(rows, {i: "en" for i, _ in rows})
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, ""), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            left[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(left["language_id"]) == {i for i, _ in rows} - {1, 2, 3, 8}
    assert set(left["ngram_jaccard_join"]) == set(left["language_id"]) - {101, 102}
    assert passage not in left["substring_dedup"][104] and left["substring_dedup"][106] == dict(rows)[106]
    assert "abcdef123456" not in left["secret_scan"][105] and "[secret]" in left["secret_scan"][105]
    assert set(left["secret_scan"]) == set(left["ngram_jaccard_join"])
    places = defaultdict(list)
    for r in docs.collect():
        places[r.sequence_id].append((r.offset, r.length))
    assert {r.doc_id for r in docs.collect()} == set(left["secret_scan"])
    assert all(sum(n for _, n in p) <= 4096 for p in places.values())


def test_run(spark):
    """The whole query: what is packed is what plain steps leave of the documents."""
    sf_dir = "/root/testdata/sf0.001"
    places = corpus_pipeline.run(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    kept = {r.doc_id for r in places}
    lettered = {i for i, t in docs.items() if t and any(c.isalpha() for c in t)}
    assert kept <= lettered and len(kept) > 0.5 * len(lettered)
    exact = defaultdict(list)
    for i in sorted(lettered):
        exact[docs[i]].append(i)
    assert all(not kept & set(same[1:]) for same in exact.values())
    ends = defaultdict(int)
    for r in sorted(places, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 4096


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_and_rejected(spark, table, rows):
    docs = table(rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, ""), name)
    assert docs.collect() == []
