"""Ranked lexical search, a term at a time with limited accumulators.

The first pass reads every text once and keeps, per document, its length and how often the
items' terms stand in it: a forward index of the asked vocabulary, written to the shared folder. Counts over all
documents (documents, terms, document frequencies) come from it.

The second pass inverts the index block by block. In a block each item's terms are worked through, the rarest
first. A document gets an accumulator while the bounds of the terms that remain (weight times the block's largest impact) could
still lift a new document to the k-th best partial score, or to the k-th best score of the task's
earlier blocks. From then on no accumulator is created; those that are there are
updated exactly to the end. Equality creates: such a document could win by its smaller id. A task keeps
``k`` documents per item, and only these meet in the final ranking.

Items are a stated query set. They are taken in batches of about ``batch_terms`` terms, which bounds what is sent to the
executors whatever the number of items; every batch meets all documents.

Defined results: null and empty texts have no terms; they count neither as documents nor for lengths and are never
returned. Repeated rows are documents of their own; rows without ``doc_id`` count in all statistics and are
not returned. Items without terms have no rows; rows that share an ``item_id`` are one item with the smallest of their texts, rows
without ``item_id`` are ignored. Ties go to the smaller ``doc_id``. Texts of any length are read in parts of
bounded size. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.shared import by_bytes, list_array, settled, word_lists

K = 50
BATCH_TERMS = 1 << 19
#: Postings and documents of a block, whichever is reached first: bounds a task's memory, not what is searched.
BLOCK_POSTINGS, BLOCK_DOCUMENTS = 1 << 21, 1 << 16

# Characters of terms (digits, letters, everything beyond ASCII) and the constants of the weights.
TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WEIGHT, HALF_LENGTH, IMPACT, SATURATION, NORM = 1000, 50, 1_000_000_000, 1000, 20


def asked_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of each item's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                terms = []
                for raw in part["text"].to_pylist():
                    found: set[bytes] = set()
                    for words in word_lists((raw or b"").translate(TERM)):
                        found.update(words)
                    terms.append(sorted(found))
                yield pa.RecordBatch.from_arrays([part["item_id"], pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    one = (
        items.filter("item_id is not null")
        .groupBy(F.col("item_id").cast("bigint").alias("item_id"))
        .agg(F.min(F.col("text").cast("string")).cast("binary").alias("text"))
    )
    return settled(one.mapInArrow(run, "item_id bigint, terms array<binary>"), "asked-terms")


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the text) and the numbers and times of those of the vocabulary, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            for part in by_bytes(batch):
                n, terms, times = [], [], []
                for raw in part["text"].to_pylist():
                    length, found = 0, []
                    for words in word_lists((raw or b"").translate(TERM)):
                        length += len(words)
                        found.append(np.array([t for t in map(number, words) if t is not None], np.int32))
                    held, often = np.unique(np.concatenate(found) if found else np.zeros(0, np.int32), return_counts=True)
                    n.append(length)
                    terms.append(held)
                    times.append(often.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(n, pa.int64()), list_array(terms), list_array(times)],
                    ["doc_id", "n", "terms", "times"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = "doc_id bigint, n bigint, terms array<int>, times array<int>"
    return settled(rows.mapInArrow(run, schema), "forward-index")


class Block:
    """The inverted lists of some documents."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, owner: np.ndarray, terms: np.ndarray, times: np.ndarray, n: int, total: int):
        m = HALF_LENGTH + HALF_LENGTH * lengths * n // total
        impact = IMPACT * times // (SATURATION * times + NORM * m[owner])
        order = np.argsort(terms, kind="stable")  # within a term documents stay in order
        self.ids, self.owner, self.impact = ids, owner[order], impact[order]
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(terms))
        self.largest = np.maximum.reduceat(self.impact, starts) if len(starts) else np.zeros(0, np.int64)
        self.score = np.zeros(len(ids), np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of at least the ``k`` best documents (ties included) that reach ``floor``.

        ``terms`` are in the order of work. ``floor`` is a score that ``k`` documents elsewhere reach.
        """
        score = self.score
        at = np.searchsorted(self.terms, terms)
        here = np.flatnonzero((at < len(self.terms)) & (weights > 0))
        here = here[self.terms[at[here]] == terms[here]]
        at, weights = at[here], weights[here]
        bounds = weights * self.largest[at]
        remaining = np.append(np.cumsum(bounds[::-1])[::-1], 0)
        creating, alive = True, None
        for i, (place, weight) in enumerate(zip(at.tolist(), weights.tolist(), strict=True)):
            lo, hi = self.starts[place], self.starts[place + 1]
            owner = self.owner[lo:hi]
            if creating:
                score[owner] += weight * self.impact[lo:hi]
                held = np.flatnonzero(score)
                least = floor
                if len(held) >= k:
                    least = max(least, int(np.partition(score[held], len(held) - k)[len(held) - k]))
                if remaining[i + 1] < least:
                    creating, alive = False, held
            elif len(alive) * 8 < len(owner):
                found = np.searchsorted(owner, alive)
                found[found == len(owner)] = 0
                match = owner[found] == alive
                score[alive[match]] += weight * self.impact[lo:hi][found[match]]
            else:
                known = score[owner] > 0
                score[owner[known]] += weight * self.impact[lo:hi][known]
        held = np.flatnonzero(score) if alive is None else alive
        found = score[held]
        score[held] = 0
        least = max(floor, int(np.partition(found, len(found) - k)[len(found) - k])) if len(found) >= k else floor
        best = (found >= least) & (found > 0)
        return held[best], found[best]


def search(
    docs: DataFrame, items: DataFrame, k: int = K, batch_terms: int = BATCH_TERMS, block: int = BLOCK_DOCUMENTS
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item."""
    asked = asked_terms(items)
    total_terms = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    batches = max(1, -(-total_terms // batch_terms))
    found = [
        _search_batch(docs, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == batch), k, block)
        for batch in range(batches)
    ]
    best = found[0]
    for more in found[1:]:
        best = best.union(more)
    in_order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = best.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search_batch(docs: DataFrame, asked: DataFrame, k: int, block: int) -> DataFrame:
    """item_id, doc_id and score of at least the ``k`` best documents of each of these items."""
    rows = asked.collect()  # about batch_terms terms
    words = sorted({term for row in rows for term in map(bytes, row.terms)})
    vocabulary = {word: number for number, word in enumerate(words)}
    index = forward_index(docs, vocabulary)
    n, total = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(words), np.int64)
    for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the batch's vocabulary
        frequency[row["term"]] = row["count"]
    weight = np.array([math.floor(WEIGHT * math.log((2 * n + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)
    queries = []
    for row in rows:
        terms = np.array([vocabulary[bytes(term)] for term in row.terms], np.int64)
        terms = terms[np.lexsort((terms, frequency[terms]))]
        queries.append((row.item_id, terms, weight[terms]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        best = [(nothing, nothing)] * len(queries)
        waiting: list[tuple] = []

        def work() -> None:
            ids, lengths, sizes, terms, times = (np.concatenate(c) for c in zip(*waiting, strict=True))
            waiting.clear()
            lists = Block(ids, lengths, np.repeat(np.arange(len(ids)), sizes), terms, times, n, total)
            for at, (_, terms, weights) in enumerate(queries):
                ids, scores = best[at]
                places, found = lists.search(terms, weights, k, int(scores[-1]) if len(scores) == k else 0)
                if len(places):
                    ids, scores = np.concatenate((ids, lists.ids[places])), np.concatenate((scores, found))
                    first = np.lexsort((ids, -scores))[:k]
                    best[at] = ids[first], scores[first]

        held = documents = 0
        for batch in batches:
            for part in (batch.slice(at, min(4096, block)) for at in range(0, batch.num_rows, min(4096, block))):
                column = part["terms"]
                waiting.append(
                    (
                        part["doc_id"].to_numpy(),
                        part["n"].to_numpy(),
                        np.diff(column.offsets.to_numpy()),
                        column.flatten().to_numpy().astype(np.int64),
                        part["times"].flatten().to_numpy().astype(np.int64),
                    )
                )
                held, documents = held + len(waiting[-1][3]), documents + part.num_rows
                if held >= BLOCK_POSTINGS or documents >= block:
                    work()
                    held = documents = 0
        if waiting:
            work()
        ids = np.repeat(np.array([q[0] for q in queries], np.int64), [len(b[0]) for b in best])
        columns = [np.concatenate(c) if len(queries) else nothing for c in zip(*best, strict=True)] or [nothing, nothing]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, *columns)], ["item_id", "doc_id", "score"])

    return index.filter("doc_id is not null and size(terms) > 0").mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def oracle(k: int = K) -> str:
    """The same ranking in plain SQL (DuckDB)."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def terms(column: str) -> str:
        return f"unnest(regexp_extract_all(translate({column}, '{upper}', '{lower}'), '{pattern}'))"

    return f"""WITH words AS (SELECT doc_id, {terms('text')} AS term FROM documents),
    asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {terms('text')} AS term FROM benchmark)),
    lengths AS (SELECT doc_id, COUNT(*) AS n FROM words GROUP BY 1),
    sums AS (SELECT COUNT(*) AS big_n, CAST(SUM(n) AS BIGINT) AS big_l FROM lengths),
    tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
        FROM tf, sums GROUP BY term, big_n),
    impacts AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l)) AS impact
        FROM tf JOIN lengths USING (doc_id), sums),
    scores AS (SELECT item_id, doc_id, CAST(SUM(w * impact) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL)
    SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= {k}"""
