"""Similarity join of word-shingle sets: Jaccard of at least 0.8 by T-occurrence search.

Two documents of x and y shingles are similar if they share T = ceil(4 (x + y) / 9) of them. Shingles
have one order for all documents: by hash, with those that very many documents hold at
the end. The first 20 % (+ 1) of a document's shingles in that order are its short lists:
a similar document stands in at least one of them (T-occurrence with the long lists set
aside). What the short lists bring together is then searched in blocks by DivideSkip: in
a block the query's shorter inverted lists are merged by a heap, documents found often
enough are probed in its longer lists by binary search, and those reaching T stay.

Work is kept linear where many documents share a list:

* equal sets are one representative;
* in the first round each representative meets one document, the smallest of most of its lists; the links
  found contract the documents into parts;
* in the second round only lists that still hold several parts bring pairs together, across parts only,
  and only where enough of both documents is left behind the place of the shared shingle;
* a bitmap per document (two bits per shingle) rejects pairs that can't share enough before any text moves.

No pair is left out: pairs inside a part are connected already, all others are tested.

Defined results: null and empty texts and texts without words have no shingles and no links;
fewer words than ``WORDS`` are one shingle; rows with one ``doc_id`` are one document; rows without
``doc_id`` are returned with a null component; other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import connected
from larder.llm.shared import by_bytes, id_and_text, release, settled

WORDS = 5
#: Documents looked at together for frequent shingles, and in how many of them a shingle is frequent.
WINDOW, FREQUENT = 1000, 4
#: Shingles held for that at most: long documents make a window of fewer.
WINDOW_SHINGLES = 1 << 20
#: Frequent shingles that are put last; any number gives the same links.
LAST = 1 << 17
#: Documents searched together for one query.
BLOCK = 256

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_random = np.random.Generator(np.random.PCG64(3))
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
PLACE = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(LOWER), np.uint8)
    word = (raw != 32) & ((raw < 9) | (raw > 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    # a word's hash is a polynomial in its bytes, from differences of one running sum over the text
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[raw] * powers(BASE, len(raw)))))
    words = mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(raw))[starts])
    if len(words) < WORDS:
        return mixed(np.sum(words * PLACE[: len(words)], dtype=np.uint64, keepdims=True) + np.uint64(len(words)))
    n = len(words) - WORDS + 1
    return np.unique(mixed(sum(words[k : k + n] * PLACE[k] for k in range(WORDS))))


def required(x: int, y: int) -> int:
    """Shared shingles that sets of x and y need for a Jaccard similarity of 0.8."""
    return -(-4 * (x + y) // 9)


def bitmap(found: np.ndarray) -> bytes:
    """Two bits per shingle and more, a power of two in all: bit ``hash mod size`` is set for each shingle."""
    size = max(64, 1 << int(2 * len(found) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(found & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def can_share(x: int, y: int, x_bits: bytes, y_bits: bytes) -> bool:
    """False if the bitmaps prove that too many shingles of one are not in the other."""
    a, b = np.frombuffer(x_bits, np.uint8), np.frombuffer(y_bits, np.uint8)
    if len(a) < len(b):
        x, y, a, b = y, x, b, a
    while len(a) > len(b):  # folded to the smaller size
        half = len(a) // 2
        a = a[:half] | a[half:]
    need = required(x, y)
    return np.bitwise_count(a & ~b).sum() <= x - need and np.bitwise_count(b & ~a).sum() <= y - need


def divide_skip(lists: list[list[int]], need: np.ndarray) -> list[int]:
    """Documents that stand in at least ``need[document]`` of the sorted lists."""
    if not lists or not len(need):
        return []
    lists = sorted(lists, key=len)
    least = int(need.min())
    # the usual choice of how many of the longest lists to set aside
    n_long = min(least - 1, int(least / (0.01 * np.log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    out, merged = [], heapq.merge(*short)
    last, count = -1, 0

    def probe(document: int, count: int) -> None:
        missing = int(need[document]) - count
        left = len(long)
        for postings in reversed(long):
            if missing <= 0 or missing > left:
                break
            at = bisect_left(postings, document)
            missing -= at < len(postings) and postings[at] == document
            left -= 1
        if missing <= 0:
            out.append(document)

    for document in merged:
        if document == last:
            count += 1
            continue
        if last >= 0 and count >= need[last] - n_long:
            probe(last, count)
        last, count = document, 1
    if last >= 0 and count >= need[last] - n_long:
        probe(last, count)
    return out


def search(query: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Positions of the sets similar to the query."""
    need = np.array([required(len(query), len(s)) for s in sets])
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.searchsorted(query, everything)
    at[at == len(query)] = 0
    hit = query[at] == everything
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    edges = np.flatnonzero(np.diff(at)) + 1
    return divide_skip([part.tolist() for part in np.split(owner, edges)] if len(at) else [], need)


def described(docs: DataFrame) -> DataFrame:
    """Per document: number of shingles, digest and bitmap of the set.

    Rows without these, and with ``n`` of -1, hold shingles that are frequent among documents read together.
    """

    def rows_of(batch: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = ["doc_id", "n", "digest", "bits", "frequent", "times"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*batch, strict=True), types, strict=True)], names
        )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window: dict[bytes, np.ndarray] = {}

        def frequent() -> tuple:
            found, times = np.unique(np.concatenate(list(window.values())), return_counts=True)
            window.clear()
            often = times >= FREQUENT
            return None, -1, None, None, found[often].view(np.int64), times[often]

        held = 0
        for batch in batches:
            for some in by_bytes(batch):
                rows = []
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                    found = shingles(text)
                    if not len(found):
                        rows.append((doc_id, 0, None, None, None, None))
                        continue
                    digest = xxhash.xxh3_128_digest(found.tobytes())
                    rows.append((doc_id, len(found), digest, bitmap(found), None, None))
                    held += 0 if digest in window else len(found)
                    window[digest] = found
                    if len(window) >= WINDOW or held >= WINDOW_SHINGLES:
                        rows.append(frequent())
                        held = 0
                yield rows_of(rows)
        if window:
            yield rows_of([frequent()])
        release()

    schema = "doc_id bigint, n bigint, digest binary, bits binary, frequent array<bigint>, times array<bigint>"
    return settled(id_and_text(docs).mapInArrow(describe, schema), "shingle-sets")


def most_frequent(sets: DataFrame) -> list[int]:
    """At most ``LAST`` shingles, the most frequent last."""
    counted = (
        sets.filter("n = -1")
        .select(F.explode(F.arrays_zip("frequent", "times")).alias("s"))
        .groupBy(F.col("s.frequent").alias("shingle"))
        .agg(F.sum("s.times").alias("times"))
        .orderBy(F.desc("times"), "shingle")
        .limit(LAST)
    )
    return [row.shingle for row in counted.collect()][::-1]


def short_lists(docs: DataFrame, last: list[int]) -> DataFrame:
    """(shingle, doc_id, at) for the first shingles of each document in the common order; ``at`` is the place there."""
    by_hash = np.array(last, np.int64).view(np.uint64)
    by_hash_order = np.argsort(by_hash)
    by_hash = by_hash[by_hash_order]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in by_bytes(batch):
                first, owner, place = [], [], []
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                    found = shingles(text)
                    keep = len(found) - (4 * len(found) + 4) // 5 + 1
                    if len(by_hash) and len(found):
                        at = np.minimum(np.searchsorted(by_hash, found), len(by_hash) - 1)
                        late = by_hash[at] == found
                        ranks = np.where(late, by_hash_order[at] + 1, 0)
                        found = found[np.argsort(ranks, kind="stable")]
                    found = found[:keep]
                    first.append(found.view(np.int64))
                    owner.append(np.full(len(found), doc_id, np.int64))
                    place.append(np.arange(len(found), dtype=np.int32))
                columns = [pa.array(np.concatenate(c)) for c in (first, owner, place)]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "doc_id", "at"])

    rows = id_and_text(docs).filter("doc_id is not null and text <> ''")
    return rows.mapInArrow(emit, "shingle bigint, doc_id bigint, at int")


def not_rejected(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow enough shared shingles."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("n", "m", "a_bits", "b_bits")]
            keep = [can_share(*row) for row in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("doc_id").alias("a"), "n", F.col("bits").alias("a_bits"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("bits").alias("b_bits"))
    near = pairs.join(one.drop("a_bits"), "a").join(two.drop("b_bits"), "b").filter("5 * least(n, m) >= 4 * greatest(n, m)")
    near = near.select("a", "b").join(one, "a").join(two, "b")
    return near.select("a", "b", "n", "m", "a_bits", "b_bits").mapInArrow(test, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) that are similar: each a is searched among its bs, ``BLOCK`` at a time."""
    pairs = settled(not_rejected(pairs, sets), f"{name}-pairs")
    partners = pairs.groupBy("a").agg(F.count("*").alias("partners"))
    blocks = pairs.join(partners, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / BLOCK)).cast("int").alias("block")
    )
    blocks = settled(blocks, f"{name}-blocks")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = settled(id_and_text(docs).join(wanted, "doc_id", "left_semi"), f"{name}-texts")
    members = blocks.join(texts, blocks["b"] == texts["doc_id"]).select("a", "block", F.lit(1).alias("member"), "doc_id", "text")
    queries = blocks.select("a", "block").distinct().join(texts, F.col("a") == F.col("doc_id"))
    rows = members.union(queries.select("a", "block", F.lit(0).alias("member"), "doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, ids, found = None, None, [], []

        def links() -> pa.RecordBatch:
            near = search(query, found) if ids and query is not None else []
            columns = [pa.array([key[0]] * len(near), pa.int64()), pa.array([ids[i] for i in near], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in batches:
            for some in by_bytes(batch):
                for a, block, member, doc_id, text in zip(*(c.to_pylist() for c in some.columns), strict=True):
                    if (a, block) != key:
                        if key is not None:
                            yield links()
                        key, query, ids, found = (a, block), None, [], []
                    if member:
                        ids.append(doc_id)
                        found.append(shingles(text))
                    else:
                        query = shingles(text)
        if key is not None:
            yield links()
        del found
        release()

    in_blocks = rows.repartition("a", "block").sortWithinPartitions("a", "block", "member")
    return settled(in_blocks.mapInArrow(run, "a bigint, b bigint").distinct(), f"{name}-links")


def similar(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Descriptions of all documents with their representative, and links (a, b) between representatives.

    The links connect whatever is connected; of the pairs inside a part not every one is listed.
    """
    sets = described(docs)
    classes = settled(
        sets.filter("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("representative")),
        "classes",
    )
    sets_of = settled(
        sets.filter("n > 0 and doc_id is not null")
        .join(classes, "digest")
        .select("doc_id", "representative", "n", "bits")
        .dropDuplicates(["doc_id"]),
        "representatives",
    )
    representative = sets_of.select("doc_id", "representative")
    own_sets = sets_of.filter("doc_id = representative").select("doc_id", "n", "bits")

    last = most_frequent(sets)
    shared = settled(
        short_lists(docs, last)
        .groupBy("shingle")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low <> high")
        .select("shingle", "low"),
        "shared-lists",
    )
    postings = settled(
        short_lists(docs, last)
        .join(shared, "shingle")
        .join(representative, "doc_id")
        .select("shingle", F.col("representative").alias("doc_id"), "at", "low"),
        "postings",
    )

    # first round: each document and the smallest document of most of its lists
    lows = representative.withColumnsRenamed({"doc_id": "low", "representative": "hub"})
    met = postings.groupBy("doc_id", "low").agg(F.count("*").alias("times"))
    met = met.join(lows, "low").filter("hub <> doc_id").groupBy("doc_id", "hub").agg(F.sum("times").alias("times"))
    best = met.groupBy("doc_id").agg(F.max(F.struct("times", -F.col("hub"))).alias("best"))
    pairs = best.select((-F.col("best.col2")).alias("a"), F.col("doc_id").alias("b"))
    first = verified(pairs, own_sets, docs, "first")
    part = first.groupBy(F.col("b").alias("doc_id")).agg(F.min("a").alias("part"))
    for _ in range(3):  # along chains of hubs; a label is always a connected document
        up = part.select(F.col("doc_id").alias("part"), F.col("part").alias("next"))
        part = settled(
            part.join(up, "part", "left").select("doc_id", F.coalesce("next", "part").alias("part")), "parts"
        )

    # second round: across the parts that still share a list
    across = (
        postings.select("shingle", "doc_id", "at")
        .distinct()
        .join(part, "doc_id", "left")
        .select("shingle", "doc_id", "at", F.coalesce("part", "doc_id").alias("part"))
    )
    mixed_lists = settled(
        across.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("shingle"),
        "mixed-lists",
    )
    sizes = own_sets.select("doc_id", "n")
    across = settled(across.join(mixed_lists, "shingle").join(sizes, "doc_id"), "mixed-postings")
    other = across.select("shingle", *(F.col(c).alias(f"{c}_") for c in ("doc_id", "at", "part", "n")))
    pairs = (
        across.join(other, "shingle")
        .filter("doc_id < doc_id_ and part <> part_ and 5 * least(n, n_) >= 4 * greatest(n, n_)")
        # at their first common shingle no more can be shared than what both have from there on
        .filter("9 * least(n - at, n_ - at_) >= 4 * (n + n_)")
        .select(F.col("doc_id").alias("a"), F.col("doc_id_").alias("b"))
        .distinct()
    )
    second = verified(pairs, own_sets, docs, "second")
    return sets.filter("n >= 0").join(classes, "digest", "left"), first.union(second)


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    sets, links = similar(docs)
    reached = connected(links)
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("representative")).otherwise(F.col("doc_id"))
    return (
        sets.select("doc_id", F.col("n").alias("n_shingles"), own.alias("node"))
        .join(reached, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest document of each component; rows without ``doc_id`` stay, repeated rows stay once."""
    others = components(docs).filter("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.filter("doc_id is not null").join(others, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return kept.select(docs.columns).union(docs.filter("doc_id is null"))
