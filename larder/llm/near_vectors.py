"""Near-duplicate vectors with a pivot-permutation index.

Every vector is described by its ``PREFIX`` nearest pivots in order and posted in an inverted list of each of them.
Vectors that share at least ``SHARED`` pivots are candidates; candidates with a cosine of at least
``threshold``, in double precision, are linked. Equal vectors are one class, posted once with
its number of copies.

A list is cut into blocks by hash and blocks meet in pairs, so no list is in one task as a whole. Within a pair of
blocks shared pivots and cosines are matrix products; a pair of vectors counts in the list
of its smallest shared pivot only. Pairs are not rows: a task returns the number of links per vector and as
many links as connect what it has found.

Measured recall is in the README. Defined results: vectors that take no part (see ``pivots``) have no
links and are their own component; rows that share a ``vec_id`` are one vector; rows without
``vec_id`` are returned unlinked; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import pivots
from larder.llm.components import connected
from larder.llm.shared import settled

PIVOTS, PREFIX, SHARED = 512, 8, 3
BLOCK = 1024
FOUND = "vec_id bigint, other bigint, links bigint"


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that connect what the links (a, b) of n vertices connect."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def pair_blocks(key: tuple, rows: pd.DataFrame, threshold: float, shared: int, n_pivots: int) -> pd.DataFrame:
    """Links within a block (``left`` = ``right``) or between two blocks of the list of pivot ``key[0]``."""
    pivot, left, right = key
    ids, copies = rows["vec_id"].to_numpy(), rows["copies"].to_numpy()
    vectors = pivots.units(pivots.matrix(rows["vector"].tolist()))
    orders = np.stack(rows["nearest"].tolist()).astype(np.int64)
    held = np.zeros((len(rows), n_pivots), np.float32)
    np.put_along_axis(held, orders, np.float32(1), axis=1)
    one = np.flatnonzero(rows["block"].to_numpy() == left)
    two = one if left == right else np.flatnonzero(rows["block"].to_numpy() == right)
    links, ends = np.zeros(len(rows), np.int64), [[], []]
    for at in range(0, len(one), 256):  # a strip of the block at a time
        some = one[at : at + 256]
        candidate = held[some] @ held[two].T >= shared
        a, b = np.nonzero(candidate & (vectors[some] @ vectors[two].T >= threshold))
        a, b = some[a], two[b]
        if left == right:
            a, b = a[ids[a] < ids[b]], b[ids[a] < ids[b]]
        first = np.argmax((held[a] * held[b]) > 0, axis=1) == pivot
        a, b = a[first], b[first]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        for x, y in spanning(a, b, len(rows)):
            ends[0].append(x)
            ends[1].append(y)
    linked = np.flatnonzero(links)
    tree = spanning(np.array(ends[0], int), np.array(ends[1], int), len(rows))
    counts = pd.DataFrame({"vec_id": ids[linked], "other": ids[linked], "links": links[linked]})
    edges = pd.DataFrame({"vec_id": [ids[x] for x, _ in tree], "other": [ids[y] for _, y in tree], "links": 0})
    return pd.concat([counts, edges]).astype("int64")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, n_pivots: int = PIVOTS, prefix: int = PREFIX, shared: int = SHARED
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    valid = pivots.valid_vectors(vectors).dropDuplicates(["vec_id"])
    chosen = pivots.choose(valid, n_pivots)
    n, nearest = len(chosen), min(prefix, len(chosen))
    index = settled(pivots.placed(valid, chosen, nearest), "described-vectors")
    classes = settled(
        index.groupBy("vector").agg(F.min("vec_id").alias("class"), F.count("*").alias("copies")), "vector-classes"
    )
    index = settled(
        index.join(classes, "vector").select("vec_id", "class", "copies", "vector", "nearest"), "indexed-vectors"
    )
    posted = index.filter("vec_id = class").select(
        "vec_id", "copies", "vector", "nearest", F.explode("nearest").alias("pivot")
    )
    # a row per pivot
    sizes = {r.pivot: -(-r["count"] // BLOCK) for r in posted.groupBy("pivot").count().collect()}
    blocks = F.element_at(F.lit([sizes.get(p, 1) for p in range(n)] or [1]), F.col("pivot") + 1)
    own = posted.select(
        "*", blocks.alias("blocks"), F.pmod(F.xxhash64("vec_id"), blocks.cast("bigint")).cast("int").alias("block")
    )
    met = own.select(
        "vec_id",
        "copies",
        "vector",
        "nearest",
        F.col("pivot").cast("int").alias("pivot"),
        "block",
        F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other"),
    ).select("*", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    at_least = min(shared, nearest)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pair_blocks(key, rows, threshold, at_least, n)

    found = settled(met.groupBy("pivot", "left", "right").applyInPandas(run, FOUND), "vector-links")
    counts = found.filter("vec_id = other").groupBy(F.col("vec_id").alias("class")).agg(F.sum("links").alias("links"))
    reached = connected(found.filter("vec_id <> other").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    members = index.select("vec_id", "class", "copies")
    linked = (
        members.join(counts, "class", "left")
        .join(reached.withColumnRenamed("node", "class"), "class", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("component_id"),
        )
    )
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    return rows.join(linked, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )
