"""Approximate nearest neighbours with a permutation index.

Every vector is represented by the order of its nearest pivots. The vectors whose first ``PREFIX`` pivots are the same, in
the same order, are a group; the groups of one first pivot are its file. A query ranks the groups by
Spearman's footrule between its own order, of all pivots, and the group's, over the group's pivots. Of the groups
nearest by footrule it takes as many as hold ``OPENED`` times the square root of the number of vectors, together with all that are as far
as the last of them: the whole table up to ``OPENED ** 2`` vectors. All vectors of these groups are ranked again by the inner product
of the original vectors, in double precision; nothing of a group that was taken is left out. Pivots grow with the square
root of the table, up to ``PIVOTS``.

Equal vectors are placed once, with their ``k + 1`` smallest ``vec_id``s, and told apart after ranking: a large
group of copies takes one place, and a query finds its own copies however many there are. Equal is what has one 128-bit digest.

Files stand one after the other on shelves of bounded size, a task each; a file larger than what is left of a shelf is dealt by
digest among the next ones. A task holds the vectors of its shelf and reads the queries in batches, so neither a pivot near to a
large part of all vectors nor many queries are held at once; beyond ``QUERY_BLOCK`` queries a shelf is read by
several tasks. In a task products are taken in single precision, group by group; what could be among the ``k`` best within the
error of that precision is computed again in double. The final choice is made over the ``k`` best of each shelf.

Measured recall of the 20 nearest is in the README. Defined results: vectors that take no
part (see ``pivots``) are neither queries nor answers; rows that share a ``vec_id`` are one vector, if these
differ the one with the smallest digest; ties go to the smaller ``vec_id``; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import pivots
from larder.llm.shared import list_array, release, settled

PIVOTS, PREFIX, OPENED = 256, 2, 360
#: Vectors for each group, on average, where pivots are not at their most.
IN_GROUP = 64
#: Vectors from which a shelf is divided while cores are idle; bytes of vectors on a shelf; queries that one task reads.
BLOCK, SHELF, QUERY_BLOCK = 4096, 3 << 26, 1 << 20
#: Queries ranked at a time; products at a time; vectors that give the first bound; candidates held for each query.
AT_ONCE, TILE, TRIED, HELD = 4096, 1 << 18, 1024, 128
#: Parts in which the copies of one vector are cut to their smallest ids before these meet; any number gives the same ids.
PARTS = 64
#: Digests that a task remembers, so as not to write a vector again.
REMEMBERED = 1 << 17

INDEX = "vec_id bigint, hi bigint, lo bigint, file int, next int, is_query boolean, vector binary"
ASKED = "task int, vec_id bigint, cut int, vector binary"
FOUND = "query_id bigint, ids array<bigint>, scores array<double>"


def orders(vectors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The pivots from the nearest on, for each vector (ties to the smaller number)."""
    return np.argsort(-(pivots.units(vectors) @ chosen.T), axis=1, kind="stable")


def places(order: np.ndarray) -> np.ndarray:
    """The place of each pivot in each order."""
    at = np.empty(order.shape, np.int16)
    np.put_along_axis(at, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return at


def footrule(at: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Distances of orders (rows; ``at`` has the place of each pivot) to groups (columns; a row of ``groups`` has its pivots)."""
    distance = at[:, groups[:, 0]].copy()
    for place in range(1, groups.shape[1]):
        distance += np.abs(at[:, groups[:, place]] - np.int16(place))
    return distance


def cuts(at: np.ndarray, groups: np.ndarray, sizes: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """For each order the footrule up to which groups hold ``wanted`` vectors, or the largest there is.

    Also for each order the files, ascending, that have a group so near; ``groups`` are sorted by file.
    """
    width, wanted = groups.shape[1] * at.shape[1] + 1, min(wanted, sizes.sum())
    files = np.flatnonzero(np.diff(groups[:, 0], prepend=-1))
    some = max(1, (1 << 18) // len(groups))
    weights, rows = np.tile(sizes.astype(float), some), np.arange(some)[:, None] * width
    cut, taken = np.empty(len(at), np.int32), np.empty((len(at), len(files)), bool)
    for lo in range(0, len(at), some):
        distance = footrule(at[lo : lo + some], groups)
        n = len(distance)
        held = np.bincount((distance + rows[:n]).ravel(), weights[: n * len(groups)], n * width)
        cut[lo : lo + n] = (held.reshape(n, width).cumsum(axis=1) < wanted).sum(axis=1)
        taken[lo : lo + n] = np.minimum.reduceat(distance, files, axis=1) <= cut[lo : lo + n, None]
    return cut, taken


def packed(flat: np.ndarray) -> list[bytes]:
    """Vectors as bytes: of single precision where that holds them exactly, else of doubles."""
    with np.errstate(over="ignore"):
        small = flat.astype(np.float32)
    exact = (small == flat).all(axis=1)
    return [(s if e else v).tobytes() for s, v, e in zip(small, flat, exact, strict=True)]


def unpacked(column: pa.Array, dimension: int) -> np.ndarray:
    """A matrix of single precision if all rows are, else of doubles."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    kinds = [np.frombuffer(b"".join(column.filter(pa.array(sizes == b * dimension)).to_pylist()), t) for b, t in ((4, np.float32), (8, float))]
    if len(kinds[0]) == len(sizes) * dimension:
        return kinds[0].reshape(-1, dimension)
    out = np.empty((len(sizes), dimension))
    out[sizes == 4 * dimension] = kinds[0].reshape(-1, dimension)
    out[sizes == 8 * dimension] = kinds[1].reshape(-1, dimension)
    return out


def described(rows: DataFrame, chosen: np.ndarray) -> DataFrame:
    """Digest, first two pivots and vector of each row; a task writes an equal vector once, but that of every query."""
    dimension = chosen.shape[1] if len(chosen) else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            digest = b"".join(hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in flat)
            digest = np.frombuffer(digest, np.int64).reshape(-1, 2)
            near = pivots.units(flat) @ chosen.T
            each = np.arange(len(flat))
            first = near.argmax(axis=1)
            near[each, first] = -np.inf
            second = near.argmax(axis=1) if len(chosen) > 1 else first
            vector = packed(flat)
            keys = zip(digest[:, 0].tolist(), digest[:, 1].tolist(), first.tolist(), second.tolist(), strict=True)
            for i, (key, is_query) in enumerate(zip(keys, batch["is_query"].to_pylist(), strict=True)):
                if key not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                elif not is_query:
                    vector[i] = None
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    pa.array(first.astype(np.int32)),
                    pa.array(second.astype(np.int32)),
                    batch["is_query"],
                    pa.array(vector, pa.binary()),
                ],
                ["vec_id", "hi", "lo", "file", "next", "is_query", "vector"],
            )

    return rows.filter(F.size("embedding") == dimension).mapInArrow(run, INDEX)


def folded(index: DataFrame, k: int) -> DataFrame:
    """A row for each distinct vector; ``ids`` has its ``k + 1`` smallest ``vec_id``s, ascending."""
    key = ["hi", "lo", "file", "next"]
    in_part = Window.partitionBy(*key, "part").orderBy("vec_id")
    return (
        index.groupBy("vec_id")
        .agg(F.min(F.struct(*key)).alias("of"))
        .select("vec_id", "of.*", F.pmod(F.xxhash64("vec_id"), F.lit(PARTS)).alias("part"))
        .withColumn("nth", F.row_number().over(in_part))
        .filter(F.col("nth") <= k + 1)
        .groupBy(*key, "part")
        .agg(F.collect_list("vec_id").alias("ids"))
        .groupBy(*key)
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
    )


class Shelf:
    """The vectors of a task, in groups, and the copies of each."""

    def __init__(self, dimension: int, expected: int):
        self.dimension, self.n = dimension, 0
        self.vectors = np.empty((expected, dimension), np.float32)
        self.groups, self.ids, self.copies = [], [], []
        self.last = None

    def add(self, batch: pa.RecordBatch) -> None:
        """Rows in the order of groups and digests: the ids of a vector, then the vector itself, once or more."""
        keys = np.column_stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("file", "next", "hi", "lo", "kind")])
        before = np.concatenate([[[-1] * 5] if self.last is None else self.last, keys[:-1]])
        self.last = keys[-1:]
        new = (keys[:, 4] == 1) & (before[:, 4] == 0) & (keys[:, :4] == before[:, :4]).all(axis=1)
        named = batch["ids"].filter(pa.array(keys[:, 4] == 0))
        self.ids.append(named.flatten().to_numpy(zero_copy_only=False))
        self.copies.append(pc.list_value_length(named).to_numpy(zero_copy_only=False))
        self.groups.append(keys[new, :2].astype(np.int16))
        found = unpacked(batch["vector"].filter(pa.array(new)), self.dimension)
        if self.n + len(found) > len(self.vectors) or found.dtype != self.vectors.dtype and found.dtype == float:
            rows = max(len(self.vectors), (self.n + len(found)) * 5 // 4)
            larger = np.empty((rows, self.dimension), np.promote_types(found.dtype, self.vectors.dtype))
            larger[: self.n] = self.vectors[: self.n]
            self.vectors = larger
        self.vectors[self.n : self.n + len(found)] = found
        self.n += len(found)

    def close(self) -> None:
        self.vectors = self.vectors[: self.n]
        self.ids, self.copies = np.concatenate(self.ids), np.concatenate(self.copies)
        if len(self.copies) != self.n:
            raise ValueError("vectors and their ids don't match")
        self.first = np.concatenate([[0], np.cumsum(self.copies)[:-1]]).astype(np.int64) if self.n else np.zeros(0, np.int64)
        each = np.concatenate(self.groups)
        edges = np.flatnonzero((each[1:] != each[:-1]).any(axis=1)) + 1
        self.edges = np.concatenate([[0], edges, [self.n]]) if self.n else np.zeros(1, int)
        self.groups = each[self.edges[:-1]].astype(np.int64)
        # products of numbers up to 1 can't overflow; of vectors as they mostly are no copy is made
        largest = max((float(np.abs(self.vectors[i : i + AT_ONCE]).max()) for i in range(0, self.n, AT_ONCE)), default=1.0)
        self.plain = self.vectors
        if self.vectors.dtype != np.float32 or not 1e-6 < largest < 1e6:
            self.plain = np.empty((self.n, self.dimension), np.float32)
            for i in range(0, self.n, AT_ONCE):
                self.plain[i : i + AT_ONCE] = self.vectors[i : i + AT_ONCE] / largest
        norms = [np.sqrt(np.square(self.plain[i : i + AT_ONCE], dtype=float).sum(axis=1).max()) for i in range(0, self.n, AT_ONCE)]
        self.longest = max(norms, default=1.0) or 1.0

    def best(self, ids: np.ndarray, vectors: np.ndarray, opened: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """Number of query, id and score of the ``k`` best of the groups that each query takes (``opened``: a row per group)."""
        m = len(ids)
        plain = pivots.units(vectors).astype(np.float32)
        # twice what rounding can make of a product; in units of that, products lie between -1 and 1
        margin = np.float32(4 * (self.dimension + 8) * 2.0**-24 * self.longest)
        bound = np.full(m, -np.inf, np.float32)
        query, at, score = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32)
        waiting: list[tuple[np.ndarray, ...]] = []
        n_waiting = 0

        tried = np.unique(np.linspace(0, self.n - 1, min(self.n, TRIED)).astype(int))
        if len(tried) > k:
            group = np.searchsorted(self.edges, tried, "right") - 1
            first = plain @ self.plain[tried].T
            first[~opened[group].T] = -np.inf
            bound = np.partition(first, len(tried) - k - 1, axis=1)[:, len(tried) - k - 1] - margin

        def trimmed(exactly: bool = False):
            """The candidates that may be among the k + 1 best so far; these must be k + 1, as the query may be one of them."""
            nonlocal bound
            q, a, s = (np.concatenate(x) for x in zip((query, at, score), *waiting, strict=True))
            value = s.astype(float)
            if exactly:
                value = self.products(q, a, vectors)
                order = np.lexsort((self.ids[self.first[a]], -value, q))
            else:
                order = np.argsort(q * (4.0 * self.longest) - value)
            q, a, s = q[order], a[order], s[order]
            starts = np.searchsorted(q, np.arange(m + 1))
            last = starts[:-1] + k
            full = last < starts[1:]
            if exactly:
                some = np.arange(len(q)) <= last[q]
            else:
                bound[full] = np.maximum(bound[full], s[last[full]] - margin)
                some = s >= bound[q]
            return q[some], a[some], s[some]

        flags = np.zeros(max(TILE, 64 * m) + 8, bool)

        def tile(some: np.ndarray, lo: int, hi: int) -> None:
            nonlocal n_waiting, query, at, score
            mine, limit = (plain, bound) if len(some) == m else (plain[some], bound[some])
            step = max(64, TILE // max(1, len(some)))
            for start in range(lo, hi, step):
                products = mine @ self.plain[start : min(hi, start + step)].T
                np.greater_equal(products, limit[:, None], out=flags[: products.size].reshape(products.shape))
                flags[products.size : products.size + 8] = False
                # few are set: eight at a time
                words = flags[: -(-products.size // 8) * 8].view(np.uint64).nonzero()[0]
                hits = (words[:, None] * 8 + np.arange(8)).ravel()
                hits = hits[flags[hits]]
                if len(hits):
                    row, column = np.divmod(hits, products.shape[1])
                    waiting.append((some[row].astype(np.int32), (column + start).astype(np.int32), products.ravel()[hits]))
                    n_waiting += len(hits)
                    if n_waiting > HELD * m:
                        query, at, score = trimmed()
                        waiting.clear()
                        if len(query) > HELD * m // 2:
                            query, at, score = trimmed(exactly=True)
                        n_waiting = len(query)
                        limit = bound if len(some) == m else bound[some]

        everyone = np.arange(m)
        if opened.all():
            tile(everyone, 0, self.n)
        else:
            for group in range(len(self.groups)):
                some = np.flatnonzero(opened[group])
                if len(some):
                    tile(some, self.edges[group], self.edges[group + 1])
        query, at, score = trimmed()
        waiting.clear()
        value = self.products(query, at, vectors)
        n = self.copies[at]
        before = np.cumsum(n) - n
        found = self.ids[np.repeat(self.first[at] - before, n) + np.arange(n.sum())]
        query, value = np.repeat(query, n), np.repeat(value, n)
        other = found != ids[query]
        query, found, value = query[other], found[other], value[other]
        order = np.lexsort((found, -value, query))
        query, found, value = query[order], found[order], value[order]
        nth = np.arange(len(query)) - np.searchsorted(query, np.arange(m))[query]
        return query[nth < k], found[nth < k], value[nth < k]

    def products(self, query: np.ndarray, at: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(len(query))
        for i in range(0, len(query), 1 << 14):
            some = slice(i, i + (1 << 14))
            out[some] = (self.vectors[at[some]].astype(float) * vectors[query[some]]).sum(axis=1)
        return out


def ranked(batches: Iterator[pa.RecordBatch], chosen: np.ndarray, k: int, expected: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of a shelf for each of its queries; the rows of a task begin with the vectors."""
    dimension, task, shelf, asked = chosen.shape[1], None, None, []

    def answers() -> Iterator[pa.RecordBatch]:
        if not asked or shelf is None or not shelf.n:
            return
        ids = np.concatenate([b["vec_id"].to_numpy() for b in asked])
        vectors = np.concatenate([unpacked(b["vector"], dimension).astype(float) for b in asked])
        cut = np.concatenate([b["cut"].to_numpy() for b in asked])
        opened = footrule(places(orders(vectors, chosen)), shelf.groups) <= cut[:, None]
        query, found, score = shelf.best(ids, vectors, np.ascontiguousarray(opened.T), k)
        edges = np.searchsorted(query, np.arange(len(ids) + 1))[1:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), list_array(np.split(found, edges)), list_array(np.split(score, edges))],
            ["query_id", "ids", "scores"],
        )

    for some in batches:
        kinds, tasks = some["kind"].to_numpy(), some["task"].to_numpy()
        changes = np.flatnonzero((np.diff(kinds == 2) != 0) | (np.diff(tasks) != 0)) + 1
        for lo, hi in zip([0, *changes.tolist()], [*changes.tolist(), some.num_rows], strict=True):
            if lo == hi:
                continue
            batch = some.slice(lo, hi - lo)
            if tasks[lo] != task:
                yield from answers()
                task, shelf, asked = tasks[lo], None, []
            if kinds[lo] != 2:
                shelf = shelf or Shelf(dimension, expected)
                shelf.add(batch)
                continue
            if not asked and shelf is not None:
                shelf.close()
            asked.append(batch)
            if sum(b.num_rows for b in asked) >= AT_ONCE:
                yield from answers()
                asked = [batch.slice(0, 0)]
    yield from answers()
    shelf = None
    release()


def search(vectors: DataFrame, queries: str, k: int = 20, n_pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` nearest found for every vector that fulfils the condition ``queries``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    valid = pivots.valid_vectors(vectors)
    known = settled(valid.select("vec_id").distinct(), "vector-ids")
    total = known.count()
    n_chosen = max(1, min(n_pivots, total // 40, math.isqrt(total // IN_GROUP)))
    sample = known.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * n_chosen)
    last = sample.agg(F.max(F.xxhash64("vec_id"))).first()[0]
    sampled = pivots.valid_vectors(vectors.filter(F.xxhash64(F.col("vec_id").cast("bigint")) <= F.lit(last)))
    chosen = pivots.choose(sampled.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), n_chosen)
    n, dimension = len(chosen), chosen.shape[1]
    is_query = F.coalesce(F.expr(queries), F.lit(False)).alias("is_query")
    index = settled(described(valid.select("vec_id", "embedding", is_query), chosen), "permutations")
    distinct = settled(folded(index, k), "distinct-vectors")

    # a row per group of the index
    counted = sorted((r.file, r.next, r["count"]) for r in distinct.groupBy("file", "next").count().collect())
    groups = np.array([c[:2] for c in counted], np.int64).reshape(-1, 2)[:, : min(PREFIX, max(n, 1))]
    sizes = np.array([c[2] for c in counted], np.int64)
    in_file = np.bincount(groups[:, 0], sizes, n).astype(np.int64) if n else np.zeros(0, np.int64)
    start, n_vectors = np.cumsum(in_file) - in_file, max(1, int(sizes.sum()))
    cores = spark.sparkContext.defaultParallelism
    shelves = max(-(-n_vectors * dimension * 4 // SHELF), min(2 * cores, -(-n_vectors // BLOCK)), 1)
    parts = max(1, -(-index.filter("is_query").count() // QUERY_BLOCK))
    wanted = OPENED * math.isqrt(n_vectors) if n_vectors > OPENED * math.isqrt(n_vectors) else n_vectors

    def of_file(values: np.ndarray):
        return F.element_at(F.lit([int(v) for v in values] or [1]), F.col("file") + 1).cast("bigint")

    place = of_file(start) + F.pmod(F.col("lo"), of_file(np.maximum(in_file, 1)))

    def standing(rows: DataFrame, kind: int) -> DataFrame:
        """Rows of vectors for each task that reads their shelf."""
        each = rows.select("*", place.alias("place"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        return each.select(
            F.expr(f"cast(part * {shelves} + place * {shelves} div {n_vectors} as int)").alias("task"),
            *("file", "next", "hi", "lo"),
            F.lit(kind).alias("kind"),
            *(F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (("ids", "array<bigint>"), ("vector", "binary"))),
        )

    met = np.zeros((n, shelves), bool)
    for file in np.flatnonzero(in_file):
        met[file, start[file] * shelves // n_vectors : (start[file] + in_file[file] - 1) * shelves // n_vectors + 1] = True

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = places(orders(unpacked(batch["vector"], dimension).astype(float), chosen))
            if wanted >= n_vectors:
                cut = np.full(len(at), np.iinfo(np.int32).max, np.int32)
                row, task = np.nonzero(np.broadcast_to(met.any(axis=0), (len(at), shelves)))
            else:
                cut, taken = cuts(at, groups, sizes, wanted)
                row, task = np.nonzero(taken.astype(np.float32) @ met[np.unique(groups[:, 0])].astype(np.float32) > 0)
            part = batch["part"].to_numpy()[row]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((part * shelves + task).astype(np.int32)),
                    batch["vec_id"].take(rows),
                    pa.array(cut[row]),
                    batch["vector"].take(rows),
                ],
                ["task", "vec_id", "cut", "vector"],
            )

    asked = (
        index.filter("is_query")
        .groupBy("vec_id")
        .agg(F.min(F.struct("hi", "lo", "vector")).alias("of"))
        .select("vec_id", "of.vector", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"))
        .mapInArrow(asking, ASKED)
    )
    rows = (
        standing(distinct, 0)
        .unionByName(standing(index.filter("vector is not null"), 1))
        .unionByName(asked.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    )
    expected = n_vectors // shelves * 21 // 20 + 1
    best = (
        rows.repartitionById(shelves * parts, F.col("task"))
        .sortWithinPartitions("task", F.col("kind") == 2, "file", "next", "hi", "lo", "kind")
        .mapInArrow(lambda batches: ranked(batches, chosen, k, expected), FOUND)
    )
    in_order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("found"))
        .select("query_id", F.col("found.ids").alias("vec_id"), F.col("found.scores").alias("score"))
        .withColumn("rank", F.row_number().over(in_order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
