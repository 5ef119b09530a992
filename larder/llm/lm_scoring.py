"""Language-model scores of texts: a hashed maximum-entropy model over words.

The probability of a word is that of its class times that of the word in its class (class-factored softmax). The
``CLASSES`` x ``WIDTH`` most frequent words stand in classes by rank; all other words fall into ``REST`` classes by
spelling. Both softmaxes have the add-one unigram distribution as their start and weights for
features of the history: the word before, the two words before, the word before that alone, and the one before
that (skips). Features are hashed into a fixed number of rows. In a rest class the words keep their unigram
shares, so the model is a distribution over every word seen in training and one unseen word, whatever the vocabulary's size.

Training makes ``ROUNDS`` distributed updates, each over another share of the training documents: tasks sum observed and expected
features under the weights so far, Spark adds the sums, and each weight moves by the
logarithm of their ratio over the number of features (iterative scaling). What a task returns has the fixed size
of the weights, and there are as many tasks as the cluster has cores, whatever the number of files.

Unigram counts cover all training documents and stay a table. The ``KNOWN`` most frequent words are sent to
the scoring tasks (a bounded table); all other words of a document meet their counts in a join. Tasks
score batches of words with sparse lookups in numpy.

Defined results: a null or empty text is the end token alone; rows without ``doc_id`` are scored, not learned from and not
held out; repeated rows count as often as they stand there; texts of any length are read in parts; with nothing to learn
from every word is the unseen word, with probability 1; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import by_bytes, settled, word_lists

CLASSES, WIDTH, REST = 16, 32, 16
ROWS = 1 << 14
ROUNDS, SMOOTHING = 4, 2.0
KNOWN = 1 << 17
FOLDS, HELD_OUT = 7, 2
#: Different words that a task counts before it starts anew, and words scored together.
REMEMBERED, TOGETHER = 1 << 18, 1 << 14
#: Rows of a softmax that are worked on at a time: they stay in a core's cache.
AT_ONCE = 1 << 11
#: Words whose features are added up in single precision, where whole numbers are exact up to 16 times as many.
SETTLED = 1 << 20
#: Longer words are known by their digest; no word holds a space, so these keys and the end are no words.
LONGEST = 64
END, START = b" ", b" start"
IMPOSSIBLE = -80.0
FEATURES = 4

LOWER = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))
SCORED = """row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double,
    word binary, times bigint, known_score double, unknown_score double"""
SUMS = "part int, block int, observed binary, expected binary"


def fold(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """Remainder of crc32 of the id in text form."""
    return F.crc32(F.col(doc_id).cast("bigint").cast("string").cast("binary")) % folds


def word_parts(raw: bytes | None) -> Iterator[list[bytes]]:
    """The keys of a text's words in parts of bounded size."""
    for words in word_lists((raw or b"").translate(LOWER)):
        if max(map(len, words), default=0) > LONGEST:
            words = [w if len(w) <= LONGEST else b" " + xxhash.xxh3_128_digest(w) for w in words]
        yield words


def id_and_bytes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def unigrams(docs: DataFrame) -> DataFrame:
    """(word, count) over all given documents, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []
        held: list[pa.Table] = []

        def count() -> None:
            values, counts = pa.array(words, pa.binary()).value_counts().flatten()
            held.append(pa.table([values, counts], ["word", "count"]))
            words.clear()

        def merged() -> pa.Table:
            sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("count", "sum")])
            return sums.rename_columns({"count_sum": "count"}).select(["word", "count"])

        for batch in batches:
            for some in by_bytes(batch):
                words.extend(repeat(END, some.num_rows))
                for raw in some["text"].to_pylist():
                    for part in word_parts(raw):
                        words += part
                        if len(words) >= REMEMBERED:
                            count()
                            if sum(t.num_rows for t in held) >= 2 * REMEMBERED:
                                held[:] = [merged()]
                                if held[0].num_rows >= REMEMBERED:
                                    yield from held.pop().to_batches()
        if words:
            count()
        if held:
            yield from merged().to_batches()

    rows = id_and_bytes(docs).mapInArrow(run, "word binary, count bigint")
    return settled(rows.groupBy("word").agg(F.sum("count").alias("count")), "unigrams")


def rest_class(word: bytes, rest: int) -> int:
    """Class of a word outside the frequent ones: by its last two bytes."""
    return zlib.crc32(word[-2:]) % rest


class Model:
    """Unigram distribution, classes and weights: of a size that its parameters fix."""

    def __init__(self, top: list[tuple[bytes, int]], total: int, distinct: int, rest_mass: np.ndarray, classes: int, width: int, rows: int):
        """``top``: the most frequent words with their counts, best first; ``rest_mass``: of the rest classes, counts plus one each."""
        self.total, self.classes, self.width, self.rest, self.rows = total, classes, width, len(rest_mass), rows
        self.norm = total + distinct + 1
        self.counts = dict(top)
        self.leaf = {word: at for at, (word, _) in enumerate(top[: classes * width])}
        leaves = np.zeros(classes * width)
        leaves[: len(self.leaf)] = [n + 1 for _, n in top[: classes * width]]
        leaves = leaves.reshape(classes, width)
        rest_mass = rest_mass.astype(float)
        rest_mass[0] += 1  # the unseen word
        with np.errstate(divide="ignore"):
            mass = np.log(np.concatenate((leaves.sum(axis=1), rest_mass)) / self.norm)
            self.class_start = np.maximum(mass, IMPOSSIBLE).astype(np.float32)
            inside = np.log(leaves / np.maximum(leaves.sum(axis=1, keepdims=True), 1))
        self.word_start = np.maximum(inside, IMPOSSIBLE).astype(np.float32)
        self.log_rest = np.log10(np.maximum(rest_mass, 1e-300) / self.norm)
        self.class_weights = np.zeros((rows, classes + self.rest), np.float32)
        self.word_weights = np.zeros((rows, width), np.float32)

    def log_base(self, count: int) -> float:
        return math.log10((count + 1) / self.norm)

    def moved(self, observed: list[np.ndarray], expected: list[np.ndarray], smoothing: float) -> None:
        """One update of all weights."""
        for weights, seen, meant in zip((self.class_weights, self.word_weights), observed, expected, strict=True):
            weights += (np.log((seen + smoothing) / (meant + smoothing)) / FEATURES).astype(np.float32)


class Described:
    """What a model says of words, whatever their history."""

    def __init__(self, model: Model, with_bases: bool = True):
        self.model = model
        self.leaves = pa.array(model.leaf.keys(), pa.binary())
        self.bases = {word: model.log_base(count) for word, count in model.counts.items()} if with_bases else {}

    def of(self, column: pa.Array, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, leaves, groups and bases of different words, given twice; no leaf is -1, no base is nan."""
        model = self.model
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
        leaves = pc.fill_null(pc.index_in(column, self.leaves), -1).to_numpy()
        tails = pc.binary_slice(column, -2).dictionary_encode()
        rest = np.array([rest_class(tail, model.rest) for tail in tails.dictionary.to_pylist()], np.int64)
        groups = np.where(leaves >= 0, leaves // model.width, model.classes + rest[tails.indices.to_numpy()])
        bases = np.full(len(words), math.nan)
        if self.bases:
            bases[:] = np.fromiter(map(self.bases.get, words, repeat(math.nan)), float, len(words))
        return hashes, leaves, groups, bases


def row_max(values: np.ndarray) -> np.ndarray:
    """Largest of each row: rows are short, and whole columns are compared faster."""
    return values.T.copy().max(axis=0)[:, None]


def softmax(logits: np.ndarray) -> None:
    """Changes the rows in place."""
    logits -= row_max(logits)
    np.exp(logits, out=logits)
    logits *= (1 / np.einsum("ij->i", logits))[:, None]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


class Batch:
    """Words in a row, with the features of their histories."""

    def __init__(self, model: Model, known: Described, pieces: list[tuple[list[bytes], list[bytes]]]):
        """``pieces``: the three words before a piece, and its words."""
        self.model = model
        words = list(chain.from_iterable(chain.from_iterable(pieces)))
        coded = pa.array(words, pa.binary()).dictionary_encode()
        numbers, self.words = coded.indices.to_numpy(), coded.dictionary
        first = np.empty(len(self.words), np.int64)
        first[numbers[::-1]] = np.arange(len(numbers))[::-1]
        different = list(map(words.__getitem__, first.tolist()))
        word_hashes, word_leaves, word_groups, word_bases = known.of(self.words, different)
        self.sizes = np.array([len(words) for _, words in pieces])
        real = np.ones(len(numbers), bool)
        starts = np.cumsum(self.sizes + 3) - self.sizes - 3
        for k in range(3):
            real[starts + k] = False
        at = np.flatnonzero(real)
        self.numbers = numbers[at]
        hashes = word_hashes[numbers]
        one, two, three = hashes[at - 1], hashes[at - 2], hashes[at - 3]
        self.features = [
            mixed(one),
            mixed(one * np.uint64(0xBF58476D1CE4E5B9) + two),
            mixed(two + np.uint64(0x94D049BB133111EB)),
            mixed(three + np.uint64(0xD6E8FEB86659FD93)),
        ]
        self.groups, self.bases = word_groups[self.numbers], word_bases[self.numbers]
        leaves = word_leaves[self.numbers]
        self.inner = np.flatnonzero(leaves >= 0)
        self.places = leaves[self.inner] % model.width
        mask = np.uint64(model.rows - 1)
        self.class_rows = [(f & mask).view(np.int64) for f in self.features]
        salt = self.groups[self.inner].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        self.word_rows = [(mixed(f[self.inner] + salt) & mask).view(np.int64) for f in self.features]

    def class_shares(self) -> np.ndarray:
        starts = np.broadcast_to(self.model.class_start, (len(self.numbers), len(self.model.class_start)))
        return self._shares(starts, self.model.class_weights, self.class_rows)

    def word_shares(self) -> np.ndarray:
        return self._shares(self.model.word_start[self.groups[self.inner]], self.model.word_weights, self.word_rows)

    @staticmethod
    def _shares(starts: np.ndarray, weights: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
        shares = np.empty(starts.shape, np.float32)
        taken = np.empty((AT_ONCE, starts.shape[1]), np.float32)
        for at in range(0, len(shares), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            logits = shares[some]
            logits[:] = starts[some]
            for rows in features:
                logits += weights.take(rows[some], axis=0, mode="clip", out=taken[: len(logits)])
            softmax(logits)
        return shares


class Sums:
    """Sums of features: added up in single precision for a bounded number of words, then in double precision."""

    def __init__(self, shape: tuple[int, int]):
        self.width = shape[1]
        self.part, self.whole = np.zeros(shape[0] * shape[1], np.float32), np.zeros(shape)
        # two neighbours are added as the halves of one complex number
        self.unit = np.complex64 if self.width % 2 == 0 else np.float32
        self.columns = np.arange(self.width // 2 if self.width % 2 == 0 else self.width)

    def add_ones(self, rows: np.ndarray, places: np.ndarray) -> None:
        np.add.at(self.part, rows * self.width + places, np.float32(1))

    def add_rows(self, rows: np.ndarray, values: np.ndarray) -> None:
        # a view of the built-in type: numpy's fast path does not know the equal type of an array that came by pickle
        at = (rows * len(self.columns))[:, None] + self.columns
        np.add.at(self.part.view(self.unit), at.ravel(), values.ravel().view(self.unit))

    def settle(self) -> None:
        self.whole += self.part.reshape(self.whole.shape)
        self.part[:] = 0


def pieces_of(docs: Iterator[tuple[int, bytes | None]]) -> Iterator[tuple[int, list[bytes], list[bytes], bool]]:
    """(document, the three words before, words, last) of each document in parts."""
    for number, raw in docs:
        before = [START] * 3
        for words in word_parts(raw):
            for at in range(0, len(words), TOGETHER):
                part = words[at : at + TOGETHER]
                yield number, before, part, False
                before = (before + part)[-3:]
        yield number, before, [END], True


def grouped(pieces: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Pieces in lists of about ``TOGETHER`` words; the end joins the piece before it."""
    held, size = [], 0
    for number, before, words, last in pieces:
        if last and held and held[-1][0] == number:
            held[-1] = (number, held[-1][1], [*held[-1][2], *words])
        else:
            held.append((number, before, words))
        size += len(words)
        if size >= TOGETHER and last:
            yield held
            held, size = [], 0
        elif size >= 2 * TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


BLOCK_ROWS = 1024


def feature_sums(docs: DataFrame, model: Model) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Observed and expected features of the given documents under the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Described(model, with_bases=False)
        tables = [Sums(w.shape) for w in (model.class_weights, model.word_weights) for _ in range(2)]
        texts = ((0, raw) for batch in batches for some in by_bytes(batch, limit=1 << 20) for raw in some["text"].to_pylist())
        unsettled, any_text = 0, False
        for held in grouped(pieces_of(texts)):
            any_text = True
            batch = Batch(model, known, [(before, words) for _, before, words in held])
            shares, inner = batch.class_shares(), batch.word_shares()
            for rows in batch.class_rows:
                tables[0].add_ones(rows, batch.groups)
                tables[1].add_rows(rows, shares)
            for rows in batch.word_rows:
                tables[2].add_ones(rows, batch.places)
                tables[3].add_rows(rows, inner)
            unsettled += len(batch.numbers)
            if unsettled >= SETTLED:
                unsettled = 0
                for table in tables:
                    table.settle()
        if any_text:
            for table in tables:
                table.settle()
            for part in range(2):
                seen, meant = (table.whole for table in tables[2 * part : 2 * part + 2])
                for block in range(-(-len(seen) // BLOCK_ROWS)):
                    some = slice(block * BLOCK_ROWS, (block + 1) * BLOCK_ROWS)
                    values = [[part], [block], [seen[some].tobytes()], [meant[some].tobytes()]]
                    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(values, types, strict=True)], ["part", "block", "observed", "expected"]
                    )

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [0.0, 0.0]
        for frame in parts:
            for i, column in enumerate(("observed", "expected")):
                for table in frame[column]:
                    sums[i] = sums[i] + np.frombuffer(table, float)
        yield pd.DataFrame({"part": [key[0]], "block": [key[1]], "observed": [sums[0].tobytes()], "expected": [sums[1].tobytes()]})

    tasks = max(2, docs.sparkSession.sparkContext.defaultParallelism)
    summed = id_and_bytes(docs).coalesce(tasks).mapInArrow(run, SUMS).groupBy("part", "block").applyInPandas(add, SUMS)
    shapes = [model.class_weights.shape, model.word_weights.shape]
    seen, meant = ([np.zeros(shape) for shape in shapes] for _ in range(2))
    for row in summed.collect():  # the size of the weights
        some = slice(row.block * BLOCK_ROWS, (row.block + 1) * BLOCK_ROWS)
        for out, raw in ((seen, row.observed), (meant, row.expected)):
            out[row.part][some] = np.frombuffer(bytes(raw), float).reshape(-1, shapes[row.part][1])
    return seen, meant


def fit(
    docs: DataFrame,
    counts: DataFrame,
    classes: int = CLASSES,
    width: int = WIDTH,
    rest: int = REST,
    rows: int = ROWS,
    rounds: int = ROUNDS,
    known: int = KNOWN,
    smoothing: float = SMOOTHING,
) -> Model:
    """A model of the given documents; ``counts`` are their unigrams. ``rows`` is a power of two."""
    if rows & (rows - 1):
        raise ValueError(f"rows: {rows} is no power of two")
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    best = counts.orderBy(F.desc("count"), "word").limit(max(known, classes * width)).toArrow()
    order = np.argsort(-best["count"].to_numpy(), kind="stable")
    words, times = best["word"].to_pylist(), best["count"].to_pylist()
    top = [(bytes(words[i]), times[i]) for i in order]
    spelled = F.crc32(F.expr("substring(word, greatest(length(word) - 1, 1), 2)")) % rest
    mass = np.zeros(rest, np.int64)
    for row in counts.groupBy(spelled.alias("spelled")).agg(F.sum(F.col("count") + 1).alias("mass")).collect():  # a row per class
        mass[row.spelled] = row.mass
    for word, count in top[: classes * width]:
        mass[rest_class(word, rest)] -= count + 1
    model = Model(top, total, distinct, mass, classes, width, rows)
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for number in range(rounds if total else 0):
        model.moved(*feature_sums(docs.filter(share == number), model), smoothing)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """A row per document with what the model's own table says, and rows of words that must be looked up."""
    names = ["row", "doc_id", "n_tokens", "n_known", "base", "score", "word", "times", "known_score", "unknown_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes = Described(model), model.classes
        first = TaskContext.get().partitionId() << 40
        sums: dict[int, list] = {}
        ids: dict[int, int | None] = {}

        def rows_of() -> Iterator[tuple[int, bytes | None]]:
            number = first
            for batch in batches:
                for some in by_bytes(batch, limit=1 << 20):
                    for doc_id, raw in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                        ids[number], sums[number] = doc_id, [0, 0, 0.0, 0.0]
                        yield number, raw
                        number += 1

        def finished(before: int | None) -> pa.RecordBatch:
            done = [n for n in sums if before is None or n < before]
            values = [sums.pop(n) for n in done]
            columns = [pa.array(done, pa.int64()), pa.array([ids.pop(n) for n in done], pa.int64())]
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            columns += [pa.array([v[i] for v in values], t) for i, t in enumerate(types)]
            columns += [pa.nulls(len(done), t) for t in (pa.binary(), pa.int64(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays(columns, names)

        for held in grouped(pieces_of(rows_of())):
            batch = Batch(model, known, [(before, words) for _, before, words in held])
            shares, inner = batch.class_shares(), batch.word_shares()
            tiny = np.float32(1e-37)
            own = np.log10(np.maximum(shares[np.arange(len(batch.groups)), batch.groups], tiny)).astype(float)
            unseen = np.log10(np.maximum(shares[:, classes], tiny)).astype(float)
            own[batch.inner] += np.log10(np.maximum(inner[np.arange(len(batch.places)), batch.places], tiny))
            base = batch.bases
            found = ~np.isnan(base)
            # a known word of a rest class: its unigram share of the class
            outer = found & (batch.groups >= classes)
            own[outer] += base[outer] - model.log_rest[batch.groups[outer] - classes]
            whose = np.repeat(np.arange(len(held)), batch.sizes)
            n_known = np.bincount(whose, found, len(held)).astype(int)
            base_sum = np.bincount(whose, np.where(found, base, 0), len(held))
            score_sum = np.bincount(whose, np.where(found, own, 0), len(held))
            for at, (number, _, words) in enumerate(held):
                total = sums[number]
                total[0] += len(words)
                total[1] += int(n_known[at])
                total[2] += float(base_sum[at])
                total[3] += float(score_sum[at])
            rare = np.flatnonzero(~found)
            if len(rare):
                pairs, place = np.unique(whose[rare] << 32 | batch.numbers[rare], return_inverse=True)
                times = np.bincount(place)
                columns = [
                    pa.array(np.array([held[d][0] for d in pairs >> 32], np.int64)),
                    *[pa.nulls(len(pairs), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())],
                    batch.words.take(pa.array(pairs & 0xFFFFFFFF)),
                    pa.array(times.astype(np.int64)),
                    pa.array(np.bincount(place, own[rare])),
                    pa.array(np.bincount(place, unseen[rare])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
            yield finished(held[-1][0])
        yield finished(None)

    return settled(id_and_bytes(docs).mapInArrow(run, SCORED), "lm-scores")


def score_documents(docs: DataFrame, held_out: int = HELD_OUT, folds: int = FOLDS, **parameters) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    training = docs.filter(fold(folds=folds) != held_out)
    counts = unigrams(training)
    model = fit(training, counts, **parameters)
    rows = scored(docs, model)
    rest = F.element_at(
        F.lit(model.log_rest.tolist()),
        (F.crc32(F.expr("substring(word, greatest(length(word) - 1, 1), 2)")) % model.rest + 1).cast("int"),
    )
    norm, seen = float(model.norm), F.col("count").isNotNull()
    base = F.log10((F.coalesce("count", F.lit(0)) + 1) / F.lit(norm))
    looked_up = (
        rows.filter("word is not null")
        .select("row", "word", "times", "known_score", "unknown_score")
        .join(counts, "word", "left")
        .select(
            "row",
            F.when(seen, F.col("times")).otherwise(0).alias("more_known"),
            (F.col("times") * base).alias("more_base"),
            F.when(seen, F.col("known_score") + F.col("times") * (base - rest))
            .otherwise(F.col("unknown_score") + F.col("times") * (base - F.lit(float(model.log_rest[0]))))
            .alias("more_score"),
        )
        .groupBy("row")
        .agg(*(F.sum(c).alias(c) for c in ("more_known", "more_base", "more_score")))
    )
    zero = F.lit(0.0)
    return (
        rows.filter("word is null")
        .join(looked_up, "row", "left")
        .select(
            "doc_id",
            F.coalesce(fold(folds=folds) == held_out, F.lit(False)).alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("bigint").alias("n_known"),
            F.lit(model.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
        )
    )
