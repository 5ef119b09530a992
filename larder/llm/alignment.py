"""Alignment of the tokens of two tokenizers over the same bytes, as Arrow columns.

Texts are encoded in parts of bounded size. From then on a part is a few flat columns: the ids of
all documents flattened with their parent indices, byte lengths looked up per id, and ends as cumulative sums
restarted at every document. A document and an end in it make one key; an Acero full outer hash join
of both tokenizers' ends on that key, in key order, is the common refinement of both
segmentations: filled backwards, every row is one link (a token of A and a token of B that share bytes), and the rows
that both sides have are the ends of groups. Links are counted with ``Table.group_by`` within a part and over the
parts of a task; Spark adds the partial counts.

The second pass looks every document's distinct links up in the counts: the ``KNOWN`` most frequent pairs, with
their counts, are sent along (a bounded table), all other pairs meet their counts in a join. A pair that
is not among the most frequent is by that no hot key.

Defined results: null and empty texts have no tokens, nor have texts that the tokens of A or B do not give back
byte for byte behind one space (U+2581 in a text, which B reads as a space, is such a case); repeated rows and rows
without ``doc_id`` are aligned once each; strings of special tokens are ordinary text; a very long text
makes a part of its own; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import by_bytes, settled

#: Most frequent pairs whose counts are sent to every task: 17 bytes each.
KNOWN = 1 << 19
#: Bytes of text aligned at a time, and rows of partial counts that a task holds.
PART_BYTES, PARTIAL_ROWS = 1 << 20, 1 << 19

ALIGNED = """row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,
    a_ids array<int>, b_ids array<int>, times array<int>"""
#: Texts of these characters alone are cut alike by every version of the character classes.
PLAIN = re.compile(r"[\x00-ɏ‐-‧]*")
#: A run that the fast encoder's pattern or merges could take very long for.
LONG_RUN = re.compile(r"\s{200}|[^\W\d_]{2000}|\d{2000}|[^\w\s]{2000}")


class ByteLevel:
    """Tokenizer A: byte-level BPE, with its tokens' bytes."""

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        # the byte-level alphabet: printable characters stand for themselves, the others for code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t.content for t in self.exact.get_added_tokens_decoder().values()}
        vocabulary = self.exact.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.tokens[number] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        self.fast = None
        if ranks_path and pattern:
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            if all(self.tokens[rank] == token for token, rank in ranks.items()):  # the same vocabulary as ranks
                self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and PLAIN.fullmatch(text) and not LONG_RUN.search(text):
            return np.array(self.fast.encode_ordinary(text), np.int32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int32)


class Pieces:
    """Tokenizer B: SentencePiece, with its pieces' bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        ]

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int32)


class Flat:
    """The tokens of the documents of a part as flat columns."""

    def __init__(self, ids: list[np.ndarray], tokens: pa.Array):
        sizes = np.array([len(i) for i in ids], np.int64)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)),
            pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)),
        )
        self.sizes, self.ids = sizes, pc.list_flatten(lists)
        self.parent = pc.cast(pc.list_parent_indices(lists), pa.int64())
        lengths = pc.cast(pc.binary_length(tokens.take(self.ids)), pa.int64())
        # segmented: what all documents before have is taken off
        total = pc.cumulative_sum(lengths)
        before = np.concatenate(([0], total.to_numpy(zero_copy_only=False)))[np.concatenate(([0], np.cumsum(sizes)[:-1]))]
        self.ends = pc.subtract(total, pa.array(before.astype(np.int64)).take(self.parent)) if len(sizes) else total
        self.keys = pc.add(pc.shift_left(self.parent, pa.scalar(32, pa.int64())), self.ends)


def spelled(tokens: pa.Array, ids: np.ndarray) -> bytes:
    """The bytes of the tokens in a row: the data of the column that looks them up."""
    _, offsets, data = tokens.take(pa.array(ids)).buffers()
    return data.to_pybytes()[: np.frombuffer(offsets, np.int32)[len(ids)]] if len(ids) else b""


class Aligner:
    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.a_tokens, self.b_tokens = pa.array(a.tokens, pa.binary()), pa.array(b.tokens, pa.binary())
        self.a_names, self.b_names = (pa.array([str(i) for i in range(len(t.tokens))]) for t in (a, b))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B; none if one of them does not give the text back."""
        nothing = np.zeros(0, np.int32)
        if not text:
            return nothing, nothing
        a, b, raw = self.a(" " + text), self.b(text), (" " + text).encode()
        same = spelled(self.a_tokens, a) == raw and spelled(self.b_tokens, b) == raw
        return (a, b) if same else (nothing, nothing)

    def part(self, texts: list[str | None]) -> tuple[dict[str, pa.Array], pa.Table]:
        """Columns of the documents, and the links' partial counts (a, b, count)."""
        encoded = [self.encode(text) for text in texts]
        a, b = (Flat(list(ids), t) for ids, t in zip(zip(*encoded, strict=True), (self.a_tokens, self.b_tokens), strict=True))
        links = (
            pa.table({"key": a.keys, "a": a.ids})
            .join(pa.table({"key": b.keys, "b": b.ids}), "key", join_type="full outer", use_threads=False)
            .sort_by("key")
            .combine_chunks()
        )
        n, documents = len(links), len(texts)
        column = (lambda name: links[name].chunk(0)) if n else (lambda name: pa.array([], links.schema.field(name).type))
        ends_a, ends_b = pc.is_valid(column("a")), pc.is_valid(column("b"))
        doc = pc.shift_right(column("key"), pa.scalar(32, pa.int64()))
        one, two = pc.fill_null_backward(column("a")), pc.fill_null_backward(column("b"))

        # groups end where both tokenizers have an end
        both = pc.and_(ends_a, ends_b)
        groups = []
        for flat, names, ends in ((a, self.a_names, ends_a), (b, self.b_names, ends_b)):
            reached = pc.filter(pc.cumulative_sum(pc.cast(ends, pa.int32())), both)
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), reached])
            groups.append(pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(flat.ids)), ","))
        written = pc.binary_join_element_wise(*groups, "|")
        n_groups = np.bincount(pc.filter(doc, both).to_numpy(), minlength=documents)
        offsets = pa.array(np.concatenate(([0], np.cumsum(n_groups))).astype(np.int32))
        texts_of = pc.binary_join(pa.ListArray.from_arrays(offsets, written), ";")
        digests = [hashlib.sha256(t.as_buffer()).hexdigest() if m else "" for t, m in zip(texts_of, n_groups, strict=True)]

        # links of each document, equal ones once with their number
        width = len(self.a.tokens)
        pair = pc.add(pc.multiply(pc.cast(two, pa.int64()), width), pc.cast(one, pa.int64())).to_numpy(zero_copy_only=False).copy()
        whose = doc.to_numpy(zero_copy_only=False)
        n_links = np.bincount(whose, minlength=documents)
        edges = np.cumsum(n_links)
        for lo, hi in zip(edges - n_links, edges, strict=True):
            pair[lo:hi] = np.sort(pair[lo:hi])
        first = np.ones(n, bool)
        first[1:] = (pair[1:] != pair[:-1]) | (whose[1:] != whose[:-1])
        starts = np.flatnonzero(first)
        distinct = np.concatenate(([0], np.cumsum(np.bincount(whose[starts], minlength=documents)))).astype(np.int32)
        times = np.diff(np.append(starts, n)).astype(np.int32)
        kept = pair[starts]
        per_document = {
            "n_a": pa.array(a.sizes),
            "n_b": pa.array(b.sizes),
            "n_groups": pa.array(n_groups),
            "n_links": pa.array(n_links),
            "groups_sha256": pa.array(digests, pa.string()),
        } | {
            name: pa.ListArray.from_arrays(pa.array(distinct), pa.array(values.astype(np.int32)))
            for name, values in (("a_ids", kept % width), ("b_ids", kept // width), ("times", times))
        }
        return per_document, added([pa.table({"pair": kept, "count": times.astype(np.int64)})])


def added(tables: list[pa.Table]) -> pa.Table:
    """Counts of equal pairs added up."""
    summed = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("count", "sum")])
    return summed.select(["pair", "count_sum"]).rename_columns(["pair", "count"])


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str, ranks_path: str | None, pattern: str | None) -> Aligner:
    return Aligner(ByteLevel(a_path, ranks_path, pattern), Pieces(b_path))


def aligned(docs: DataFrame, a_path: str, b_path: str, ranks_path: str | None, pattern: str | None) -> DataFrame:
    """One row per document; rows without ``row`` hold a task's partial counts of pairs (a_ids, b_ids, times)."""
    names = "row doc_id n_a n_b n_groups n_links groups_sha256 a_ids b_ids times".split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path, ranks_path, pattern)
        width = len(align.a.tokens)
        row = TaskContext.get().partitionId() << 40
        partial: list[pa.Table] = []

        def counts() -> pa.RecordBatch:
            table = partial[0]
            pair, times = table["pair"].to_numpy(), table["count"].to_numpy()
            partial.clear()
            # counts of a task beyond 32 bits are no case: a task holds fewer tokens
            lists = [
                pa.ListArray.from_arrays(pa.array([0, len(pair)], pa.int32()), pa.array(v.astype(np.int32)))
                for v in (pair % width, pair // width, times)
            ]
            empty = [pa.nulls(1, pa.int64())] * 6 + [pa.nulls(1, pa.string())]
            return pa.RecordBatch.from_arrays([*empty, *lists], names)

        for batch in batches:
            for some in by_bytes(batch, limit=PART_BYTES):
                columns, counted = align.part(some["text"].to_pylist())
                rows = pa.array(np.arange(row, row + some.num_rows))
                row += some.num_rows
                yield pa.RecordBatch.from_arrays([rows, some["doc_id"], *(columns[c] for c in names[2:])], names)
                partial = [added([*partial, counted])]
                if partial[0].num_rows >= PARTIAL_ROWS:
                    yield counts()
        if partial and partial[0].num_rows:
            yield counts()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settled(rows.mapInArrow(run, ALIGNED), "alignment")


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    known: int = KNOWN,
) -> DataFrame:
    """Counts, links and the digest of the groups of every document.

    ``ranks_path`` and ``pattern`` name the vocabulary of A as ranks for a faster encoder, used where both agree for certain.
    """
    parts = aligned(docs, a_path, b_path, ranks_path, pattern)
    counts = settled(
        parts.filter("row is null")
        .select(F.explode(F.arrays_zip("a_ids", "b_ids", "times")).alias("p"))
        .groupBy(F.col("p.a_ids").alias("a"), F.col("p.b_ids").alias("b"))
        .agg(F.sum(F.col("p.times").cast("bigint")).alias("count")),
        "pair-counts",
    )
    best = counts.groupBy("b").agg(F.max("count").alias("highest"))  # a row per id of B
    ranked = settled(counts.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best")), "pairs")
    often = ranked.orderBy(F.desc("count"), "a", "b").limit(known).toArrow()
    a, b = (often[c].to_numpy().astype(np.int64) for c in "ab")
    order = np.lexsort((a, b))
    a, b, times_of, best_of = (x[order] for x in (a, b, often["count"].to_numpy(), often["best"].to_numpy().astype(bool)))
    pairs = (b << 32) + a

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                sizes = pc.list_value_length(some["a_ids"]).to_numpy()
                owner = np.repeat(some["row"].to_numpy(), sizes)
                one, two, times = (some[c].flatten().to_numpy().astype(np.int64) for c in ("a_ids", "b_ids", "times"))
                wanted = (two << 32) + one
                place = np.minimum(np.searchsorted(pairs, wanted), max(0, len(pairs) - 1))
                found = pairs[place] == wanted if len(pairs) else np.zeros(len(wanted), bool)
                whose = np.repeat(np.arange(some.num_rows), sizes)
                n_best, total = np.zeros(some.num_rows, np.int64), np.zeros(some.num_rows, np.int64)
                if found.any():
                    np.add.at(n_best, whose[found], times[found] * best_of[place[found]])
                    np.add.at(total, whose[found], times[found] * times_of[place[found]])
                rare = ~found
                none = pa.nulls(some.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some["row"], none, none, none, pa.array(n_best), pa.array(total)], ["row", "a", "b", "times", "n_best", "count_sum"]
                )
                none = pa.nulls(int(rare.sum()), pa.int64())
                columns = [pa.array(x[rare]) for x in (owner, one, two, times)]
                yield pa.RecordBatch.from_arrays([*columns, none, none], ["row", "a", "b", "times", "n_best", "count_sum"])

    documents = parts.filter("row is not null")
    schema = "row bigint, a bigint, b bigint, times bigint, n_best bigint, count_sum bigint"
    looked_up = settled(
        documents.filter("n_links > 0").select("row", "a_ids", "b_ids", "times").mapInArrow(look_up, schema), "looked-up"
    )
    rare = looked_up.filter("a is not null").select("row", "a", "b", "times")
    rare = rare.join(ranked, ["a", "b"]).select(
        "row",
        F.when(F.col("best"), F.col("times")).otherwise(0).cast("bigint").alias("n_best"),
        (F.col("times") * F.col("count")).alias("count_sum"),
    )
    sums = (
        looked_up.filter("a is null")
        .select("row", "n_best", "count_sum")
        .union(rare)
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return documents.join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"),
        "groups_sha256",
    )
