"""Substring dedup by content-defined chunks.

A gear rolling hash runs over every text; a chunk ends where no hash within ``REACH`` characters on both sides
is larger. Such cuts depend on the nearest characters
alone, so an insertion moves no cut beyond its own neighbourhood. Text with a period has equal largest hashes and
is cut at each of them, once a period; equal chunks in a row are one row after the first. Chunks are compared by
a 64-bit digest of their characters. The first place of a digest (smallest document, then
smallest start) keeps its text, all other places are repeats. Repeats that follow each
other without a gap are a run; runs of at least ``MIN_WORDS`` words, or of ``MIN_CHARS`` characters in scripts
without spaces, are reported. A passage mostly loses up to about 65 characters at either end (more in a few of a hundred),
where its chunks reach beyond it, so this bound finds passages of over 50 words; a run has several chunks, so that one
chance collision of digests removes nothing.

Both the grouping by digest and the join back to the places move small rows, never texts.
Grouping combines on the map side, and the digests that repeat are written before the
join so that adaptive execution can split a digest that a large part of all places has.

Defined results: null and empty texts have no chunks; rows with one ``doc_id`` count as one
document; text that no cut divides for ``LONGEST`` characters is cut there; other columns
are carried along by ``remove_repeats`` and ignored by ``repeated_spans``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.shared import by_bytes, counted, id_and_text, settled

REACH = 16
LONGEST = 1024
MIN_WORDS = 20
#: A run of so many characters is reported whatever its words; ordinary prose reaches ``MIN_WORDS`` before.
MIN_CHARS = 400
ROWS_AT_ONCE = 100_000
CHUNKS = "digest bigint, doc_id bigint, start int, end int, word int, end_word int, again boolean"
#: Gear values: one 32-bit number per class of characters.
GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, 4096, dtype=np.uint32)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def cuts(codes: np.ndarray) -> np.ndarray:
    """Where chunks start, in order, and the end of the text."""
    gear = GEAR[(codes * np.uint32(0x9E3779B1)) >> np.uint32(20)]
    for width in (1, 2, 4, 8):  # the hash of the last 16 characters, the newest unshifted
        older = gear[:-width] << np.uint32(width)
        gear[width:] += older
    around = np.zeros(len(gear) + 2 * REACH, np.uint32)
    around[REACH : REACH + len(gear)] = gear
    for width in (1, 2, 4, 8):  # around[i] is the largest of the REACH values from i on
        np.maximum(around[:-width], around[width:], out=around[:-width])
    before, after = around[: len(gear)], around[REACH + 1 : REACH + 1 + len(gear)]
    found = np.flatnonzero((gear >= before) & (gear >= after))
    found = found[found >= REACH]
    edges = np.concatenate(([0], found, [len(codes)]))
    if np.diff(edges).max(initial=0) > LONGEST:
        parts = [np.arange(a, b, LONGEST) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        edges = np.concatenate([*parts, [len(codes)]])
    return edges


def chunks_of(text: str) -> tuple[np.ndarray, ...]:
    """Starts and ends of a text's chunks, their digests, how many words start before each start and end, and whether
    the text has the same chunk before. Equal chunks in a row are one from the second on."""
    codes = codes_of(text)
    edges = cuts(codes)
    raw = memoryview(codes.tobytes())
    at = (4 * edges).tolist()
    digests = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    gap = (codes == 32) | ((codes >= 9) & (codes <= 13))
    starts = ~gap
    starts[1:] &= gap[:-1]
    before = np.concatenate(([0], np.cumsum(starts)))
    digests = np.array(digests, np.uint64).view(np.int64)
    again = np.ones(len(digests), bool)
    again[np.unique(digests, return_index=True)[1]] = False
    opens = np.ones(len(digests), bool)
    opens[2:] = (digests[2:] != digests[1:-1]) | ~again[1:-1]
    first = np.flatnonzero(opens)
    starts, ends = edges[:-1][first], np.append(edges[:-1][first[1:]], edges[-1])
    return starts, ends, digests[first], before[starts], before[ends], again[first]


def chunks(docs: DataFrame) -> DataFrame:
    """The chunks of every text; ``again``: the text has the same chunk before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (np.int64, np.int64, np.int32, np.int32, np.int32, np.int32, np.bool_)
        names = "digest doc_id start end word end_word again".split()

        def batch_of(parts: list[tuple]) -> pa.RecordBatch:
            columns = zip(types, zip(*parts, strict=True), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t)) for t, c in columns], names)

        for batch in batches:
            for some in by_bytes(batch):
                parts, held = [], 0
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                    starts, ends, digests, words, end_words, again = chunks_of(text)
                    parts.append((digests, np.full(len(digests), doc_id), starts, ends, words, end_words, again))
                    held += len(digests)
                    if held >= ROWS_AT_ONCE:
                        yield batch_of(parts)
                        parts, held = [], 0
                if parts:
                    yield batch_of(parts)

    return id_and_text(docs).filter("doc_id is not null and text <> ''").mapInArrow(cut, CHUNKS)


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Runs of repeated chunks: doc_id, start, length, words, and the documents that keep the text."""
    first = settled(
        chunks(docs)
        .filter("not again")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("documents"))
        .filter("documents > 1")
        .drop("documents"),
        "repeated-chunks",
    )
    repeats = (
        chunks(docs)
        .join(first, "digest", "left")
        .filter("again or doc_id <> first_doc_id")
        .select("doc_id", "start", "end", "word", "end_word", F.coalesce("first_doc_id", "doc_id").alias("first_doc_id"))
    )
    in_order = Window.partitionBy("doc_id").orderBy("start")
    opens = F.coalesce(F.col("start") > F.lag("end").over(in_order), F.lit(True))
    return (
        repeats.withColumn("opens", opens.cast("int"))
        .withColumn("run", F.sum("opens").over(in_order))
        .groupBy("doc_id", "run")
        .agg(
            F.min("start").alias("start"),
            (F.max("end") - F.min("start")).alias("length"),
            (F.max("end_word") - F.min("word")).alias("words"),
            F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"),
        )
        .filter((F.col("words") >= min_words) | (F.col("length") >= min_chars))
        .drop("run")
    )


def by_document(spans: DataFrame) -> DataFrame:
    """One row per document that repeats text of others or of its own."""
    span = F.struct("start", "length", "words", "first_doc_ids")
    return spans.groupBy("doc_id").agg(
        F.count("*").alias("n_spans"),
        F.sum("length").alias("n_chars"),
        F.sum("words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("first_doc_ids")))).alias("first_doc_ids"),
        F.array_sort(F.collect_list(span)).alias("spans"),
    )


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given (start, length) spans, each drawn in to whole words."""
    out, done = [], 0
    for start, length in spans:
        end = start + length
        while 0 < start < end and not text[start - 1].isspace():
            start += 1
        while end < len(text) and end > start and not text[end].isspace():
            end -= 1
        out.append(text[done:start])
        done = end
    out.append(text[done:])
    return "".join(out)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated passages; documents that have nothing else go. Other columns stay as they are."""
    names = docs.columns
    added = "_spans"
    while added in names:
        added += "_"
    spans = by_document(repeated_spans(docs, min_words)).select("doc_id", F.col("spans").alias(added))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for some in by_bytes(batch):
                found = some[added].to_pylist()
                texts = [
                    without_spans(text, [(s["start"], s["length"]) for s in spans]) if spans else text
                    for text, spans in zip(some["text"].to_pylist(), found, strict=True)
                ]
                left = [not spans or bool(text.strip()) for text, spans in zip(texts, found, strict=True)]
                new = some.set_column(at, some.schema.field(at), pa.array(texts, some.schema.field(at).type))
                yield new.select(names).filter(pa.array(left))

    return counted(docs.join(spans, "doc_id", "left").select(*names, added).mapInArrow(cut, docs.schema))
