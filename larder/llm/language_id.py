"""Language identification with language-bitmask n-gram filters.

Each language has a Bloom filter of the character n-grams that are usual in it. The
filters are bit-sliced: slot i of all of them is one bitmask, so the masks at an
n-gram's slots, and-ed, name all languages that contain it. A text goes to the language
whose filter contains the largest share of its n-grams, after the share that the filter
would contain by chance (its false-positive rate) is taken off.

``fit`` counts slots over all labelled documents: every task adds its documents into one
table per language, and the tables are summed in two levels, so that what moves depends
on the number of tasks and not on the texts. The model has ``SLOTS`` bits per language
(128 KiB), 64 languages to a mask word and as many words as the languages need; that is its size when it is
sent to the executors.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is
every text if nothing was learned; ties go to the language first in code-point order;
repeated rows count as often as they stand there; columns other than those named are
ignored. Documents without an id are never held out and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import by_bytes, id_and_text, release

UNKNOWN = "und"
ORDERS = (3, 4)
SLOTS = 1 << 20
#: An n-gram belongs to a language if its slots hold at least this share of the language's n-grams, and two at least.
USUAL_SHARE = 1e-5
BLOCK = 1 << 14
FAN_IN = 64
#: Symbols of a language that a task gathers before it counts their n-grams: bounds its memory, not what is counted.
WAITING = 1 << 18
#: Languages whose tables (4 MiB each) a task holds at a time.
TABLES = 8
#: Languages of one mask word.
WORD = 64
PREDICTED = "doc_id bigint, lang_pred string, score double"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def letters_and_gaps(text: str | None) -> np.ndarray:
    """Lower-case letters of a text, every run of other characters as one gap, a gap at both ends; empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[np.minimum(codes, 0xFFFF)]
    beyond = codes > 0xFFFF
    if beyond.any():
        letter[beyond] = [chr(c).isalpha() for c in codes[beyond]]
    if not letter.any():
        return np.zeros(0, np.uint64)
    out = np.zeros(len(codes) + 2, np.uint64)
    out[1:-1] = np.where(letter, codes, 0)
    return out[np.concatenate(([True], (out[1:] | out[:-1]) != 0))]


def slots(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both slots of every n-gram of the given symbols."""
    hashes, gram = [], symbols
    for order in range(2, max(ORDERS) + 1):
        gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + symbols[order - 1 :]
        if order in ORDERS:
            hashes.append(gram)
    mixed = np.concatenate(hashes)
    hashes.clear()
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    second = (mixed >> np.uint64(40) & np.uint64(SLOTS - 1)).astype(np.int32)
    mixed &= np.uint64(SLOTS - 1)
    return mixed.astype(np.int32), second


def count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language and block of slots that a task has seen."""
    counts: dict[str, np.ndarray] = {}
    total: dict[str, int] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    held: dict[str, int] = {}

    def count(lang: str) -> None:
        for found in slots(np.concatenate(waiting.pop(lang))):
            np.add.at(counts[lang], found, np.int32(1))
        total[lang] += held[lang]
        held[lang] = 0

    def tables() -> Iterator[pa.RecordBatch]:
        for lang in list(waiting):
            count(lang)
        for lang, table in counts.items():
            blocks = [b for b in range(SLOTS // BLOCK) if table[b * BLOCK : (b + 1) * BLOCK].any()]
            columns = [
                pa.array([lang] * len(blocks)),
                pa.array(blocks, pa.int32()),
                pa.array([table[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in blocks], pa.binary()),
                pa.array([total[lang]] * len(blocks), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "block", "counts", "grams"])
        for kept in (counts, total, held):
            kept.clear()

    for batch in batches:
        for some in by_bytes(batch):
            for text, lang in zip(some["text"].to_pylist(), some["lang"].to_pylist(), strict=True):
                symbols = letters_and_gaps(text)
                if len(symbols):
                    if lang not in counts:
                        if len(counts) >= TABLES:
                            yield from tables()
                        counts[lang], total[lang], held[lang] = np.zeros(SLOTS, np.int32), 0, 0
                    waiting.setdefault(lang, []).append(symbols)
                    held[lang] += len(symbols)
                    if held[lang] >= WAITING:
                        count(lang)
    yield from tables()
    release()


def add_tables(tables: DataFrame, *keys: str) -> DataFrame:
    """Sum of the count tables that share the keys, a block at a time."""

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, grams = np.zeros(BLOCK, np.int64), 0
        for part in parts:
            for table in part["counts"]:
                counts += np.frombuffer(table, np.int32 if len(table) == 4 * BLOCK else np.int64)
            grams += int(part["grams"].sum())
        yield pd.DataFrame({**{k: [v] for k, v in zip(keys, key, strict=True)}, "counts": [counts.tobytes()], "grams": [grams]})

    types = dict(tables.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in (*keys, "counts", "grams"))
    return tables.groupBy(*keys).applyInPandas(add, schema)


class LanguageFilters:
    """Bit-sliced filters: bit j of ``masks[w][i]`` is set if slot i is set for ``languages[64 w + j]``."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks = languages, masks.reshape(-1, SLOTS)
        filled = [float((masks[j // WORD] >> np.uint64(j % WORD) & np.uint64(1)).mean()) for j in range(len(languages))]
        self.chance = np.array(filled) ** 2

    def hits(self, text: str | None) -> tuple[np.ndarray, int]:
        """How many n-grams of the text each language contains, and how many there are."""
        symbols = letters_and_gaps(text)
        if not len(symbols):
            return np.zeros(len(self.languages)), 0
        first, second = slots(symbols)
        found = []
        for word, masks in enumerate(self.masks):
            held, bits = masks[first] & masks[second], min(WORD, len(self.languages) - WORD * word)
            if bits <= 12:
                by_mask = np.bincount(held.astype(np.int64), minlength=1 << bits)
                numbers = np.arange(len(by_mask))
                found += [by_mask[numbers >> j & 1 == 1].sum() for j in range(bits)]
            else:
                found += [int((held >> np.uint64(j) & np.uint64(1)).sum()) for j in range(bits)]
        return np.array(found, float), len(first)

    def decide(self, text: str | None) -> tuple[str, float]:
        found, grams = self.hits(text)
        if not grams or not self.languages:
            return UNKNOWN, 0.0
        share = np.clip((found / grams - self.chance) / (1 - self.chance), 0, 1)
        best = int(share.argmax())
        return self.languages[best], float(share[best])

    def predict(self, docs: DataFrame) -> DataFrame:
        """doc_id, lang_pred and score of every document; reads only id and text."""
        languages, masks = self.languages, self.masks.tobytes()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = LanguageFilters(languages, mask_words(masks))
            for batch in batches:
                for some in by_bytes(batch):
                    lang, score = zip(*map(filters.decide, some["text"].to_pylist()), strict=True)
                    columns = [some["doc_id"], pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

        return id_and_text(docs).mapInArrow(run, PREDICTED)


def mask_words(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64).reshape(-1, SLOTS)


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Remainder of crc32 of the id in text form."""
    return F.crc32(F.col(doc_id).cast("bigint").cast("string").cast("binary")) % folds


def fit(docs: DataFrame) -> LanguageFilters:
    """Filters learned from ``text`` and non-null ``lang`` of the given documents."""
    rows = docs.filter("lang is not null and text is not null").select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    per_task = rows.mapInArrow(count_slots, "lang string, block int, counts binary, grams bigint")
    per_task = per_task.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(FAN_IN)))
    summed = add_tables(add_tables(per_task, "lang", "block", "part"), "lang", "block")

    def usual(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = [
                np.packbits(np.frombuffer(c, np.int64) >= max(2, USUAL_SHARE * g), bitorder="little").tobytes()
                for c, g in zip(batch["counts"], batch["grams"], strict=True)
            ]
            yield batch[["lang", "block"]].assign(bits=bits)

    # at most SLOTS / 8 bytes per language
    rows = summed.mapInPandas(usual, "lang string, block int, bits binary").collect()
    languages = sorted({row.lang for row in rows})
    masks = np.zeros((-(-len(languages) // WORD), SLOTS), np.uint64)
    number = {lang: j for j, lang in enumerate(languages)}
    for row in rows:
        bits = np.unpackbits(np.frombuffer(bytes(row.bits), np.uint8), bitorder="little").astype(np.uint64)
        j = number[row.lang]
        masks[j // WORD, row.block * BLOCK : (row.block + 1) * BLOCK] |= bits << np.uint64(j % WORD)
    return LanguageFilters(languages, masks)


def predict_held_out(docs: DataFrame) -> DataFrame:
    """Learn from four folds of five, predict all."""
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    model = fit(docs.filter(fold() != 0))
    return model.predict(docs).select("doc_id", held_out, "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with ``lang`` as predicted, learned from four folds of five; texts without a letter go."""
    model = fit(docs.filter(fold() != 0))
    languages, masks = model.languages, model.masks.tobytes()
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = LanguageFilters(languages, mask_words(masks))
        for batch in batches:
            at = batch.schema.get_field_index("lang")
            field = batch.schema.field(at)
            for some in by_bytes(batch):
                texts = some["text"].to_pylist()
                kept = pa.array([len(letters_and_gaps(text)) > 0 for text in texts], pa.bool_())
                decided = pa.array([filters.decide(text)[0] for text in texts], field.type)
                yield some.set_column(at, field, decided).select(names).filter(kept)

    return docs.mapInArrow(run, docs.schema)
