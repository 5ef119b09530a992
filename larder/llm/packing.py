"""Best-fit packing of tokenised documents into sequences of bounded length (best-two-fit).

``token_pieces`` turns documents into pieces of at most ``capacity`` token ids,
``pack`` assigns pieces to sequences. Only documents longer than a sequence are
cut. Pieces are dealt into groups of about ``group_rows`` by a hash of their key,
so a task holds a bounded number of small rows whatever the table's size, and
each group loses less than one sequence.

Within a group a sequence is filled greedily with the longest piece that fits,
again and again. Its smallest piece is then taken out if two pieces that are
still waiting fill the widened gap further; the one taken out waits again.

Of pieces of equal length those with the smaller ``doc_id`` and ``piece`` wait in front.

Defined results: a null or empty text is a document of the closing id alone; an
empty table gives no rows; repeated rows are packed once each; columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import by_bytes, id_and_text, release

CAPACITY = 4096
CLOSING_ID = 1
GROUP_ROWS = 8192
#: Bytes that a task's table of ids may take (words, or their lower-case letters and marks); a full table is emptied.
CACHED_BYTES = 48 << 20
#: What an entry takes besides its characters and ids, about.
ENTRY_BYTES = 200
#: Words encoded in one call.
TOGETHER = 4096

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PIECES_AND_IDS = PIECES + ", ids binary"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


def tokenizer(path: str):
    """The tokenizer (of the size of its file), and which ids end a word."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    vocabulary = found.get_vocab()
    suffix = getattr(found.model, "end_of_word_suffix", None)
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, number in vocabulary.items():
        ends[number] = bool(suffix) and token.endswith(suffix)
    return found, ends


#: Letters and plain punctuation that the tokenizer cuts, lower-cases and merges apart, whatever stands beside them.
LETTERS_THEN_MARKS = r"^(?P<letters>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<marks>[.,!?;:|#$%&*]*)$"
LOWER_LETTERS = re.compile(r"[a-z\u00DF-\u00F6\u00F8-\u00FF]+")
PLAIN_LETTERS = re.compile(r"[a-z]+")


class WordIds:
    """Token ids of texts, word by word.

    The tokenizer drops white space before it merges, so the ids of a text are those
    of its words in a row. Texts are cut at plain spaces and line feeds only: other
    white space stays inside a word and is left to the tokenizer. The different words of
    some texts are taken apart into letters and marks where that is safe, so that the tokenizer
    sees each run of letters once, in lower case; Arrow's columns do the rest.
    """

    def __init__(self, path: str, limit: int = CACHED_BYTES):
        self.tokenizer, self.ends = tokenizer(path)
        self.limit = limit
        self.words: dict[str, bytes] = {}
        self.words_bytes = 0

    def plain(self, parts: list[str]) -> list[bytes]:
        """Ids of runs of a to z, which reach the tokenizer's merges as they stand."""
        merged = self.tokenizer.model.tokenize
        return [array("I", [t.id for t in merged(part)]).tobytes() for part in parts]

    def letters(self, parts: list[str]) -> list[bytes]:
        """Ids of runs of lower-case letters: each is one word to the tokenizer, so one call takes many."""
        out: list[bytes] = []
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            encoded = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(encoded[0].ids, "<u4")
            edges = np.flatnonzero(self.ends[ids]) + 1
            if len(edges) == len(some) and edges[-1] == len(ids):
                raw, cut = ids.tobytes(), [0, *(4 * edges).tolist()]
                out += [raw[lo:hi] for lo, hi in zip(cut[:-1], cut[1:], strict=True)]
            else:
                out += self.others(some)
        return out

    def others(self, parts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False) if parts else []
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def known(self, names: list[str]) -> pa.Array:
        """Ids of words, or of their letters or marks, from the table; new ones are put into it."""
        new = [n for n in names if n not in self.words]
        plain = list(filter(PLAIN_LETTERS.fullmatch, new))
        letters = [n for n in new if not n.isascii() and LOWER_LETTERS.fullmatch(n)]
        others = list(set(new).difference(plain, letters))
        for some, ids in ((plain, self.plain(plain)), (letters, self.letters(letters)), (others, self.others(others))):
            self.words.update(zip(some, ids, strict=True))
            self.words_bytes += sum(map(len, some)) + sum(map(len, ids)) + ENTRY_BYTES * len(some)
        return pa.array(map(self.words.__getitem__, names), pa.large_binary())

    def of_words(self, words: pa.Array) -> pa.Array:
        """Ids of different words."""
        cut = pc.extract_regex(words, LETTERS_THEN_MARKS)
        first = pc.coalesce(pc.utf8_lower(pc.struct_field(cut, "letters")), words).dictionary_encode()
        second = pc.fill_null(pc.struct_field(cut, "marks"), "").dictionary_encode()
        both = (self.known(x.dictionary.to_pylist()).take(x.indices) for x in (first, second))
        return pc.binary_join_element_wise(*both, pa.scalar(b"", pa.large_binary()))

    def of_texts(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text; a null text has none."""
        if self.words_bytes > self.limit:
            self.words, self.words_bytes = {}, 0
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        ids = self.of_words(words.dictionary).take(words.indices)
        # the ids of all words lie in a row, so those of a text do
        _, offsets, raw = ids.buffers()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        edges = np.frombuffer(offsets, np.int64)[ids.offset :][np.concatenate(([0], ends))].tolist()
        raw = memoryview(raw or b"")
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            yield bytes(raw[lo:hi])

    def __call__(self, text: str) -> bytes:
        return next(self.of_texts(pa.array([text], pa.string())))


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    closing_id: int = CLOSING_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of each document's ids, the closing id included; ``ids`` holds little-endian 32-bit ids if asked for."""

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = WordIds(tokenizer_path)  # its tables end with the task
        closing = np.array([closing_id], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            for some in by_bytes(batch):
                rows = []
                for doc_id, ids in zip(some["doc_id"].to_pylist(), encode.of_texts(some["text"]), strict=True):
                    ids += closing
                    for piece, at in enumerate(range(0, len(ids), width)):
                        part = ids[at : at + width]
                        rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns[: 6 if with_ids else 5], names[: 6 if with_ids else 5])
        del encode
        release()

    return id_and_text(docs).mapInArrow(cut, PIECES_AND_IDS if with_ids else PIECES)


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of positions in ``lengths`` (each from 1 to ``capacity``), every position once."""
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    for at in range(len(lengths) - 1, -1, -1):
        waiting[lengths[at]].append(at)
    count = np.array([len(w) for w in waiting])
    sizes = np.arange(capacity + 1)
    longest = np.maximum.accumulate(np.where(count > 0, sizes, 0))  # longest[x]: the longest waiting piece of at most x

    def take(size: int) -> int:
        count[size] -= 1
        if not count[size]:
            below = longest[size - 1]
            above = size + 1 + int(np.argmax(count[size + 1 :] > 0)) if count[size + 1 :].any() else capacity + 1
            longest[size:above] = below
        return waiting[size].pop()

    def put_back(size: int, at: int) -> None:
        waiting[size].append(at)
        count[size] += 1
        reach = longest[size:]
        reach[reach < size] = size

    bins = []
    while longest[capacity]:
        held: list[tuple[int, int]] = []
        gap = capacity
        while gap and longest[gap]:
            size = int(longest[gap])
            held.append((size, take(size)))
            gap -= size
        if gap and len(held) > 1:
            size, at = held[-1]  # pieces were taken longest first
            room = gap + size
            first = np.flatnonzero(count[: room + 1])
            if len(first):
                second = longest[room - first]
                alone = (second == first) & (count[first] < 2)
                second[alone] = longest[first[alone] - 1]
                total = np.where(second > 0, first + second, 0)
                best = int(total.argmax())
                if total[best] > size:
                    held.pop()
                    for s in (int(first[best]), int(second[best])):
                        held.append((s, take(s)))
                    put_back(size, at)
        bins.append([at for _, at in held])
    return bins


def pack(pieces: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``; other columns are kept.

    ``groups`` is the number of independently packed shares of the rows.
    """
    kept = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], kind="stable", ignore_index=True)
        lengths = rows["length"].to_numpy()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, held in enumerate(best_two_fit(lengths, capacity)):
            sequence[held] = (int(key[0]) << 32) + number
            offset[held] = np.cumsum(lengths[held]) - lengths[held]
        return rows[kept].assign(sequence_id=sequence, offset=offset)

    share = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).alias("_share")
    return pieces.select("*", share).groupBy("_share").applyInPandas(fill, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
    with_ids: bool = False,
) -> DataFrame:
    """Documents to packed pieces. The number of groups follows the number of documents (read from file footers)."""
    groups = max(1, -(-docs.count() // group_rows))
    return pack(token_pieces(docs, tokenizer_path, capacity, with_ids=with_ids), groups, capacity)
