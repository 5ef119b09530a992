"""SentencePiece encoding and decoding with a weighted finite-state transducer.

The normaliser, the pieces and the byte fallback are compiled into one transducer: it reads characters and
writes piece ids. Pieces form a trie; a path through the trie ends in an arc back to
the start that writes the piece, with minus its score as weight. A character that is no piece has an arc
that writes its bytes. For BPE models the pieces are further composed with an acceptor of
neighbouring pieces: its state is the last piece, and an arc exists where merging keeps both
pieces apart (weight 0, otherwise none). Each segment of a text, a linear automaton, is
composed with the transducer on the fly, and the shortest path in the tropical semiring
(sum along a path, minimum over paths) gives the ids. Of equal paths the one whose last
piece starts first stays, as in the tokenizer.

Texts are cut where no piece can cross, so paths of segments add up; words that come again are remembered
within a bound. Decoding runs the pieces backwards.

Defined results: null and empty texts have no ids and decode to an empty text;
repeated rows are encoded once each; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.pieces import BPE, BYTE, CONTROL, SPACE, UNKNOWN, PieceModel, by_segment, load
from larder.llm.shared import id_and_text

ENCODED = "doc_id bigint, ids array<int>, n_ids bigint, round_trip boolean"


class Transducer:
    """The compiled transducer. A trie state is [arcs by character, what its final arc writes or None]."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.start: list = [{}, None]
        for text, number in model.ids.items():
            state = self.start
            for char in text:
                state = state[0].setdefault(char, [{}, None])
            state[1] = (text, array("i", [number]).tobytes(), -model.scores[text])

    def unknown(self, char: str) -> tuple[str, bytes, float]:
        """What the arc of a character that is no piece writes."""
        return char, array("i", self.model.fallback(char)).tobytes(), -self.model.unknown_score

    def shortest_path(self, text: str) -> bytes:
        """Ids on the shortest path through the composition with a text, as 32-bit numbers.

        One state of the composition is kept per place: for unigram models there is one, for BPE models merging
        leaves one sequence of pieces up to each place, so the first arc that the acceptor allows is the only one.
        """
        model, n = self.model, len(text)
        bpe, follows, alone = model.kind == BPE, model.follows, model.alone
        cost: list[float | None] = [0.0] + [None] * n
        back, last, wrote = [0] * (n + 1), [""] * (n + 1), [b""] * (n + 1)
        for at in range(n):
            base = cost[at]
            if base is None:
                continue
            before, state, end, single = last[at], self.start, at, False
            while True:
                state = state[0].get(text[end])
                if state is None:
                    break
                end += 1
                final = state[1]
                if final is not None:
                    single = single or end == at + 1
                    if bpe:
                        if cost[end] is None and (follows(before, final[0]) if before else alone(final[0])):
                            cost[end], back[end], last[end], wrote[end] = base, at, final[0], final[1]
                    elif cost[end] is None or base + final[2] < cost[end]:
                        cost[end], back[end], wrote[end] = base + final[2], at, final[1]
                if end == n:
                    break
            if not single:
                end, (char, ids, weight) = at + 1, self.unknown(text[at])
                if bpe:
                    if cost[end] is None and (not before or follows(before, char)):
                        cost[end], back[end], last[end], wrote[end] = base, at, char, ids
                elif cost[end] is None or base + weight < cost[end]:
                    cost[end], back[end], wrote[end] = base + weight, at, ids
        out, at = [], n
        while at > 0:
            out.append(wrote[at])
            at = back[at]
        return b"".join(reversed(out))

class Codec:
    def __init__(self, model: PieceModel):
        self.model = model
        self.solved = by_segment(model, Transducer(model).shortest_path)
        self.written = [
            b""
            if kind == CONTROL
            else bytes([int(text[3:5], 16)])
            if kind == BYTE
            else " ⁇ ".encode()
            if kind == UNKNOWN
            else text.replace(SPACE, " ").encode("utf-8", "surrogatepass")
            for text, _, kind in model.pieces
        ]

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(self.solved(text)) if text else b"", np.int32)

    def decode(self, ids) -> str:
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(load(path))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_path)
        for batch in batches:
            texts = [text or "" for text in batch["text"].to_pylist()]
            for at in range(0, len(texts), 1000):
                part = texts[at : at + 1000]
                ids = [coder.encode(text) for text in part]
                back = [coder.decode(i.tolist()) == text for i, text in zip(ids, part, strict=True)]
                sizes = [len(i) for i in ids]
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(at, len(part)), lists, pa.array(sizes, pa.int64()), pa.array(back)],
                    ["doc_id", "ids", "n_ids", "round_trip"],
                )

    return id_and_text(docs).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``text`` of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_path)
        for batch in batches:
            texts = [coder.decode(ids or []) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
