"""Token counts by a count-only Viterbi search.

An Aho-Corasick automaton over the vocabulary enumerates all pieces that end at each place of a text;
dynamic programming carries the best score and the number of pieces up to each place, no ids and no back
pointers. Two rules are applied to the same matches:

* ``n_tokens`` follows the tokenizer that the file describes. For a unigram file that is the best sum of scores. For
  a BPE file the best sum of scores is not what the tokenizer does; there a piece may only follow
  a piece from which merging keeps it apart, and the one path that is left is the tokenizer's.
* ``n_by_score`` is the best sum of scores whatever the file's type.

Equal scores keep the path whose last piece starts first; a character that is no piece counts its bytes (one unknown
token without byte fallback), with the tokenizer's penalty. Scores are added exactly,
word by word, so long texts lose no digits.

Defined results: null and empty texts have 0 tokens; repeated rows are counted once each; columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.pieces import BPE, PieceModel, by_segment, load
from larder.llm.shared import id_and_text

COUNTED = "doc_id bigint, n_tokens bigint, n_by_score bigint"


class Counter:
    def __init__(self, model: PieceModel):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for text, score in model.scores.items():
            self.automaton.add_word(text, (len(text), text, score))
        self.automaton.make_automaton()
        self.solved = by_segment(model, self.both)

    def matches(self, text: str) -> list[list[tuple[int, str, float]]]:
        """For each end the pieces that end there, longest first, so that earlier starts win ties."""
        found: list[list] = [[] for _ in text]
        for end, piece in self.automaton.iter(text):  # the automaton follows its failure links: longest first
            found[end].append(piece)
        for at, ending in enumerate(found):
            if not ending or ending[-1][0] > 1:
                ending.append((1, text[at], self.model.unknown_score))
        return found

    def cost(self, char: str) -> int:
        return 1 if char in self.model.scores else len(self.model.fallback(char))

    def by_score(self, found: list) -> int:
        """Number of pieces of the best sum of scores."""
        best, count = [0.0], [0]
        for end, ending in enumerate(found, 1):
            top, pieces = None, 0
            for length, piece, score in ending:
                total = best[end - length] + score
                if top is None or total > top:
                    top, pieces = total, count[end - length] + (1 if length > 1 else self.cost(piece))
            best.append(top)
            count.append(pieces)
        return count[-1]

    def by_merges(self, found: list) -> int:
        """Number of pieces of the one sequence in which merging keeps all neighbours apart."""
        last: list[str | None] = [""]
        count = [0]
        follows, alone = self.model.follows, self.model.alone
        for end, ending in enumerate(found, 1):
            kept, pieces = None, 0
            for length, piece, _ in ending:
                before = last[end - length]
                if before is not None and (follows(before, piece) if before else alone(piece)):
                    kept, pieces = piece, count[end - length] + (1 if length > 1 else self.cost(piece))
                    break
            last.append(kept)
            count.append(pieces)
        return count[-1]

    def both(self, text: str) -> int:
        """Both counts of a segment in one number, the second in units of 2^32."""
        found = self.matches(text)
        scored = self.by_score(found)
        return (self.by_merges(found) if self.model.kind == BPE else scored) + (scored << 32)

    def __call__(self, text: str | None) -> tuple[int, int]:
        total = sum(self.solved(text)) if text else 0
        return total & 0xFFFFFFFF, total >> 32


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(load(path))


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """Both counts of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_path)
        for batch in batches:
            counts = [count(text) for text in batch["text"].to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in (zip(*counts, strict=True) if counts else ((), ()))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_tokens", "n_by_score"])

    return id_and_text(docs).mapInArrow(run, COUNTED)
