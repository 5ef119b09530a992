"""A piece vocabulary as its file gives it, and what both the transducer and the counter need to know of it."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

SPACE = "▁"
#: Kinds of models and of pieces in a SentencePiece file; penalty of an unknown character.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Segments of up to this many characters are remembered, and so many segments and pairs of pieces;
#: then the table starts anew.
REMEMBERED_LENGTH, REMEMBERED = 64, 600_000
PAIRS = 500_000


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    if model.normalizer_spec.precompiled_charsmap:
        raise ValueError(f"{path}: normalisation tables of a file are not supported")
    return PieceModel(
        [(p.piece, p.score, p.type) for p in model.pieces],
        model.trainer_spec.model_type,
        model.normalizer_spec.add_dummy_prefix,
        model.normalizer_spec.remove_extra_whitespaces,
    )


class PieceModel:
    """Pieces (text, score, kind) of a unigram or BPE model with byte fallback."""

    def __init__(
        self,
        pieces: list[tuple[str, float, int]],
        kind: int,
        dummy_prefix: bool = True,
        single_spaces: bool = False,
    ):
        if kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {kind} is neither unigram nor BPE")
        self.pieces, self.kind = pieces, kind
        self.dummy_prefix, self.single_spaces = dummy_prefix, single_spaces
        self.ids = {text: i for i, (text, _, k) in enumerate(pieces) if k in (NORMAL, USER_DEFINED, UNUSED)}
        self.scores = {text: pieces[i][1] for text, i in self.ids.items()}
        self.byte_ids = {int(text[3:5], 16): i for i, (text, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.unknown_score = min((p[1] for p in pieces if p[2] == NORMAL), default=0.0) - UNKNOWN_PENALTY
        self._pairs: dict[tuple[str, str], bool] = {}
        self._splits: dict[str, tuple[str, str] | None] = {}
        self._edges: dict[tuple[str, int], list[tuple[str, float]] | None] = {}
        inside = {c for text in self.ids for c in text if len(text) > 1}
        cut_at_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", text) for text in self.ids)
        line = "" if "\n" in inside else "\n"
        #: Parts of a text that no piece and no merge can span.
        self.segment = re.compile(
            f"{line + '|' if line else ''}{SPACE}*[^{SPACE}{line}]+|{SPACE}+" if cut_at_spaces else r"(?s).+"
        )

    def fallback(self, char: str) -> list[int]:
        """Ids for a character that is no piece."""
        raw = char.encode("utf-8", "surrogatepass")
        return [self.byte_ids[b] for b in raw] if len(self.byte_ids) == 256 else [self.unknown]

    def normalised(self, text: str) -> str:
        """The text as the pieces see it: spaces visible, a space in front."""
        if self.single_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """Merge by merge: of neighbours that form a piece, those with the best score first, then the leftmost."""
        return self._merge(text)[0]

    def _merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """What merging makes of a text, and the last two symbols that were merged."""
        symbols, last = list(text), None
        scores = [self.scores.get(a + b) for a, b in zip(symbols, symbols[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, score in enumerate(scores):
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return symbols, last
            last = (symbols[at], symbols[at + 1])
            symbols[at : at + 2] = ["".join(last)]
            del scores[at]
            if at:
                scores[at - 1] = self.scores.get(symbols[at - 1] + symbols[at])
            if at < len(scores):
                scores[at] = self.scores.get(symbols[at] + symbols[at + 1])

    def alone(self, piece: str) -> bool:
        """Merging the characters of a piece gives the piece."""
        return len(piece) == 1 or self._halves(piece) is not None

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two symbols that the last merge of a piece joins; None if merging does not give the piece."""
        if piece not in self._splits:
            symbols, last = self._merge(piece)
            self._splits[piece] = last if symbols == [piece] else None
        return self._splits[piece]

    def _edge(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """Symbols at one edge of a piece while it is merged, from a character to the whole, each with the score of
        the merge that ends it. None if a merge has a better score than one before it, or scores can be equal."""
        key = (piece, side)
        if key not in self._edges:
            out: list[tuple[str, float]] | None = [(piece, float("-inf"))]
            symbol = piece
            while out is not None and len(symbol) > 1:
                halves = self._halves(symbol)
                if halves is None or SPACE + SPACE in symbol:
                    out = None
                    break
                part, score = halves[side], self.scores[symbol]
                if len(part) > 1 and self.scores[part] <= score:
                    out = None
                    break
                out.append((part, score))
                symbol = part
            self._edges[key] = out[::-1] if out is not None else None
        return self._edges[key]

    def follows(self, left: str, right: str) -> bool:
        """Merging both together keeps them as they are.

        A sequence of pieces is what merging makes of its text exactly if this holds for all neighbours, so merge
        order becomes a property of arcs between two pieces.
        """
        pair = (left, right)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs = {}
            known = self._pairs[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        if not (self.alone(left) and self.alone(right)):
            return False
        one, two = self._edge(left, 1), self._edge(right, 0)
        if one is None or two is None:
            return self.merged(left + right) == [left, right]
        # follow both edges in the order of merges: does a merge across come before what ends either symbol?
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = one[i], two[j]
            ends = max(a_ends, b_ends)
            across = self.scores.get(a + b)
            if across is not None and across >= ends:
                return False if across > ends else self.merged(left + right) == [left, right]
            if ends == float("-inf"):
                return True
            if a_ends == ends:
                i += 1
            if b_ends == ends:
                j += 1


def by_segment(model: PieceModel, solve: Callable[[str], object]) -> Callable[[str], list]:
    """What ``solve`` gives for each segment of a text, short segments remembered."""
    known: dict[str, object] = {}

    def run(text: str) -> list:
        nonlocal known
        segments = model.segment.findall(model.normalised(text))
        found = list(map(known.get, segments))
        if None in found:
            if len(known) >= REMEMBERED:
                known = {}
            for at, (segment, value) in enumerate(zip(segments, found, strict=True)):
                if value is None:
                    value = known.get(segment)
                    if value is None:
                        value = solve(segment)
                        if len(segment) <= REMEMBERED_LENGTH:
                            known[segment] = value
                    found[at] = value
        return found

    return run
