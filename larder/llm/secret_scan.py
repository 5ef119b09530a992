"""Secret scans by assignment-aware lexing.

Three plain patterns give the base spans (assignments to sensitive words, access
keys, long hexadecimal runs). On top, assignments in source and configuration
syntax are lexed into (name, literal) pairs: ``name = "x"``, ``name := 'x'``,
``"name": "x"``, ``name => x``, ``NAME=x``, ``name: x``. Literals may be joined by
``+`` and names that stand for an earlier literal of the same text are replaced by it
(constant propagation). A pair is scored by how sensitive its name is and how much its
literal looks like a credential; literals that score at least ``min_score`` become
spans of kind ``lexed`` at the place where the literal stands.

Spans of different kinds may overlap, all are reported; of equal starts the kinds go in the order
base, then lexed. A literal that stands at one place under several names is one span, of the first name. Literals of any
length are found; only what constants build by joining is bounded (``MAX_BUILT``), beyond that the expression is
unknown and the parts' own assignments remain.

Defined results: null and empty texts have no spans; repeated rows are scanned
once each; columns other than ``doc_id`` and ``text`` are ignored. Offsets count
code points, ends are exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import by_bytes, id_and_text, with_text

KINDS = ("assign", "access", "hex", "lexed")
MIN_SCORE = 0.5
SPANS = (
    "doc_id bigint, spans array<struct<kind string, start int, end int, value_start int, value_end int, "
    "name string, score double>>"
)

# Fixed patterns and lengths of the base spans.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # runs are maximal, so a failing shorter run never hides a longer one
MIN_ASSIGNED, MIN_ACCESS = 6, 20

#: How sensitive a target name is, by the words in it (the highest counts).
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "pwd": 0.9,
    "passphrase": 1.0,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "privatekey": 1.0,
    "accesskey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "auth": 0.6,
    "bearer": 0.8,
    "signature": 0.5,
    "key": 0.5,
}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|nil|true|false|todo|changeme|example.*|your.*|<.*>|\$\{.*\}|%.*%)$")

NAME = r"""[A-Za-z_$][\w$.\-]*"""
TARGET = re.compile(rf"""(?<![\w$.\-])(?:"({NAME})"|'({NAME})'|({NAME}))[ \t]*(?::=|=>|=(?![=>~])|:(?![:=/]))[ \t]*""", re.A)
STRING = re.compile(r""""((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'""")
BARE = re.compile(r"""[^\s"'`,;<>(){}\[\]]+""")
JOINED = re.compile(r"[ \t]*\+[ \t]*")
WORDS_OF_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


#: What constants build together (characters, parts) is followed up to here: doubling (``a = a + a``) must not grow
#: without end. A literal that stands in the text, alone or joined of parts that stand there, has no bound.
MAX_BUILT, MAX_PARTS = 1 << 16, 1 << 10


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    value_start: int
    value_end: int
    name: str
    score: float


class Literal:
    """A value and the places of its parts; how much it looks like a credential is worked out once."""

    def __init__(self, text: str, places: tuple[tuple[int, int], ...], quoted: bool):
        self.text, self.places, self.quoted = text, places, quoted

    @cached_property
    def score(self) -> float:
        return literal_score(self.text)


def name_score(name: str) -> float:
    """Sensitivity of a target name: its words in snake, kebab or camel case, alone and in neighbouring pairs."""
    words = [w.lower() for w in WORDS_OF_NAME.findall(name)]
    parts = [*words, *map("".join, zip(words, words[1:], strict=False))]
    return max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)


def literal_score(text: str) -> float:
    """How much a literal looks like a credential: long enough, no placeholder, several kinds of characters, mixed."""
    if len(text) < 6 or PLACEHOLDER.match(text) or any(c.isspace() for c in text):
        return 0.0
    counts = Counter(text)
    entropy = -sum(n / len(text) * math.log2(n / len(text)) for n in counts.values())
    kinds = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.15 * kinds + entropy / 6 + min(len(text), 32) / 128)


def value_at(text: str, at: int, constants: dict[str, Literal]) -> tuple[Literal | None, int]:
    """The literal that the expression at ``at`` stands for (None if unknown), and where the expression ends."""
    parts: list[Literal] = []
    known, borrowed = True, False
    while True:
        if m := STRING.match(text, at):
            group = 1 if m[1] is not None else 2
            parts.append(Literal(m[group], (m.span(group),), True))
        elif m := BARE.match(text, at):
            if m[0] in constants:
                parts.append(constants[m[0]])
                borrowed = True
            else:
                parts.append(Literal(m[0], (m.span(),), False))
                known = known and text[m.end() : m.end() + 1] not in ("(", "[")
        else:
            break
        at = m.end()
        if not (m := JOINED.match(text, at)):
            break
        at = m.end()
    if not parts or not known:
        return None, at
    if len(parts) == 1:  # a name alone stands for its literal, however long
        return parts[0], at
    if borrowed and (sum(len(p.text) for p in parts) > MAX_BUILT or sum(len(p.places) for p in parts) > MAX_PARTS):
        return None, at
    places = tuple(place for part in parts for place in part.places)
    return Literal("".join(p.text for p in parts), places, any(p.quoted for p in parts)), at


def lexed(text: str, min_score: float = MIN_SCORE) -> list[Span]:
    """Sensitive literals of a text."""
    spans: dict[tuple[int, int], Span] = {}
    constants: dict[str, Literal] = {}
    at = 0
    while target := TARGET.search(text, at):
        name = target[1] or target[2] or target[3]
        literal, end = value_at(text, target.end(), constants)
        at = max(end if literal and literal.quoted else target.end(), target.end())
        if literal is None:
            continue
        constants[name] = literal
        score = name_score(name)
        score *= literal.score if score else 0.0
        if score >= min_score:
            for start, stop in literal.places:
                if stop > start:
                    spans.setdefault((start, stop), Span("lexed", start, stop, start, stop, name, score))
    return sorted(spans.values(), key=lambda s: s[1:3])


def scan(text: str | None, min_score: float = MIN_SCORE) -> list[Span]:
    """All spans of a text by start, then kind."""
    if not text:
        return []
    spans = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        spans += [
            Span("assign", *m.span(), *m.span(2), m[1], 1.0)
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= MIN_ASSIGNED
        ]
    if "AKIA" in text:
        spans += [
            Span("access", *m.span(), *m.span(), "", 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS
        ]
    spans += [Span("hex", *m.span(), *m.span(), "", 1.0) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        spans += lexed(text, min_score)
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def find_secrets(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document with all its spans."""

    spans_type = pa.list_(
        pa.struct(
            [("kind", pa.string()), *((c, pa.int32()) for c in ("start", "end", "value_start", "value_end"))]
            + [("name", pa.string()), ("score", pa.float64())]
        )
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in by_bytes(batch):
                spans = [[s._asdict() for s in scan(text, min_score)] for text in some["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array(spans, spans_type)], ["doc_id", "spans"])

    return id_and_text(docs).mapInArrow(find, SPANS)


def mask(text: str | None, mark: str = "[secret]", min_score: float = MIN_SCORE) -> str | None:
    """The text with every secret value replaced; overlapping values are replaced as one."""
    spans = sorted((s.value_start, s.value_end) for s in scan(text, min_score))
    if not spans:
        return text
    out, done = [], 0
    for start, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def summary(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans and all spans in text form."""
    written = "transform({}, s -> concat(s.kind, ':', s.start, ':', s.end))"
    base = "filter(spans, s -> s.kind <> 'lexed')"
    counts = [
        F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(F.expr(written.format(base)), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(written.format("spans")), ",").alias("spans"),
        F.expr("coalesce(array_max(transform(spans, s -> s.score)), 0D)").alias("top_score"),
    )


def masked(docs: DataFrame, mark: str = "[secret]", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with all secret values replaced; every document stays."""
    return with_text(docs, lambda text: mask(text, mark, min_score))
