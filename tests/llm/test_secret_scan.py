from __future__ import annotations

import hashlib
import random
import re

from llm_cases import SF_SMALL, odd_rows, table  # noqa: F401 - fixtures
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import secret_scan as S


def base(text):
    out = []
    for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A
    ):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


PIECES = ["password", "Token", '"', "'", " ", "=", ":", "abc123", "AKIA", "ABCDEFGH", "0f" * 13, "\n", "é", "api_key", "x"]


@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
@settings(max_examples=400, deadline=None)
def test_base_spans(text):
    assert [(s.kind, s.start, s.end) for s in S.scan(text) if s.kind != "lexed"] == base(text)


def test_assignments_in_several_syntaxes():
    text = (
        'pw = "Tr0ub4dor&3x"\npassword = pw\n{"client-secret": "a8F!kk20xx"}\nexport AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7\n'
        "auth_token := 'zz' + \"91-ABqq.7\"\nname = \"nobody here\"\nsecret = \"changeme\"\n"
    )
    found = [(text[s.start : s.end], s.name) for s in S.lexed(text)]
    assert ("Tr0ub4dor&3x", "password") in found and ("a8F!kk20xx", "client-secret") in found
    assert ("wJalrXUtnFEMI/K7", "AWS_SECRET_ACCESS_KEY") in found and ("91-ABqq.7", "auth_token") in found
    assert not any("nobody" in value or "changeme" in value for value, _ in found)


def test_doubling_constants_stay_bounded():
    text = 'a = "0123456789abcdefXYZ"\n' + "a = a + a\n" * 60 + "password = a\n"
    assert len(S.lexed(text)) <= S.MAX_PARTS


def test_literals_of_any_length_and_number_of_parts():
    rng = random.Random(7)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for size in (4096, 4097, 4364, 200_000):
        value = "".join(rng.choice(signs) for _ in range(size))
        text = f"users:\n  client-key-data: {value}\n"
        assert [(s.start, s.end) for s in S.lexed(text)] == [(text.index(value), text.index(value) + size)]
        assert value not in S.mask(text) and S.mask(text).startswith("users:\n  client-key-data: [secret]")
        assert value not in S.mask(f'k = "{value}"\npassword = k\n')
    parts = ["".join(rng.choice(signs) for _ in range(8)) for _ in range(70)]
    spans = S.lexed("private_key = " + " + ".join(f'"{p}"' for p in parts))
    assert len(spans) == 70


def plain_lexed(text):
    """Assignments of one plain syntax, constants replaced, every name and literal scored."""
    constants, out = {}, {}
    for m in re.finditer(r'(?m)^(\w+) = (?:"([^"\n]*)"|(\w+))$', text):
        place = m.span(2) if m[2] is not None else m.span(3)
        value, place = constants.get(m[3], (m[3], place)) if m[2] is None else (m[2], place)
        constants[m[1]] = (value, place)
        if S.name_score(m[1]) * S.literal_score(value) >= S.MIN_SCORE:
            out.setdefault(place)
    return sorted(out)


LINES = st.tuples(
    st.sampled_from(["a", "b", "password", "db_token", "name", "apiKey"]),
    st.sampled_from(['"x9F!k20Qz"', '"changeme"', '"abc"', '"Zk3#plm8/Qw"', "a", "b", "nobody1"]),
)


@given(st.lists(LINES, max_size=8))
@settings(max_examples=200, deadline=None)
def test_lexed_spans_of_plain_assignments(lines):
    text = "".join(f"{name} = {value}\n" for name, value in lines)
    assert sorted({(s.start, s.end) for s in S.lexed(text)}) == plain_lexed(text)


def test_overlapping_spans_are_all_reported():
    text = 'api_key = "0123456789abcdef0123456789abcdef"'
    assert [s.kind for s in S.scan(text)] == ["assign", "hex", "lexed"]
    assert S.mask(text) == 'api_key = "[secret]"'


def test_masking():
    assert S.mask("a password = hunter2xx b") == "a password = [secret] b"
    assert S.mask("plain words") == "plain words" and S.mask(None) is None


def test_documents(spark, table, odd_rows):
    rows = [*odd_rows, (20, "x token=abcdef1 y"), (21, "AKIA" + "A" * 16)]
    rows += [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 100", "text").collect()]
    out = S.summary(S.find_secrets(table(rows))).collect()
    assert len(out) == len(rows)
    for row, (i, text) in zip(out, rows, strict=True):
        spans = base(text or "")
        assert row.doc_id == i and [row.n_assign, row.n_access, row.n_hex] == [
            sum(s[0] == kind for s in spans) for kind in ("assign", "access", "hex")
        ]
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) - {""} <= set(row.spans.split(","))
    masked = {r.doc_id: r for r in S.masked(table(rows)).collect()}
    assert masked[20].text == "x token=[secret] y" and masked[20].n_chars == len(masked[20].text)
    assert S.find_secrets(table([])).collect() == []
