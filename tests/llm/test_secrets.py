import hashlib
import random
import re

import pytest

from blockflow.llm import secrets as S


def brute(text):
    """The contract's base spans, by plain expressions."""
    out = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    for k, (p, n) in enumerate(((r"AKIA[A-Z0-9]+", 16), (r"[0-9a-f]+", 32)), 1):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text) if m.end() - m.start() >= n]
    return [(a, b, k) for a, k, b in sorted(out)]


PARTS = ["password", "PASSWD", "Secret", "token", "api_key", "apikey", '"', "'", " ", ":", "=", "AKIA", "ABCDEF0123456789", "0123456789abcdef" * 2, "deadbeef", "ü", "K", "ſ", "x" * 7, "x" * 9, "\n", "ghp_", "A" * 36, "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "\0"]


def test_base_spans_equal_brute_force():
    rng = random.Random(7)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(3000)] + [None, ""]
    for t, spans in zip(texts, S.scan_block(texts), strict=True):
        assert [s for s in spans if s[2] < 3] == brute(t or "")


def test_candidates_lose_no_match():
    rng = random.Random(8)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(2000)]
    full = [sorted(((m.start(), m.end(), k) for k, r in enumerate(S.RULES) for m in r.compiled.finditer(t) if r.keep is None or r.keep(m)), key=lambda s: (s[0], s[2])) for t in texts]
    assert S.scan_block(texts) == full


@pytest.mark.parametrize("pattern, expected", [("abcd", ("and", (b"abc", b"bcd"))), ("[0-9a-f]+", True), ("ab", True), ("x*", True), ("abc|de", True), ("(?:abc|bcd)x?", ("or", (b"abc", b"bcd"))), ("a{3}", b"aaa"), ("abc.*def", ("and", (b"abc", b"def")))])
def test_trigram_queries(pattern, expected):
    assert S.trigram_query(pattern) == expected


def test_whole_operator(spark):
    rows = [(1, None, "x"), (2, "", "y"), (2, "token = abcdefgh12", "y"), (None, "é AKIA" + "A" * 12 + " " + "0f" * 20, "z"), (5, "w " * 90000 + "secret: 12345678", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex): r for r in S.secret_digest(docs).collect()}
    assert set(got) == {(1, 0, 0, 0), (2, 0, 0, 0), (2, 1, 0, 0), (None, 0, 1, 1), (5, 1, 0, 0)}
    assert got[(1, 0, 0, 0)].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[(None, 0, 1, 1)].spans == "access:2:18,hex:19:59"
    assert got[(5, 1, 0, 0)].spans == "assign:180000:180016"
    spans = {r.doc_id: r.spans for r in S.find_secrets(docs).where("doc_id = 5").collect()}
    assert spans[5][0].kind == "assign"
    red = {r.text for r in S.redact(docs).where("doc_id = 2").collect()}
    assert red == {"", "<assign>"}
    assert S.redact(docs).columns == docs.columns
    assert S.secret_digest(docs.limit(0)).count() == 0
