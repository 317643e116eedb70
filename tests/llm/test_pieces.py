import random

import public_tokenizers
import pytest
import sentencepiece

from blockflow.llm import pieces as E

PATH = public_tokenizers.path("piece_bpe_32k.model")


def every(lattice, s):
    """All segmentations, by brute force."""
    if not s:
        return [(0.0, [])]
    out = []
    for n in range(1, len(s) + 1):
        if s[:n] in lattice.scores:
            i, score = lattice.scores[s[:n]]
            out += [(score + r, [i, *ids]) for r, ids in every(lattice, s[n:])]
        elif n == 1:
            data = s[0].encode()
            out += [(lattice.byte_score * len(data) + r, [*(lattice.byte_ids[b] for b in data), *ids]) for r, ids in every(lattice, s[1:])]
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_unit_nbest_equals_brute_force(n):
    rng = random.Random(n)
    pieces = {"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(25)} | {"a", "b"}
    lattice = E.Lattice({p: (300 + i, -rng.random() * 5) for i, p in enumerate(sorted(pieces))}, list(range(256)), -9.0)
    for _ in range(150):
        s = "".join(rng.choices("abcé", k=rng.randint(0, 8)))
        want = sorted(every(lattice, s), key=lambda x: (-x[0], x[1]))[:n]
        got = lattice.nbest(s, n)
        assert [round(a, 6) for a, _ in got] == [round(a, 6) for a, _ in want], s


def test_text_nbest_equals_brute_force():
    m = E.PieceModel(PATH, 5)
    rng = random.Random(3)
    for _ in range(120):
        t = "".join(rng.choices(["a", "in", " ", "\n", "▁", "é", "t", "日"], k=rng.randint(0, 6)))
        want = sorted((-s, ids) for s, ids in every(m.lattice, m.normalise(t)))[:5]
        got = m.encode(t)
        assert [round(s, 6) for s, _ in got] == [round(-s, 6) for s, _ in want], t
        assert m.decode(list(memoryview(got[0][1]).cast("I"))) == t.replace("▁", " ")


def test_ids_mean_what_the_library_says(spark, sf_dir):
    s = sentencepiece.SentencePieceProcessor(model_file=PATH)
    m = E.PieceModel(PATH, 2)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()] + ["  a\tb\x00 ", "日本 🙂"]
    for t in texts:
        for _, ids in m.encode(t):
            ids = list(memoryview(ids).cast("I"))
            assert s.decode(ids) == t == m.decode(ids)
        assert m.decode(s.encode(t)) == t


def test_many_equal_paths():
    m = E.PieceModel(PATH, 3)
    t = "a" * 20000 + " " * 5000
    assert m.decode(list(memoryview(m.encode(t)[0][1]).cast("I"))) == t


def test_whole_operator(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "in the end", 2), (3, "in the end", 2), (None, "x", 3), (5, "w " * 200000, 3)], "doc_id long, text string, n_pieces int")
    got = E.pieces_digest(docs).collect()
    assert sorted((r.doc_id or 0, r.round_trip) for r in got) == [(0, True), (1, True), (2, True), (3, True), (3, True), (5, True)]
    by = {r.doc_id: r for r in got}
    assert by[1].n_pieces == 0 and by[1].best_score == 0 and by[1].nbest_scores == [0.0]
    assert by[3].nbest_scores == sorted(by[3].nbest_scores, reverse=True) and len(by[3].nbest_scores) == 3
    enc = E.encode_nbest(docs).selectExpr("doc_id", "segmentations[0].ids as ids")
    back = {r.doc_id: r.text for r in E.decode(enc).collect()}
    assert back == {1: "", 2: "", 3: "in the end", None: "x", 5: "w " * 200000}
    assert E.pieces_digest(docs.limit(0)).count() == 0
