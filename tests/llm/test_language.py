import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockflow.llm import language as L
from blockflow.llm.arraystore import discounts, find, mix, open_arrays, write_arrays


def slow_model(counts, order, alphabet):
    """Interpolated modified Kneser-Ney of one language with dictionaries; returns p(symbol | context)."""
    top = Counter()
    for w, c in counts.items():
        s = L.START * (order - 1) + w + L.END
        for i in range(order - 1, len(s)):
            top[s[i - order + 1 : i + 1]] += c
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    d = {k: discounts(*(sum(c == x for c in v.values()) for x in (1, 2, 3, 4))) for k, v in levels.items()}

    def cut(k, c):
        return min(c, d[k][0] if c == 1 else d[k][1] if c == 2 else d[k][2])

    def prob(context, x, k):
        if k == 0:
            return 1 / (alphabet + 1)
        context = context[len(context) - (k - 1) :] if k > 1 else ""
        own = {g: c for g, c in levels[k].items() if g[:-1] == context}
        lower = prob(context, x, k - 1)
        if not own:
            return lower
        total = sum(own.values())
        c = own.get(context + x, 0)
        return (c - cut(k, c) if c else 0) / total + sum(cut(k, c) for c in own.values()) / total * lower

    return prob


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_models_equal_brute_force(order):
    rng = random.Random(order)
    counts = {lang: Counter("".join(rng.choices(abc, k=rng.randint(1, 6))) for _ in range(60)) for lang, abc in (("x", "aab"), ("y", "bcd"))}
    arrays = L.fit(counts, order)
    alphabet = 4 + 1
    scorer = L.Scorer(arrays, ["x", "y"], order)
    words = [*counts["x"], *counts["y"], "zzz", "abz", "q"]
    got = scorer.words(words)
    for j, lang in enumerate(("x", "y")):
        prob = slow_model(counts[lang], order, alphabet)
        for i, w in enumerate(words):
            s = L.START * (order - 1) + w + L.END
            want = sum(np.log(prob(s[max(0, k - order + 1) : k], s[k], order)) for k in range(order - 1, len(s)))
            assert abs(got[i, j] - want) < 1e-3 * (1 + abs(want)), (order, lang, w)
    assert got[:, -1].tolist() == [len(w) + 1 for w in words]


def test_probabilities_sum_to_one():
    counts = {"x": Counter({"abab": 3, "ba": 2, "aab": 1, "b": 4})}
    prob = slow_model(counts["x"], 3, 3)
    for ctx in (L.START * 2, "ab", "zz", "b" + "a"):
        assert abs(sum(prob(ctx, x, 3) for x in ("a", "b", L.END, "?")) - 1) < 1e-9


def test_array_store(tmp_path):
    a = {"k": np.arange(5, dtype=np.uint64), "e": np.zeros((0, 3), np.float32), "m": np.ones((2, 3), np.float32)}
    write_arrays(f"file://{tmp_path}/a b/x.arrays", a, note="é")
    got, extra = open_arrays(f"file://{tmp_path}/a b/x.arrays")
    assert extra == {"note": "é"} and all(np.array_equal(got[k], a[k]) and got[k].dtype == a[k].dtype for k in a)
    assert find(a["k"], np.array([3, 9], np.uint64))[1].tolist() == [True, False]
    assert mix(np.uint64([1]), np.uint64([2])) != mix(np.uint64([2]), np.uint64([1]))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    out = L.language_digest(docs, learn).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in out)
    assert right >= 0.97 * len(out)
    assert sum(not r.accepted for r in out) <= 0.02 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_edge_cases(spark):
    rows = [(i, "the cat sat on the mat %d" % i, "en", "x") for i in range(30)] + [(100 + i, "le chat est sur la table", "fr", "x") for i in range(30)]
    rows += [(200, None, "en", "x"), (201, "", "en", None), (202, "123 ½² !!_", "fr", "x"), (203, "the mat", None, "x"), (None, "la table", None, "x"), (204, "日本語 текст", None, "x"), (205, "the " * 40000, "en", "x"), (206, "a" * 30000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r for r in L.language_digest(docs, F.lit(True)).collect()}
    assert len(got) == len(rows)
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and got[200].score == 0 and not got[202].accepted
    assert got[203].lang_pred == "en" and got[None].lang_pred == "fr" and got[205].lang_pred == "en"
    assert got[204].lang_pred in ("en", "fr") and got[206].lang_pred in ("en", "fr")
    kept = L.keep_identified(docs, F.lit(True))
    assert kept.columns == docs.columns and {1, 101, 203} <= {r.doc_id for r in kept.collect()} and not {200, 201, 202} & {r.doc_id for r in kept.collect()}
    assert {r.lang_pred for r in L.language_digest(docs, F.lit(False)).collect()} == {"und"}
    assert L.language_digest(docs.limit(0), F.lit(True)).count() == 0
