import numpy as np
import pytest
from pyspark.sql import functions as F

from blockflow.llm import gbt as G
from blockflow.llm import toxicity as T
from blockflow.llm.common import held_out


def test_trees_learn_and_expressions_agree(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    m = G.boost(x, y, G.BoostParams(trees=30, depth=3))
    assert ((m.margin(x) > 0) == y).mean() > 0.98
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in x[:200]], "a double, b double, c double")
    got = np.array([r.m for r in df.select(m.expression([F.col("a"), F.col("b"), F.col("c")]).alias("m")).collect()])
    assert np.allclose(got, m.margin(x[:200]))
    assert G.boost(x, np.zeros(3000)).trees == [] and G.boost(x[:0], y[:0]).base == 0


def test_isotonic():
    s = np.array([1.0, 2, 3, 4, 5, 5])
    xs, ps = G.isotonic(s, np.array([0, 1, 0, 1, 1, 1]))
    assert ps == sorted(ps) and xs == sorted(xs)
    assert G.calibrated(xs, ps, np.array([2.0]))[0] == G.calibrated(xs, ps, np.array([3.0]))[0]
    assert G.isotonic(np.zeros(0), np.zeros(0)) == ([0.0], [0.5])


def test_features():
    f = T.Features({"clown": 3.0, "lowe*": 2.0})
    x = dict(zip(T.FEATURES, f.text("You CLOWN, loweings and cl0wn!"), strict=True))
    assert abs(x["lexicon_density"] - 3 / 5) < 1e-9 and abs(x["hidden_density"] - 1 / 5) < 1e-9
    assert x["lexicon_heaviest"] == 3 and x["near_second_person"] == 1 and x["nearest_second_person"] == 1 and abs(x["caps_words"] - 1 / 5) < 1e-9
    assert f.text(None) == f.text(" \n") == [0.0] * len(T.FEATURES)


def corpus(spark):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("n", "lt", "ma", "rok")]
    rows = []
    for i in range(1500):
        w = list(rng.choice(words, 40))
        if i % 10 == 0:
            for _ in range(4):
                w.insert(int(rng.integers(40)), ["scumbag", "vequot" + w[0], "You"][int(rng.integers(3))])
        rows.append((i, " ".join(w), int(i % 10 == 0)))
    return rows


def test_held_out_documents(spark):
    rows = corpus(spark)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in T.toxicity_digest(docs, labels, ~held_out(3, 1)).collect()}
    truth = {i: y for i, _, y in rows}
    has = {i: "scumbag" in t or "vequot" in t for i, t, _ in rows}
    held = [r for r in got.values() if r.held_out]
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    assert sum(r.predicted for r in held if truth[r.doc_id] and has[r.doc_id]) >= 0.9 * sum(has[r.doc_id] for r in held)
    assert sum(r.predicted for r in held if not truth[r.doc_id]) == 0


def test_edge_cases(spark):
    rows = [(i, "plain words here", 0) for i in range(40)] + [(100 + i, "you scumbag there", 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1, "plain words here"), (500, None), (501, ""), (None, "you scumbag"), (502, "word " * 200000 + "scumbag"), (503, "z" * 200000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, None, y) for i, _, y in rows] + [(0, 1, 1), (None, 1, 1), (501, 1, None)], "doc_id long, quality int, toxic int")
    out = T.toxicity_digest(docs, labels, F.lit(True)).collect()
    assert len(out) == docs.count()
    by = {r.doc_id: r for r in out}
    assert by[None].predicted == 1 and by[2].predicted == 0 and by[500].score == by[501].score and by[500].predicted == 0
    none = T.toxicity_digest(docs, labels.limit(0), F.lit(True)).collect()
    assert {r.score for r in none} == {0.0}
    assert T.toxicity_digest(docs.limit(0), labels, F.lit(True)).count() == 0


def test_sample_is_bounded_and_copies_stay_together(spark):
    rows = [(i % 30, f"text {i % 45} you") for i in range(300)] + [(100 + i, f"other {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 30)) for i in {r[0] for r in rows}], "doc_id long, quality int, toxic int")
    few = T.labelled(docs, labels, F.lit(True), T.ToxicityParams(sample=20)).collect()
    assert 0 < len(few) <= 20
    every = T.labelled(docs, labels, F.lit(True), T.ToxicityParams()).collect()
    assert len(every) == 230
    assert all(len({(r.half, r.fold) for r in every if r._text == t}) == 1 for t in {r._text for r in every})
    with pytest.raises(ValueError):
        T.score(docs.withColumn("score", F.lit(1)), {})
