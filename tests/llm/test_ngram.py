import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockflow.llm import ngram as N
from blockflow.llm.arraystore import discounts

S, E = "<s>", "</s>"


class Slow:
    """Interpolated modified Kneser-Ney with dictionaries of tuples."""

    def __init__(self, texts, order):
        self.order = order
        top, self.raw = Counter(), Counter()
        for t in texts:
            w = [S] * (order - 1) + t + [E]
            for i in range(order - 1, len(w)):
                top[tuple(w[i - order + 1 : i + 1])] += 1
                self.raw[w[i]] += 1
        self.c = {order: top}
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d = {k: discounts(*(sum(v == x for v in c.values()) for x in (1, 2, 3, 4))) for k, c in self.c.items()}
        self.follow = {k: defaultdict(list) for k in self.c}
        for k, c in self.c.items():
            for g, n in c.items():
                self.follow[k][g[:-1]].append(n)

    def cut(self, k, n):
        return min(n, self.d[k][min(n, 3) - 1]) if n else 0

    def p(self, h, w, k=None):
        k = self.order if k is None else k
        if k == 0:
            return 1 / (len(self.raw) + 1)
        h = tuple(h[len(h) - k + 1 :]) if k > 1 else ()
        low = self.p(h[1:], w, k - 1)
        own = self.follow[k].get(h)
        if not own:
            return low
        n = self.c[k].get((*h, w), 0)
        return (n - self.cut(k, n)) / sum(own) + sum(self.cut(k, x) for x in own) / sum(own) * low


def corpus(rng, n):
    words = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    return [rng.choices(words, weights, k=rng.choice([0, 1, 2, 5, 30])) for _ in range(n)]


@pytest.mark.parametrize("order, shards, fan", [(1, 3, 9), (2, 5, 9), (3, 1, 9), (3, 12, 4), (4, 7, 9)])
def test_equals_brute_force(spark, order, shards, fan):
    rng = random.Random(order)
    texts = corpus(rng, 150) + [["w0"] * 700]
    test = corpus(rng, 40) + [["new", "w1", "new"], ["w0"] * 20]
    docs = spark.createDataFrame([(i, " \n".join(t).upper()) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    model = N.train(docs, N.NgramParams(order=order, tokens=300, shards=shards, fan=fan, sample=20))
    slow = Slow(texts, order)
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(test)], "doc_id long, text string")
    total, vocabulary = sum(slow.raw.values()), len(slow.raw)
    got = {r.doc_id: r._lm for r in N.score(rows, model).collect()}
    for i, t in enumerate(test):
        w = [S] * (order - 1) + t + [E]
        want = sum(math.log10(slow.p(w[:k], w[k])) for k in range(order - 1, len(w)))
        base = sum(math.log10((slow.raw[x] + 0.5) / (total + 0.5 * (vocabulary + 1))) for x in t + [E])
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t) + 1, sum(x in slow.raw for x in t) + 1, total)
        assert abs(r.base_score - base) < 1e-9 * (1 + abs(base))
        assert abs(r.score - want) < 1e-9 * (1 + abs(want)), (order, t)
    for h in ([S] * 3, ["w0", "w1", "w2"], ["new", "w5", "w0"]):
        assert abs(sum(slow.p(h, w) for w in slow.raw) + slow.p(h, "?") - 1) < 1e-9


def test_blobs():
    rng = np.random.default_rng(1)
    plain = np.unique(rng.integers(0, 1 << 48, 60).astype(np.uint64))
    words = N.Codes(rng.permutation(plain[::2]))
    own = [rng.choice(plain, 400) for _ in range(2)]
    t = [words.coded(x) for x in own]
    assert {int(x) >> 48 for x in t[0]} == {0, 1} and all(np.array_equal(words.plain(x), y) for x, y in zip(t, own, strict=True))
    assert np.array_equal(words.keys(t), N.chain(own))
    v = [rng.integers(0, 1 << 40, 400).astype(np.uint64), np.zeros(400, np.uint64)]
    a, b = N._unpack(N._pack(t, v), 2, 2)
    assert all(np.array_equal(x, y) for x, y in zip(t + v, a + b, strict=True))


@pytest.mark.parametrize("n", [0, 1, 5, 40_000])
def test_layout(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, 2 * n + 1).astype(np.uint64))
    rng.shuffle(keys)
    own, other = np.sort(keys[:n]), keys[n:]
    counts = rng.choice(np.array([0, 1, 7, 254, 255, 256, 1 << 40], dtype=np.uint64), n)
    more = rng.integers(0, 1000, n).astype(np.uint64)
    arrays = N._layout(own, {"count": counts, "more": more})
    at, ok = N._places(arrays, own)
    got = N._values(arrays, ("more", "count"), at)
    assert ok.all() and np.array_equal(got[0], more.astype(float)) and np.array_equal(got[1], counts.astype(float))
    assert not N._places(arrays, other)[1].any()


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "A b", "x"), (2, "A b", "x"), (None, "a\x1cb c\x0bd", None), (9, "long " * 300000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = N.ngram_digest(docs, F.lit(True)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in out) == [(0, 4, 4), (1, 1, 1), (2, 1, 1), (2, 3, 3), (2, 3, 3), (9, 300001, 300001)]
    none = N.ngram_digest(docs, F.lit(False)).collect()
    assert {(r.n_known, r.base_score, r.score) for r in none} == {(0, 0.0, 0.0)}
    assert N.ngram_digest(docs.limit(0), F.lit(True)).count() == 0


def test_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    r = N.ngram_digest(docs, learn).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_query_uses_more_than_one_word_of_context(spark):
    # after "a x" comes b, after "c x" comes d: one word of context can't tell
    docs = spark.createDataFrame([(k, "a x b" if k % 2 else "c x d") for k in range(200)] + [(1000, "a x b"), (1001, "a x d")], "doc_id long, text string")
    got = {r.doc_id: r.perplexity for r in N.ngram_digest(docs, F.col("doc_id") < 1000).collect()}
    assert got[1000] * 1.5 < got[1001]
