import random

import numpy as np
import xxhash

from blockflow.llm import simhash as S


def slow(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, d=2):
    """Smallest index reachable, by brute force."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= d:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprint():
    rng = random.Random(1)
    for _ in range(200):
        t = " ".join(rng.choices(["The", "a", "ÄB", "c\x1fd", "x y", "e\n\t", "long" * 9], k=rng.randint(0, 40)))
        assert S.fingerprint(t.encode()) == slow(t)


def test_same_hash_as_spark(spark):
    assert spark.sql("select xxhash64('a b c') h").first().h % (1 << 64) == S.fingerprint(b"A b\tC")


def near(rng, base, most):
    return base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most)))


def check(spark, values, p):
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in S.components(S.links(fps, p)).collect()}
    want = classes(values, p.distance)
    for i in range(len(values)):
        for j in range(i):
            same = got.get(signed[i], signed[i]) == got.get(signed[j], signed[j])
            assert same == (want[i] == want[j]), (i, j)


def test_links_against_brute_force(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(12)]
    values = list({near(rng, c, 4) for c in centres for _ in range(20)} | {rng.getrandbits(64) for _ in range(100)})
    check(spark, values, S.SimHashParams())


def test_crowded_values_lose_no_link(spark):
    rng = random.Random(4)
    c = rng.getrandbits(64)
    values = list({near(rng, c, 5) for _ in range(250)} | {near(rng, c ^ (2**64 - 1), 3) for _ in range(50)})
    for parts in ((2,), (3,), (4,)):
        check(spark, values, S.SimHashParams(bucket=8, partitions=parts))


def test_allocation():
    cost, t = S.allocate([22, 21, 21], {(i, k): 10.0 * k for i in range(3) for k in (0, 1)}, 100, 2)
    assert sum(t) == 0
    cost, t = S.allocate([22, 21, 21], {(0, 0): 1e9, (0, 1): 2e9, (1, 0): 1, (1, 1): 2, (2, 0): 1, (2, 1): 2}, 1, 2)
    assert sorted(t) == [-1, 0, 1] and t[0] == -1


def test_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r.node: r.root for r in S.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_whole_operator(spark):
    rng = random.Random(5)
    long = [" ".join(rng.choices([f"w{i}" for i in range(50)], k=400)) for _ in range(3)]
    rows = [(9, long[0]), (3, long[0].upper()), (4, long[0] + " tail"), (7, long[1]), (7, long[1]), (8, None), (6, ""), (None, " \n"), (5, long[2])]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, fp string")
    got = S.simhash_digest(docs).collect()
    assert len(got) == len(rows)
    fp = [slow(t) for _, t in rows]
    want = classes(fp)
    for r in got:
        k = next(k for k, (i, t) in enumerate(rows) if i == r.doc_id and f"{fp[k]:016x}" == r.fingerprint)
        assert r.component_id == min(i for j, (i, _) in enumerate(rows) if want[j] == want[k] and i is not None)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in got})
    assert S.simhash_digest(docs.limit(0)).count() == 0
    assert S.keep_one(docs.limit(0)).count() == 0


def test_bit_groups_follow_correlation():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    bits = bits.astype(float)
    groups = S.group_bits(bits.T @ bits, 4000, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({3, 40} <= set(g) for g in groups)



def test_one_row_of_each_component_stays(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    a, b, c, d, e = (" ".join(rng.choices(words, k=200)) for _ in range(5))
    # null ids: a copy of a named document, two texts without a named one (one of them twice); one id with two texts
    rows = [(1, a), (None, a), (None, b), (None, b.upper()), (None, c), (7, d), (7, e), (7, e), (9, e)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int")
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text.lower()) for r in kept.collect()) == sorted([(1, a), (0, b), (0, c), (7, d), (7, e)])
