import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as C
from blockflow.llm import nearcopies as N
from blockflow.llm.simhash import row_keys


def shingle_set(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def edited(rng, text, n):
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.random()}"
    return " ".join(w)


def test_edited_copies_do_not_survive_the_pipeline_s_stages(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(20)]
    rows = [(100 * k, t) for k, t in enumerate(base)] + [(100 * k + j, edited(rng, t, 4)) for k, t in enumerate(base) for j in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, stage in C.STAGES:
        if name.startswith("near_"):
            docs = stage(spark, docs, "")
    left = {r.doc_id for r in docs.collect()}
    # two edited copies of one text may be less alike than each is to the text
    assert left == {100 * k for k in range(20)}


def similar_pairs(texts):
    """Pairs of keys whose texts have a Jaccard similarity of 0.8 or more, by shared shingles."""
    sets, by = {i: shingle_set(t) for i, t in texts.items()}, {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, set()).add(i)
    want = set()
    for i, s in sets.items():
        shared = {}
        for x in s:
            for j in by[x]:
                if j > i:
                    shared[j] = shared.get(j, 0) + 1
        want |= {(i, j) for j, n in shared.items() if n / (len(s) + len(sets[j]) - n) >= 0.8}
    return want


def test_links_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = N.features(docs).select("id", F.col("h1").alias("node"), F.col("h1").alias("group"), "keys").cache()
    of = {r.node: r.id for r in rows.collect()}
    keyed = docs.select(row_keys(docs, "doc_id", "text")[0].alias("_node"), F.coalesce("text", F.lit("")).cast("binary").alias("_text"))
    got = N.links(rows.select("node", "group", "keys"), lambda nodes: keyed.join(nodes.withColumnRenamed("node", "_node"), "_node", "left_semi"))
    want = similar_pairs(texts)
    assert {tuple(sorted((of[r.a], of[r.b]))) for r in got.collect()} == want and len(want) > 50


def test_crowded_keys_and_edges(spark):
    rng = random.Random(2)
    base = " ".join(f"x{i}" for i in range(400))
    rows = [(k, edited(rng, base, 2)) for k in range(150)] + [(None, edited(rng, base, 2)), (900, "a b"), (901, "A  B"), (902, "a b c"), (903, None), (904, "")]
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, _h1 string, keys int")
    kept = N.keep_distinct(docs, N.NearCopyParams(bucket=10))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 900, 902, 903]
    assert N.keep_distinct(docs.limit(0)).count() == 0
    only = spark.createDataFrame([(None, "a b"), (None, "A b"), (None, "c d"), (None, "c d"), (5, "e f"), (5, "e f"), (5, "g " * 200_000)], "doc_id long, text string")
    assert sorted(r.text[:5].lower() for r in N.keep_distinct(only).collect()) == ["a b", "c d", "e f", "g g g"]


def test_whole_groups_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(25)]
    rows = list(enumerate(base + [edited(rng, t, k) for t in base for k in (1, 3, 9)] + base[:5]))
    rng.shuffle(rows)
    kept = {r.doc_id for r in N.keep_distinct(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    left = {}  # exact copies first
    for i in sorted(texts):
        left.setdefault(texts[i], i)
    texts = {i: t for t, i in left.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in similar_pairs(texts):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    assert kept == {find(i) for i in texts}


def test_crowded_keys_lose_no_group(spark):
    """Texts that share a long passage meet under crowded keys in many groups; a chain's ends are alike only through others."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(110))
    texts = []
    for g in range(40):
        t = passage + " " + " ".join(f"g{g}_{i}" for i in range(rng.choice([40, 60])))
        for _ in range(rng.choice([1, 2, 6])):
            texts.append(t)
            t = edited(rng, t, rng.choice([2, 3]))
    texts = dict(enumerate(dict.fromkeys(texts)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = similar_pairs(texts)

    def groups(pairs):
        root = {i: i for i in texts}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        return {i: find(i) for i in texts}

    rows = N.features(docs).select("id", F.col("h1").alias("node"), F.col("h1").alias("group"), "keys").cache()
    of = {r.node: r.id for r in rows.collect()}
    keyed = docs.select(row_keys(docs, "doc_id", "text")[0].alias("_node"), F.col("text").cast("binary").alias("_text"))
    p = N.NearCopyParams(bucket=3)
    got = N.links(rows.select("node", "group", "keys"), lambda nodes: keyed.join(nodes.withColumnRenamed("node", "_node"), "_node", "left_semi"), p)
    got = {tuple(sorted((of[r.a], of[r.b]))) for r in got.collect()}
    assert got <= want and groups(got) == groups(want)
    assert 1 < len(set(groups(want).values())) < len(texts)
    kept = {r.doc_id for r in N.keep_distinct(docs, p).collect()}
    assert kept == set(groups(want).values())


def test_candidates_of_edited_copies_are_few_and_whole(spark):
    """A group of near copies too far from each other makes hardly a pair; no similar pair of any sizes is left out."""
    rng = np.random.default_rng(8)
    sets = {}
    for k in range(60):  # 15 of 100 members replaced: similarity to each other some 0.6
        own = rng.choice(100, 85, replace=False)
        sets[k] = {*own.tolist(), *range(1000 * (k + 1), 1000 * (k + 1) + 15)}
    few = spark.createDataFrame([(k, k, k, True) for k in sets], "node long, group long, root long, outside boolean")
    rows = spark.createDataFrame([(k, sorted(s)) for k, s in sets.items()], "node long, s array<long>")
    assert N.candidates(few, rows, N.NearCopyParams()).count() < 60
    for k in range(60, 260):  # edits of others, or of such edits
        base = sorted(sets[int(rng.integers(0, k))])
        gone = set(rng.choice(base, int(rng.integers(0, len(base) // 6 + 1)), replace=False).tolist())
        sets[k] = {*base} - gone | {*rng.integers(0, 140, int(rng.integers(0, 12))).tolist()}
    nodes = spark.createDataFrame([(k, k, k % 90, k % 3 > 0) for k in sets], "node long, group long, root long, outside boolean")
    rows = spark.createDataFrame([(k, sorted(s)) for k, s in sets.items()], "node long, s array<long>")
    got = {(r.a, r.b) for r in N.candidates(nodes, rows, N.NearCopyParams()).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and a % 90 != b % 90 and (a % 3 or b % 3) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(want) > 150 and want <= got
