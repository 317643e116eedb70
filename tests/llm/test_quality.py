import random
import re

from blockflow.llm import quality as Q


def slow(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    hit = {i + k for i, x in enumerate(win) if win.count(x) > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force(spark, sf_dir):
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "b ", "c\n", "ü", "#", "|", " ", "\n", "\x0b", "\x1c", "a b c d e "], k=rng.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " \n ", "x y z u v " * 3, "w " * 3000, "".join(f"k{i} " for i in range(30000))]
    docs = spark.createDataFrame([(i, t, "en", "clash") for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_words string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in Q.quality_digest(docs, labels).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts[:-1]):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow(t), t
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)
    assert got[len(texts) - 1].n_repeat_words == 0 and got[len(texts) - 1].n_words == 30000


def test_bound():
    assert not Q.is_safe(0, 100, 0.01, 0.05) and Q.is_safe(0, 299, 0.01, 0.05)
    assert not Q.is_safe(0, 298, 0.01, 0.05)
    assert not Q.is_safe(1, 299, 0.01, 0.05) and Q.is_safe(1, 473, 0.01, 0.05) and not Q.is_safe(1, 472, 0.01, 0.05)
    assert not Q.is_safe(0, 0, 0.5, 0.05)


def test_choice_stops_at_the_first_unsafe_cutoff():
    grid = Q.GRIDS["symbols_per_char"]
    p = Q.QualityParams()
    table = {("en", "symbols_per_char", 0, True): 9000, ("en", "symbols_per_char", 20, True): 900, ("en", "symbols_per_char", 30, False): 50, ("en", "symbols_per_char", 10, False): 50}
    (row,) = Q.choose(table, p)
    assert row[:3] == ("en", "symbols_per_char", grid[29]) and row[4:] == (0, 50)
    assert Q.choose({("en", "symbols_per_char", 0, True): 90, ("en", "symbols_per_char", 30, False): 50}, p) == []


def test_ladder_of_all_rules():
    table = {("en", Q.ALL, 0, True): 900, ("en", Q.ALL, 12, True): 1, ("en", Q.ALL, 5, True): 99, ("en", Q.ALL, 14, False): 30, ("en", "long_words", 0, True): 1000, ("en", "long_words", 3, False): 20}
    rows = Q.choose(table, Q.QualityParams())
    assert [r[1] for r in rows] == list(Q.GRIDS) and all(r[3:] == (1000, 0, 30) for r in rows)
    # the most lenient of the best cutoffs: step 7 of the ladder rejects from cell 14 on
    assert all(r[2] == Q.ladder(r[1], 7) for r in rows)
    assert all(Q.ladder(r, Q.STEPS) == g[0] and Q.ladder(r, 1) == g[-1 - (len(g) - 1) // Q.STEPS] for r, g in Q.GRIDS.items())


def test_false_rejections_are_limited(spark):
    """Rejections on fresh documents of the same kind stay below alpha in nearly all draws."""
    rng, p, failed, acted = random.Random(5), Q.QualityParams(), 0, 0
    grid = Q.GRIDS["symbols_per_char"]
    for _ in range(200):
        draw = lambda good, n: [min(len(grid), int(rng.expovariate(0.25 if good else 0.05))) for _ in range(n)]
        table = {}
        for good, n in ((True, 300), (False, 60)):
            for c in draw(good, n):
                table["en", "symbols_per_char", c, good] = table.get(("en", "symbols_per_char", c, good), 0) + 1
        for _, _, cutoff, *_ in Q.choose(table, Q.QualityParams(cost=0.5)):
            j = grid.index(cutoff)
            acted += 1
            failed += sum(c > j for c in draw(True, 4000)) / 4000 > p.alpha
    assert acted > 100 and failed <= 0.1 * acted


def test_rules_apply_by_stratum(spark):
    good = [(i, "some plain words in a row that are fine here to read x%d y%d" % (i, i), "en") for i in range(4000)]
    bad = [(5000 + i, "## ** $$ %% some words that are not ## so ** fine x$%d" % i, "en") for i in range(200)]
    other = [(6000 + i, t, "fr") for i, (_, t, _) in enumerate(bad[:20])]
    rows = good + bad + other + [(None, bad[0][1], "en"), (7000, bad[0][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good] + [(i, 0, 0) for i, *_ in bad + other] + [(7000, 0, 0), (7000, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.quality_digest(docs, labels).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {i for i, *_ in good} | {i for i, *_ in other} | {7000}
    stay = Q.keep_good(docs, labels)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == kept
    assert Q.quality_digest(docs.limit(0), labels.limit(0)).count() == 0
