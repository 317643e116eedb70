import numpy as np
import pytest
from pyspark.sql import functions as F

from blockflow.llm import media as M

P = M.MediaParams()


def song(seed, seconds=8, rate=4000):
    rng = np.random.default_rng(seed)
    return samples(M.render(list(rng.normal(0, 0.5, int(seconds / 0.125))), rate))


def samples(w):
    return (M.samples_of(w, 4000) * 32768).astype(np.int16)


def bits(a, b):
    return float(np.bitwise_count(a ^ b).sum()) / (32 * len(a))


def test_integral_image_equals_sums():
    c = np.random.default_rng(0).random((40, 12))
    got = M.integers(c)
    assert len(got) == 40 - M.WIDTH + 1
    kind, y, h, w = M.filters()[0]
    for t in (0, 7, 24):
        a, b = c[t : t + w, y : y + h].sum() * 12 / h, c[t : t + w].sum()
        v = np.log((1 + a) / (1 + b))
        q = int(v > -0.25) + int(v > 0) + int(v > 0.25)
        assert int(got[t]) >> 30 == q ^ (q >> 1)


def test_noise_keeps_most_bits_and_other_recordings_do_not():
    x = song(1)
    noisy = (x + np.random.default_rng(2).normal(0, 600, len(x))).astype(np.int16)
    a, b, c = (M.fingerprint(M.wav(s, 4000)) for s in (x, noisy, song(3)))
    assert bits(a, b) < 0.1 < 0.25 < bits(a, c)


def test_rate_and_channels():
    x = song(4, rate=4000)
    import io, wave  # noqa: E401

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.repeat(np.repeat(x, 2), 2).astype("<i2").tobytes())
    a, b = M.fingerprint(M.wav(x, 4000)), M.fingerprint(out.getvalue())
    n = min(len(a), len(b))
    assert n > 50 and bits(a[:n], b[:n]) < 0.1


@pytest.mark.parametrize("bad", [None, b"", b"RIFF", b"x" * 100, M.wav(np.zeros(10, np.int16), 4000), M.wav(np.zeros(50000, np.int16), 4000)[:45]])
def test_broken_recordings_have_no_integers(bad):
    assert len(M.fingerprint(bad)) == 0


def test_alignment_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [song(10 + k) for k in range(12)]
    media = {}
    for k, x in enumerate(base):
        media[100 * k] = x
        media[100 * k + 1] = x[256 * 20 :]  # starts 20 hops later
        media[100 * k + 2] = (x + rng.normal(0, 300, len(x))).astype(np.int16)
        media[100 * k + 3] = x.copy()
    media[5000], media[5001] = np.zeros(30000, np.int16), np.zeros(33000, np.int16)
    df = spark.createDataFrame([(i, bytearray(M.wav(x, 4000))) for i, x in media.items()], "vec_id long, media binary")
    fps = M.fingerprints(df, "vec_id", "media", P)
    table, members = M.classes(fps)
    assert {(r.id, r.class_id) for r in members.where("id % 100 in (0, 3) and id < 5000").collect()} == {(100 * k + j, 100 * k) for k in range(12) for j in (0, 3)}
    queries = table.where("class_id % 100 = 0 and size(items) > 0")
    got = {(r.class_id, r.match_id): r for r in M.align(table.where("size(items) > 0"), queries, P).join(table.select("h", "class_id"), "h").collect()}
    items = {r.class_id: np.array(r["items"], dtype=np.int32).view(np.uint32) for r in table.collect()}
    want = {}
    for q in (i for i in items if i % 100 == 0):
        for m, b in items.items():
            a = items[q]
            for o in range(-len(b) + 1, len(a)):
                x, y = a[max(o, 0) :], b[max(-o, 0) :]
                n = min(len(x), len(y))
                if m != q and n >= P.overlap * min(len(a), len(b)) and bits(x[:n], y[:n]) <= P.error:
                    want.setdefault((q, m), []).append((bits(x[:n], y[:n]), o))
    want = {k: min(v) for k, v in want.items()}
    good = sum(k in got for k in want)
    assert good >= 0.9 * len(want) and len(want) >= 24
    assert (5000, 5001) in want and (5000, 5001) in got  # sustained silence of two lengths
    for k, r in got.items():
        assert k in want and abs(r.bit_error - want[k][0]) < 1e-9
    for k in range(12):
        assert got[100 * k, 100 * k + 1].offset == 20


def test_recall_at_larger_errors(spark):
    rng = np.random.default_rng(7)
    rows, error = [], {}
    for k in range(20):
        x = song(200 + k)
        rows.append((100 * k, x))
        for j, sd in enumerate((6000, 8000, 10000, 12000)):
            y = (x + rng.normal(0, sd, len(x))).clip(-32000, 32000).astype(np.int16)
            rows.append((100 * k + 1 + j, y))
            error[100 * k, 100 * k + 1 + j] = bits(M.fingerprint(M.wav(x, 4000)), M.fingerprint(M.wav(y, 4000)))
    sound = (12000 * np.sin(np.arange(40000) * 2 * np.pi * 440 / 4000)).astype(np.int16)
    rows += [(9000, sound), (9001, sound[:24000])]  # one tone of two lengths
    # a very long recording that holds a short one
    rows += [(9100, song(500)), (9101, np.concatenate([np.concatenate([song(501 + i) for i in range(10)]), song(500), np.concatenate([song(520 + i) for i in range(10)])]))]
    df = spark.createDataFrame([(i, bytearray(M.wav(x, 4000))) for i, x in rows], "vec_id long, media binary")
    table, _ = M.classes(M.fingerprints(df, "vec_id", "media", P))
    queries = table.where("class_id % 100 = 0")
    got = {(r.class_id, r.match_id): r for r in M.align(table, queries, P).join(table.select("h", "class_id"), "h").collect()}
    wanted = [k for k, e in error.items() if 0.1 <= e <= P.error]
    assert len(wanted) >= 20 and sum(k in got for k in wanted) >= 0.9 * len(wanted)
    assert (9000, 9001) in got and got[9100, 9101].bit_error < 0.05


def test_whole_operator(spark):
    rng = np.random.default_rng(6)
    v = [[float(x) for x in rng.normal(0, 0.4, 64)] for _ in range(5)]
    rows = [(0, v[0]), (1, v[0]), (2, v[1]), (2, v[1]), (None, v[0]), (100, v[2]), (7, None), (8, []), (9, [None, 1.0]), (200, v[3][:3]), (11, [float("nan")] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("class_id", F.lit("x"))
    got = M.media_digest(df).collect()
    member = {(r.id, r.class_id) for r in got if r.kind == "member"}
    assert len([r for r in got if r.kind == "member"]) == len(rows)
    assert {(0, 0), (1, 0), (None, 0), (2, 2), (100, 100), (7, 7), (8, 7), (9, 7), (200, 7)} <= member
    assert M.media_digest(df.limit(0)).count() == 0


def test_hits_are_not_shuffled_and_blocks_change_nothing(spark, monkeypatch):
    """Recordings of few notes share most integers; whatever is compared at once, the best alignments are the same."""
    rng = np.random.default_rng(9)
    rows = [(k, bytearray(M.render([float(x) / 32 for x in rng.integers(0, 2, 40)]))) for k in range(60)]
    table, _ = M.classes(M.fingerprints(spark.createDataFrame(rows, "vec_id long, media binary"), "vec_id", "media", P))
    queries = table.where("class_id % 10 = 0")
    found = M.align(table, queries, P)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    kept = [(r["h"], np.array(r["items"], dtype=np.int32).view(np.uint32), r["class_id"]) for r in table.collect()]
    asked = [x for x in kept if x[2] % 10 == 0]
    cat = lambda x: (np.concatenate([i for _, i, _ in x]), np.cumsum([0, *(len(i) for _, i, _ in x)]), {k: np.array([h[k] for h, _, _ in x]) for k in "abn"})
    values, starts, h = cat(asked)
    at = M._runs(values, starts)
    owner = np.searchsorted(starts, at, "right") - 1
    order = np.argsort(values[at], kind="stable")
    index = h | {"values": values, "starts": starts, "keys": values[at][order], "owner": owner[order], "at": (at - starts[owner])[order], "runs": np.bincount(owner)}
    for p in (P, M.MediaParams(hits=3)):
        want = None
        for hits, compared in ((1 << 20, 1 << 22), (1, 1), (500, 70)):
            monkeypatch.setattr(M, "HITS", hits)
            monkeypatch.setattr(M, "COMPARED", compared)
            got = sorted((asked[q][2], kept[r][2], o, n, e) for part in M._aligned(index, *cat(kept), p) for r, q, o, n, e in zip(*(x.tolist() for x in part), strict=True))
            want = want or got
            assert got == want
        if p == P:
            ids = {x[0]: x[2] for x in kept}
            assert want == sorted((ids[r.h], r.match_id, r.offset, r.overlap, r.bit_error) for r in found.collect()) and len(want) > 20
