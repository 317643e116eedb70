import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from blockflow.llm.secrets import RULES, scan_block
from blockflow.llm.simhash import fingerprint
from tests.llm.test_nearcopies import similar_pairs


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage over sf0.01."""
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, f in C.STAGES:
        after = f(spark, docs, sf_dir).cache()
        out[name] = docs, after
        docs = after
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_filters_keep_whole_rows(stages):
    for name in ("quality", "language", "near_duplicates"):
        before, after = (rows(d) for d in stages[name])
        assert stages[name][0].columns == stages[name][1].columns
        assert 0 < len(after) < len(before) or name == "language"
        assert all(before[i] == r for i, r in after.items())


def test_quality_keeps_the_good(stages, spark):
    before, after = (rows(d) for d in stages["quality"])
    good = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()}
    assert len(good & set(after)) >= 0.98 * len(good & set(before))


def groups(ids, linked):
    """The smallest id of each component of the ids."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {find(i) for i in ids}


def test_one_of_each_group_stays(stages):
    """Fingerprints first, then five-word similarity among what stays."""
    before, after = (rows(d) for d in stages["near_duplicates"])
    fp = {i: fingerprint(r.text.encode()) for i, r in before.items()}
    ids = sorted(fp)
    left = groups(ids, ((i, j) for k, i in enumerate(ids) for j in ids[:k] if (fp[i] ^ fp[j]).bit_count() <= 2))
    similar = similar_pairs({i: before[i].text for i in left})
    assert similar
    assert set(after) == groups(left, similar)


NAMES = ["kept", "base_failed", "rejected_by", "_counts", "_stratum", "_lang_pred", "_h1", "_keep", "id", "fp", "keys", "KEPT_"]


def test_clashing_columns_null_ids_and_repeated_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionByName(docs.limit(2))
    wide = docs.unionByName(more).select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES))
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, wide, "/root/testdata/sf0.001")
        assert after.columns == wide.columns, name
        assert {c: t for c, t in after.dtypes} == {c: t for c, t in wide.dtypes}
        got = after.collect()
        assert 0 < len(got) <= wide.count()
        assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in got for n in NAMES)
    assert C.STAGES[-1][1](spark, wide, "/root/testdata/sf0.001").count() >= wide.count()


def test_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        after = stage(spark, docs, "/root/testdata/sf0.001")
        assert after.count() == 0
    assert len(C.STAGES) in (4, 5)


def test_no_secret_is_left(stages):
    before, after = (rows(d) for d in stages["secrets"])
    assert set(before) == set(after)
    base = [k for k, r in enumerate(RULES) if r.base]
    hit = scan_block([before[i].text for i in before])
    assert any(hit)
    assert not any(s[2] in base for spans in scan_block([r.text for r in after.values()]) for s in spans)
    for i, spans in zip(before, hit, strict=True):
        assert bool(spans) == (before[i].text != after[i].text)


def test_sequences_hold_all_tokens(stages):
    before, after = stages["packing"]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = defaultdict(dict)
    places = defaultdict(list)
    for r in after.collect():
        got[r.doc_id][r.piece] = r.ids
        places[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(array("I", r.ids).tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for i, r in rows(before).items():
        assert [x for k in sorted(got[i]) for x in got[i][k]] == t.encode(r.text, add_special_tokens=False).ids + [0]
    for s in places.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and s[-1][0] + s[-1][1] <= 2048


def test_run(spark, sf_dir):
    assert C.run(spark, sf_dir).count() > 0
