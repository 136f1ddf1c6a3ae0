"""Each stage against a plain version of its decision, and the whole against the stages."""

import re

import xxhash

import corpus_pipeline as C
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_decontaminate import _shingles, _words
from tidemark.llm import importance, source_mix, token_planes


def test_stages(spark):
    assert [n for n, _ in C.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "source mixing", "token planes"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, rows = docs.columns, {}

    def step(i):
        nonlocal docs, rows
        rows = {r.doc_id: r for r in docs.collect()}
        docs = C.stored(C.STAGES[i][1](spark, docs, SF_SMALL), "test")
        assert i == 4 or docs.columns == columns
        return docs.collect()

    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    kept = {r.doc_id for r in importance.resample(importance.scored(docs, labels)).where("kept").collect()}
    out = step(0)
    assert 0.3 * len(rows) < len(out) < len(rows) and {r.doc_id for r in out} == kept and all(r == rows[r.doc_id] for r in out)

    out = step(1)
    groups = brute.simhash_groups([(r.doc_id, r.text) for r in rows.values()])
    assert sorted(r.doc_id for r in out) == sorted({g for _, _, g in groups}) and all(r == rows[r.doc_id] for r in out)

    items = [_shingles(_words(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    out = step(2)
    clean = {d for d, r in rows.items() if not any(len(q & _shingles(_words(r.text))) >= 0.8 * len(q) for q in items)}
    assert {r.doc_id for r in out} == clean and len(clean) < len(rows)

    plan = {r.doc_id: r for r in source_mix.mix(docs).collect()}
    out = step(3)
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(brute.words(r.text))
        assert r.n_chars == len(r.text) and brute.words(rows[r.doc_id].text)[:len(brute.words(r.text))] == brute.words(r.text)
    assert words == {d: r.taken for d, r in plan.items() if r.taken}

    # rows with one id (cut and repeated texts) stand by their text's hash, a signed long, then by the text
    hashed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)
    mixed = sorted(((r.doc_id, r.text) for r in out), key=lambda r: (r[0], hashed(r[1]), r[1].encode()))
    assert sorted(map(tuple, step(4)), key=lambda r: r[1]) == brute.token_index(mixed, token_planes.tokenizer_path())
    assert sorted(map(tuple, C.run(spark, SF_SMALL).collect())) == sorted(map(tuple, docs.collect()))


def test_awkward_rows(spark):
    """Nulls in any column, repeated rows and ids, empty tables: no stage fails or loses a clean row."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, a, "en", "x", 33), (1, a, "en", "x", 33), (1, b, None, None, None), (None, None, None, None, None), (None, a + " and more words here", "en", "x", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    near = C.near_duplicates(spark, docs, SF_SMALL).collect()
    assert sorted((r.text or "", r.doc_id or 0) for r in near) == sorted([(a, 1), (b, 1), ("", 0), (a + " and more words here", 0)])
    assert C.benchmark_free(spark, docs, SF_SMALL).count() == 6
    assert C.quality(spark, docs, SF_SMALL).columns == docs.columns
    assert {r.text for r in C.mixture(spark, docs, SF_SMALL).collect()} >= {None}
    assert C.tokens(spark, docs, SF_SMALL).count() == 6
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF_SMALL).collect() == []


def test_only_the_ten_operators_are_called():
    text = open(C.__file__).read()
    assert re.findall(r"return (\w+)\.", text) == ["importance", "simhash", "decontaminate", "source_mix", "token_planes"]
