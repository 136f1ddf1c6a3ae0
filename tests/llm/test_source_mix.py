import pytest

from tests.llm import brute, fixtures
from tidemark.llm import source_mix as M


def test_targets_and_cut(spark):
    rows = fixtures.documents()
    got = M.mix(fixtures.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    size = {d: len(brute.words(t)) for d, t, _ in rows}
    totals = {}
    for d, _, s in rows:
        totals[s] = totals.get(s, 0) + size[d]
    want = brute.targets(totals)
    taken = dict.fromkeys(totals, 0)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == totals[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in totals:
        assert taken[s] == int(want[s] + 1e-9)
    # at most one document of a source is cut, the others are taken in whole epochs
    cut = [r.source for r in got if r.size and r.taken % r.size]
    assert len(cut) == len(set(cut))
    again = M.mix(fixtures.frame(spark, rows).repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_rows_of_the_mix(spark):
    rows = fixtures.documents()
    df = fixtures.frame(spark, rows)
    out = M.mixed_rows(df)
    assert out.columns == df.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(brute.words(r.text))
    assert {r.doc_id: r.taken for r in M.mix(df).collect() if r.taken} == {d: n for d, n in words.items() if n}


def test_empty_and_repeated(spark):
    schema = "doc_id long, text string, source string"
    assert M.mix(spark.createDataFrame([], schema)).collect() == []
    assert M.mixed_rows(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "a b c d", "x")] * 4 + [(None, None, None), (2, "q", None)]
    df = spark.createDataFrame(rows, schema)
    assert sum(r.taken for r in M.mix(df).collect()) == pytest.approx(sum(brute.targets({"x": 16, None: 1}).values()), abs=2)
    assert {r.doc_id for r in M.mixed_rows(df).collect()} == {1, None, 2}
