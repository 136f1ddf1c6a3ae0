from tests.llm import brute, fixtures
from tidemark.llm import exact_sort as X


def _rows(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_against_groups(spark):
    rows = fixtures.documents()
    want = [(d, t) for d, t, _ in rows]
    df = fixtures.frame(spark, rows)
    assert _rows(X.exact_groups(df, keep="max")) == brute.exact(want, max)
    assert _rows(X.exact_groups(df, keep="min")) == brute.exact(want, min)


def test_one_group_over_many_partitions(spark):
    rows = [(i, "same") for i in range(5000)] + [(9000 + i, f"other {i % 7}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(X.exact_groups(df, keep="max")) == brute.exact(rows, max)


def test_empty_and_null_id(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert X.exact_groups(empty).collect() == []
    got = X.exact_groups(spark.createDataFrame([(None, "a"), (2, "a"), (2, "a")], "doc_id long, text string"), keep="max").collect()
    assert sorted((r.keep_id, r.group_size) for r in got) == [(2, 3)] * 3 and sum(r.kept for r in got) == 1


def test_folded_normalisation(spark):
    rows = [(1, "A  b\n"), (2, "a b"), (3, "a c")]
    got = X.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), X.folded).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == [(1, 1), (2, 1), (3, 3)]
