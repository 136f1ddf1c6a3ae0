import random

import pytest

from tests.llm import brute, fixtures
from tidemark.llm import spelling as S


def _rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def _texts(seed=5):
    """Few letters and many slips: dense neighbourhoods, ties, chains of forms."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.choice([5, 6, 7]))) for _ in range(60)]
    words += ["harbour", "harbor", "harbours", "hárbour", "Harbour", "x" * 300, "x" * 299, "x" * 299 + "y", "naïve×word"]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(80)))) for i in range(60)]


def test_against_all_pairs(spark):
    rows = [*_texts(), *[(d, t) for d, t, _ in fixtures.documents()]]
    df = fixtures.frame(spark, [(d, t, None) for d, t in rows])
    assert _rows(S.variants(df)) == brute.spelling(rows)


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "letter letter letters"), (None, None), (1, ""), (1, "letter letters letters"), (1, "letter letters letters"), (2, "12 34")]
    assert _rows(S.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute.spelling(rows)


def test_small_shards_change_nothing(spark, monkeypatch):
    """Vocabulary and questions dealt over many shards and blocks."""
    monkeypatch.setattr(S, "SHARD", 7)
    monkeypatch.setattr(S, "QUERIES", 11)
    rows = _texts(6)
    assert _rows(S.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute.spelling(rows)


def test_chain_of_forms(spark):
    """Each word occurs twice as often as the one before; one root for all."""
    words = ["a" * (9 - i) + "b" * i for i in range(8)]
    rows = [(i, " ".join([w] * (3 * 2 ** i))) for i, w in enumerate(words)]
    got = {r.word: r for r in S.variants(spark.createDataFrame([(d, " ".join(t.split())) for d, t in rows], "doc_id long, text string")).collect()}
    want = {w[0]: w for w in brute.spelling(rows)}
    assert {w: (r.form, r.root, r.n, r.n_near, r.form_n) for w, r in got.items()} == {w: x[1:] for w, x in want.items()}
    assert len({r.root for r in got.values() if r.form}) == 1


@pytest.mark.parametrize("words", [["abcde"], ["abcde", "abcdf", "bbcde"], ["ab", "ba", "aa"]])
def test_index_of_few_words(words):
    index = S.PositionIndex(words)
    for q in ["abcde", "abcdef", "abcd", "bcde", "xabcde", "ab", "a", "abc", ""]:
        got = [w for j, w in enumerate(words) if index.near(q) >> j & 1] if abs(len(q) - len(words[0])) < 2 else []

        def near(a, b):
            if len(a) == len(b):
                return sum(x != y for x, y in zip(a, b)) == 1
            s, l = sorted((a, b), key=len)
            return len(l) - len(s) == 1 and any(l[:i] + l[i + 1:] == s for i in range(len(l)))
        assert got == [w for w in words if near(q, w)]


def test_empty_table(spark):
    assert S.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
