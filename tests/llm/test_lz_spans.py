import pytest

from tests.llm import brute, fixtures
from tidemark.llm import lz_spans as L


def _rows(df, window=13):
    return sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in L.without_copies(df, window).collect())


@pytest.mark.parametrize("window", [13, 4, 50])
def test_against_all_windows(spark, window):
    rows = fixtures.documents()
    assert _rows(fixtures.frame(spark, rows), window) == brute.removed([(d, t) for d, t, _ in rows], window)


def test_few_words_many_repeats(spark):
    """A vocabulary of two words: every anchor is ambiguous and repeats inside its window."""
    import random
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(300)]
    assert _rows(spark.createDataFrame(rows, "doc_id long, text string")) == brute.removed(rows)


def test_factors_are_the_removed_words(spark):
    a = " ".join(f"w{i}" for i in range(40))
    rows = [(1, a), (2, "x " + a[4:90] + " y"), (3, None), (3, a), (None, a)]
    got = {(r.doc_id, r.n_words): r for r in L.without_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 40].factors == [] and got[3, 0].kept == "" and got[3, 40].n_removed == 40 and got[None, 40].kept == ""
    two = next(r for k, r in got.items() if k[0] == 2)
    assert sum(e - s for s, e in two.factors) == two.n_removed > 12


def test_empty_table(spark):
    assert _rows(spark.createDataFrame([], "doc_id long, text string")) == []
