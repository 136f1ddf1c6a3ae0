import hashlib
import random

import pytest

from tests.llm import brute, fixtures
from tidemark.llm import suffix_columns as S


def _rows(df, window=100, **kw):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
                  for r in S.without_repeats(df, window, **kw).collect())


def _brute(rows, window=100):
    """rows with unique ids: (doc_id, text), a null id last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (key, _), t, gone in zip(rows, texts, brute.covered(texts, window)):
        spans = sum(i - 1 not in gone for i in gone)
        out.append((key, len(t), len(gone), spans, hashlib.sha256(bytes(b for i, b in enumerate(t) if i not in gone)).hexdigest()))
    return sorted(out)


def _suffixes(texts):
    """Every suffix in order: bytes, then the end, which is smaller than all bytes; ties by text."""
    return sorted((tuple(b + 1 for b in t[j:]) + (0,), i, j) for i, t in enumerate(texts) for j in range(len(t) + 1))


@pytest.mark.parametrize("seed", range(40))
def test_transform_of_a_collection(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab" if seed % 2 else b"abcdefgh") for _ in range(rng.randrange(1, 25))) for _ in range(rng.randrange(1, 12))]
    texts += texts[:2]
    bwt, lcp, text, at = S.column_bwt(texts)
    want = _suffixes(texts)
    assert list(zip(text.tolist(), at.tolist())) == [(i, j) for _, i, j in want]
    assert bwt.tolist() == [S.END if j == 0 else texts[i][j - 1] for _, i, j in want]
    common = [0]
    for (a, *_), (b, *_) in zip(want, want[1:]):
        n = 0
        while n < min(len(a), len(b)) - 1 and a[n] == b[n]:
            n += 1
        common.append(n)
    assert lcp.tolist() == common


@pytest.mark.parametrize("window, many", [(100, 2048), (12, 2048), (12, 1), (41, 3)])
def test_against_all_strings(spark, window, many):
    """``many=1`` deals every anchor with two texts by single windows."""
    rows = [(d, t) for d, t, _ in fixtures.documents()]
    assert _rows(fixtures.frame(spark, [(d, t, None) for d, t in rows]), window, many=many, batch_bytes=3000) == _brute(rows, window)


@pytest.mark.parametrize("many", [2048, 2])
def test_few_letters_and_a_line_in_other_surroundings(spark, many):
    rng = random.Random(3)
    line = "".join(rng.choice("abcdefghij ") for _ in range(90))
    noise = lambda n: "".join(rng.choice("klmnopqrst ") for _ in range(n))
    rows = [(i, noise(40) + line + noise(30) + (line + noise(5)) * (i % 3)) for i in range(150)]
    rows += [(1000 + i, "".join(rng.choice("ab") for _ in range(rng.randrange(400)))) for i in range(60)]
    assert _rows(spark.createDataFrame(rows, "doc_id long, text string"), 60, many=many) == _brute(rows, 60)


def test_long_texts_in_steps(spark, monkeypatch):
    """Steps cut pieces anew; the result stays."""
    rng = random.Random(4)
    base = "".join(rng.choice("abcdef ") for _ in range(4000))
    rows = [(1, base), (2, base[700:3100]), (3, "é" * 900 + base[:350] + "é" * 900), (4, base[1000:1099]), (5, base[1000:1100])]
    want = _brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(df) == want
    monkeypatch.setattr(S, "STEP", 500)
    p = S.Pieces(*(lambda t: (S.np.frombuffer(t, S.np.uint8), S.np.array([0, len(t)])))(base.encode()), 100)
    assert int(p.count.sum()) == 3901


def test_ids_null_repeated_and_empty(spark):
    text = "".join(random.Random(8).choices("abcdefgh", k=150))
    rows = [(None, text), (None, text), (7, text), (7, text), (7, None), (8, ""), (9, text[:99])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((99 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed) for r in S.without_repeats(df).collect())
    assert got == [(7, 0, 0), (7, 150, 0), (7, 150, 150), (8, 0, 0), (9, 99, 0), (99, 150, 150), (99, 150, 150)]
    assert S.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_spans_are_the_removed_bytes(spark):
    a = "".join(random.Random(9).choices("abcdefgh", k=300))
    rows = [(1, a), (2, "x" + a[:120] + "yyy" + a[150:280])]
    two = next(r for r in S.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id == 2)
    assert two.spans == [[1, 121], [124, 254]] and bytes(two.kept) == b"xyyy"
