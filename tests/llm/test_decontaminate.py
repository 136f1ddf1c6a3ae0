import random

import pytest
import regex as re

from tests.llm import fixtures
from tidemark.llm import decontaminate as D


def _words(text):
    return re.findall(r"[\p{L}\p{N}\p{M}]+", (text or "").lower())


def _shingles(w, k=5):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def _brute(docs, items, t=0.8):
    out = []
    for d, x, *_ in docs:
        w = _words(x)
        at = {k: _shingles(w, k) for k in range(1, 6)}
        for i, y in items:
            k = min(5, len(_words(y)))
            q = _shingles(_words(y), k) if k else set()
            s = at.get(k, set())
            if q and len(q & s) >= t * len(q) - 1e-9:
                out.append((d, i, len(q & s), len(q)))
    return sorted(out)


def _items(rng):
    items = [(i, fixtures.sentence(rng, rng.choice([1, 4, 5, 7, 12, 30, 60, 200]))) for i in range(60)]
    return items + [(100, items[9][1]), (101, None), (102, ""), (103, "!!")]


def _planted():
    """Items inside short and very long documents: verbatim, in capitals, with edits, scattered."""
    rng = random.Random(4)
    items, docs = _items(rng), fixtures.documents()
    for n, (i, text) in enumerate(items[:60]):
        w = text.split()
        for j, long in enumerate((0, 50, 9000)):
            if (n + j) % 3 == 0:
                body = w
            elif len(w) > 20:
                body = [x if rng.random() > 0.02 else "zz" for x in w]
            else:
                body = [x.upper() + "," for x in w]
            if long == 50 and len(w) > 20:
                half = len(w) // 2
                body = body[:half] + fixtures.sentence(rng, 400).split() + body[half:]
            pad = fixtures.sentence(rng, long).split()
            docs.append((10_000 + 10 * n + j, " ".join([*pad[: long // 3], *body, *pad[long // 3:]]), "s"))
    return docs, items


@pytest.mark.parametrize("block", [4 << 20, 800])
def test_against_all_pairs(spark, block):
    docs, items = _planted()
    it = spark.createDataFrame(items, "item_id long, text string")
    df = fixtures.frame(spark, docs)
    want = _brute(docs, items)
    got = sorted((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in D.contained_items(df, it, block_bytes=block).collect())
    assert len(want) > 100 and got == want
    clean = D.clean_rows(df, it, block_bytes=block)
    assert clean.columns == df.columns
    bad = {d for d, *_ in want}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, *_ in docs if d not in bad)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contained_items(docs, none).collect() == [] and D.clean_rows(docs, none).count() == 2
    it = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert D.contained_items(docs.limit(0), it).collect() == []
    assert [r.containment for r in D.contained_items(docs, it).collect()] == [1.0]


def test_typographic_signs_hide_no_copy(spark):
    item = "the old light house stands near the far green river and the new road goes by the sea"
    w = item.split()
    docs = [(1, item), (2, " ".join([*w[:4], "\u201c" + w[4] + "\u201d", *w[5:9], "\u2014", *w[9:]])), (3, item.replace(" ", "\u00a0")), (4, "\u2026".join(w)),
            (5, item.upper()), (6, "\u3001".join(w)), (7, " ".join(w[:8])), (8, item.replace("old", "\u00f6ld"))]
    it = spark.createDataFrame([(1, item), (2, "\u2018" + item + "\u2019")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in D.contained_items(spark.createDataFrame(docs, "doc_id long, text string"), it).collect())
    assert got == sorted((d, i) for d in (1, 2, 3, 4, 5, 6, 8) for i in (1, 2) if (d, i) in {(d, i) for d, i, *_ in _brute(docs, it.collect())})
    assert {d for d, _ in got} >= {1, 2, 3, 4, 5, 6}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_items_below_five_words(spark, n):
    rng = random.Random(n)
    items = [(i, " ".join(f"q{n}x{i}y{j}" for j in range(n))) for i in range(5)] + [(9, "stone stone"), (10, "stone")]
    docs = [(i, f"{fixtures.sentence(rng, 30 * (i % 4))} {t.upper()}, {fixtures.sentence(rng, i % 3)}") for i, t in items]
    docs += [(100, " ".join(items[0][1].split()[::-1]) + " z"), (101, items[1][1]), (102, "stone, STONE! stone"), (103, None)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in D.contained_items(df, it).collect())
    assert got == _brute(docs, items) and (102, 9, 1, 1) in got and (2, 2, 1, 1) in got
