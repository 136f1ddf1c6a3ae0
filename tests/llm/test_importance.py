import random

import numpy as np

from tests.llm import fixtures
from tidemark.llm import importance as I


def _table(spark, n=1500, junk=0.25, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < junk
        text = fixtures.sentence(rng, rng.randrange(20, 120))
        if bad:
            text = " | ".join(w.upper() + "!!" for w in text.split())
        docs.append((i, text, "s"))
        if rng.random() < 0.5:
            labels.append((i, int(not bad), 0))
    return docs, labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_exact_rank(spark):
    docs, labels, known = _table(spark)
    out = I.resample(I.scored(fixtures.frame(spark, docs), known)).collect()
    assert len(out) == len(docs)
    labelled, bad = {d for d, *_ in labels}, {d for d, t, _ in docs if "!!" in t}
    rest = [r for r in out if r.doc_id not in labelled]
    assert np.mean([r.kept for r in rest if r.doc_id not in bad]) > 0.97
    assert np.mean([not r.kept for r in rest if r.doc_id in bad]) > 0.97
    order = sorted(out, key=lambda r: (-r.key, r.doc_id))
    assert [r.rank for r in order] == list(range(1, len(out) + 1))
    assert all(r.kept == (r.rank <= sum(x.kept for x in out)) for r in out)


def test_counts_equal_a_plain_model(spark):
    docs, labels, known = _table(spark, 200)
    df = fixtures.frame(spark, docs).selectExpr("doc_id", "text", "doc_id % 3 = 0 AS good")
    raw, target = np.zeros(I.BUCKETS), np.zeros(I.BUCKETS)
    for d, t, _ in docs:
        data = np.frombuffer(t.encode(), np.uint8)
        bucket, _ = I.features(data, np.array([0, len(data)]))
        raw += np.bincount(bucket, minlength=I.BUCKETS)
        target += np.bincount(bucket, minlength=I.BUCKETS) * (d % 3 == 0)
    assert np.allclose(I.fit(df), I.log_ratios(raw, target))


def test_features_do_not_cross_rows():
    a, b = "Sea sea 12 WIND!! ", "x | é é"
    both = (a + b).encode()
    alone = [I.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in (a, b)]
    bucket, row = I.features(np.frombuffer(both, np.uint8), np.array([0, len(a.encode()), len(both)]))
    for i in (0, 1):
        assert sorted(bucket[row == i]) == sorted(alone[i])


def test_top_k_and_awkward_rows(spark):
    schema = "doc_id long, text string, extra int"
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (None, None, 2), (3, "", 3), (4, "b c", 4)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    keys = I.scored(df, none)
    assert [r.kept for r in I.resample(keys).collect()] == [True] * 5
    assert sum(r.kept for r in I.resample(keys, k=2).collect()) == 2
    assert all(r.log_weight == 0 for r in keys.collect())
    kept = I.kept_rows(df, none)
    assert kept.columns == df.columns and kept.count() == 5
    assert I.resample(I.scored(df.limit(0), none)).collect() == []


def test_gumbel_draws_follow_the_weights(spark):
    """Rows of equal weight are kept about equally often over seeds; e-fold weight is e-fold odds."""
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(4000)], "doc_id long, w double")
    got = df.withColumn("key", df.w + I.gumbel(5, "doc_id")).orderBy("key", ascending=False).limit(400).groupBy("w").count().collect()
    n = {r.w: r["count"] for r in got}
    assert 2.1 < n[1.0] / n[0.0] < 3.5


def test_all_labels_not_fitted_on_set_the_size(spark, monkeypatch):
    """A bound on the rows of the fit is none on the rows that place the cut."""
    monkeypatch.setattr(I.labelled_good, "__defaults__", (100,))
    docs, labels, known = _table(spark)
    fitted = {r.doc_id for r in I.labelled_good(known).collect() if not r.held}
    want = {d for d, quality, _ in labels if quality} - fitted
    assert 0 < len(fitted) <= 100 < len(want)
    df = fixtures.frame(spark, docs)
    keys = I.scored(df.unionByName(df.limit(3).withColumn("doc_id", df.doc_id * None)), known)
    assert sorted(r.doc_id for r in keys.where("good").collect()) == sorted(want)
    out = I.resample(keys).collect()
    k = np.percentile([r["rank"] for r in out if r.doc_id in want], 100 * I.RECALL)
    assert len(out) == len(docs) + 3 and sum(r.kept for r in out) == int(np.ceil(k))
