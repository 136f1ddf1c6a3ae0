import random

from tests.llm import brute, fixtures
from tidemark.llm import components, simhash


def _groups(df, **options):
    return sorted((r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in simhash.near_groups(df, **options).collect())


def test_against_all_pairs(spark):
    rows = fixtures.documents()
    assert _groups(fixtures.frame(spark, rows)) == brute.simhash_groups([(d, t) for d, t, _ in rows])


def test_whole_table(spark):
    from tests.conftest import SF_SMALL
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert _groups(df) == brute.simhash_groups([(r.doc_id, r.text) for r in df.collect()])


def test_hot_shards_are_cut_without_losing_links(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    codes = {centre ^ sum(1 << b for b in rng.sample(range(40), rng.randrange(7))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(200)}
    codes = sorted(codes)
    nodes = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c, i) for i, c in enumerate(codes)], "fp long, id long")
    parent = list(range(len(codes)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= 2:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    want = {i: top(i) for i in range(len(codes)) if any(top(j) == top(i) for j in range(len(codes)) if j != i)}
    for limit in (10, 100_000):
        got = {r.id: r.label for r in components.smallest_labels(simhash.links(nodes, 2, limit)).collect()}
        assert got == want


def test_components_of_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.id: r.label for r in components.smallest_labels(edges).collect()}
    assert got == {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000}


def test_empty_table(spark):
    assert simhash.near_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
