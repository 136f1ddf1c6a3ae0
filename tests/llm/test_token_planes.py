import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute, fixtures
from tidemark.llm import token_planes as T


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(1, 64), st.sampled_from([1, 8]))
def test_planes_round_trip(ids, block, bits):
    a = np.array(ids, "<u4")
    sizes, payload = T.pack(a, block, bits)
    assert (T.unpack(sizes, payload, len(a), block, bits) == a).all()


def _index(spark, df, **options):
    return sorted(tuple(r) for r in T.token_index(T.write_tokens(df, "t", T.tokenizer_path(), **options)).collect())


def test_ids_equal_whole_text_encoding(spark):
    rows = fixtures.documents()
    want = brute.token_index([(d, t) for d, t, _ in rows], T.tokenizer_path())
    df = fixtures.frame(spark, rows)
    assert _index(spark, df) == want
    assert _index(spark, df, by_word=False, plane_bits=1, block=100, segment=500) == want


def test_empty_ties_and_nulls(spark):
    schema = "doc_id long, text string"
    assert _index(spark, spark.createDataFrame([], schema)) == []
    df = spark.createDataFrame([(5, "b"), (5, "a"), (None, "c"), (1, None), (5, "a")], schema)
    got = T.token_index(T.write_tokens(df, "t", T.tokenizer_path())).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens) for r in got) == [(0, None, 2), (2, 1, 1), (3, 5, 2), (5, 5, 2), (7, 5, 2)]


def test_blocks_can_be_read_alone(spark):
    rows = [(i, "wind and sea " * 50) for i in range(20)]
    seg = T.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), "t", T.tokenizer_path(), block=128).first()
    whole = T.unpack(seg.sizes, seg.payload, seg.n_ids, seg.block, seg.plane_bits)
    skip = sum(seg.sizes[:8])  # the planes of two blocks
    third = T.unpack(seg.sizes[8:12], seg.payload[skip:], min(128, seg.n_ids - 256), 128, 8)
    assert (third == whole[256:384]).all()


def test_rows_without_an_id_are_dealt_over_partitions(spark):
    rows = [(None if i % 3 else i, f"wind {i} and sea") for i in range(3000)]
    segments = T.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), "t", T.tokenizer_path(), segment=200)
    assert segments.where("doc_ids[0] IS NULL").select("shard").distinct().count() > 2
    got = T.token_index(segments).collect()
    assert len(got) == 3000 and len({r.start for r in got}) == 3000 and sum(r.doc_id is None for r in got) == 2000


def test_words_are_not_remembered_but_their_pieces(monkeypatch):
    """What a worker holds between slices grows with the different runs of letters, not with the words they make."""
    letters, enc = "abcdefghijklmnopqrst", T.WordEncoder(T.tokenizer_path())
    runs = [a + b + c for a in letters for b in letters for c in letters]
    text = " ".join(r + s for s in (",", ".", "!!", "?", ";", ":", "$", "&&&") for r in runs).encode()
    assert enc([text, b"", b" x "]) == T.WholeEncoder(T.tokenizer_path())([text, b"", b" x "])
    held = [v for v in vars(enc).values() if isinstance(v, dict)]
    assert sum(map(len, held)) <= 2 * len(runs)
    monkeypatch.setattr(T, "CACHE_PIECES", 100)
    enc([b"one more"])
    assert sum(map(len, held)) <= 100


def test_slices_end_at_white_space(monkeypatch):
    rows = [t.encode() for _, t, _ in fixtures.documents() if t] + [b"\xff ab\xc3 ", b" \t\x0b\x0c a\rb\n"]
    monkeypatch.setattr(T, "SLICE", 50)
    assert T.WordEncoder(T.tokenizer_path())(rows) == T.WholeEncoder(T.tokenizer_path())(rows)
