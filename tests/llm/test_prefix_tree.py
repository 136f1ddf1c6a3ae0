import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import prefix_tree as P

PIECES = st.lists(st.sampled_from([*P.CONTROLS, "\\", "<", "[", "s>", "/INST]", "a", " ", "\n", "é", "\U0001f600", "<|endoftext|>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.one_of(PIECES, st.text(max_size=20)), st.one_of(st.sampled_from(["user", "assistant", "system", ""]), PIECES))
def test_template_round_trip(text, role):
    escaped = P.escape(text)
    assert P.unescape(escaped) == text and not any(c in escaped for c in P.CONTROLS)
    assert P.parsed("".join(P.formatted(role, text))) == (role, text)


def _rows():
    rng = random.Random(6)
    words = lambda: " ".join(rng.choice(["sea", "wind", "</s>", "é\\", "[INST]", "ok"]) for _ in range(rng.randrange(6)))
    first = [words() for _ in range(3)]
    rows = []
    for c in range(120):
        turns = [("user", first[0] if c % 3 else rng.choice(first))]
        for t in range(rng.randrange(7)):
            turns.append((rng.choice(["assistant", "user", "system", "tool", None]), rng.choice([words(), "same", None, ""])))
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(400)]  # one very long conversation
    rows += [(501, t, r, x) for c, t, r, x in rows if c == 500][:300]
    rows += [(-1, 0, "user", P.ODD), (-1, 1, "assistant", P.ODD), (7, 0, None, None), (600, None, "user", "b"), (600, None, "user", "a"), (600, 1, "user", "a")]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y")]
    return rows


def _brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t), r or "", x or "") for d, t, r, x in rows if d == c)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss), sum(len("".join(P.formatted(r, x))) for _, r, x in turns))
    return out


@pytest.fixture(scope="module")
def tree(spark):
    rows = _rows()
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int").repartition(6)
    return rows, *P.write_tree(df, P.byte_tokenizer())


def test_read_back(tree):
    rows, stream, paths = tree
    got = {r.conv_id: tuple(r)[1:] for r in P.read_back(stream, paths, P.byte_tokenizer()).collect()}
    assert got == _brute(rows)


def test_tree(tree):
    """Shared turns stand once; positions and intervals are those of the ancestors."""
    rows, stream, paths = tree
    nodes = {r.start: r for r in stream.collect()}
    flat, at = [], 0
    for s in sorted(nodes):
        assert s == at
        flat += nodes[s].ids
        at += nodes[s].n_tokens
    by = {}
    for r in paths.collect():
        by.setdefault(r.conv_id, []).append((r.depth, r.start))
    histories, parents = set(), {}
    for c, path in by.items():
        turns = [(r or "", x or "") for t, r, x in sorted(((-1 if t is None else t), r or "", x or "") for d, t, r, x in rows if d == c)]
        before = []
        for i, (_, s) in enumerate(sorted(path)):
            assert nodes[s].position == len(before)
            assert [x for a, b in nodes[s].ancestors for x in flat[a:b]] == before
            before = before + nodes[s].ids
            histories.add(tuple(turns[:i + 1]))
            parents[s] = sorted(path)[i - 1][1] if i else None
    assert len(nodes) == len(histories)
    # depth-first: the nodes of a subtree are neighbours
    order = sorted(nodes)
    for s in order:
        under = []
        for x in order:
            y = x
            while y is not None and y != s:
                y = parents[y]
            if y == s:
                under.append(order.index(x))
        assert under == list(range(under[0], under[0] + len(under)))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert P.read_back(*P.write_tree(df, P.byte_tokenizer()), P.byte_tokenizer()).collect() == []
