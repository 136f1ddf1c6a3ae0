"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

VOCAB = "the of and in wind sea stone river light house old new road far near green".split()


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) + str(rng.randrange(40)) for _ in range(n))


def documents(seed=1):
    """(doc_id, text, source): copies, near copies, shared passages, odd texts."""
    rng = random.Random(seed)
    passage = sentence(rng, 40)
    base = [sentence(rng, rng.choice([1, 2, 3, 12, 13, 14, 30, 120])) for _ in range(30)]
    texts = [*base, *base[:8], *[base[3]] * 5, None, "", "", " \t\n ", None, "x", "X x X x X", "a b 　 c\x1cd", "<|endoftext|> don't I'll 1234 ẞİ",
             "é öffnen 한글 \U0001f600\U0001f600 " * 3, sentence(rng, 5000), "w" * 70_000, "ab " * 3000]
    for i in range(12):
        texts.append(sentence(rng, i) + " " + passage[: 40 + 11 * i] + " " + sentence(rng, 12 - i))
    for i in range(12):
        w = base[7].split() or ["z"]
        texts.append("\n".join([*w, *sentence(rng, 100).split()][: 100 + i]))
    long = sentence(rng, 300).split()
    for i in range(10):
        texts.append(" ".join(long[:20 * i] + [f"edit{i}"] + long[20 * i + 1:]))
    rng.shuffle(texts)
    sources = ["web", "books", None, "étude", "code", "empty"]
    ids = rng.sample(range(10, 5000), len(texts))
    return [(d, t, "empty" if t == "" else rng.choice(sources[:5])) for d, t in zip(ids, texts)]


def frame(spark, rows):
    """As a table with extra columns whose names clash with those of the operators' work."""
    return spark.createDataFrame(
        [(d, t, s, 7, "x", 1.5, -1) for d, t, s in rows],
        "doc_id long, text string, source string, size int, fp string, part double, pos int").repartition(5)
