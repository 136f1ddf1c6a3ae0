"""Plain single-process versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows, keep=max):
    """rows: (doc_id, text) -> {(doc_id, keep_id, group_size, kept, sha)}"""
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    return sorted((d, keep(g), len(g), d == keep(g), sha(t)) for t, g in groups.items() for d in g)


def fingerprint(text, k=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_groups(rows, radius=2):
    """rows: (doc_id, text) -> sorted (doc_id, fingerprint, component)"""
    fps = [(d, fingerprint(t)) for d, t in rows]
    a = np.array([f for _, f in fps], np.uint64)
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(a)):
        x = a ^ a[i]
        for j in np.flatnonzero(np.bitwise_count(x) <= radius):
            p, q = top(i), top(int(j))
            if p != q:
                parent[p] = q
    least = {}
    for i, (d, _) in enumerate(fps):
        least[top(i)] = min(d, least.get(top(i), d))
    return sorted((d, f"{f:016x}", least[top(i)]) for i, (d, f) in enumerate(fps))


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """sizes: {source: size} -> {source: target}; the excess is handed on until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level >= cap * sizes[s]}
        if not full:
            break
        for s in full:
            target[s] = float(cap * sizes[s])
        open_ -= full
        left = share * sum(sizes.values()) - sum(target.values())
    return target | {s: w[s] * left / sum(w[x] for x in open_) for s in open_}


def token_index(rows, path, end=1):
    """rows: (doc_id, text) -> [(doc_id, start, n, crc)] over whole texts"""
    from tokenizers import Tokenizer
    t, at, out = Tokenizer.from_file(path), 0, []
    for d, x in sorted(rows, key=lambda r: r[0]):
        ids = t.encode(x or "", add_special_tokens=False).ids + [end]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def removed(rows, n=13):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, sha of what is kept)"""
    split = [(d, words(t)) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in split:
        drop = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < d:
                drop[i:i + n] = [True] * n
        kept = " ".join(x for x, y in zip(w, drop) if not y)
        out.append((d, len(w), sum(drop), sha(kept)))
    return sorted(out)


def spelling(rows, length=5, least=3):
    """(word, form, root, n, n_near, form_n) by comparing every pair of words."""
    counts = Counter()
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for key, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if n >= least and len(w) >= length}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    partners = {w: [x for x in vocab if near(w, x)] for w in vocab}
    form = {}
    for w, others in partners.items():
        best = min(others, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best and vocab[best] >= 2 * vocab[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(partners[w]), vocab.get(form[w])) for w, n in vocab.items())


def covered(texts, width):
    """For each text (bytes) the places of all strings of ``width`` that also start earlier."""
    seen, out = set(), []
    for t in texts:
        gone = set()
        for i in range(len(t) - width + 1):
            w = t[i:i + width]
            if w in seen:
                gone.update(range(i, i + width))
            seen.add(w)
        out.append(gone)
    return out
