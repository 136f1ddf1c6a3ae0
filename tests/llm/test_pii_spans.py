import hashlib
import random
import re

from tests.llm import fixtures
from tidemark.llm import pii_spans as P

# The contract's patterns, as they are stated.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def _base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (14 <= len(d) <= 19 and _luhn(d))
                    or kind == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def _card(rng):
    d = [rng.randrange(10) for _ in range(15)]
    return next("".join(map(str, [4, *d[1:], c])) for c in range(10) if _luhn("".join(map(str, [4, *d[1:], c]))))


def _texts():
    rng = random.Random(9)
    card = _card(rng)
    odd = ["a@b.c_d@e.f", "a@b@c.de", "..@x.y", "x@y.z.", "@a.b", "é@a.b ü@é.c", "1.2.3.4.5.6.7.8", "256.1.1.1", "1.1.1.256", "0001.002.3.0255", "1.2.3", "1..2.3.4", "99999999999999999999.1.1.1",
           card, card[:4] + " " + card[4:8] + "-" + card[8:], card + " " + _card(rng), "4" * 3000, "1-" * 2000 + "1", "+1 (555) 123-4567", "+1 555", "+1 (555) 123-4567 10.0.0.1", "+" + "1 " * 500,
           "+1 (017) 555-7713 4111 1111 1111 1111", "\U0001f600 mail: x.y+z@mail.example.com, \U0001f600é 10.20.30.40", "a" * 20000, "a" * 5000 + "@b" + ".c" * 3000, "x@" * 3000, "%" * 5000, "- " * 3000 + "1", "1 " * 40]
    chars = "a1@.+-() 9%_é4"
    odd += ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(600)]
    return odd


def test_base_spans_equal_the_stated_patterns(spark):
    rows = [(i, t, "s") for i, t in enumerate([*_texts(), None, "", *(t for _, t, _ in fixtures.documents())])]
    got = P.find(fixtures.frame(spark, rows))
    got = {r[0]: r[1:] for r in got.select("doc_id", P._written(P.F.col("base")).alias("w"), "base", "added").collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i][0] == _base(t), (t or "")[:200]
        assert len(got[i][1]) == len(list(filter(None, _base(t).split(","))))


def test_given_documents(spark):
    from tests.conftest import SF_SMALL
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = P.op5_pii_spans(spark, SF_SMALL).collect()
    assert len(got) == len(text)
    for r in got:
        want = _base(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k + ":") for k in P.KINDS]
    plan = P.op5_pii_spans(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_the_classifier_adds_what_the_patterns_miss(spark):
    """Neighbouring cards hide each other from the patterns, as a phone number and an address do; order numbers stay out."""
    rng = random.Random(1)
    rows, pairs, plain = [], set(), set()
    for i in range(400):
        w = fixtures.sentence(rng, 8)
        if i % 4 == 0:
            rows.append((i, f"{w} {_card(rng)} {w}"))
        elif i % 4 == 1:
            rows.append((i, f"{w} {_card(rng)} {_card(rng)} {w}"))
            pairs.add(i)
        elif i % 4 == 2:
            rows.append((i, f"{w} call +1 (555) {rng.randrange(100, 1000)}-{rng.randrange(1000, 10000)} {w}"))
        else:
            rows.append((i, f"{w} order {rng.randrange(10**15, 10**16)} {w}"))
            plain.add(i)
    got = {r.doc_id: r for r in P.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(len(got[i].added) == 2 for i in pairs)
    wrong = sum(len(got[i].added) > 0 for i in plain)
    assert found > 0.9 * len(pairs) and wrong < 0.1 * len(plain)


def test_estimates_recover_the_labelers():
    """Votes drawn from known labelers: the estimates come near their accuracies."""
    rng = random.Random(2)
    right = (0.95, 0.85, 0.7, 0.9, 0.8)
    from collections import Counter
    c, truth = Counter(), {}
    for _ in range(20_000):
        y = rng.random() < 0.6
        v = tuple((1 if y else -1) * (1 if rng.random() < a else -1) for a in right)
        c[v] += 1
        truth.setdefault(v, Counter())[y] += 1
    models, posterior = P.estimate([(0, v, n) for v, n in c.items()])
    share, table = models[0]
    assert abs(share - 0.6) < 0.03
    for j, a in enumerate(right):
        assert abs(table[j, 1, 1] - a) < 0.03 and abs(table[j, 0, -1] - a) < 0.03
    hits = sum(n for v, t in truth.items() for y, n in t.items() if (posterior[0, v] > 0.5) == y)
    assert hits / 20_000 > 0.95


def _timed(spark, texts):
    import time
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t = time.time()
    got = P.find(df).select("doc_id", P._written(P.F.col("base")).alias("w"), P.F.size("added").alias("n")).collect()
    return {r.doc_id: r for r in got}, time.time() - t


def test_very_many_numbers_in_one_text(spark):
    """200,000 short numbers, and 60,000 spans that pass, beside as many candidates."""
    rng = random.Random(11)
    numbers = " ".join(str(rng.randrange(10 ** rng.randrange(1, 8))) + rng.choice(["", ",", ";"]) for _ in range(200_000))
    card = [_card(rng) for _ in range(50)]
    spans = "; ".join(rng.choice(["a{}@b.com", "10.0.{}.1", "+44 20 7946 0{}", "x {}"]).format(rng.randrange(100, 250)) if i % 3 else
                      rng.choice([c[:4] + " " + c[4:8] + " " + c[8:12] + " " + c[12:] for c in card]) for i in range(90_000))
    got, seconds = _timed(spark, [numbers, spans])
    assert seconds < 60
    assert got[0].w == _base(numbers) and got[1].w == _base(spans) and got[1].w.count(":") > 100_000


def test_candidates_over_base_spans_go(spark):
    """Against every pair of spans."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice([_card(rng), "+1 (555) 123-4567", "555-123-4567", "a@b.co", "x (at) y (dot) com", "10.0.0.1", "1:2:3:4:5:6:7:8", "7"]) for _ in range(n))
             for n in (1, 2, 3, 5, 8, 300, 700)]
    found, some = {r.doc_id: r for r in P.voted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}, 0
    for i, t in enumerate(texts):
        loose = []
        for j, kind in enumerate(P.KINDS):
            pattern = re.compile(P.LOOSE[kind].replace("}+", "}").replace("++", "+"))     # greedy is enough for these texts
            loose += [(m.start(), m.end(), j) for m in pattern.finditer(t)]
        want = sorted(c for c in loose if not any(b.start < c[1] and c[0] < b.stop for b in found[i].base))
        assert [(x.start, x.stop, x.kind) for x in found[i].loose] == want
        some += len(want)
    assert some > 20


def test_empty_table(spark):
    assert P.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []
