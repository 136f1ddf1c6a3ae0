"""Personal data by weak supervision, in DataFrame expressions only.

1. Base spans: the four contract patterns, leftmost and non-overlapping per kind,
   with their digit and checksum tests.  Candidates: looser forms of each kind (a
   card next to another number, a phone number without a plus sign, an obfuscated
   address, an IPv6 address).
2. Labelers vote on every base span and candidate, for (+1), against (-1) or not at
   all (0): the contract's *regex*, the *structure* (checksum, digit counts), a
   *gazetteer* (top-level domains, issuer prefixes, calling codes, reserved
   addresses), *context* words before the span, and the *border* characters.
3. Expectation-maximisation estimates, per kind, how often the kind is real and how
   each labeler votes on real and on other spans.  It needs only the counts of vote
   patterns, at most ``4 * 3**5`` of them however large the corpus.
4. The posteriors are soft labels of a final classifier: a naive Bayes model over the
   votes and the span's shape.  Candidates that it takes and that overlap no base
   span are added; base spans always stay.

One pass over the texts.  Matches, a few numbers each, are dealt by their document's row
for the running sums that place them; work is linear in the matches of a text.  Offsets
are code points, end exclusive.

Cases: null and empty texts have no span; every row is judged by itself, equal and
null ids too; a corpus without spans trains on nothing and adds nothing; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import load, partitions_for, stored

KINDS = ("email", "ip", "card", "phone")
LEFT = 24
EM_ROUNDS = 50
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# The contract's patterns.  Possessive loops and a start at the run's first character
# (or where the last match ended) find the same matches without retries inside a run.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?(?:\(at\)|\[at\])\x20?{_LABEL}{{1,63}}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?{_LABEL}{{1,63}}+)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([ -]?)[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9+.A-Za-z-])(?:\+[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
# A text without a match of these has no span of the kind.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE_HINT = {"email": r"[(\[]at[)\]]", "ip": "[0-9A-Fa-f]:[0-9A-Fa-f]", "card": "[0-9]{4}[\x20-]?[0-9]{4}", "phone": r"[0-9]{3}\)?[ .-][0-9]{3}"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})?"
IP_VALID = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
# Gazetteers, by the rules of the public lists.  Fixed values: country domains have two letters
# (ISO 3166), the generic ones in wide use are listed, four are reserved (RFC 2606).
DOMAINS = r"(?i)(?:\.|[)\]])\x20?(?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|pro|aero|coop|museum|jobs|mobi|travel|tel|cat|asia|post|arpa|app|dev|online|site|shop|store|tech|xyz|blog|cloud|club)$"
NO_DOMAINS = r"(?i)\.(?:test|invalid|localhost|local)$"
# Country codes as the numbering zones assign them (E.164).
CALLING = r"^\+(?:1|7|2[07]|2[1-689][0-9]|3[0-469]|3[578][0-9]|4[013-9]|42[0-9]|5[1-8]|5[09][0-9]|6[0-6]|6[789][0-9]|8[1246]|8[05789][0-9]|9[0-58]|9[679][0-9])"
ISSUERS = r"^(?:4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[0689]|3[47]|35|6(?:011|4[4-9]|5|2))"
RESERVED = r"^0*(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CUES = {
    "email": r"(?i)\b(?:e-?mail|mailto|contact|kontakt|correo|courriel|write to)\b[^.!?]*$",
    "ip": r"(?i)\b(?:ip|ipv4|ipv6|host|server|addr|address|adresse)\b[^.!?]*$",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\b[^.!?]*$",
    "phone": r"(?i)\b(?:tel|phone|call|mobile|cell|fax|telefon|téléphone|teléfono|whatsapp)\b[^!?]*$",
}
AGAINST = r"(?i)(?:\b(?:version|ver|isbn|issn|order|invoice|serial|sku|token|build|release|page|section)\b[^.!?]{0,12}|[=#$€£][\"']?)$"
LABELERS = ("regex", "structure", "gazetteer", "context", "border")
SHAPES = ("size", "digits", "marks")
_MATCHES = ("array<struct<skip:int,size:int,kind:int,loose:boolean,votes:struct<regex:int,structure:int,gazetteer:int,context:int,border:int,"
            "size:int,digits:int,marks:int>>>")


def _matches(text: Column, kind: str, base: bool) -> Column:
    """All matches of a kind's pattern, in order: the length of the text since the last
    match, the match's length, and its votes if it is a span (a base match that fails the
    contract's test has a place in the sums, no more)."""
    pattern, hint = (BASE[kind], HINT[kind]) if base else (LOOSE[kind], LOOSE_HINT[kind])
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.filter(F.arrays_zip(hits.alias("hit"), gaps.alias("gap"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("after")), lambda x: x["hit"].isNotNull())

    def item(x: Column) -> Column:
        near = F.struct(x["hit"].alias("hit"), F.right(x["gap"], F.lit(LEFT)).alias("left"), F.left(x["after"], F.lit(1)).alias("right"))
        votes = _votes(kind, near, base)
        return F.struct(F.length(x["gap"]).alias("skip"), F.length(x["hit"]).alias("size"), F.lit(KINDS.index(kind)).alias("kind"), F.lit(not base).alias("loose"),
                        (F.when(valid(kind, x["hit"]), votes) if base else votes).alias("votes"))

    return F.when(text.rlike(hint), F.transform(rows, item)).otherwise(F.array().cast(_MATCHES))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Checksum of a string of digits."""
    def value(x: Column, i: Column) -> Column:
        d = x.cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.split(F.reverse(digits), "(?<=[0-9])(?=[0-9])"), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    """The contract's test of a match."""
    n = F.length(_digits(hit))
    if kind == "ip":
        return hit.rlike(IP_VALID)
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(hit))).otherwise(F.lit(False))
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, x: Column, base: bool) -> Column:
    """The labelers' votes and the shape of a span, as small whole numbers."""
    hit, digits = x["hit"], _digits(x["hit"])
    structure = {
        "email": lambda: _vote(hit.rlike(r"[.\x20)\]][A-Za-z]{2,24}$") & ~hit.rlike(r"\.\.|^\.|\.@"), ~hit.rlike(r"[A-Za-z]$")),
        "ip": lambda: _vote(hit.rlike(IP_VALID) | hit.contains(":"), ~hit.contains(":")),
        "card": lambda: _vote(valid("card", hit), ~valid("card", hit)),
        "phone": lambda: _vote(F.length(digits).between(10, 13), F.length(digits) > 15),
    }[kind]()
    gazetteer = {
        "email": lambda: _vote(hit.rlike(DOMAINS), hit.rlike(NO_DOMAINS)),
        "ip": lambda: _vote(~hit.rlike(RESERVED), hit.rlike(RESERVED)),
        "card": lambda: _vote(digits.rlike(ISSUERS), ~digits.rlike("^[1-9]")),
        "phone": lambda: _vote(F.regexp_replace(hit, "[^0-9+]", "").rlike(CALLING), hit.startswith("+") & ~F.regexp_replace(hit, "[^0-9+]", "").rlike(CALLING)),
    }[kind]()
    context = _vote(x["left"].rlike(CUES[kind]), x["left"].rlike(AGAINST))
    apart = r"^(?:|[\s,;:.!?()\[\]<>\"'|*%&$#/-])$"
    border = _vote(F.right(x["left"], F.lit(1)).rlike(apart) & x["right"].rlike(apart), F.right(x["left"], F.lit(1)).rlike("[0-9A-Za-z]") | x["right"].rlike("[0-9A-Za-z]"))
    size = F.least(F.floor(F.length(hit) / 6), F.lit(9)).cast("int")
    share = F.floor(F.length(digits) * 4 / F.greatest(F.length(hit), F.lit(1))).cast("int")
    marks = F.least(F.length(F.regexp_replace(hit, "[0-9A-Za-z]", "")), F.lit(9))
    return F.struct(F.lit(1 if base else -1).alias("regex"), structure.alias("structure"), gazetteer.alias("gazetteer"),
                    context.alias("context"), border.alias("border"), size.alias("size"), share.alias("digits"), marks.alias("marks"))


def voted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, loose: spans with their votes.

    One pass over the texts finds the matches; each becomes a row of a few numbers.  A
    match's place is a running sum over the matches before it in its text, and a candidate
    over a base span is told by the last end and the next start of base spans around it: all
    are windows over one text's matches, linear in their number.  The rows are dealt
    once, by the document's row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    each = F.flatten(F.array(*[_matches(F.col("text"), k, base) for base in (True, False) for k in KINDS]))
    found = rows.select("row", "doc_id", F.posexplode_outer(each).alias("at", "m")).select("row", "doc_id", "at", "m.*")
    found = found.repartition(partitions_for(docs.sparkSession), "row")
    before = Window.partitionBy("row", "kind", "loose").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("stop", F.sum(F.col("skip") + F.col("size")).over(before).cast("int")).withColumn("start", F.col("stop") - F.col("size"))
    found = found.where(F.col("votes").isNotNull() | F.col("at").isNull() | (F.col("at") == 0))    # the first match keeps its document
    span = F.when(F.col("votes").isNotNull(), F.struct("start", "stop", "kind", *[F.col(f"votes.{c}").alias(c) for c in (*LABELERS, *SHAPES)]))
    here = [F.col(c) for c in ("start", "loose", "kind")]      # frames that grow: a shrinking one would be summed anew for each row
    by_place, back = (Window.partitionBy("row").orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in (here, [c.desc() for c in here]))
    is_base = ~F.col("loose") & F.col("votes").isNotNull()
    reach = F.max(F.when(is_base, F.col("stop"))).over(by_place)
    ahead = F.min(F.when(is_base, F.col("start"))).over(back)
    found = found.select("row", "doc_id", "loose", "start", "stop", span.alias("span"), reach.alias("reach"), ahead.alias("ahead"))
    clear = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("ahead", F.col("stop")) >= F.col("stop"))
    out = found.groupBy("row", "doc_id").agg(F.collect_list(F.when(~F.col("loose"), F.col("span"))).alias("base"), F.collect_list(F.when(F.col("loose") & clear, F.col("span"))).alias("loose"))
    return out.select("doc_id", F.array_sort("base").alias("base"), F.array_sort("loose").alias("loose"))


def estimate(patterns: list[tuple[int, tuple, int]], rounds: int = EM_ROUNDS) -> tuple[dict, dict]:
    """Expectation-maximisation over (kind, votes, count): per kind the share of real
    spans and each labeler's vote distribution given real or not; and the posterior
    of each (kind, votes).  Pseudo-counts say that labelers are better than chance."""
    lean = {1: {1: 4.0, 0: 2.0, -1: 1.0}, 0: {1: 1.0, 0: 2.0, -1: 4.0}}
    posterior = {(k, v): (sum(v) + 2.0 + 1) / (2 * len(v) + 2) if sum(v) > -3 else 0.05 for k, v, _ in patterns}
    models = {}
    for _ in range(rounds):
        for kind in {k for k, _, _ in patterns}:
            real = {1: 1.0, 0: 1.0}
            table = {(j, y, s): lean[y][s] for j in range(len(LABELERS)) for y in (0, 1) for s in (-1, 0, 1)}
            for k, v, n in patterns:
                if k == kind:
                    q = posterior[k, v]
                    real[1] += n * q
                    real[0] += n * (1 - q)
                    for j, s in enumerate(v):
                        table[j, 1, s] += n * q
                        table[j, 0, s] += n * (1 - q)
            total = {(j, y): sum(table[j, y, s] for s in (-1, 0, 1)) for j in range(len(LABELERS)) for y in (0, 1)}
            models[kind] = (real[1] / (real[0] + real[1]), {key: x / total[key[:2]] for key, x in table.items()})
        for k, v, _ in patterns:
            share, table = models[k]
            odds = math.log(share / (1 - share)) + sum(math.log(table[j, 1, s] / table[j, 0, s]) for j, s in enumerate(v))
            posterior[k, v] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return models, posterior


def trained(spans: DataFrame) -> tuple[dict[int, float], dict[tuple[str, int], float]]:
    """The final classifier: log odds per kind, and per (feature, kind * 100 + value + 50).
    Spans reach the driver only as counts of vote and shape patterns, whose number is
    bounded by their few values."""
    each = spans.select(F.explode(F.concat("base", "loose")).alias("s")).groupBy(*[F.col(f"s.{c}").alias(c) for c in ("kind", *LABELERS, *SHAPES)]).count()
    rows = [tuple(r) for r in each.collect()]
    counts: dict = defaultdict(int)
    for r in rows:
        counts[r[0], r[1:6]] += r[-1]
    _, posterior = estimate(sorted((k, v, n) for (k, v), n in counts.items()))
    real = {(k, y): 1.0 for k in range(len(KINDS)) for y in (0, 1)}
    seen: dict = defaultdict(lambda: defaultdict(float))
    values: dict = defaultdict(set)
    for r in rows:
        q, n = posterior[r[0], r[1:6]], r[-1]
        for y, w in ((1, q * n), (0, (1 - q) * n)):
            real[r[0], y] += w
            for f, v in zip((*LABELERS, *SHAPES), r[1:-1]):
                seen[f, r[0], v][y] += w
                values[f, r[0]].add(v)
    prior = {k: math.log(real[k, 1] / real[k, 0]) for k in range(len(KINDS))}
    weights = {}
    for (f, k, v), w in seen.items():
        m = len(values[f, k])
        weights[f, 100 * k + v + 50] = math.log((w[1] + 1) / (real[k, 1] + m)) - math.log((w[0] + 1) / (real[k, 0] + m))
    return prior, weights


def _log_odds(s: Column, prior: dict, weights: dict) -> Column:
    def table(cells: dict) -> Column:
        return F.create_map(*[F.lit(x) for pair in sorted(cells.items()) for x in pair])

    out = F.coalesce(F.try_element_at(table(prior), s["kind"]), F.lit(0.0))
    for f in (*LABELERS, *SHAPES):
        cells = {c: w for (name, c), w in weights.items() if name == f}
        if cells:
            out = out + F.coalesce(F.try_element_at(table(cells), s["kind"] * 100 + s[f] + 50), F.lit(0.0))
    return out


def _written(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    key = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    return F.array_join(F.transform(key, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, added: the contract's spans, and those that the classifier adds;
    each span with start, stop, kind (its place in KINDS) and its votes."""
    spans = stored(voted(docs, id_col, text_col), "pii_votes")
    prior, weights = trained(spans)
    return spans.select("doc_id", "base", F.filter("loose", lambda s: _log_odds(s, prior, weights) > 0).alias("added"))


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    def number(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return find(load(spark, sf_dir, "documents")).select(
        "doc_id", *[number(i) for i in range(len(KINDS))], F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
