"""Large documents read in splits against the whole-document reader."""

import json
import os
import random

import pytest

from tidemark.sources import feeds as FD
from tidemark.sources import splits as SP
from tidemark.sources.feeds import read_feed


@pytest.fixture
def tiny_splits(spark):
    """Every file is cut into splits of some hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def _records(rng, n):
    odd = ['plain', 'quote " in', 'back \\ slash', 'end \\', '{"a": [1]}', '}}}{{{', '[[', ']] ,', 'é한\U0001f600', '\\"', '"', '', ' ', '\n', '":{"']
    out = []
    for i in range(n):
        r = {"k": i, "s": rng.choice(odd) + rng.choice(odd), "n": rng.choice([None, 1.5, True])}
        if rng.random() < 0.2:
            r["deep"] = {"x": [{"y": rng.choice(odd)}, [1, {"z": "}"}]], "w": "x" * rng.choice([0, 900])}
        if rng.random() < 0.1:
            r["Message"] = "harbour"
        out.append(r)
    return out


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def _rows(feed):
    got = {}
    for r in feed.records.orderBy("pos").collect():
        got.setdefault(r["pos"]["line"]["file"].rsplit("/", 1)[-1], []).append(dict(r["rec"]))
    return got


def _both(spark, folder, strict=False):
    whole = read_feed(spark, folder, form="document", strict=strict, split_over=1 << 40)
    split = read_feed(spark, folder, form="document", strict=strict, split_over=40)
    return whole, split


def _same(spark, folder, strict=False):
    whole, split = _both(spark, folder, strict)
    assert _rows(split) == _rows(whole)
    bad = lambda feed: sorted(r["pos"]["file"] for r in feed.malformed.collect())
    assert bad(split) == bad(whole)
    assert split.stats().first() == whole.stats().first()
    return _rows(split)


@pytest.mark.parametrize("strict", [False, True])
def test_regular_documents(spark, tmp_dir, tiny_splits, strict):
    rng = random.Random(1)
    for i, form in enumerate([{}, {"indent": 2, "ensure_ascii": False}, {"separators": (",", ":")}]):
        recs = _records(rng, 30)
        _write(tmp_dir, f"table{i}.json", json.dumps({"Table": recs}, **form))
        _write(tmp_dir, f"array{i}.json", "\n " + json.dumps(recs, **form) + " \n\n")
        _write(tmp_dir, f"more{i}.json", json.dumps({"Status": "ok } ] \" {", "Table": recs, "Count": [1, 2]}, **form))
    _write(tmp_dir, "empty.json", '{"Table":' + " " * 500 + "[]}")
    _write(tmp_dir, "mark.json", b"\xef\xbb\xbf" + json.dumps({"Table": recs}).encode())
    rows = _same(spark, tmp_dir, strict)
    assert len(rows["table0.json"]) == 30 and ("array0.json" in rows) is not strict
    starts = SP.split_starts(SP.fragments(spark, tmp_dir, 40)).where("file like '%table2.json'")
    assert starts.count() > 2 and starts.where("depth >= 2").count() > 1
    everywhere = SP.split_starts(SP.fragments(spark, tmp_dir, 40))
    assert everywhere.where("quoted").count() > 0 and everywhere.where("depth > 4").count() > 0


def test_regular_documents_are_not_read_whole(spark, tmp_dir, tiny_splits, monkeypatch):
    _write(tmp_dir, "a.json", json.dumps({"Table": _records(random.Random(2), 60)}))
    real, asked = FD.read_documents, []
    monkeypatch.setattr(FD, "read_documents", lambda spark, path, up_to=None: (asked.append(up_to), real(spark, path, up_to))[1])
    feed = read_feed(spark, tmp_dir, form="document", split_over=40)
    assert feed.records.count() == 60 and asked == [40]
    assert real(spark, tmp_dir, 40).rdd.getNumPartitions() == 0      # the file does not reach the whole-text scan


def test_irregular_documents_go_to_the_whole_reader(spark, tmp_dir, tiny_splits):
    rng = random.Random(3)
    recs = _records(rng, 12)
    text = json.dumps({"Table": recs})
    one = json.dumps(recs[0])
    cases = {
        "cut": text[: len(text) // 2], "no_bracket": text[:-1], "no_end": text[:-2], "twice": text + text, "tail": text + " x", "lead": "x" + text,
        "comma": text.replace("}, {", "} {", 1), "commas": text.replace("}, {", "},, {", 1), "last": text[:-2] + ",]}", "null": text[:-2] + ", null]}",
        "number": text[:-2] + ", 5]}", "other": json.dumps({"Other": recs, "Table": recs[:2]}), "nested": json.dumps({"Meta": {"a": recs[0]}, "Table": recs}),
        "object": json.dumps({"a": {"b": recs[0]}, "c": recs}), "not_table": json.dumps({"Tables": recs}), "array_in": json.dumps([recs, recs]),
        "message": json.dumps({"Message": "No data found", "pad": "x" * 400}), "one_message": json.dumps([{"Message": "No record found", "pad": "x" * 400}]),
        "two_messages": json.dumps([{"Message": "No record found", "pad": "x" * 400}] * 2), "scalar": '"' + "x" * 400 + '"', "spaces": " " * 700,
        "bad_record": text.replace('"k": 3', '"k": 3x', 1), "open_string": text[:-1] + ', "x": "', "single": "[" + one + "]", "wrong": text.replace("}, {", "}] [{", 1),
        "long": json.dumps({"Note": "x" * 3000, "Table": recs}), "closing": "}" * 300, "repeat": '{"Table": [], "Table": [' + one + "]}" + " " * 300,
    }
    for name, t in cases.items():
        _write(tmp_dir, name + ".json", t)
    rows = _same(spark, tmp_dir)
    assert len(rows["nested.json"]) == 12 and len(rows["single.json"]) == 1 and len(rows["two_messages.json"]) == 2


def test_much_text_outside_records(spark, tmp_dir, tiny_splits, monkeypatch):
    monkeypatch.setattr(SP, "OUTSIDE", 100)
    _write(tmp_dir, "a.json", json.dumps({"Note": "x" * 3000, "Table": [{"k": 1}]}))
    _same(spark, tmp_dir)


def test_irregular_and_too_large_is_malformed(spark, tmp_dir, tiny_splits, monkeypatch):
    monkeypatch.setattr(FD, "WHOLE", 500)
    _write(tmp_dir, "a.json", json.dumps({"Table": _records(random.Random(4), 30)})[:-1])
    feed = read_feed(spark, tmp_dir, form="document", split_over=40)
    assert feed.records.count() == 0 and feed.malformed.count() == 1 and feed.stats().first()["malformed"] == 1


def test_small_and_large_documents_in_one_folder(spark, tmp_dir, tiny_splits):
    rng = random.Random(5)
    for i, n in enumerate([0, 1, 2, 30, 80]):
        _write(tmp_dir, f"{i}.json", json.dumps({"Table": _records(rng, n)}))
    whole = _rows(read_feed(spark, tmp_dir, form="document", split_over=1 << 40))
    assert _rows(read_feed(spark, tmp_dir, form="document", split_over=2000)) == whole and len(whole["4.json"]) == 80


@pytest.mark.parametrize("form", ["lines", "auto"])
def test_one_line_envelope_of_any_size(spark, tmp_dir, tiny_splits, form):
    rng = random.Random(6)
    _write(tmp_dir, "envelope.txt", json.dumps({"Table": [{**r, "s": r["s"].replace("\n", " ")} for r in _records(rng, 50)]}, separators=(",", ":")) + "\n")
    _write(tmp_dir, "lines.txt", "\n".join(json.dumps(r) for r in _records(rng, 50)))
    _write(tmp_dir, "wrapped.txt", '{"Table":[' + ",\n".join(json.dumps(r) for r in _records(rng, 30)) + "]}\n")
    _write(tmp_dir, "broken.txt", '{"Table":[' + ",\n".join(json.dumps(r) for r in _records(rng, 30)) + ",\n{broken\n")
    plain = read_feed(spark, tmp_dir, form=form, split_over=1 << 40)
    split = read_feed(spark, tmp_dir, form=form, split_over=400)
    strip = lambda rows: {f: rows[f] for f in sorted(rows)}
    assert strip(_rows(split)) == strip(_rows(plain))
    assert split.malformed.count() == plain.malformed.count() == 1
    assert split.stats().first()["records"] == plain.stats().first()["records"] == 160
