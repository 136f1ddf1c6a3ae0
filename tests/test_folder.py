"""A folder of feed files loaded as one plan."""

import os

from pyspark.sql import types as T

from tidemark.plans import bulk as B
from tidemark.sources.store import SnapshotStore
from tidemark.spec import TableSpec

SPEC = TableSpec.of("board", T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.LongType()),
                                           T.StructField("flag", T.StringType())]), pk=["k"], renames={"vendor a": "a"})
OTHER = TableSpec.of("other", T.StructType([T.StructField("id", T.LongType()), T.StructField("flag", T.StringType())]), pk=["id"])


def _put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name + ".txt"), "w") as f:
            f.write(text)


def _load(spark, folder, store=None):
    rep = B.load_folder(spark, folder, {"board": SPEC, "other": OTHER}, {"board": store} if store else None)
    return {r.file[:-4]: (r.table_name, r.structure, r.load, r.rows_loaded, r.notes) for r in rep.collect()}


def test_names_are_resolved_per_file(spark, tmp_dir):
    """Spellings, renames and repeated names differ between the files of one table."""
    d, store = os.path.join(tmp_dir, "f"), SnapshotStore(spark, os.path.join(tmp_dir, "s"), SPEC)
    _put(d, BOARD='{"Table":[{" K ": 1, "Vendor A": "x", "B": 5, "FLAG": "a"}, {" K ": 2, "a": "direct", "FLAG": "A"}]}',
         Board='{"Table":[{"k": 3, "A": "first", "a ": "second", "flag": "A", "it\'s": 1}]}',
         board='{"Table":[{"k": 4, "VENDOR A": "old", "vendor a": "new", "b": "7", "flag": "A"}]}')
    rep = _load(spark, d, store)
    assert rep["Board"] == ("board", "MISMATCH", "PASS", 1, """extra_json=["it's"] | missing_json=['b']""")
    assert rep["board"][1:3] == ("MISMATCH", "PASS") and rep["BOARD"][1:4] == ("MATCH", "PASS", 2)
    assert sorted((r.k, r.a, r.b) for r in store.read().collect()) == [(1, "x", 5), (2, None, None), (3, "first", None), (4, "new", 7)]


def test_files_are_folded_in_name_order(spark, tmp_dir):
    d, store = os.path.join(tmp_dir, "f"), SnapshotStore(spark, os.path.join(tmp_dir, "s"), SPEC)
    store.write(spark.createDataFrame([(1, "t", 1, "A"), (2, "t", 2, "A"), (3, "t", 3, "A"), (9, "t", 9, "A")], SPEC.schema))
    _put(d, BOARD='{"Table":[{"k": 1, "a": "one", "flag": "O"}, {"k": 2, "flag": "D"}, {"k": 3, "a": "gone", "flag": "A"}, {"k": 5, "a": "n", "flag": "A"}]}',
         Board='{"Table":[{"k": 2, "b": 20, "flag": "A"}, {"k": 3, "b": 30, "flag": "A"}, {"k": 3, "b": 0, "flag": "D"}, {"k": 5, "b": 0, "flag": "D"}]}',
         board='{"Table":[{"k": 1, "b": 10, "flag": "O"}, {"k": 1, "b": 11, "flag": "X"}, {"k": 7, "b": 0, "flag": "D"}]}')
    assert {f: x[2:4] for f, x in _load(spark, d, store).items()} == {"BOARD": ("PASS", 4), "Board": ("PASS", 4), "board": ("PASS", 2)}
    got = {r.k: (r.a, r.b, r.flag) for r in store.read().collect()}
    # 1: two files overlay; 2: deleted, then added with b only; 3: deleted and added in one file; 5: added, then deleted; 9: untouched
    assert got == {1: ("one", 10, "O"), 2: (None, 20, "A"), 3: (None, 30, "A"), 9: ("t", 9, "A")}


def test_a_bad_file_is_left_out_as_a_whole(spark, tmp_dir):
    d, store = os.path.join(tmp_dir, "f"), SnapshotStore(spark, os.path.join(tmp_dir, "s"), SPEC)
    _put(d, BOARD='{"Table":[{"k": 1, "a": "x", "b": 1, "flag": "A"}, {"k": null, "a": "y", "b": 1, "flag": "A"}]}',
         Board='{"Table":[{"k": 2, "a": "x", "b": "1.5", "flag": "A"}]}', bOard='{"Table":[{"zzz": 1}]}', boArd='{"Table":[{"k": 3, "a": "x", "b": 1}]}',
         boaRd='{"Table":[]}', board='{"Table":[{"k": 4, "a": "x", "b": 1, "flag": "A"}]}', other='{"Table":[{"id": 4, "flag": "A"}]}',
         OTHER='[{"id": 5, "flag": "A"}]', nothing="{}", **{"with space+plus": "{}"})
    rep = _load(spark, d, store)
    assert rep["BOARD"] == ("board", "MATCH", "FAIL", 0, "NULL primary key in 1 add/update rows")
    assert rep["Board"] == ("board", "MATCH", "FAIL", 0, "values the declared types cannot store")
    assert rep["bOard"][2:4] == ("FAIL", 0) and rep["bOard"][4].endswith("No valid columns after schema filtering for table=board")
    assert rep["boArd"] == ("board", "MISMATCH", "FAIL", 0, "missing_json=['flag'] | Required 'flag' column not present for table: board")
    assert rep["boaRd"][1:4] == ("MISMATCH", "FAIL", 0) and rep["OTHER"][1:3] == ("PARSE ERROR", "SKIP")
    assert rep["nothing"] == rep["with space+plus"] == ("NOT FOUND", "SKIP", "SKIP", 0, "No matching table")
    assert rep["other"][2:4] == rep["board"][2:4] == ("PASS", 1) and [r.k for r in store.read().collect()] == [4]


def test_jobs_do_not_grow_with_files(spark, tmp_dir):
    tracker, counts = spark.sparkContext.statusTracker(), []
    for n in (2, 24):
        d = os.path.join(tmp_dir, f"f{n}")
        _put(d, **{"".join(c.upper() if i >> j & 1 else c for j, c in enumerate("board")): f'{{"Table":[{{"k": {i}, "a": "x", "b": 1, "flag": "A"}}]}}' for i in range(n)})
        spark.sparkContext.setJobGroup(f"folder{n}", "folder")
        try:
            assert len(_load(spark, d)) == n
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        counts.append(len(tracker.getJobIdsForGroup(f"folder{n}")))
    assert counts[0] > 0 and abs(counts[1] - counts[0]) <= 3, counts


def test_a_table_unpacks_its_own_files_only(spark, tmp_dir, monkeypatch):
    """Its records come from lines stored with their table: no join after the records of all files are unpacked."""
    d, plans, real = os.path.join(tmp_dir, "f"), [], B.typed_rows
    _put(d, board='{"Table":[{"k": 4, "a": "x", "b": 1, "flag": "A"}]}', other='{"Table":[{"id": 4, "flag": "A"}]}')

    def typed(records, *rest):
        plans.append(records._jdf.queryExecution().executedPlan().toString())
        return real(records, *rest)

    monkeypatch.setattr(B, "typed_rows", typed)
    assert all(x[2:4] == ("PASS", 1) for x in _load(spark, d).values())
    assert len(plans) == 2 and not any("Join" in p for p in plans) and "EqualTo(table_name,board)" in plans[0]
