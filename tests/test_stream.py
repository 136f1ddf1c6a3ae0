"""Streams: failing, empty, replayed and restarted batches lose and repeat nothing."""

import os

import pytest
from pyspark.sql import types as T
from pyspark.sql.utils import StreamingQueryException

from tidemark.plans import fixtures as FX
from tidemark.spec import TableSpec
from tidemark.streaming.merge_stream import MergeStream


def _put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _row(key, event, value="1.5"):
    return f'{{"user_id": {key}, "event_id": {event}, "event_type": "v", "value": {value}, "flag": "A"}}'


class Run:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.folder = os.path.join(root, "in")

    def stream(self, **kw):
        return MergeStream(self.spark, os.path.join(self.root, "stream"), FX.EVENTS_SPEC, **kw)

    def go(self, **kw):
        self.stream().run(self.folder, **kw)
        return {r.user_id: r.event_id for r in self.stream().current().collect()}

    def log(self):
        return {r.batch_id: (r.status, r.rows_received, r.rows_malformed) for r in self.stream().log().collect()}


def test_empty_batch_passes_and_restart_continues(spark, tmp_dir):
    run = Run(spark, tmp_dir)
    _put(run.folder, "1.json", _row(1, 1), "{broken", _row(2, 2))
    assert run.go() == {1: 1, 2: 2}
    _put(run.folder, "2.json", '{"Message":"No Data Found"}')
    assert run.go() == {1: 1, 2: 2}
    _put(run.folder, "3.json", _row(1, 5), _row(3, 6))
    assert run.go() == {1: 5, 2: 2, 3: 6}
    assert run.log() == {0: ("SUCCESS", 2, 1), 1: ("EMPTY", 0, 0), 2: ("SUCCESS", 2, 0)}


def test_failing_batch_stops_the_stream_and_is_read_again(spark, tmp_dir):
    run = Run(spark, tmp_dir)
    _put(run.folder, "1.json", _row(1, 1))
    run.go()
    _put(run.folder, "2.json", _row(2, 2), _row(3, '"1.5"'))          # no whole number: cannot be stored
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            run.go()
    assert [r.user_id for r in run.stream().current().collect()] == [1] and run.log()[1][0] == "FAILED"
    os.remove(os.path.join(run.folder, "2.json"))
    _put(run.folder, "2.json", _row(2, 2), _row(3, 3))                # the feed is mended
    assert run.go() == {1: 1, 2: 2, 3: 3}


def test_quarantine_keeps_the_lines(spark, tmp_dir):
    run, aside = Run(spark, tmp_dir), os.path.join(tmp_dir, "aside")
    _put(run.folder, "1.json", _row(2, 2), _row(3, '"1.5"'))
    assert run.go(quarantine=aside) == {}
    _put(run.folder, "2.json", '{"event_id": 7, "flag": "A"}')         # no key column
    _put(run.folder, "3.json", _row(4, 4))
    assert run.go(quarantine=aside) == {4: 4}
    assert spark.read.parquet(aside).count() == 3


def _forget(folder, batch):
    """As after a crash: the batch ran, but its checkpoint was not committed."""
    for name in (str(batch), f".{batch}.crc"):
        path = os.path.join(folder, "commits", name)
        if os.path.exists(path):
            os.remove(path)


@pytest.mark.parametrize("stage", ["judge", "merge"])
def test_replayed_batch_changes_nothing(spark, tmp_dir, stage):
    run = Run(spark, tmp_dir)
    _put(run.folder, "1.json", _row(1, 1), _row(2, 2))
    run.go()
    changes, log = sorted(run.stream().changes().collect()), run.log()
    _forget(os.path.join(tmp_dir, "stream", "_checkpoint", stage), 0)
    assert run.go() == {1: 1, 2: 2}
    assert sorted(run.stream().changes().collect()) == changes and run.log() == log == {0: ("SUCCESS", 2, 0)}
    _put(run.folder, "2.json", _row(2, 5))
    assert run.go() == {1: 1, 2: 5}


def test_good_batches_before_a_failing_one_are_applied(spark, tmp_dir):
    run = Run(spark, tmp_dir)
    _put(run.folder, "1.json", _row(1, 1))
    _put(run.folder, "2.json", _row(3, '"1.5"'))
    os.utime(os.path.join(run.folder, "1.json"), (1, 1))
    with pytest.raises(StreamingQueryException):
        run.go()
    assert [r.user_id for r in run.stream().current().collect()] == [1]


SPEC = TableSpec.of("t", T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.DecimalType(38, 6)), T.StructField("n", T.LongType()),
                                       T.StructField("s", T.StringType()), T.StructField("at", T.TimestampNTZType()), T.StructField("flag", T.StringType())]), pk=["k"])


def test_delete_add_partial_columns_and_exact_values(spark, tmp_dir):
    """Columns that a batch does not carry keep the stored value; large numbers stay exact."""
    stream, folder = MergeStream(spark, os.path.join(tmp_dir, "stream"), SPEC), os.path.join(tmp_dir, "in")
    big, money = 2 ** 62 + 1, "12345678901234567890.123456"
    batches = [
        [f'{{"k": 1, "a": "{money}", "n": {big}, "s": "x", "at": "2024-01-02 03:04:05", "flag": "A"}}', '{"k": 2, "s": "y", "flag": "A"}', '{"k": null, "s": "z", "flag": "A"}'],
        ['{"k": 1, "s": "changed", "flag": "O"}', '{"k": 2, "flag": "D"}', '{"k": 3, "flag": "D"}', '{"k": 1, "s": "last", "flag": "O"}'],
        ['{"k": 2, "s": "again", "flag": "A"}', '{"k": 1, "s": "last", "flag": "O"}', '{"k": 1, "s": "?", "flag": "X"}'],
    ]
    for i, lines in enumerate(batches):
        _put(folder, f"{i}.json", *lines)
        stream.run(folder)
    rows = {r.k: r for r in stream.current().collect()}
    assert set(rows) == {1, 2} and (str(rows[1].a), rows[1].n, rows[1].s, str(rows[1]["at"])) == (money, big, "last", "2024-01-02 03:04:05")
    assert (rows[2].a, rows[2].s, rows[2].flag) == (None, "again", "A")
    got = {(r.batch_id, r.k): r.action for r in stream.changes().collect()}
    assert got == {(0, 1): "insert", (0, 2): "insert", (1, 1): "update", (1, 2): "delete", (1, 3): "no_match", (2, 1): "ignored", (2, 2): "insert"}
    log = {r.batch_id: (r.rows_received, r.rows_inserted, r.rows_updated, r.rows_deleted, r.rows_unchanged, r.rows_rejected) for r in stream.log().collect()}
    assert log == {0: (3, 2, 0, 0, 0, 1), 1: (4, 0, 1, 1, 0, 2), 2: (3, 1, 0, 0, 0, 2)}


def test_stream_on_top_of_a_table(spark, tmp_dir):
    stream, folder = MergeStream(spark, os.path.join(tmp_dir, "stream"), FX.EVENTS_SPEC, newer_than="event_id"), os.path.join(tmp_dir, "in")
    stream.start_from(spark.createDataFrame([(1, 10, "v", 1.0), (2, 3, "v", 2.0)], FX.EVENTS_SPEC.schema))
    _put(folder, "1.json", _row(1, 9), _row(2, 20), _row(4, 1))
    stream.run(folder)
    assert {r.user_id: r.event_id for r in stream.current().collect()} == {1: 10, 2: 20, 4: 1}
    log = stream.log().first()
    assert (log.rows_inserted, log.rows_updated, log.rows_stale, log.rows_rejected) == (1, 1, 1, 1)
    with pytest.raises(ValueError):
        stream.start_from(stream.current())


def test_current_rows_become_a_version(spark, tmp_dir):
    from tidemark.sources.store import SnapshotStore
    run = Run(spark, tmp_dir)
    _put(run.folder, "1.json", _row(1, 1), _row(2, 2))
    run.go()
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.EVENTS_SPEC)
    assert store.write(run.stream().current()) == 1 and store.read().count() == 2
