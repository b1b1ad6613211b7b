"""Committed tables and logs of upserts: isolation, conflicts, history, expiry, compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators.upsert import merge_upsert
from salesmart.sources.commits import FAN_IN, CommitConflict, CommittedTable, MergedTable

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("day", T.StringType()), T.StructField("v", T.StringType()),
                       T.StructField("run", T.StringType())])


def frame(spark, *rows):
    return spark.createDataFrame([(*r, None)[:4] for r in rows], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return CommittedTable(spark, str(tmp_path / "t"), SCHEMA, ["day"], "run")


def test_readers_keep_their_commit_and_reruns_replace(spark, table):
    assert table.read().count() == 0 and table.latest() == 0
    table.replace_run("a", frame(spark, (1, "d", "x", "a"), (2, "e", "y", "a")), "2024-01-01 00:00:00")
    old = table.read()
    table.replace_run("b", frame(spark, (3, "d", "z", "b")), "2024-01-02 00:00:00")
    table.replace_run("a", frame(spark, (1, "d", "new", "a")), "2024-01-03 00:00:00")
    assert rows(old) == [(1, "d", "x", "a"), (2, "e", "y", "a")]
    assert rows(table.read()) == [(1, "d", "new", "a"), (3, "d", "z", "b")]
    assert table.version_at("2024-01-02 12:00:00") == 2 and table.version_at("2023-01-01 00:00:00") == 0
    assert rows(table.read(2)) == [(1, "d", "x", "a"), (2, "e", "y", "a"), (3, "d", "z", "b")]
    assert rows(table.changes(2)) == [(1, "d", "new", "a")]


def test_a_rebuild_reads_the_table_and_a_later_run_strikes_out_its_rows(spark, table):
    for run in "ab":
        table.replace_run(run, frame(spark, (1, "d", f"it's {run}", run), (2, "e", run, run)))
    table.replace_all(table.read().withColumn("v", F.upper("v")))
    assert len(table.segments()) == 1 and table.read().count() == 4
    table.replace_run("a", frame(spark, (9, "d", "again", "a")))
    want = [(1, "d", "IT'S B", "b"), (2, "e", "B", "b"), (9, "d", "again", "a")]
    assert rows(table.read()) == want
    assert rows(spark.sql(table.view_sql())) == want
    table.replace_run("a", frame(spark, (8, "d", "once more", "a")))
    assert [r[0] for r in rows(table.read())] == [1, 2, 8]


def test_a_failure_before_the_commit_leaves_the_old_rows(spark, table, monkeypatch, tmp_path):
    table.replace_run("a", frame(spark, (1, "d", "x", "a")))
    with monkeypatch.context() as patch:
        patch.setattr(CommittedTable, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.replace_all(frame(spark, (5, "d", "half", "a")))
    assert rows(table.read()) == [(1, "d", "x", "a")]
    assert len(os.listdir(tmp_path / "t" / "data")) == 2
    assert table.expire("2100-01-01 00:00:00") == (0, 0)  # young segments may still be committed
    assert table.expire("2100-01-01 00:00:00", grace_hours=0) == (0, 1)
    assert rows(table.read()) == [(1, "d", "x", "a")]


def test_expiry_keeps_what_a_reader_may_need(spark, table):
    for day in range(1, 5):
        table.replace_run("a", frame(spark, (day, "d", "x", "a")), f"2024-01-0{day} 00:00:00")
    assert table.expire("2024-01-03 12:00:00", grace_hours=0) == (2, 2)
    assert table.versions() == [3, 4]
    assert rows(table.read(3)) == [(3, "d", "x", "a")] and rows(table.read()) == [(4, "d", "x", "a")]


def test_two_writers(spark, table, monkeypatch):
    table.replace_run("a", frame(spark, (1, "d", "x", "a")))
    with pytest.raises(CommitConflict):
        table.commit(0, [])
    with pytest.raises(CommitConflict):  # the rename itself refuses a number that is taken
        table._publish("{}", "000000000001.json")
    assert all(not n.startswith(".") or n.endswith(".crc") for n in table._names("commits"))
    seen, latest = [], CommittedTable.latest

    def stale(self):  # another run commits after this one looked
        if not seen:
            seen.append(1)
            found = latest(self)
            other = CommittedTable(spark, table.path, SCHEMA, ["day"], "run")
            monkeypatch.setattr(CommittedTable, "latest", latest)
            other.replace_run("b", frame(spark, (2, "d", "y", "b")))
            return found
        return latest(self)

    monkeypatch.setattr(CommittedTable, "latest", stale)
    table.replace_run("c", frame(spark, (3, "d", "z", "c")))
    assert [r[0] for r in rows(table.read())] == [1, 2, 3]


MART = T.StructType([T.StructField("k", T.LongType()), T.StructField("day", T.StringType()), T.StructField("name", T.StringType()),
                     T.StructField("n", T.LongType())])


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_upserts_equal_merges_whatever_is_compacted(spark, tmp_path):
    rng = random.Random(1)
    log = MergedTable(spark, str(tmp_path / "m"), MART, ["k", "day"], ["n"])
    state = spark.createDataFrame([], MART)
    assert log.read().count() == 0 and log.view_sql() is None
    merged = 0
    for batch in range(11):
        keys = rng.sample(range(40), 12)
        new = spark.createDataFrame(
            [(k, rng.choice("de"), f"b{batch}", None if k % 9 == 0 else batch * 100 + k) for k in keys] + [(None, "d", f"b{batch}", 1)], MART)
        state = spark.createDataFrame(merge_upsert(state, new, ["k", "day"], ["n"]).collect(), MART)
        log.upsert(new)
        while log.compact_step():
            merged += 1
        assert rows(log.read()) == rows(state)
    assert merged >= 2 and len(log.table.segments()) < 2 * FAN_IN
    assert rows(spark.sql(log.view_sql())) == rows(state)


def test_an_upsert_writes_its_batch_and_refuses_repeated_keys(spark, tmp_path):
    log = MergedTable(spark, str(tmp_path / "m"), MART, ["k", "day"], ["n"])
    log.upsert(spark.range(200_000).selectExpr("id AS k", "'d' AS day", "concat('name ', id) AS name", "id AS n"))
    whole = size(tmp_path / "m" / "data")
    log.upsert(spark.range(100).selectExpr("id AS k", "'d' AS day", "'other' AS name", "-id AS n"))
    assert size(tmp_path / "m" / "data") - whole < whole / 100
    assert log.read().where("n <= 0").count() == 100 and log.read().where("name = 'other'").count() == 0
    before = log.table.latest()
    with pytest.raises(Exception, match="duplicate key"):
        log.upsert(spark.createDataFrame([(1, "d", "a", 1), (1, "d", "b", 2)], MART))
    assert log.table.latest() == before
