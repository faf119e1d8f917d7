"""Versioned tables: operations, net changes, commit lists, bases with late commits over them."""

import datetime

import pytest
from pyspark.sql import functions as F

from copperleaf.sources import changelog as C
from copperleaf.sources import versions as V

KEYS, SCHEMA = ["id", "t"], "id long, t timestamp, v string"
DAY = lambda m: datetime.datetime(2024, m, 5)
TIE = lambda: F.col("v")


@pytest.fixture
def log(spark, tmp_path):
    """Commits of two writers; b's first one is written last and at a late time."""
    path = str(tmp_path / "log")

    def put(rows, seq, writer="a", hour=None, op=C.UPSERT):
        at = datetime.datetime(2024, 6, 1, seq if hour is None else hour)
        C.append(spark.createDataFrame([(i, DAY(m), v) for i, m, v in rows], SCHEMA), path, seq, writer, F.lit(at).cast("timestamp"), op)

    put([(1, 1, "x"), (2, 1, "x"), (3, 2, "x"), (9, 3, "x")], 0)
    put([(2, 1, "y"), (2, 1, "z"), (4, 2, "n")], 1)
    put([(3, 2, "x")], 2, op=C.DELETE)
    put([(5, 2, "p"), (5, 2, "q"), (1, 1, "beside")], 2, "b", op=C.APPEND)
    put([(2, 1, "y"), (2, 1, "z"), (4, 2, "n")], 1)  # a replay
    put([(6, 3, "new"), (3, 2, "late")], 1, "b", 20)
    return path


def rows(df, *names):
    return sorted((tuple(r[n] for n in (names or ("id", "v"))) for r in df.collect()), key=str)


def test_operations(spark, log):
    table = C.read(spark, log)
    assert rows(C.live_rows(table, KEYS, TIE())) == [(1, "beside"), (1, "x"), (2, "z"), (4, "n"), (5, "p"), (5, "q"), (6, "new"), (9, "x")]
    assert rows(C.latest_by_key(table, KEYS, TIE())) == [(1, "beside"), (2, "z"), (4, "n"), (5, "q"), (6, "new"), (9, "x")]
    with pytest.raises(ValueError, match="no such operation"):
        C.append(spark.createDataFrame([], SCHEMA), log, 9, op="MERGE")


def test_commit_list(spark, log):
    got = V.commit_list(C.read(spark, log), KEYS, TIE()).orderBy("_commit_seq", "_writer").collect()
    assert [(r._commit_seq, r._writer, r.operation, r.n_rows, r.total_records) for r in got] == [
        (0, "a", "UPSERT", 4, 4), (1, "a", "UPSERT", 3, 5), (1, "b", "UPSERT", 2, 6), (2, "a", "DELETE", 1, 5), (2, "b", "APPEND", 3, 8),
    ]
    assert got[2].committed_at == datetime.datetime(2024, 6, 1, 20)


def test_net_changes(spark, log):
    table = C.read(spark, log)
    image = lambda r: (r.id, r.change, r.old and r.old.v, r.new and r.new.v)
    seen, only = V.between(0, 1)
    assert sorted(map(image, V.net_changes(table, KEYS, seen, TIE(), only).collect())) == [(2, "update", "x", "z"), (3, "update", "x", "late"), (4, "insert", None, "n"), (6, "insert", None, "new")]
    # the late commit alone: its version of 3 is older than the delete that was seen, so nothing changes there
    late = (F.col("_writer") != "b") | (F.col("_commit_seq") != 1)
    assert sorted(map(image, V.net_changes(table, KEYS, late, TIE()).collect())) == [(6, "insert", None, "new")]
    seen, only = V.between(1, 2)
    assert (3, "delete", "late", None) in map(image, V.net_changes(table, KEYS, seen, TIE(), only).collect())
    assert V.net_changes(table, KEYS, F.lit(True), TIE()).collect() == []


def test_bases_skip_history(spark, log, tmp_path):
    table, bases = C.read(spark, log), str(tmp_path / "bases")
    want = rows(C.latest_by_key(table, KEYS, TIE()))
    assert rows(V.current(table, bases, KEYS, TIE(), "t")) == want  # without a base
    V.make_base(table.filter("_commit_seq = 0"), bases, 1, KEYS, TIE(), "t")
    V.make_base(table.filter("_commit_ts < timestamp '2024-06-01 03:00:00'"), bases, 2, KEYS, TIE(), "t")
    assert V.newest_base(spark, bases) == 2
    now = V.current(table, bases, KEYS, TIE(), "t")
    assert rows(now) == want
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert "_writer" in plan and "IN (2024-03,2024-02)" in plan.replace("2024-02,2024-03", "2024-03,2024-02")  # only the late commit's months meet
    at = F.lit("2024-06-01 00:30:00").cast("timestamp")
    assert V.newest_base(spark, bases, at) == 1
    assert rows(V.current(table, bases, KEYS, TIE(), "t", at)) == rows(C.as_of(table, KEYS, at, TIE()))
    early = F.lit("2000-01-01").cast("timestamp")
    assert V.newest_base(spark, bases, early) is None and V.current(table, bases, KEYS, TIE(), "t", early).collect() == []
    V.make_base(table, bases, 3, KEYS, TIE(), "t")
    assert rows(V.current(table, bases, KEYS, TIE(), "t")) == want


def test_bases_and_their_commits_meet_in_one_shuffle(spark, log, tmp_path):
    table, bases = C.read(spark, log), str(tmp_path / "bases")
    V.make_base(table.filter("_commit_seq < 2"), bases, 1, KEYS, TIE(), "t")
    plan = V.current(table, bases, KEYS, TIE(), "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_many_commits_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "log")
    put = lambda rows: C.append_commits(spark.createDataFrame(rows, "id long, v string, _writer string, _commit_seq int, _op string, _commit_ts string"), path)
    at = "2024-06-01 00:00:00"
    put([(1, "x", "a", 0, C.UPSERT, at), (2, "x", "a", 0, C.UPSERT, at), (1, None, "b", 0, C.DELETE, at), (3, "y", "a", 1, C.APPEND, at)])
    put([(3, "z", "a", 1, C.APPEND, at)])  # replaces its commit only
    C.append(spark.createDataFrame([(4, "w")], "id long, v string"), path, 1, "b", F.lit(at).cast("timestamp"))
    assert rows(C.live_rows(C.read(spark, path), ["id"], TIE())) == [(2, "x"), (3, "z"), (4, "w")]


def test_newest_version_is_limited_before_the_shuffle(spark, log):
    plan = C.latest_by_key(C.read(spark, log), KEYS, TIE())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "SortAggregate" not in plan
