"""The stored state: all tables of a run or none, one of two writers, open run records."""

import os
import tempfile

import pytest

from conftest import SF_SMALL
from lodestar.constants import AS_OF
from lodestar.plans import jobs, run
from lodestar.plans.state import Conflict, Store


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_states_are_whole_and_numbered(spark):
    s = Store(spark, tempfile.mkdtemp(prefix="lodestar-state-"))
    assert s.snapshot().number == 0 and s.read("a") is None and s.versions("a") == []
    one = s.commit(s.snapshot(), {"a": spark.range(3), "b": spark.range(2)})
    two = s.commit(one, {"a": spark.range(5)})
    assert (one.number, two.number) == (1, 2) and s.versions("a") == [1, 2] and s.versions("b") == [1]
    assert s.read("a").count() == 5 and s.read("b").count() == 2
    assert s.read("a", s.snapshot(1)).count() == 3      # what was read is never overwritten


def test_of_two_writers_one_wins(spark):
    s = Store(spark, tempfile.mkdtemp(prefix="lodestar-race-"))
    base = s.commit(s.snapshot(), {"a": spark.range(1), "b": spark.range(1)})
    mine, theirs = s.put({"a": spark.range(10)}), s.put({"a": spark.range(20)})
    s.publish(base, theirs)
    with pytest.raises(Conflict, match="a"):
        s.publish(base, mine)
    with pytest.raises(Conflict, match="a"):            # rests on a table that has changed
        s.publish(base, s.put({"b": spark.range(7)}), read=("a",))
    assert s.publish(base, s.put({"c": spark.range(4)})).number == 3        # nothing in common: goes on from the new state
    assert s.read("a").count() == 20 and s.read("b").count() == 1 and s.read("c").count() == 4


def test_a_taken_number_is_never_overwritten(spark, monkeypatch):
    s = Store(spark, tempfile.mkdtemp(prefix="lodestar-taken-"))
    base = s.commit(s.snapshot(), {"a": spark.range(1)})
    assert not s._rename_new("{}", 1) and s._rename_new('{"a": [1, "x"]}', 2)
    assert s.snapshot(1).tables == base.tables
    assert not [f for f in os.listdir(f"{s.root}/_state") if f.startswith("_tmp")]


def test_crash_between_two_tables_leaves_the_old_state(spark):
    s = Store(spark, tempfile.mkdtemp(prefix="lodestar-crash-"))
    base = s.commit(s.snapshot(), {"a": spark.range(1), "b": spark.range(1)})
    broken = spark.range(5).selectExpr("raise_error('lost') as id")
    with pytest.raises(Exception, match="lost"):
        s.commit(base, {"a": spark.range(100), "b": broken})
    now = Store(spark, s.root)
    assert now.snapshot() == base and now.read("a").count() == 1
    assert now.commit(base, {"a": spark.range(2)}).number == 2


def test_a_run_that_dies_leaves_running_records(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="lodestar-dead-")
    def dies(*a, **k):
        raise RuntimeError("executor lost")
    with monkeypatch.context() as m:
        m.setattr(jobs, "ingest", dies)
        with pytest.raises(RuntimeError, match="executor lost"):
            run.run_ingest(spark, SF_SMALL, out, AS_OF)
    open_ = run.newest(spark, f"{out}/runs").collect()
    sites = {r.source_site for r in jobs.source_sites(spark, SF_SMALL).collect()}
    assert {r.source_site for r in open_} == sites and {(r.status, r.completed_at) for r in open_} == {("running", None)}
    assert run.newest(spark, f"{out}/listings") is None
    run.run_ingest(spark, SF_SMALL, out, "2024-02-01 00:00:00")
    later = run.newest(spark, f"{out}/runs").collect()
    assert len(later) == 2 * len(sites) and sum(r.status == "running" for r in later) == len(sites)
    assert run.versions(spark, f"{out}/listings") == [1]
