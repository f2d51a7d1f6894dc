"""Jobs that run side by side, and what the ingest and the gold refresh make of them."""

import os
import threading
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from checks import catalog, feed
from checks.context import Context
from wardflow.operators.messages import message_time
from wardflow.plans import increment
from wardflow.plans.increment import STEPS, Shared, refresh_increment
from wardflow.session import METHOD_BYTES, at_once
from wardflow.sources.files import LISTING
from wardflow.streaming import ingest

HEAD = (
    "MSH|^~\\&|A|F|||2024010{}||ADT^A01|C{}|P|2.5\rEVN|A01\rPID|1||P{}\rPV1|1|E|ED^^^H\rAL1|1|DA|AL1\rDG1|1|||X\r"
    "DG1|2||I10\rIN1|1|PL1\rOBR|1|ORD1\rOBX|1|NM|GLU||5\r"
)


@pytest.fixture
def drops(tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"{i}.hl7").write_text("".join(HEAD.format(1 + k % 3, f"{i}-{k}", k % 4) for k in range(6)))
    return str(tmp_path / "in")


def most_running(calls):
    """How many of the calls stood side by side."""
    now, seen, lock = [0], [0], threading.Lock()

    def watched(call, *a, **k):
        with lock:
            now[0] += 1
            seen[0] = max(seen[0], now[0])
        try:
            time.sleep(0.2)
            return call(*a, **k)
        finally:
            with lock:
                now[0] -= 1

    return {name: partial(watched, call) for name, call in calls.items()}, seen


def test_calls_run_side_by_side_and_in_order_where_asked(spark):
    ended = []
    calls, seen = most_running({n: partial(ended.append, n) for n in "abcd"})
    assert list(at_once(spark, calls, {"d": ["a", "b"], "b": ["a"]})) == list("abcd")
    assert seen[0] > 1 and ended.index("a") < ended.index("b") < ended.index("d")


def test_what_follows_a_failure_is_left_out(spark):
    ended = []

    def fail():
        raise RuntimeError("no disk")

    with pytest.raises(RuntimeError, match="no disk"):
        at_once(spark, {"a": fail, "b": partial(ended.append, "b"), "c": partial(ended.append, "c")}, {"b": ["a"]})
    assert ended == ["c"]


def test_calls_take_on_the_job_group_and_keep_their_own_properties(spark):
    sc, meet = spark.sparkContext, threading.Barrier(2)

    def own(n):
        sc.setLocalProperty("side.by.side", n)
        meet.wait(10)
        return sc.getLocalProperty("side.by.side"), sc.getLocalProperty("spark.jobGroup.id")

    sc.setLocalProperty("spark.jobGroup.id", "caller")
    try:
        assert at_once(spark, {n: partial(own, n) for n in "xy"}) == {n: (n, "caller") for n in "xy"}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_segment_tables_are_written_side_by_side_by_compiled_code(spark, drops, tmp_path, monkeypatch):
    modes, write = [], ingest._write_segment
    seen = []

    def watched(spark, calls, after=None):
        calls, most = most_running(calls)
        found = at_once(spark, calls, after)
        seen.append(most[0])
        return found

    monkeypatch.setattr(ingest, "at_once", watched)
    monkeypatch.setattr(ingest, "_write_segment", lambda *a: modes.append(spark.conf.get(METHOD_BYTES)) or write(*a))
    before = spark.conf.get(METHOD_BYTES, None)
    ingest.ingest_batch(spark, drops, str(tmp_path / "out"), message_time())
    assert seen[0] > 1 and set(modes) == {"8000"} and spark.conf.get(METHOD_BYTES, None) == before
    assert ingest.read_silver(spark, str(tmp_path / "out"), "PID").count() == 30
    found = {(r["segment"], r["rule"]): (r["rows_checked"], r["failures"]) for r in ingest.read_violations(spark, str(tmp_path / "out")).collect()}
    assert found["DG1", "dg1_code_not_null"] == (60, 30) and found["PV1", "pv1_patient_class_present"] == (30, 0)
    assert ingest.read_quarantine(spark, str(tmp_path / "out"), "DG1").count() == 30


def test_a_stream_lists_its_files_in_a_few_tasks(spark, drops, tmp_path):
    before = spark.conf.get(LISTING, None)
    try:
        for own, want in ((None, str(4 * spark.sparkContext.defaultParallelism)), ("7", "7")):
            spark.conf.unset(LISTING) if own is None else spark.conf.set(LISTING, own)
            ingest.start_ingest(spark, drops, str(tmp_path / f"out{own}"), str(tmp_path / f"ckpt{own}"), parsed_at=message_time()).awaitTermination()
            assert spark.conf.get(LISTING) == want
    finally:
        spark.conf.unset(LISTING) if before is None else spark.conf.set(LISTING, before)


def test_gold_steps_run_after_those_they_read_and_share_what_they_ask(spark, drops, tmp_path, monkeypatch):
    begun, ended, asked = [], [], []
    for name, step in STEPS.items():
        monkeypatch.setitem(STEPS, name, lambda r, n=name, f=step: (begun.append((n, set(ended))), f(r), ended.append(n)))
    first = Shared.get
    monkeypatch.setattr(Shared, "get", lambda self, key, make: first(self, key, lambda: asked.append(key[0]) or make()))
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    ingest.ingest_batch(spark, drops, silver, message_time())
    made = refresh_increment(spark, silver, gold, as_of=F.lit("2024-02-01").cast("timestamp"))
    assert list(made) == list(STEPS)
    for name, before in begun:
        assert set(increment.NEEDS.get(name, ())) <= before, name
    assert sorted(asked) == ["activity days", "buckets", "first day"]
    assert refresh_increment(spark, silver, gold) == {}


def test_a_run_of_many_files_counts_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame(
        [(i, f"2024-01-01 00:{i % 60:02d}:00", i % 9, "view", 1.0, "{}") for i in range(1000)],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(catalog, "ingest_batch", partial(ingest.ingest_batch, most_files=4))
    found = catalog.QUERIES["R3_two_runs"][0](Context(spark, str(tmp_path)))
    assert [tuple(r) for r in found.collect()] == [(10, 2)]
    assert len(os.listdir(feed.landing_folder(spark, str(tmp_path)))) == 20
