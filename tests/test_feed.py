"""The feed's messages and files at size: who makes them, what is shuffled, how they are listed."""

import os

import pytest
from pyspark.sql import functions as F

from checks import feed
from wardflow.operators.messages import message_time, messages
from wardflow.sources.files import LISTING, list_files, read_files, read_line_messages
from wardflow.streaming import ingest


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """3000 events in one row group, with null and repeated ids."""
    folder = str(tmp_path_factory.mktemp("events"))
    number = F.when(F.col("id") % 500 == 3, None).otherwise(F.col("id") - F.col("id") % 100 % 2)
    spark.range(3000).select(
        number.alias("event_id"),
        F.timestamp_seconds(1704067200 + F.col("id") * 300).alias("ts"),
        (F.col("id") % 40).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("signup", "view", "purchase", "click"))), (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 90).cast("double").alias("value"),
    ).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_are_made_by_many_tasks_and_not_shuffled(spark, events):
    for df in (feed.feed(spark, events), feed.feed_files(spark, events)):
        shuffles = [line for line in plan(df).splitlines() if "Exchange" in line]
        assert len(shuffles) == 1
        below = plan(df).split("Exchange", 1)[1]
        assert "raw_message" not in below and "MSH" not in below
    assert feed.feed(spark, events).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_text_is_made_by_compiled_code(spark, events):
    assert "->" not in feed.raw_message(feed.Spark)
    seen = []

    def build(spark, sf_dir):
        seen.append(spark.conf.get(feed.METHOD_BYTES))
        return spark.range(1)

    before = spark.conf.get(feed.METHOD_BYTES, None)
    feed.landed(spark, events, "method-bytes", build)
    assert seen == ["8000"] and spark.conf.get(feed.METHOD_BYTES, None) == before


def test_repeats_are_as_many_as_counted(spark):
    made = F.expr(feed.Spark.lines("'L' || {i} || ';'", "n", 3))
    rows = spark.createDataFrame([(0,), (1,), (3,)], "n long").select("n", made.alias("text")).collect()
    assert {r["n"]: r["text"] for r in rows} == {0: "", 1: "L0;", 3: "L0;L1;L2;"}


def test_a_line_with_an_unknown_value_is_left_out(spark, tmp_path):
    """The message stays, without that line."""
    rows = [(1, None), (2, 3.0), (11, None)]
    made = spark.createDataFrame(rows, "event_id long, value double")
    made = made.selectExpr("event_id", "timestamp'2024-01-01' AS ts", "1L AS user_id", "'click' AS event_type", "value")
    made.write.parquet(f"{tmp_path}/events.parquet")
    texts = {r["event_id"]: r["raw_message"] for r in feed.feed(spark, str(tmp_path)).collect()}
    assert {k: x.count("\rOBX|") for k, x in texts.items()} == {1: 0, 2: 2, 11: 0}


def test_more_events_get_more_tasks(spark, events, monkeypatch):
    monkeypatch.setattr(feed, "TASK_EVENTS", 100)
    assert feed.feed(spark, events).rdd.getNumPartitions() == 30


def test_files_hold_their_events_in_order(spark, events):
    made = feed.feed(spark, events).where("event_id IS NOT NULL")
    want = made.groupBy(F.floor(F.col("event_id") / feed.FILE_SIZE).alias("n")).agg(F.count("*").alias("events"))
    got = messages(feed.feed_files(spark, events)).where("file_id IS NOT NULL").groupBy("file_id").count()
    assert same(got, want.select(F.concat(F.lit("file-"), F.col("n").cast("string")).alias("file_id"), "events"))


def test_drops_hold_every_message(spark, events, monkeypatch):
    monkeypatch.setattr(feed, "DROP_TEXTS", 7)
    files = read_files(spark, feed.landing_drops(spark, events), glob="*.txt")
    assert files.count() < 60 // 2
    want = messages(feed.landed_files(spark, events)).select("message_id", "raw_message")
    assert same(messages(files).select("message_id", "raw_message"), want)


def listing_tasks(spark, name, make):
    spark.sparkContext.setJobGroup(name, name)
    try:
        make()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(job).stageIds]
    return [tracker.getStageInfo(s).numTasks for s in stages]


def test_folders_are_listed_in_a_few_tasks(spark, tmp_path):
    most = 4 * spark.sparkContext.defaultParallelism
    for i in range(2 * most):
        os.mkdir(tmp_path / f"{i}")
        (tmp_path / f"{i}" / "a.txt").write_text("MSH|")
    paths = [str(tmp_path / f"{i}" / "a.txt") for i in range(2 * most)]
    before = spark.conf.get(LISTING, None)
    listed = listing_tasks(spark, "list", lambda: list_files(spark, str(tmp_path), glob="*.txt", recursive=True))
    read = listing_tasks(spark, "read", lambda: read_files(spark, paths, glob="*"))
    assert listed and read and max(listed + read) <= most
    assert spark.conf.get(LISTING, None) == before


def test_batches_share_one_scan_of_the_listing(spark, events, tmp_path, monkeypatch):
    seen, plain = [], ingest.not_taken
    monkeypatch.setattr(ingest, "not_taken", lambda files, out: seen.append(files.storageLevel.useMemory) or plain(files, out))
    folder = feed.landing_drops(spark, events)
    made = ingest.ingest_batch(spark, folder, str(tmp_path), message_time(), glob="*.txt", most_files=4)
    assert len(made) > 1 and seen == [True] * (len(made) + 1)
    # The listing is let go.
    assert not list_files(spark, folder, glob="*.txt").coalesce(4 * spark.sparkContext.defaultParallelism).storageLevel.useMemory


def test_line_messages_open_each_file_once(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.hl7").write_text("".join(f"MSH|^~\\&|A|F|{i}|{k}\rPID|1||P{k}\n\n" for k in range(4)))
    found = read_line_messages(spark, str(tmp_path))
    assert "FileScan text" not in plan(found)
    want = messages(read_files(spark, str(tmp_path)))
    assert found.count() == 12
    assert same(found.select("raw_message", "file_message_count"), want.select("raw_message", "file_message_count"))


def test_named_files_are_written_without_a_process_each(spark, events):
    folder = feed.landing_folder(spark, events)
    names = [f for _, _, files in os.walk(folder) for f in files]
    assert set(names) == {"part-00000.txt"}  # no checksums, no marker, nothing half written
    plain = feed.new_path(spark, "plain")
    rows = feed.landed_files(spark, events).select("file_id", F.col("raw_content").alias("value"))
    rows.write.partitionBy("file_id").text(plain)

    def read(path):
        name = F.regexp_extract("source_file", "file_id=([^/]*)/", 1)
        return read_files(spark, path, glob="*.txt", recursive=True).select(name.alias("name"), "raw_content")

    assert same(read(folder), read(plain)) and read(folder).where("name LIKE '%HIVE_DEFAULT%'").count() == 1
