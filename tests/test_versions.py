"""Tables that switch versions, the change feed, and gold kept up to date from new batches."""

import re

import pytest
from pyspark.sql import functions as F

from wardflow.operators import features
from wardflow.sources import versions
from wardflow.sources.changes import publish_version, read_changes, read_published, replay
from wardflow.sources.predictions import append_predictions, open_days, predictions_of, read_predictions
from wardflow.sources.versions import in_parts, part_names, read_version, state, taken_batches, write_version


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def partition_filter(df, column):
    return re.search(rf"PartitionFilters: \[[^\]]*cast\({column}#", df._jdf.queryExecution().executedPlan().toString())


def made(spark, days, start=0):
    return spark.createDataFrame([(d, start + i) for i, d in enumerate(days)], "d string, n int").select(F.to_date("d").alias("day"), "n")


def test_versions_replace_and_add_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(made(spark, ["2024-01-01", "2024-01-02", None]), path, "day", batches=["a"])
    write_version(made(spark, ["2024-01-02"], 10), path, "day", replaced=["2024-01-02"], batches=["b", "c"])
    write_version(made(spark, ["2024-01-01"], 20), path, "day", add=True)
    write_version(made(spark, []), path, "day", replaced=[versions.NULL_PART])
    found = read_version(spark, path, keep_part=True)
    assert sorted((str(r["day"]), r["n"]) for r in found.collect()) == [("2024-01-01", 0), ("2024-01-01", 20), ("2024-01-02", 10)]
    assert rows(taken_batches(spark, path)) == [("a",), ("b",), ("c",)]
    assert read_version(spark, path).columns == ["n"]
    assert part_names(found, "day") == ["2024-01-01", "2024-01-02"]
    assert partition_filter(found.where(in_parts("day", ["2024-01-02"])), "day")
    with pytest.raises(ValueError):
        write_version(made(spark, ["2024-01-01"]), path, replaced=["2024-01-01"])


def test_an_interrupted_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_version(made(spark, ["2024-01-01"]), path)

    def fail(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(versions, "_put", fail)
        with pytest.raises(RuntimeError):
            write_version(made(spark, ["2024-02-01", "2024-02-02"]), path)
    assert [str(r["day"]) for r in read_version(spark, path).collect()] == ["2024-01-01"]
    write_version(made(spark, ["2024-03-01"]), path)
    assert [str(r["day"]) for r in read_version(spark, path).collect()] == ["2024-03-01"]
    assert state(spark, path).version == 2


def test_long_logs_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "FOLD", 3)
    path, one = str(tmp_path / "t"), made(spark, ["2024-01-01"])
    for _ in range(8):
        write_version(one, path, "day", add=True)
    assert read_version(spark, path).count() == 8 and state(spark, path).version == 8


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(made(spark, []), path, "day")
    assert read_version(spark, path).count() == 0 and read_version(spark, path, keep_part=True).columns == ["day", "n"]


def test_change_feed_replays_to_the_newest_version(spark, tmp_path):
    path, schema = str(tmp_path / "p"), "k int, k2 string, v string"
    snapshots = [
        [(1, None, "a"), (2, "x", None), (3, "y", "c")],
        [(1, None, "b"), (3, "y", "c"), (4, "z", "d")],
        [(1, None, "b"), (2, "x", "again"), (4, "z", None)],
    ]
    seen = []
    for values in snapshots:
        seen.append(spark.createDataFrame(values, schema))
        assert publish_version(seen[-1], path, ["k", "k2"]) == len(seen)
    assert rows(read_published(spark, path)) == rows(seen[-1])
    for since in range(3):
        base = seen[since - 1] if since else seen[0].limit(0)
        assert rows(replay(base, read_changes(spark, path, since), ["k", "k2"])) == rows(seen[-1])
    assert read_changes(spark, path, 3).count() == 0
    assert read_changes(spark, path, 2).count() == 3  # one back, one gone, one changed


def test_predictions_are_read_by_open_days_only(spark, tmp_path):
    schema = "prediction_id string, target_hour timestamp, actual_value double, absolute_error double"
    hours = [f"2024-01-0{d} 05:00:00" for d in (1, 1, 2, 3)]
    log = spark.createDataFrame([(str(i), h) for i, h in enumerate(hours)], "prediction_id string, h string").select(
        "prediction_id", F.col("h").cast("timestamp").alias("target_hour"),
        F.when(F.col("prediction_id") == "0", 1.0).alias("actual_value"), F.lit(None).cast("double").alias("absolute_error"),
    )
    assert log.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    gold = str(tmp_path)
    append_predictions(log, gold)
    append_predictions(log.limit(2), gold)  # known ids add nothing
    assert read_predictions(spark, gold).count() == 4
    days = open_days(spark, gold, F.lit("2024-01-02").cast("date"))
    assert days == ["2024-01-01", "2024-01-02"]
    assert partition_filter(predictions_of(spark, gold, days), "target_day")


@pytest.mark.parametrize("facility", ["H", None])
def test_features_go_on_from_the_stored_ones(spark, facility):
    """Sparse and dense hours; the later rows' features equal those of the whole table."""
    hours = [i * (1 if i < 200 else 7) for i in range(400)]
    census = spark.createDataFrame(
        [(facility, h, (h * 7) % 5, (h * 3) % 4) for h in hours] + [(facility, 30, 9, 0)] * (facility is None),
        "location_facility string, h long, arrivals long, discharges long",
    ).select(
        F.timestamp_seconds(F.col("h") * 3600 + 1704067200).alias("event_hour"), "location_facility", "arrivals", "discharges",
        (F.col("arrivals") - F.col("discharges")).alias("net_change"), F.lit(1).alias("hour_of_day"),
        F.lit(1).alias("day_of_week"), F.lit(0).alias("is_weekend"),
    )
    whole = features.forecast_features(census, "ED")
    for start in ("2024-01-02 06:00:00", "2024-01-20 00:00:00"):
        at = F.lit(start).cast("timestamp")
        part = features.forecast_features(features.with_history(census, whole, at), "ED").where(F.col("event_hour") >= at)
        assert rows(part.select(whole.columns)) == rows(whole.where(F.col("event_hour") >= at))
