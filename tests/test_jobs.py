"""Whole jobs: ingest as stream and batch, gold refresh, forecast loop, publishing."""

import os

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from checks import feed
from checks.context import Context
from wardflow.operators import forecast as fc
from wardflow.operators.messages import message_time, messages
from wardflow.operators.segments import SILVER
from wardflow.plans.forecast import backfill, predict_all, train_all
from wardflow.plans import reports
from wardflow.plans.gold import GOLD, refresh_gold
from wardflow.sources import tables as store
from wardflow.sources.bus import messages_from
from wardflow.sources.files import read_files, read_framed, read_line_messages
from wardflow.sources.predictions import append_predictions, read_predictions
from wardflow.sources.publish import SERVING_KEYS, create_statement, key_report, publish_all
from wardflow.streaming.ingest import (
    FILES,
    VIOLATIONS,
    ingest_batch,
    ingest_stream,
    read_ingested,
    read_quarantine,
    read_silver,
    read_violations,
    start_ingest,
)


@pytest.fixture(scope="module")
def landing(spark, sf, tmp_path_factory):
    """The feed as files on disk, with each layout."""
    folder = tmp_path_factory.mktemp("landing")
    for row in feed.feed_files(spark, sf).collect():
        (folder / f"{row['file_id']}.hl7").write_bytes(row["raw_content"].encode())
    (folder / "notes.txt").write_text("not a message file")
    return str(folder)


@pytest.fixture(scope="module")
def batch(spark, landing, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("batch"))
    ingest_batch(spark, landing, out, message_time())
    return out


@pytest.fixture(scope="module")
def gold(spark, batch, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("gold"))
    assert len(refresh_gold(spark, batch, out)) == len(GOLD) - 1
    return out


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_files(spark, landing):
    files = read_files(spark, landing)
    assert files.count() == 20
    row = files.orderBy("source_file").select("*", F.md5(F.concat("raw_content", F.col("file_modification_time").cast("string"))).alias("id")).first()
    assert row["file_id"] == row["id"] and row["source_file"].endswith("file-0.hl7")


def test_framed_files_are_split_by_frame(spark, tmp_path):
    head = "MSH|^~\\&|A|F|||20240101||ADT^A01|C{}|P|2.5"
    text = "".join(f"\x0b{head.format(i)}\rPID|1||P{i}\x1c\r" for i in range(500))
    (tmp_path / "big.hl7").write_bytes(text.encode())
    framed = messages(read_framed(spark, str(tmp_path)))
    assert same(framed.select("raw_message"), messages(read_files(spark, str(tmp_path))).select("raw_message"))
    assert framed.count() == 500


@pytest.mark.parametrize("split", ["128m", "700"])
def test_large_files_are_read_by_line(spark, tmp_path, split):
    head = "MSH|^~\\&|A|F|||20240101||ADT^A01|C{}|P|2.5"
    parts = [f"\x0b{head.format(i)}\rPID|1||P{i}{'|x' * (i % 9)}\x1c\r" for i in range(60)]
    parts += ["garbage\n", head.format("a") + "\r\n EVN|A01 \r\n\r\nPID|no header\n", head.format("b") + "\n" + head.format("c") + "\x1cPV1|1"]
    (tmp_path / "big.hl7").write_bytes("".join(parts).encode())
    (tmp_path / "none.hl7").write_bytes(b"nothing")
    whole = messages(read_files(spark, str(tmp_path))).select("message_id", "raw_message", "source_file", "file_message_count")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = read_line_messages(spark, str(tmp_path))
        assert split != "700" or spark.read.text(str(tmp_path / "big.hl7")).rdd.getNumPartitions() > 3
        assert same(lines.select(*whole.columns), whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_batch_equals_feed(spark, sf, batch):
    context = Context(spark, sf)
    for kind in SILVER:
        assert same(read_silver(spark, batch, kind), context.segment(kind)), kind


def test_stream_equals_batch_and_takes_files_once(spark, landing, batch, tmp_path):
    source, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    source.mkdir()
    names = sorted(n for n in os.listdir(landing) if n.endswith(".hl7"))

    def land(some):
        for n in some:
            (source / n).write_bytes(open(f"{landing}/{n}", "rb").read())

    def run():
        query = start_ingest(spark, str(source), out, ckpt, parsed_at=message_time(), max_files=4)
        query.awaitTermination(300)
        return query

    land(names[:9])
    assert len({p["batchId"] for p in run().recentProgress if p["numInputRows"]}) == 3
    run()
    land(names[9:])
    run()
    for kind in SILVER:
        assert same(read_silver(spark, out, kind), read_silver(spark, batch, kind)), kind


def test_a_replayed_batch_leaves_no_duplicates(spark, landing, tmp_path):
    from wardflow.streaming.ingest import _write_batch

    files = read_files(spark, landing)
    for _ in range(2):
        _write_batch(files, "run-3", str(tmp_path), message_time())
    rows = messages(files)
    assert read_silver(spark, str(tmp_path), "EVN").count() == rows.where("raw_message LIKE '%EVN|%'").count()


def test_runs_into_one_folder_keep_each_other(spark, landing, batch, tmp_path):
    names = sorted(n for n in os.listdir(landing) if n.endswith(".hl7"))
    out = str(tmp_path / "out")
    for part, some in (("a", names[:7]), ("b", names[7:])):
        (tmp_path / part).mkdir()
        for n in some:
            (tmp_path / part / n).write_bytes(open(f"{landing}/{n}", "rb").read())
    ingest_batch(spark, str(tmp_path / "a"), out, message_time())
    start_ingest(spark, str(tmp_path / "b"), out, str(tmp_path / "c"), parsed_at=message_time()).awaitTermination(300)
    ingest_batch(spark, str(tmp_path / "a"), out, message_time())  # again: adds nothing
    for kind in SILVER:
        assert same(read_silver(spark, out, kind), read_silver(spark, batch, kind)), kind
    assert read_ingested(spark, out, FILES).count() == len(names)
    assert same(read_violations(spark, out), read_violations(spark, batch))
    assert same(read_quarantine(spark, out, "DG1"), read_quarantine(spark, batch, "DG1"))


def test_a_failed_batch_is_not_read_and_its_files_are_taken_again(spark, tmp_path, monkeypatch):
    from wardflow.streaming import ingest

    source, out = tmp_path / "in [1]", str(tmp_path / "out")
    source.mkdir()
    (source / "a{b}.hl7").write_text("MSH|^~\\&|A|F|||20240101||ADT^A01|C1|P|2.5\rPID|1||P1\r")

    def fail(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(ingest, "_stored", lambda df, out, table, *a, f=ingest._stored, **k: fail() if table == VIOLATIONS else f(df, out, table, *a, **k))
        with pytest.raises(RuntimeError):
            ingest_batch(spark, str(source).replace("[", "\\[").replace("]", "\\]"), out)
    assert read_silver(spark, out, "PID").count() == 0
    (source / "c.hl7").write_text("MSH|^~\\&|A|F|||20240102||ADT^A01|C2|P|2.5\rPID|1||P2\r")
    made = ingest_batch(spark, str(source).replace("[", "\\[").replace("]", "\\]"), out, most_files=1)
    assert len(made) == 2 and sorted(r[0] for r in read_silver(spark, out, "PID").select("patient_id").collect()) == ["P1", "P2"]
    assert read_silver(spark, out, "PV1").count() == 0  # no row of it in any batch


def test_files_without_messages_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.hl7").write_text("garbage before any header")
    ingest_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert read_ingested(spark, str(tmp_path / "out"), FILES).first()["raw_content"] == "garbage before any header"
    assert read_silver(spark, str(tmp_path / "out"), "PID").count() == 0
    assert read_violations(spark, str(tmp_path / "out")).agg(F.sum("rows_checked")).first()[0] == 0


def test_continuous_trigger(spark, landing, batch, tmp_path):
    query = start_ingest(
        spark, landing, str(tmp_path / "o"), str(tmp_path / "c"), {"processingTime": "1 second"}, message_time(), max_bytes="200k"
    )
    try:
        query.processAllAvailable()
        assert same(read_silver(spark, str(tmp_path / "o"), "PV1"), read_silver(spark, batch, "PV1"))
        assert query.isActive
    finally:
        query.stop()


def test_bus_stream(spark, landing, tmp_path):
    """Any streaming frame with message text feeds the same ingest."""
    sent = read_files(spark, landing, streaming=True).select(
        F.col("raw_content").cast("binary").alias("value"), F.lit("hl7").alias("topic"), F.current_timestamp().alias("timestamp")
    )
    query = ingest_stream(messages_from(sent), str(tmp_path / "o"), str(tmp_path / "c"), parsed_at=message_time())
    query.awaitTermination(300)
    assert read_silver(spark, str(tmp_path / "o"), "EVN").count() == 900


def test_stream_table_to_table(spark, batch, tmp_path):
    evn = read_silver(spark, batch, "EVN", streaming=True).select("message_id", "event_type_code")
    query = store.write_stream(evn, str(tmp_path / "t"), str(tmp_path / "c"))
    query.awaitTermination(300)
    assert same(store.read_table(spark, str(tmp_path / "t")), read_silver(spark, batch, "EVN").select("message_id", "event_type_code"))


def test_gold_equals_direct_tables(spark, sf, gold):
    context = Context(spark, sf)
    for name, df in {
        "gold_encounter_fact": context.encounters,
        "gold_patient_dim": context.patients,
        "gold_ed_daily_summary": context.ed_day,
        "gold_icu_forecast_features": context.icu_feat,
        "gold_combined_forecast_features": context.combined,
    }.items():
        assert same(store.read_table(spark, f"{gold}/{name}"), df), name


def test_forecast_loop(spark, gold, tmp_path):
    linear = LinearRegression(labelCol="label", featuresCol="x")
    search = [("linear", linear, ParamGridBuilder().addGrid(linear.regParam, [0.1]).build())]
    report = train_all(spark, gold, str(tmp_path / "models"), search, folds=2).collect()
    assert {(r["model_name"], r["status"]) for r in report} == {(m.name, "SUCCESS") for m in fc.MODELS}
    rows = store.read_table(spark, f"{gold}/gold_model_training_metadata").collect()
    assert {r["model_name"] for r in rows} == {m.name for m in fc.MODELS}
    assert all(r["training_samples"] >= 10 and r["rmse"] >= 0 and r["champion"] for r in rows)

    # A retrain with too few rows for one department keeps its champions; one broken table harms no other model.
    other = str(tmp_path / "retrain")
    for name in ("ed", "combined"):
        table = f"gold_{name}_forecast_features"
        store.write_table(store.read_table(spark, f"{gold}/{table}"), f"{other}/{table}")
    icu = store.read_table(spark, f"{gold}/gold_icu_forecast_features")
    store.write_table(icu.limit(4), f"{other}/gold_icu_forecast_features")
    store.write_table(store.read_table(spark, f"{gold}/gold_model_training_metadata"), f"{other}/gold_model_training_metadata")
    again = {r["model_name"]: r for r in train_all(spark, other, str(tmp_path / "models"), search, folds=2).collect()}
    assert again["icu_arrivals_forecast"]["status"] == "SKIPPED" and again["icu_arrivals_forecast"]["training_samples"] == 4
    assert again["ed_arrivals_forecast"]["status"] == "SUCCESS"
    fresh = {r["model_name"]: r for r in store.read_table(spark, f"{other}/gold_model_training_metadata").collect()}
    assert set(fresh) == {m.name for m in fc.MODELS}
    first = {r["model_name"]: r for r in rows}
    assert all(fresh[m][k] == first[m][k] for m in fresh for k in ("rmse", "mae", "r2_score"))  # repeatable
    assert predict_all(spark, other) == 5  # by the clock: one run, all departments
    newest = store.read_table(spark, f"{other}/gold_forecast_predictions")
    assert newest.select("forecast_generated_at").distinct().count() == 1
    assert reports.latest_batch(newest).select("department").distinct().count() == 3

    run = F.lit("2024-01-31 00:00:00").cast("timestamp")
    assert predict_all(spark, gold, run) == 5
    assert predict_all(spark, gold, run) == 5  # the same run again adds nothing
    predictions = store.read_table(spark, f"{gold}/gold_forecast_predictions")
    assert predictions.count() == 20 and len(predictions.columns) == 17
    assert predictions.select("prediction_id").distinct().count() == 20
    assert predictions.where("predicted_value < 0 OR prediction_lower_bound < 0").count() == 0
    # a known hour and an unknown one
    known = store.read_table(spark, f"{gold}/gold_ed_hourly_census").agg(F.min("event_hour")).first()[0]
    moved = predictions.withColumn(
        "target_hour", F.when(F.col("forecast_horizon_hours") == 1, F.lit(known)).otherwise(F.col("target_hour") + F.expr("INTERVAL 90 DAYS"))
    )
    append_predictions(moved, str(tmp_path / "g"))
    for name in ("gold_ed_hourly_census", "gold_icu_hourly_census"):
        store.write_table(store.read_table(spark, f"{gold}/{name}"), str(tmp_path / "g" / name))
    assert backfill(spark, str(tmp_path / "g")) == [str(known.date())]
    assert backfill(spark, str(tmp_path / "g")) == []  # nothing new: nothing changes
    filled = read_predictions(spark, str(tmp_path / "g"))
    assert backfill(spark, str(tmp_path / "nothing")) is None
    assert filled.count() == 20
    scored = filled.where("actual_value IS NOT NULL")
    assert {r["forecast_horizon_hours"] for r in scored.collect()} == {1}
    accuracy = fc.forecast_accuracy(filled)
    assert accuracy.count() == scored.select("model_name").distinct().count() > 0


def test_same_hour_columns_are_left_out(spark, gold):
    ed = store.read_table(spark, f"{gold}/gold_ed_forecast_features")
    kept = fc.feature_columns(ed, "arrivals")
    assert "arrivals" not in kept and "net_change" not in kept and "arrivals_rolling_6h" not in kept
    assert "arrivals_lag_1h" in kept and "discharges_rolling_24h" in kept
    assert fc.train(ed.limit(5), "arrivals") == 5


def test_horizons(spark):
    points = spark.createDataFrame(
        [("2024-01-01 00:00:00", "H", -1.0, 2.0), ("2024-01-01 00:00:00", "H", 4.0, 0.0)],
        "t string, location_facility string, prediction double, spread double",
    ).withColumn("feature_snapshot_hour", F.col("t").cast("timestamp"))
    rows = fc.expand_horizons(points.drop("t")).orderBy("predicted_value", "forecast_horizon_hours").collect()
    assert [r["forecast_horizon_hours"] for r in rows] == [1, 4, 8, 24] * 2
    assert rows[0]["predicted_value"] == 0 and rows[0]["prediction_lower_bound"] == 0
    assert rows[0]["prediction_upper_bound"] == 3.31 and rows[0]["confidence_level"] == 0.98
    assert rows[3]["confidence_level"] == 0.52 and rows[3]["target_hour"].day == 2
    assert rows[4]["prediction_lower_bound"] == rows[4]["prediction_upper_bound"] == 4.0
    one = spark.createDataFrame([(0, "H", 3.0)], "event_hour int, location_facility string, prediction double")
    assert fc.latest_score(one).first()["spread"] == 0.0
    assert fc.latest_score(one.limit(0)).count() == 0


def test_accuracy_of_zero_actuals(spark):
    df = spark.createDataFrame(
        [("m", "1", "ED", "arrivals", 1, "2024-01-01", 2.0, 1.0, 3.0, 0.0, 2.0), ("m", "1", "ED", "arrivals", 1, "2024-01-01", 2.0, 1.0, 3.0, 4.0, 2.0)],
        "model_name string, model_version string, department string, target_metric string, forecast_horizon_hours int, d string, "
        "predicted_value double, prediction_lower_bound double, prediction_upper_bound double, actual_value double, absolute_error double",
    ).withColumn("target_hour", F.col("d").cast("timestamp"))
    row = fc.forecast_accuracy(df).first()
    assert (row["prediction_count"], row["mae"], row["mse"], row["mape"], row["coverage_pct"]) == (2, 2.0, 4.0, 50.0, 0.0)


def test_publish(spark, gold, tmp_path):
    target = str(tmp_path / "serving")
    store.write_table(store.read_table(spark, f"{gold}/gold_order_fact"), f"{target}/gold_absent")
    source = str(tmp_path / "source")
    orders = store.read_table(spark, f"{gold}/gold_order_fact")
    store.write_table(orders, f"{source}/gold_order_fact")
    store.write_table(orders.limit(0), f"{source}/gold_empty")
    report = publish_all(spark, source, target, ["gold_order_fact", "gold_empty", "gold_absent", "gold_never"])
    got = {r["table"]: (r["status"], r["rows"]) for r in report.collect()}
    assert got == {
        "gold_order_fact": ("SUCCESS", orders.count()),
        "gold_empty": ("SKIPPED_EMPTY", 0),
        "gold_absent": ("SKIPPED_NOT_FOUND", 0),
        "gold_never": ("SKIPPED_NOT_FOUND", 0),
    }
    assert same(store.read_table(spark, f"{target}/gold_order_fact"), orders)
    assert store.read_table(spark, f"{target}/gold_absent").count() == 0
    failed = publish_all(spark, source, "jdbc:nothing:x", ["gold_order_fact"]).first()
    assert failed["status"] == "FAILED" and failed["error"]
    assert len(SERVING_KEYS) == 18
    # Repeated keys are refused; a missing text in a key is published as a value.
    store.write_table(orders.union(orders.limit(1)), f"{source}/gold_order_fact")
    refused = publish_all(spark, source, target, ["gold_order_fact"]).first()
    assert refused["status"] == "FAILED" and refused["error"].startswith("1 key values") and len(refused["error"]) < 90
    assert same(store.read_table(spark, f"{target}/gold_order_fact"), orders)  # what was refused was never shown
    row = key_report(orders.union(orders.limit(1)), "gold_order_fact", ["order_key"]).first()
    assert (row["rows"], row["distinct_keys"], row["rows_without_key"]) == (orders.count() + 1, orders.count(), 0)
    census = store.read_table(spark, f"{gold}/gold_ed_hourly_census")
    assert publish_all(spark, gold, target, ["gold_ed_hourly_census"]).first()["status"] == "SUCCESS"
    written = store.read_table(spark, f"{target}/gold_ed_hourly_census")
    assert written.where("location_facility = ''").count() == census.where("location_facility IS NULL").count() > 0
    text = create_statement("gold_patient_dim", store.read_table(spark, f"{gold}/gold_patient_dim"), ["patient_key"])
    assert text.startswith('CREATE TABLE IF NOT EXISTS "gold_patient_dim" ("patient_key" TEXT NOT NULL, ')
    assert text.endswith('PRIMARY KEY ("patient_key"))')


def test_facts_have_unique_keys(spark, gold):
    for name in ("gold_encounter_fact", "gold_observation_fact", "gold_order_fact", "gold_patient_dim"):
        table = store.read_table(spark, f"{gold}/{name}")
        assert store.check_primary_key(table, SERVING_KEYS[name]).count() == 0, name
