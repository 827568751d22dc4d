"""Silence sessions without a watermark, and de-duplication of keys with very many copies."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from fleetpulse.operators.signal import signal_loss_sessions
from fleetpulse.sources.silence import announce_losses, compact_sessions, read_losses, read_sessions, session_sink
from fleetpulse.streaming.telemetry import dedup_stream

START = datetime(2026, 5, 20, tzinfo=timezone.utc)
AS_OF = START + timedelta(hours=6)


def pings(spark, *points):
    """(device, minute) points."""
    return spark.createDataFrame([(d, START + timedelta(minutes=m)) for d, m in points], "equipo_id string, event_ts timestamp")


def minutes(losses):
    at = lambda t: (t.replace(tzinfo=timezone.utc) - START).total_seconds() / 60
    return sorted((r["equipo_id"], at(r["first_ping"]), at(r["last_ping"]), r["pings"], *([r["state"]] if "state" in r else [])) for r in losses.collect())


def store(spark, path, batch, batch_id, **options):
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    session_sink(path, **options)(batch, batch_id)


def test_a_late_ping_takes_a_loss_back(spark, tmp_path):
    path = str(tmp_path / "s")
    store(spark, path, pings(spark, ("a", 0), ("a", 5), ("a", 25), ("b", 1)), 0)
    assert minutes(announce_losses(spark, path, AS_OF)) == [("a", 0, 5, 2, "LOST"), ("a", 25, 25, 1, "LOST"), ("b", 1, 1, 1, "LOST")]
    store(spark, path, pings(spark, ("a", 15)), 1)  # joins the two, ten minutes from each
    assert minutes(announce_losses(spark, path, AS_OF)) == sorted([
        ("a", 0, 5, 2, "WITHDRAWN"), ("a", 25, 25, 1, "WITHDRAWN"), ("a", 0, 25, 4, "LOST"),
    ])
    assert minutes(announce_losses(spark, path, AS_OF)) == []
    assert minutes(read_losses(spark, path, AS_OF)) == [("a", 0, 25, 4), ("b", 1, 1, 1)]
    assert minutes(read_losses(spark, path, START + timedelta(minutes=30))) == [("b", 1, 1, 1)]


def test_any_order_repeats_and_snapshots_give_the_batch_form(spark, tmp_path):
    path, chance = str(tmp_path / "s"), random.Random(4)
    points = [(chance.choice("abc"), chance.randrange(0, 3000) / 10) for _ in range(240)] + [(None, 5)]
    chance.shuffle(points)
    for k in range(6):
        batch = pings(spark, *points[40 * k : 40 * (k + 1)] + (points[240:] if k == 5 else []))
        for _run in range(1 + (k == 2)):  # one micro-batch is repeated
            store(spark, path, batch, k, compact_every=4, keep_seconds=-10)
    whole = pings(spark, *points)
    assert minutes(read_losses(spark, path, AS_OF)) == minutes(signal_loss_sessions(whole, AS_OF))
    compact_sessions(spark, path)
    assert minutes(read_losses(spark, path, AS_OF)) == minutes(signal_loss_sessions(whole, AS_OF))
    assert read_sessions(spark, str(tmp_path / "none")).count() == announce_losses(spark, str(tmp_path / "none"), AS_OF).count() == 0


def test_copies_of_one_key_do_not_meet_in_one_task(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.format_string("CAM_%d", "id")).otherwise("HOT").alias("equipo_id"), F.lit("t").alias("timestamp"), "id"
    )
    rows.repartition(3, "id").write.parquet(folder)
    stream = dedup_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder))
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10_001
    dropped = {}
    for progress in query.recentProgress:
        for k, operator in enumerate(progress["stateOperators"]):
            dropped[k] = dropped.get(k, 0) + operator["customMetrics"].get("numDroppedDuplicateRows", 0)
    assert sorted(dropped.values())[0] <= 15 and sum(dropped.values()) == 19_999
