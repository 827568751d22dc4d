"""Streaming queries over folders of files."""

import base64
import json
import os
import re
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F, types as T

from fleetpulse.constants import GPS_DATASET
from fleetpulse.operators.signal import signal_loss_sessions
from fleetpulse.sources.last_seen import read_last_seen
from fleetpulse.sources.readers import read_rejected, read_silver, read_telemetry, read_telemetry_stream
from fleetpulse.sources.schemas import GPS_SILVER, MAINTENANCE_SILVER
from fleetpulse.streaming.maintenance import ingest_maintenance_stream
from fleetpulse.streaming.signal import signal_loss_stream
from fleetpulse.streaming.telemetry import dedup_stream, stream_judged, telemetry_pipeline

PING = T.StructType([
    T.StructField("equipo_id", T.StringType()), T.StructField("timestamp", T.StringType()), T.StructField("event_ts", T.TimestampType()),
])
START = datetime(2026, 5, 20, 12, 0, 0, tzinfo=timezone.utc)


def message(machine, when=None, **over):
    when = when or datetime.now(timezone.utc)
    return {"equipo_id": machine, "timestamp": when.isoformat(), "latitud": -9.1, "longitud": -77.5, "velocidad": 60.0, "estado": "ACTIVO", **over}


def drop(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")


def run(spark, tmp_path):
    queries = telemetry_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), available_now=True, max_files=1)
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None
    silver = read_silver(spark, str(tmp_path / "out" / "silver" / GPS_DATASET), GPS_SILVER)
    rejected = read_rejected(spark, str(tmp_path / "out" / "rejected" / GPS_DATASET))
    return silver, rejected, read_last_seen(spark, str(tmp_path / "out" / "state" / "last_seen"))


def test_pipeline_routes_dedups_and_survives_replay_and_restart(spark, tmp_path):
    good, other = message("CAM_001"), message("CAM_002")
    wrapped = json.dumps({"kinesis": {"data": base64.b64encode(json.dumps(other).encode()).decode()}})
    drop(tmp_path / "in", "1.json", good, wrapped, message("CAM_003", latitude=50.0), "{broken")
    silver, rejected, seen = run(spark, tmp_path)
    assert sorted(r["equipo_id"] for r in silver.collect()) == ["CAM_001", "CAM_002"]
    assert sorted(r["rejection_reason"].split(":")[0] for r in rejected.collect()) == ["decode_error", "lat_out_of_bbox"]
    assert sorted(r["equipo_id"] for r in seen.collect()) == ["CAM_001", "CAM_002"]

    # the same message again, the same instant spelled otherwise, and a newer one
    later = datetime.now(timezone.utc)
    drop(tmp_path / "in", "2.json", good, {**good, "timestamp": good["timestamp"].replace("+00:00", "Z")})
    drop(tmp_path / "in", "3.json", good, message("CAM_001", later), message(None))
    silver, rejected, seen = run(spark, tmp_path)
    assert sorted(str(r["equipo_id"]) for r in silver.collect()) == ["CAM_001", "CAM_001", "CAM_001", "CAM_002", "None"]
    assert rejected.count() == 2
    state = {r["equipo_id"]: r["last_seen"] for r in seen.select("equipo_id", F.unix_micros("last_seen").alias("last_seen")).collect()}
    assert state["CAM_001"] == int(later.timestamp() * 1e6 + 0.5) and set(state) == {"CAM_001", "CAM_002"}


def test_a_ping_on_the_edge_has_one_verdict_however_late_the_stages_run(spark, tmp_path):
    edge = datetime.now(timezone.utc) - timedelta(minutes=60) + timedelta(seconds=20)
    drop(tmp_path / "in", "1.json", message("CAM_001", edge), message("CAM_002", edge - timedelta(hours=1)))
    landing = str(tmp_path / "out" / "landing" / GPS_DATASET)
    first, _ = stream_judged(spark, str(tmp_path / "in"), landing, str(tmp_path / "check" / "landing"), available_now=True)
    first.awaitTermination()
    time.sleep(max(0, (edge + timedelta(hours=1, seconds=1) - datetime.now(timezone.utc)).total_seconds()))
    for _ in range(2):  # the second run finds nothing left to do
        silver, rejected, seen = run(spark, tmp_path)
        assert [r["equipo_id"] for r in silver.collect()] == ["CAM_001"] == [r["equipo_id"] for r in seen.collect()]
        assert [r["equipo_id"] for r in rejected.collect()] == ["CAM_002"]
    folders = {d for _, ds, _ in os.walk(tmp_path / "out" / "silver") for d in ds if d.startswith("batch=")}
    assert len(folders) == 1 and re.fullmatch(r"batch=[0-9a-f-]{36}-0", folders.pop())


def test_a_pipeline_needs_no_settings_from_its_session(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    kept = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        drop(tmp_path / "in", "1.json", message("CAM_001"))
        run(spark, tmp_path)
        assert spark.conf.get(key) == kept and "RocksDB" in kept
    finally:
        spark.conf.set(key, kept)


def test_pipeline_runs_continuously(spark, tmp_path):
    drop(tmp_path / "in", "1.json", message("CAM_001"), message("CAM_002", latitud=1.5))
    queries = telemetry_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), interval="1 second")
    try:
        for name in ("CAM_001", "CAM_009"):
            for q in queries:
                q.processAllAvailable()
            seen = read_last_seen(spark, str(tmp_path / "out" / "state" / "last_seen"))
            assert name in {r["equipo_id"] for r in seen.collect()}
            drop(tmp_path / "in", "2.json", message("CAM_009"))
    finally:
        for q in queries:
            q.stop()


def test_stream_and_batch_read_the_same(spark, tmp_path):
    drop(tmp_path / "in", "1.json", message("A"), json.dumps({"body": json.dumps(message("B")), "attributes": {"SentTimestamp": "1779278400123"}}))
    batch = read_telemetry(spark, str(tmp_path / "in"), "transport").select("body").collect()
    stream = read_telemetry_stream(spark, str(tmp_path / "in"), arrival="transport").select("body")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r[0] for r in batch) == sorted(r[0] for r in spark.read.parquet(str(tmp_path / "o")).collect())


def _ping_stream(spark, tmp_path, batches):
    """One file per micro-batch."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(m, (START + timedelta(seconds=s)).isoformat(), START + timedelta(seconds=s)) for m, s in rows], PING)
        df.coalesce(1).write.parquet(str(tmp_path / "pings" / f"b{i}"))
    return (
        spark.readStream.schema(PING).option("maxFilesPerTrigger", 1).option("latestFirst", False)
        .option("recursiveFileLookup", True).parquet(str(tmp_path / "pings"))
    )


def _collect(spark, df, tmp_path):
    q = df.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / "rows"))


def test_dedup_across_micro_batches(spark, tmp_path):
    stream = _ping_stream(spark, tmp_path, [[("A", 0), ("A", 0), ("B", 5)], [("A", 0), ("A", 60)], [("B", 5), ("C", 70)]])
    rows = _collect(spark, dedup_stream(stream), tmp_path).collect()
    assert sorted((r["equipo_id"], r["timestamp"][14:19]) for r in rows) == [("A", "00:00"), ("A", "01:00"), ("B", "00:05"), ("C", "01:10")]


def test_a_backlog_out_of_order_loses_nothing(spark, tmp_path):
    day = 86_400
    stream = _ping_stream(spark, tmp_path, [[("A", 9 * day)], [("A", 5 * day), ("B", 0)], [("A", 6 * day), ("B", 0), ("A", 9 * day)]])
    rows = _collect(spark, dedup_stream(stream), tmp_path).collect()
    assert sorted((r["equipo_id"], r["event_ts"].day - START.day) for r in rows) == [("A", 5), ("A", 6), ("A", 9), ("B", 0)]


def test_silent_devices_are_given_out_like_in_batch(spark, tmp_path):
    batches = [[("A", 0), ("A", 600), ("B", 0)], [("A", 1201), ("B", 30)], [("Z", 40_000)]]
    stream = _ping_stream(spark, tmp_path, batches)
    rows = _collect(spark, signal_loss_stream(stream), tmp_path)
    got = sorted(tuple(r) for r in rows.collect())
    batch = signal_loss_sessions(spark.read.schema(PING).option("recursiveFileLookup", True).parquet(str(tmp_path / "pings")), START + timedelta(hours=10))
    assert got == sorted(tuple(r) for r in batch.collect()) and [r[4] for r in got] == [2, 1, 2]


def test_maintenance_files_of_other_layouts_do_not_stop_the_stream(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("silver", "rejected", "check")]
    drop(tmp_path / "csv", "a.csv", "equipo_id,fecha,tipo_falla,criticidad", "cam_001,2026-05-20,Motor,alta")
    drop(tmp_path / "csv", "b.csv", "criticidad,equipo_id,fecha,tipo_falla", "baja,cam_002,2026-05-20,Motor")
    drop(tmp_path / "csv", "c.csv", "equipo_id,fecha", "cam_003,2026-05-20")
    for _ in range(2):
        ingest_maintenance_stream(spark, str(tmp_path / "csv"), None, *paths).awaitTermination()
    assert sorted(r["equipo_id"] for r in read_silver(spark, paths[0], MAINTENANCE_SILVER).collect()) == ["CAM_001", "CAM_002"]
    assert [r["rejection_reason"] for r in spark.read.json(paths[1]).collect()] == ["missing_columns:tipo_falla"]


def test_new_maintenance_files_are_taken_once(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("equipo_id", "fecha", "tipo_falla", "criticidad")])
    paths = [str(tmp_path / p) for p in ("silver", "rejected", "check")]
    header = "equipo_id,fecha,tipo_falla,criticidad"
    drop(tmp_path / "csv", "a.csv", header, "cam_001,2026-05-20,Motor,alta", "cam_001,x,Motor,alta")
    for _ in range(2):
        ingest_maintenance_stream(spark, str(tmp_path / "csv"), schema, *paths).awaitTermination()
    drop(tmp_path / "csv", "b.csv", header, "cam_002,2026-05-20,Motor,baja")
    ingest_maintenance_stream(spark, str(tmp_path / "csv"), schema, *paths).awaitTermination()
    assert sorted(r["equipo_id"] for r in read_silver(spark, paths[0], MAINTENANCE_SILVER).collect()) == ["CAM_001", "CAM_002"]
    assert spark.read.json(paths[1]).count() == 1


def test_messages_are_made_by_many_tasks_and_state_is_stored_by_changes(spark, sf_dir):
    from fleetpulse.plans.shared_tables import envelopes, rich_messages
    from fleetpulse.session import STREAMING

    plan = envelopes(spark, sf_dir, rich_messages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(event_id" in plan
    assert STREAMING["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] == "true"
