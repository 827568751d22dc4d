"""Readers, writers, keyed state, tables and jobs: written and read back."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.constants import GPS_DATASET, MAINTENANCE_DATASET
from fleetpulse.operators.reports import critical_equipment_report, faults_by_equipment
from fleetpulse.operators.signal import auto_maintenance_records, signal_loss_maintenance
from fleetpulse.plans.jobs import dq_run, ingest_maintenance, signal_sweep
from fleetpulse.sources import storage
from fleetpulse.sources.last_seen import (
    compact_last_seen, last_seen_sink, read_last_seen, upsert_last_seen, write_last_seen,
)
from fleetpulse.sources.readers import (
    read_auto_maintenance, read_maintenance_csv, read_quality_history, read_rejected, read_silver, rejected_sample,
)
from fleetpulse.sources.schemas import GPS_SILVER, LAST_SEEN, MAINTENANCE_SILVER
from fleetpulse.sources.tables import create_tables, refresh_tables
from fleetpulse.sources.writers import (
    append_auto_maintenance, write_quality_metrics, write_rejected_gps, write_silver_gps, write_silver_maintenance,
)

AS_OF = datetime(2026, 5, 20, 12, 0, 0, tzinfo=timezone.utc)


def pings(spark, *rows):
    return spark.createDataFrame(
        [(m, -9.1, -77.5, t.isoformat(), 60.0, "ACTIVO", t, None) for m, t in rows], GPS_SILVER
    )


def csv_file(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


HEADER = "equipo_id,fecha,tipo_falla,criticidad"


def test_silver_gps_layout_and_read_back(spark, tmp_path):
    path = str(tmp_path / "silver")
    df = pings(spark, ("A", AS_OF), ("B", AS_OF))
    write_silver_gps(df, path, datetime(2026, 5, 3, 4, tzinfo=timezone.utc))
    assert os.path.isdir(f"{path}/year=2026/month=05/day=03/hour=04")
    for back in (read_silver(spark, path), read_silver(spark, path, GPS_SILVER)):
        assert set(back.columns) == set(GPS_SILVER.fieldNames())
        assert sorted(r["equipo_id"] for r in back.collect()) == ["A", "B"]
    write_silver_gps(df, path, datetime(2026, 5, 3, 5, tzinfo=timezone.utc))
    assert read_silver(spark, path, GPS_SILVER).count() == 4
    assert read_silver(spark, str(tmp_path / "none"), GPS_SILVER).count() == 0
    assert read_silver(spark, str(tmp_path / "none")).columns == []


def test_a_folder_without_rows_reads_as_empty(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver_gps(pings(spark, ("A", AS_OF)).limit(0), path, AS_OF)
    assert not [f for _, _, files in os.walk(path) for f in files if f.endswith(".parquet")]
    assert read_silver(spark, path).columns == [] and read_silver(spark, path, GPS_SILVER).count() == 0
    assert dq_run(spark, str(tmp_path), str(tmp_path / "gold"), [GPS_DATASET]) == [{"dataset": GPS_DATASET, "status": "no_data"}]


def test_silver_files_of_different_columns_are_merged_by_name(spark, tmp_path):
    path = str(tmp_path / "silver")
    spark.createDataFrame([("A", 1.0)], "equipo_id string, latitude double").write.parquet(f"{path}/one")
    spark.createDataFrame([(5.0, "B")], "speed_kmh double, equipo_id string").write.parquet(f"{path}/two")
    df = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path)
    assert {r["equipo_id"]: (r["latitude"], r["speed_kmh"]) for r in df.collect()} == {"A": (1.0, None), "B": (None, 5.0)}


def test_rejected_zone_and_sample(spark, tmp_path):
    path = str(tmp_path / "rejected")
    df = spark.createDataFrame(
        [("A", 20.0, -77.5, "t", None, "x", AS_OF, "{...}", "lat_out_of_bbox:20.0")],
        "equipo_id string, latitude double, longitude double, timestamp string, speed_kmh double, estado string, arrival_ts timestamp, body string, rejection_reason string",
    )
    write_rejected_gps(df, path, AS_OF - timedelta(hours=1))
    write_rejected_gps(df.withColumn("equipo_id", F.lit("B")), path, AS_OF)
    newest = [os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(".json") and "hour=12" in r]
    for file in newest:
        os.utime(file, (2_000_000_000, 2_000_000_000))
    rows = read_rejected(spark, path).collect()
    assert {(r["equipo_id"], r["latitude"], r["_raw"], r["rejection_reason"]) for r in rows} == {
        ("A", "20.0", "{...}", "lat_out_of_bbox:20.0"), ("B", "20.0", "{...}", "lat_out_of_bbox:20.0"),
    }
    assert all(r["file"].endswith(".json") and r["modified"] for r in rows)
    assert [r["equipo_id"] for r in rejected_sample(spark, path).collect()] == ["B"]
    assert rejected_sample(spark, str(tmp_path / "none")).count() == 0


def test_csv_missing_words_quotes_and_file_names(spark, tmp_path):
    csv_file(tmp_path / "in", "a.csv", HEADER, 'CAM_001,2026-05-20,"Motor, ""grande""",ALTA', "NULL,n/a,,NA")
    rows = read_maintenance_csv(spark, str(tmp_path / "in")).collect()
    assert tuple(rows[0])[:4] == ("CAM_001", "2026-05-20", 'Motor, "grande"', "ALTA")
    assert tuple(rows[1])[:4] == (None, None, None, None)
    assert rows[0]["source_file"].endswith("a.csv")


def test_csv_files_with_other_headers_fail_or_are_stacked_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    csv_file(folder, "a.csv", HEADER, "A,2026-05-20,x,ALTA")
    csv_file(folder, "b.csv", "criticidad,tipo_falla,fecha,equipo_id", "BAJA,y,2026-05-21,B")
    csv_file(folder, "c.csv", HEADER + ",tecnico", "C,2026-05-22,z,MEDIA,Rosa")
    with pytest.raises(Exception):
        read_maintenance_csv(spark, str(folder)).collect()
    rows = {r["equipo_id"]: r for r in read_maintenance_csv(spark, str(folder), mixed_headers=True).collect()}
    assert (rows["B"]["criticidad"], rows["B"]["fecha"], rows["A"]["tecnico"], rows["C"]["tecnico"]) == ("BAJA", "2026-05-21", None, "Rosa")


def test_ingest_is_repeatable_and_drops_what_went_bad(spark, tmp_path):
    folder, silver, rejected = tmp_path / "in", str(tmp_path / "silver"), str(tmp_path / "rejected")
    csv_file(folder, "a.csv", HEADER, "cam_001,2026-05-20,Motor,alta", "cam_002,20/05/2026,Motor,URGENTE")
    csv_file(folder, "b.csv", HEADER, "cam_003,2026-05-20,Motor,baja")
    for _ in range(2):
        rows = ingest_maintenance(spark, str(folder), silver, rejected).collect()
        summary = {os.path.basename(r["source_file"]): (r["total"], r["valid"], r["rejected"]) for r in rows}
    assert summary == {"a.csv": (2, 1, 1), "b.csv": (1, 1, 0)}
    assert all(spark.read.parquet(r["silver_key"]).count() == r["valid"] for r in rows)
    assert sorted(r["equipo_id"] for r in read_silver(spark, silver, MAINTENANCE_SILVER).collect()) == ["CAM_001", "CAM_003"]
    assert [r["rejection_reason"] for r in spark.read.json(rejected).collect()] == ["invalid_criticidad:URGENTE"]

    csv_file(folder, "a.csv", HEADER, "cam_001,2026-05-20,Motor,alta")   # nothing left to reject
    csv_file(folder, "b.csv", HEADER, "cam_003,nunca,Motor,baja")        # nothing left that is valid
    ingest_maintenance(spark, str(folder), silver, rejected)
    assert [r["equipo_id"] for r in read_silver(spark, silver, MAINTENANCE_SILVER).collect()] == ["CAM_001"]
    assert [r["rejection_reason"] for r in spark.read.json(rejected).collect()] == ["invalid_fecha_mantenimiento"]


def test_each_file_is_ingested_by_its_own_header(spark, tmp_path):
    folder, silver, rejected = tmp_path / "in", str(tmp_path / "silver"), str(tmp_path / "rejected")
    csv_file(folder, "a +%b.csv", HEADER, "A,2026-05-20,x,ALTA", "A,2026-05-20,x,URGENTE")
    csv_file(folder, "b.csv", "criticidad,tipo_falla,fecha_mantenimiento,equipo_id", "BAJA,y,2026-05-21,B")
    csv_file(folder, "c.csv", "equipo_id,fecha,nota", "C,2026-05-22,n", "C,2026-05-23,n")
    csv_file(folder, "d.csv", "equipo_id,fecha,tipo_falla", "D,2026-05-24,z")
    for _ in range(2):
        rows = ingest_maintenance(spark, str(folder), silver, rejected).collect()
    assert sorted((r["total"], r["valid"], r["rejected"]) for r in rows) == [(1, 1, 0), (1, 1, 0), (2, 0, 2), (2, 1, 1)]
    assert all(os.path.exists(r["silver_key"]) == (r["valid"] > 0) for r in rows)
    stored = spark.read.parquet(silver)
    assert "nota" not in stored.columns
    assert sorted((r["equipo_id"], r["fecha_mantenimiento"]) for r in stored.collect()) == [("A", "2026-05-20"), ("B", "2026-05-21"), ("D", "2026-05-24")]
    reasons = sorted((r["equipo_id"], r["rejection_reason"]) for r in spark.read.json(rejected).collect())
    assert reasons == [("A", "invalid_criticidad:URGENTE")] + 2 * [("C", "missing_columns:tipo_falla")]


def test_ingest_names_missing_columns(spark, tmp_path):
    csv_file(tmp_path / "in", "a.csv", "equipo_id,criticidad", "A,ALTA")
    with pytest.raises(ValueError, match="fecha, tipo_falla"):
        ingest_maintenance(spark, str(tmp_path / "in"), str(tmp_path / "s"), str(tmp_path / "r"))


def test_same_file_name_in_two_folders_is_two_files(spark, tmp_path):
    silver = str(tmp_path / "silver")
    for folder, machine in (("x", "A"), ("y", "B")):
        csv_file(tmp_path / folder, "same.csv", HEADER, f"{machine},2026-05-20,Motor,ALTA")
        ingest_maintenance(spark, str(tmp_path / folder), silver, str(tmp_path / "rejected"))
    assert read_silver(spark, silver).count() == 2


def test_last_seen_moves_forward_only(spark):
    old = spark.createDataFrame([("A", AS_OF), ("C", AS_OF)], LAST_SEEN)
    new = pings(spark, ("A", AS_OF - timedelta(minutes=5)), ("B", AS_OF), ("C", AS_OF + timedelta(minutes=1)), (None, AS_OF))
    merged = {r["equipo_id"]: r["last_seen"] for r in upsert_last_seen(old, new).collect()}
    assert set(merged) == {"A", "B", "C"} and merged["A"] == merged["B"] and merged["C"] - merged["A"] == timedelta(minutes=1)


def test_last_seen_versions(spark, tmp_path):
    path = str(tmp_path / "seen")
    assert read_last_seen(spark, path).count() == 0
    for minute in range(5):
        fresh = upsert_last_seen(read_last_seen(spark, path), pings(spark, ("A", AS_OF + timedelta(minutes=minute))))
        write_last_seen(fresh, path)
    assert storage.child_names(spark, path) == [f"v={i}" for i in range(5)]
    os.remove(f"{path}/v=4/_SUCCESS")  # a write that died half-way
    assert read_last_seen(spark, path).head()["last_seen"].minute == 3
    write_last_seen(read_last_seen(spark, path), path)
    assert os.path.exists(f"{path}/v=4/_SUCCESS")


def test_a_last_seen_frame_outlives_later_micro_batches(spark, tmp_path):
    path = str(tmp_path / "seen")
    merge = last_seen_sink(path, compact_every=3)
    merge(pings(spark, ("A", AS_OF), ("B", AS_OF), (None, AS_OF)), 0)
    early = read_last_seen(spark, path)
    for i in range(1, 11):
        merge(pings(spark, ("A", AS_OF + timedelta(minutes=i)), ("B", AS_OF - timedelta(minutes=i))), i)
    merge(pings(spark, ("A", AS_OF + timedelta(minutes=10))), 10)  # repeated after a failure
    assert {(r["equipo_id"], r["last_seen"].minute) for r in early.collect()} == {("A", 0), ("B", 0)}
    now = {(r["equipo_id"], r["last_seen"].minute) for r in read_last_seen(spark, path).collect()}
    assert now == {("A", 10), ("B", 0)}
    compact_last_seen(spark, path, keep_seconds=-60)
    assert storage.child_names(spark, path) == ["v=3"]
    assert {(r["equipo_id"], r["last_seen"].minute) for r in read_last_seen(spark, path).collect()} == now


def test_a_named_batch_of_pings_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "silver")
    for machines in ("AB", "ABC"):
        write_silver_gps(pings(spark, *[(m, AS_OF) for m in machines]), path, AS_OF, batch="backfill")
    write_silver_gps(pings(spark, ("D", AS_OF)), path, AS_OF)
    assert sorted(r["equipo_id"] for r in read_silver(spark, path, GPS_SILVER).collect()) == ["A", "B", "C", "D"]


def test_auto_records_are_stored_once_per_sweep(spark, tmp_path):
    path = str(tmp_path / "mant")
    base = spark.createDataFrame([("A", "2026-05-01", "Motor", "ALTA", "taller.csv")], "equipo_id string, fecha_mantenimiento string, tipo_falla string, criticidad string, source_file string")
    write_silver_maintenance(base, path)
    lost = signal_loss_maintenance(spark.createDataFrame([("A", AS_OF - timedelta(hours=1))], LAST_SEEN), AS_OF)
    for as_of in (AS_OF, AS_OF, AS_OF + timedelta(minutes=5)):
        append_auto_maintenance(auto_maintenance_records(lost, as_of), path, as_of)
    assert tuple(faults_by_equipment(read_silver(spark, path, MAINTENANCE_SILVER)).head()) == ("A", 3)


def test_signal_sweep_job(spark, tmp_path):
    state, path = str(tmp_path / "seen"), str(tmp_path / "mant")
    rows = [("fresh", AS_OF), ("alert", AS_OF - timedelta(minutes=20)), ("lost", AS_OF - timedelta(minutes=40))]
    write_last_seen(spark.createDataFrame(rows, LAST_SEEN), state)
    for as_of in (AS_OF, AS_OF + timedelta(minutes=1), AS_OF + timedelta(minutes=2)):
        alert, summary = signal_sweep(spark, state, path, as_of)
        assert sorted(r["equipo_id"] for r in alert.collect()) == ["alert", "lost"]
        assert (summary.head()["alert_lost"], summary.head()["maint_created"]) == (2, 1)
    stored = read_silver(spark, path, MAINTENANCE_SILVER).collect()
    assert [(r["equipo_id"], r["tipo_falla"], r["criticidad"]) for r in stored] == [("lost", "GPS DESCONECTADO (40 min sin señal)", "ALTA")]
    today = read_auto_maintenance(spark, path, AS_OF)
    assert today.count() == 1 and read_auto_maintenance(spark, path, AS_OF + timedelta(days=1)).count() == 0
    assert "StartsWith(source_file" in today._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    signal_sweep(spark, state, path, AS_OF + timedelta(minutes=3), skip_repeated=False)
    assert read_silver(spark, path, MAINTENANCE_SILVER).count() == 2


def test_a_repeated_sweep_keeps_its_records_and_adds_new_ones(spark, tmp_path):
    state, path = str(tmp_path / "seen"), str(tmp_path / "mant")
    for silent in (["A", "B"], ["A", "B", "C"]):
        write_last_seen(spark.createDataFrame([(x, AS_OF - timedelta(minutes=40)) for x in silent], LAST_SEEN), state)
        signal_sweep(spark, state, path, AS_OF)
    assert sorted(r["equipo_id"] for r in read_silver(spark, path, MAINTENANCE_SILVER).collect()) == ["A", "B", "C"]


def test_quality_run_and_history(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_silver_gps(pings(spark, ("A", AS_OF), ("A", AS_OF)), f"{silver}/{GPS_DATASET}", AS_OF)
    for day in (1, 2):
        results = dq_run(spark, silver, gold, run_ts=AS_OF + timedelta(days=day))
    assert results == [
        {"dataset": GPS_DATASET, "status": "ok", "total_rows": 2, "valid_pct": 100.0, "duplicates_pct": 50.0},
        {"dataset": MAINTENANCE_DATASET, "status": "no_data"},
    ]
    assert dq_run(spark, silver, gold, datasets=["other"]) == []
    history = read_quality_history(spark, gold, GPS_DATASET).collect()
    assert [r["run_timestamp"].day for r in history] == [21, 22]
    assert history[0]["completeness_pct"]["latitude"] == 100.0 and history[0]["out_of_range_pct"] == {}
    flat = spark.read.parquet(f"{gold}/parquet").head()
    assert json.loads(flat["completeness_pct"])["latitude"] == 100.0
    assert read_quality_history(spark, gold, MAINTENANCE_DATASET).count() == 0


def test_history_fills_what_old_runs_lack(spark, tmp_path):
    folder = tmp_path / "gold" / "json" / f"dataset={GPS_DATASET}"
    folder.mkdir(parents=True)
    (folder / "old.json").write_text('{"run_timestamp": "2026-05-20T12:00:00.000Z", "valid_pct": 97.25}\n')
    row = read_quality_history(spark, str(tmp_path / "gold"), GPS_DATASET).head()
    assert (row["total_rows"], row["valid_pct"], row["duplicates_pct"], row["completeness_pct"]) == (0, 97.2, 0.0, {})


def test_tables_over_stored_files(spark, tmp_path):
    silver = str(tmp_path / "silver")
    write_silver_gps(pings(spark, ("A", AS_OF)), f"{silver}/{GPS_DATASET}", datetime(2026, 5, 3, 4, tzinfo=timezone.utc))
    mant = spark.createDataFrame([("A", "2026-05-01", "Motor", "ALTA", f"f{i}.csv") for i in range(4)], "equipo_id string, fecha_mantenimiento string, tipo_falla string, criticidad string, source_file string")
    write_silver_maintenance(mant, f"{silver}/{MAINTENANCE_DATASET}")
    create_tables(spark, "fleet_io_test", silver)
    create_tables(spark, "fleet_io_test", silver)  # a second time changes nothing
    gps = spark.table(f"fleet_io_test.{GPS_DATASET}")
    assert gps.filter("month = 5 AND day = 3 AND hour = 4").count() == 1
    write_silver_gps(pings(spark, ("B", AS_OF)), f"{silver}/{GPS_DATASET}", datetime(2026, 5, 3, 5, tzinfo=timezone.utc))
    refresh_tables(spark, "fleet_io_test")
    assert spark.table(f"fleet_io_test.{GPS_DATASET}").count() == 2
    plan = gps.filter("day = 3 AND hour = 4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    report = critical_equipment_report(spark.table(f"fleet_io_test.{MAINTENANCE_DATASET}"), gps, AS_OF)
    assert [(r["equipo_id"], r["estado_gps"]) for r in report.collect()] == [("A", "OK")]


def test_scratch_is_below_the_shared_folder(spark):
    a, b = storage.scratch(spark, "x"), storage.scratch(spark, "x")
    assert a != b and a.startswith(storage.shared_dir(spark).rstrip("/"))


def test_quality_metrics_are_written_in_both_forms(spark, tmp_path):
    from fleetpulse.operators.quality import dq_metrics

    path = str(tmp_path / "gold")
    write_quality_metrics(dq_metrics(pings(spark, ("A", AS_OF)), GPS_DATASET, AS_OF), path)
    assert spark.read.json(f"{path}/json").head()["total_rows"] == 1
    assert isinstance(spark.read.parquet(f"{path}/parquet").head()["out_of_range_pct"], str)
