"""Hour partitions: pruning by event time, merging, and what readers see meanwhile."""

import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from fleetpulse.operators.quality import dq_key_counts, dq_metrics
from fleetpulse.operators.reports import critical_equipment_report
from fleetpulse.plans import jobs
from fleetpulse.plans.jobs import dq_run_incremental
from fleetpulse.sources import hours
from fleetpulse.sources.hours import counting, folders, merge_hours
from fleetpulse.sources.readers import read_rejected, read_silver
from fleetpulse.sources.schemas import GPS_REJECTED, GPS_SILVER
from fleetpulse.sources.tables import create_tables, refresh_tables
from fleetpulse.sources.writers import write_rejected_gps, write_silver_gps

START = datetime(2026, 5, 20, tzinfo=timezone.utc)


def pings(spark, n, first=0):
    ids = F.col("id") + first
    return spark.range(n).select(
        F.format_string("CAM_%03d", ids % 7).alias("equipo_id"), F.lit(-9.0).alias("latitude"), F.lit(-77.0).alias("longitude"),
        F.format_string("t%d", ids).alias("timestamp"), F.lit(1.0).alias("speed_kmh"), F.lit("ACTIVO").alias("estado"),
        F.timestamp_micros(F.unix_micros(F.lit(START)) + ids * 60_000_000).alias("event_ts"),
    )


def test_a_long_stream_leaves_a_bounded_number_of_folders(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = pings(spark, 1000).withColumn("batch", F.format_string("q-%d", F.col("timestamp").substr(F.lit(2), F.lit(9)).cast("int") % 500))
    late = F.col("timestamp").substr(F.lit(2), F.lit(9)).cast("int") >= 500
    stored = rows.withColumns({"year": F.lit("2026"), "month": F.lit("05"), "day": F.lit("20"), "hour": F.when(late, "10").otherwise("00")})
    stored.write.partitionBy("year", "month", "day", "hour", "batch").parquet(path)  # as 500 micro-batches would
    assert len(folders(spark, path)) == 1000
    before = read_silver(spark, path, GPS_SILVER)  # planned before the merge, read after it
    assert merge_hours(spark, path, GPS_SILVER, START + timedelta(hours=10)) == 1
    assert before.count() == read_silver(spark, path, GPS_SILVER).count() == 1000
    assert len(counting(spark, path)) == 501  # the hour that is still open keeps its folders
    merge_hours(spark, path, GPS_SILVER, START + timedelta(days=2), keep_seconds=-10)
    merge_hours(spark, path, GPS_SILVER, START + timedelta(days=2), keep_seconds=-10)
    assert len(folders(spark, path)) == 2
    back = read_silver(spark, path, GPS_SILVER).drop("other_fields")
    assert back.count() == back.distinct().count() == 1000


def test_readers_see_each_row_once_at_every_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    for k in range(3):
        write_silver_gps(pings(spark, 10, 10 * k), path, START, batch=f"b{k}")
    with_data = lambda: sorted(r["timestamp"] for r in read_silver(spark, path, GPS_SILVER).collect())
    whole = with_data()

    def dies(*_args):
        raise OSError("gone before the entry was written")

    monkeypatch.setattr(hours, "write_small", dies)
    try:
        merge_hours(spark, path, GPS_SILVER, START + timedelta(hours=1))
    except OSError:
        pass
    assert with_data() == whole and len(folders(spark, path)) == 4  # the merge that died does not count
    monkeypatch.undo()
    merge_hours(spark, path, GPS_SILVER, START + timedelta(hours=1))
    assert with_data() == whole
    write_silver_gps(pings(spark, 5, 100), path, START, batch="late")  # a micro-batch repeated long after
    assert len(with_data()) == 35
    merge_hours(spark, path, GPS_SILVER, START + timedelta(hours=1), keep_seconds=-10)
    assert len(with_data()) == 35 and len(counting(spark, path)) == 1
    merge_hours(spark, path, GPS_SILVER, START + timedelta(hours=1), keep_seconds=-10)
    assert len(with_data()) == 35 and len(folders(spark, path)) == 1
    assert merge_hours(spark, path, GPS_SILVER, START + timedelta(hours=1)) == 0


def test_only_hours_that_can_hold_the_range_are_read(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = pings(spark, 600)
    write_silver_gps(rows, path, F.col("event_ts"), batch="a")
    since = START + timedelta(hours=4)
    found = read_silver(spark, path, GPS_SILVER, since=since)
    assert found.count() == 360
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    try:
        plan = read_silver(spark, path, GPS_SILVER, since=since)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "make_timestamp" in filters and "event_ts" not in filters
    read = {f.split("hour=")[1][:2] for f in found.inputFiles()}
    assert {"04", "05", "09"} <= read
    scanned = {r["h"] for r in found.select(F.input_file_name().alias("f")).distinct().select(F.regexp_extract("f", "hour=([0-9]+)", 1).alias("h")).collect()}
    assert scanned == {"04", "05", "06", "07", "08", "09"}
    assert read_silver(spark, path, GPS_SILVER, since=since, until=since + timedelta(minutes=30), lag_seconds=0).count() == 31
    report = critical_equipment_report(
        spark.createDataFrame([("CAM_001", "2026-05-01", "x", "ALTA", None)] * 4, "equipo_id string, fecha_mantenimiento string, tipo_falla string, criticidad string, estado string"),
        found, START + timedelta(hours=10),
    )
    assert report.count() == 1


def test_rejected_zone_and_catalog_follow_the_merge(spark, tmp_path):
    path, silver = str(tmp_path / "rejected"), str(tmp_path / "silver")
    for k in range(2):
        bad = pings(spark, 5, 10 * k).withColumns({"rejection_reason": F.lit("x:1"), "arrival_ts": F.lit(START), "body": F.lit("{}")})
        write_rejected_gps(bad, path, START, batch=f"b{k}")
        write_silver_gps(pings(spark, 5, 10 * k), f"{silver}/gps_eventos", START, batch=f"b{k}")
    os.makedirs(f"{silver}/mantenimientos")
    create_tables(spark, "hours_test", silver)
    assert spark.table("hours_test.gps_eventos").count() == 10
    assert merge_hours(spark, path, GPS_REJECTED, START + timedelta(hours=1), kind="json") == 1
    assert read_rejected(spark, path).count() == 10
    for _run in range(2):  # the second removes what the first replaced
        merge_hours(spark, f"{silver}/gps_eventos", GPS_SILVER, START + timedelta(hours=1), keep_seconds=-10)
    refresh_tables(spark, "hours_test")
    assert spark.table("hours_test.gps_eventos").count() == 10
    spark.sql("DROP DATABASE hours_test CASCADE")


def test_quality_run_reads_only_changed_folders(spark, tmp_path):
    path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_silver_gps(pings(spark, 20), path, START, batch="a")
    dq_run_incremental(spark, path, gold, run_ts=START)
    write_silver_gps(pings(spark, 20, 10), path, START, batch="b")  # ten keys come again
    second = dq_run_incremental(spark, path, gold, run_ts=START).head()
    counted = lambda v: {r["source"].split("@")[0]: r["n"] for r in spark.read.parquet(f"{gold}/states/gps_eventos/v={v}/counters").where("kind = 'total'").collect()}
    assert counted(0) == {"2026/5/20/0/a": 20} and counted(1) == {"2026/5/20/0/b": 20}
    whole = dq_metrics(read_silver(spark, path, GPS_SILVER), "gps_eventos", START).head()
    assert second.asDict() == whole.asDict() and second["duplicates_count"] == 10
    dq_run_incremental(spark, path, gold, run_ts=START)
    assert counted(2) == {}
    write_silver_gps(pings(spark, 5), path, START, batch="a")  # a folder written anew takes its old counts with it
    assert dq_run_incremental(spark, path, gold, run_ts=START).head()["total_rows"] == 25
    merge_hours(spark, path, GPS_SILVER, START + timedelta(hours=1))
    merged = dq_run_incremental(spark, path, gold, run_ts=START).head()
    assert merged.asDict() == dq_metrics(read_silver(spark, path, GPS_SILVER), "gps_eventos", START).head().asDict()


def test_no_task_of_a_quality_run_holds_a_folder_or_its_keys(spark, tmp_path, monkeypatch):
    path, gold, seen = str(tmp_path / "silver"), str(tmp_path / "gold"), {}
    rows = pings(spark, 40).unionAll(pings(spark, 1).crossJoin(spark.range(500)).drop("id"))  # a key of 501 rows
    write_silver_gps(rows, path, START, batch="a")

    def kept(name):
        made = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda first, *rest: (seen.update({name: first}), made(first, *rest))[1])

    for name in ("dq_states", "dq_metrics_of_states"):
        kept(name)
    found = dq_run_incremental(spark, path, gold, run_ts=START).head()
    assert found.asDict() == dq_metrics(read_silver(spark, path, GPS_SILVER), "gps_eventos", START).head().asDict()
    assert found["total_rows"] == 540 and found["duplicates_count"] == 500
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for frame in seen.values():  # rows find their folder, and counters theirs, without an exchange by folder
        assert "BroadcastHashJoin" in plan(frame) and "hashpartitioning" not in plan(frame)
    counts = plan(dq_key_counts(seen["dq_states"], "gps_eventos", "source"))
    assert counts.rindex("HashAggregate") < counts.rindex("Exchange hashpartitioning(key")  # the lowest count is above an exchange
    assert counts.count("_share") and dq_key_counts(seen["dq_states"], "gps_eventos", "source").agg(F.max("n")).head()[0] == 501
