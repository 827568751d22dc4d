"""Counts of micro-batches, and alarms over them."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.signal import alert_documents
from fleetpulse.sources.batch_metrics import LAST_SEEN, REJECTED, SILVER, SWEEP, batch_totals, observed, pipeline_alarms, read_batch_metrics, rejected_totals
from fleetpulse.sources.schemas import BATCH_METRICS

START = datetime(2026, 5, 20, tzinfo=timezone.utc)


def test_counts_are_replaced_on_repeat_and_failures_stay(spark, tmp_path):
    path = str(tmp_path / "metrics")
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    batch = spark.createDataFrame([("stale_timestamp:1", START, START - timedelta(seconds=90)), ("decode_error:x", START, None)],
                                  "rejection_reason string, arrival_ts timestamp, event_ts timestamp")
    seen = []
    store = observed(lambda df, _id: seen.append(len(df.collect())), path, REJECTED)
    for _run in range(2):
        store(batch, 4)
    store(batch.limit(0), 5)

    def fails(_df, _id):
        raise ValueError("no room")

    with pytest.raises(ValueError):
        observed(fails, path, SILVER)(batch, 6)
    rows = {(r["stage"], r["batch_id"]): r for r in read_batch_metrics(spark, path).collect()}
    assert seen == [2, 2, 0] and len(rows) == 3
    first = rows[REJECTED, 4]
    assert (first["rows"], first["oldest_age_seconds"], first["errors"]) == (2, 90.0, 0)
    assert first["rejected"] == {"stale_timestamp": 1, "decode_error": 1}
    assert (rows[REJECTED, 5]["rows"], rows[SILVER, 6]["errors"]) == (0, 1)
    metrics = read_batch_metrics(spark, path)
    assert batch_totals(metrics).head().asDict() == {"valid": 0, "rejected": 2, "total": 2}
    assert {r["reason"]: r["rejections"] for r in rejected_totals(metrics).collect()} == {"stale_timestamp": 1, "decode_error": 1}
    assert read_batch_metrics(spark, str(tmp_path / "none")).count() == 0
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_all_five_alarms_from_the_counts(spark):
    def row(stage, minute, ms=10, rows=1, errors=0, age=None, rejected=None):
        return stage, minute, START + timedelta(minutes=minute), ms, rows, errors, age, rejected or {}

    rows = [row(SILVER, m, errors=1) for m in [1] * 6] + [row(SWEEP, 3, errors=1)] * 2
    rows += [row(LAST_SEEN, m, age=61.0) for m in (10, 11)] + [row(LAST_SEEN, 13, age=5.0)]
    rows += [row(REJECTED, 20, rejected={"decode_error": 1, "stale_timestamp": 7}), row(REJECTED, 21, rejected={"stale_timestamp": 7})]
    rows += [row(SILVER, m, ms=46_000) for m in (30, 31, 32)] + [row(SILVER, 40)]
    changes = pipeline_alarms(spark.createDataFrame(rows, BATCH_METRICS), START + timedelta(minutes=50)).collect()
    got = sorted((r["alarm"], int((r["period_start"].replace(tzinfo=timezone.utc) - START).total_seconds() // 60), r["state"]) for r in changes)
    assert got == sorted([
        ("validate_errors", 1, "ALARM"), ("validate_errors", 2, "OK"), ("sweep_errors", 0, "ALARM"), ("sweep_errors", 5, "OK"),
        ("oldest_message_age_seconds", 11, "ALARM"), ("oldest_message_age_seconds", 12, "OK"),
        ("dead_letter_count", 20, "ALARM"), ("dead_letter_count", 21, "OK"),
        ("validate_duration_ms", 32, "ALARM"), ("validate_duration_ms", 33, "OK"),
    ])


def test_alert_documents_are_bounded_and_complete(spark):
    alerts = spark.range(3000).select(
        F.format_string("CAM_%05d", "id").alias("equipo_id"), F.lit("2026-05-20T00:00:00Z").alias("last_seen"), F.lit(12.5).alias("minutes_silent")
    )
    rows = alert_documents(alerts, START, max_bytes=10_000).orderBy("document").collect()
    assert [r["document"] for r in rows] == list(range(1, len(rows) + 1)) and {r["documents"] for r in rows} == {len(rows)}
    assert sum(r["devices"] for r in rows) == 3000 and max(len(r["body"]) for r in rows) < 10_300 and len(rows) < 100
    assert alert_documents(alerts.limit(0), START).count() == 0
