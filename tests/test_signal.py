"""Silence thresholds, alert documents, automatic records, fleet status."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from fleetpulse.operators.signal import (
    alert_payload, auto_maintenance_records, fleet_status, fleet_status_kpis, minutes_silent, order_status,
    signal_loss_alert, signal_loss_maintenance, signal_loss_sessions, signal_sweep_summary,
)

AS_OF = datetime(2026, 5, 20, 12, 0, 0, tzinfo=timezone.utc)


def seen(spark, **ages):
    """Devices by seconds since their last ping."""
    rows = [(name, (AS_OF - timedelta(seconds=s)).isoformat()) for name, s in ages.items()]
    return spark.createDataFrame(rows, "equipo_id string, last_seen string")


def names(df):
    return {r["equipo_id"] for r in df.collect()}


def test_thresholds_are_strict_and_unrounded(spark):
    df = seen(spark, fresh=0, ten=600, just_over=601, forty=2400, thirty=1800)
    assert names(signal_loss_alert(df, AS_OF)) == {"just_over", "forty", "thirty"}
    assert names(signal_loss_maintenance(df, AS_OF)) == {"forty"}


def test_unreadable_times_are_left_out_and_unnamed_devices_are_labelled(spark):
    df = spark.createDataFrame(
        [("A", None), ("B", ""), ("C", "sin dato"), (None, "2026-05-20T11:00:00")], "equipo_id string, last_seen string"
    )
    assert [tuple(r) for r in minutes_silent(df, AS_OF).collect()] == [("UNKNOWN", "2026-05-20T11:00:00", 60.0)]


def test_minutes_are_rounded_like_the_client_rounds(spark):
    df = seen(spark, a=603, b=9, c=135, d=-30)
    got = {r["equipo_id"]: r["minutes_silent"] for r in minutes_silent(df, AS_OF).collect()}
    assert got == {"a": 10.1, "b": 0.1, "c": 2.2, "d": -0.5}


def test_timestamp_state_pushes_the_threshold_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "seen")
    df = seen(spark, a=0, b=6000).withColumn("last_seen", F.col("last_seen").cast("timestamp"))
    df.write.parquet(path)
    alerts = signal_loss_alert(spark.read.parquet(path), AS_OF)
    assert names(alerts) == {"b"}
    assert "LessThan(last_seen" in alerts._jdf.queryExecution().executedPlan().toString()


def test_alert_rows(spark):
    alerts = signal_loss_alert(seen(spark, b=1200, a=2400, ok=5), AS_OF)
    rows = sorted(alert_payload(alerts, AS_OF).collect(), key=lambda r: r["equipo_id"])
    assert {(r["alert_type"], r["affected_count"], r["alert_threshold_min"], r["maint_threshold_min"]) for r in rows} == {("SIGNAL_LOSS", 2, 10, 30)}
    assert [(r["equipo_id"], r["minutes_silent"]) for r in rows] == [("a", 40.0), ("b", 20.0)]
    assert alert_payload(alerts.limit(0), AS_OF).count() == 0


def test_an_alert_has_a_row_for_each_device_whatever_the_fleet(spark):
    df = spark.range(10_001).select(
        F.format_string("CAM_%05d", "id").alias("equipo_id"), F.lit("2026-05-20T10:00:00").alias("last_seen")
    )
    alerts = signal_loss_alert(df, AS_OF)
    rows = alert_payload(alerts, AS_OF)
    assert rows.select("equipo_id").distinct().count() == rows.count() == 10_001
    assert rows.head()["affected_count"] == 10_001
    assert signal_sweep_summary(alerts, alerts, AS_OF).count() == 10_001


def test_sweep_summary(spark):
    df = seen(spark, a=1200, b=2400, ok=5)
    rows = signal_sweep_summary(signal_loss_alert(df, AS_OF), signal_loss_maintenance(df, AS_OF), AS_OF).collect()
    key = f"auto_gps_loss_{AS_OF:%Y%m%d_%H%M%S}"
    assert sorted(tuple(r) for r in rows) == [(2, 1, key, "a"), (2, 1, key, "b")]
    quiet = df.limit(0)
    rows = signal_sweep_summary(signal_loss_alert(quiet, AS_OF), signal_loss_maintenance(quiet, AS_OF), AS_OF).collect()
    assert [tuple(r) for r in rows] == [(0, 0, None, None)]


def test_auto_records_once_a_day(spark):
    lost = signal_loss_maintenance(seen(spark, a=2430, b=4000), AS_OF)
    rows = {r["equipo_id"]: r for r in auto_maintenance_records(lost, AS_OF).collect()}
    assert rows["a"]["tipo_falla"] == "GPS DESCONECTADO (40 min sin señal)"  # 40.5, half to even
    assert (rows["a"]["fecha_mantenimiento"], rows["a"]["criticidad"]) == ("2026-05-20", "ALTA")
    existing = spark.createDataFrame(
        [("a", "2026-05-20", "GPS DESCONECTADO (35 min sin señal)"), ("b", "2026-05-19", "GPS DESCONECTADO (35 min sin señal)"), ("b", "2026-05-20", "Motor")],
        "equipo_id string, fecha_mantenimiento string, tipo_falla string",
    )
    assert names(auto_maintenance_records(lost, AS_OF, existing)) == {"b"}


def test_fleet_status_classes(spark):
    extra = spark.createDataFrame([("none", None), ("blank", ""), ("bad", "sin dato")], "equipo_id string, last_seen string")
    df = seen(spark, ok=600, ok_rounded=602, alert=603, alert_edge=1802, silent=1804).union(extra)
    status = fleet_status(df, AS_OF)
    got = {r["equipo_id"]: r["estado"] for r in status.collect()}
    assert got == {
        "ok": "OK", "ok_rounded": "OK", "alert": "ALERTA", "alert_edge": "ALERTA", "silent": "SIN SEÑAL",
        "none": "SIN REGISTRO", "blank": "SIN REGISTRO", "bad": "DATO INVÁLIDO",
    }
    assert tuple(fleet_status_kpis(status).head()) == (8, 2, 2, 1, 1, 2)
    ordered = [r["equipo_id"] for r in order_status(status).collect()]
    assert ordered[0] == "silent" and set(ordered[-3:]) == {"none", "blank", "bad"}
    shown = {r["equipo_id"]: r["ultima_senal"] for r in status.collect()}
    assert shown["none"] == "—" and shown["ok"] == "2026-05-20 11:50:00" and shown["bad"] == "sin dato"


def test_sessions_split_on_more_than_the_gap(spark):
    at = [0, 599, 1199, 1800, 9000]  # gaps of 599, 600, 601 and 7200 seconds
    rows = [("A", AS_OF - timedelta(seconds=10000 - s)) for s in at] + [("B", AS_OF - timedelta(seconds=600))]
    df = spark.createDataFrame(rows, "equipo_id string, event_ts timestamp")
    got = sorted((r["equipo_id"], r["pings"]) for r in signal_loss_sessions(df, AS_OF).collect())
    assert got == [("A", 1), ("A", 1), ("A", 3)]  # B's ping is exactly the gap old: not lost yet


def test_sessions_of_a_very_busy_device_are_folded_before_the_exchange(spark):
    busy = spark.range(200_000).select(
        F.lit("A").alias("equipo_id"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 1000).alias("event_ts")
    )
    rows = signal_loss_sessions(busy, AS_OF).collect()
    assert [(r["equipo_id"], r["pings"]) for r in rows] == [("A", 200_000)]
