"""One registered query per operator, over the shared tables.

Each takes (spark, folder of tables) and returns a DataFrame. Queries of readers and sinks
write below the shared folder first and read back what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from fleetpulse.constants import GPS_DATASET, MAINTENANCE_DATASET
from fleetpulse.functions.dates import parse_mixed_date
from fleetpulse.functions.iso_time import iso_timestamp
from fleetpulse.functions.json_values import number_text
from fleetpulse.functions.text import null_token_normalize, strip
from fleetpulse.operators import maintenance as mt
from fleetpulse.operators import monitoring as mon
from fleetpulse.operators import quality as dq
from fleetpulse.operators import reports as rp
from fleetpulse.operators import signal as sg
from fleetpulse.operators import telemetry as tm
from fleetpulse.operators.relations import union_by_name
from fleetpulse.plans import jobs
from fleetpulse.plans import shared_tables as data
from fleetpulse.plans.shared_tables import AS_OF
from fleetpulse.session import prepare
from fleetpulse.sources import batch_metrics as counted
from fleetpulse.sources import hours
from fleetpulse.sources import last_seen as state
from fleetpulse.sources import readers, writers
from fleetpulse.sources.schemas import GPS_SILVER, MAINTENANCE_SILVER
from fleetpulse.sources.silence import announce_losses, read_losses
from fleetpulse.sources.storage import scratch
from fleetpulse.sources.tables import create_tables as make_tables
from fleetpulse.sources.writers import stream_silver_gps
from fleetpulse.streaming.signal import follow_sessions
from fleetpulse.streaming.signal import signal_loss_stream as silent_sessions
from fleetpulse.streaming.telemetry import dedup_stream as first_arrivals
from fleetpulse.streaming.telemetry import telemetry_pipeline as run_pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# The sparse test data leave nearly every device silent at 10 and 30 minutes.
WIDE = {"alert_min": 600, "maint_min": 1800}


def query(fn: Query | None = None, *, name: str | None = None):
    """Registers ``fn`` under ``name``, or under its own."""
    if fn is None:
        return lambda f: query(f, name=name)

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(prepare(spark), sf_dir)
        # zone-free times compare alike whatever the client's own zone
        return df.withColumns({
            f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, TimestampType)
        })

    QUERIES[name or fn.__name__] = run
    return run


def _decoded(spark, sf):
    return tm.decode_payload(data.messages(spark, sf))


def _checked(spark, sf):
    return tm.validate_gps(_decoded(spark, sf))


def _faulty_table(spark, sf):
    """The faulty pings as a stored table would hold them."""
    return data.faulty_pings(spark, sf).withColumn("event_ts", iso_timestamp(F.col("timestamp")))


def _normal_log(spark, sf):
    return mt.normalize_maintenance(data.raw_maintenance(spark, sf))


def _log_table(spark, sf):
    return _normal_log(spark, sf).withColumn("fecha_mantenimiento", F.col("fecha_mantenimiento").cast("string"))


def _seen(spark, sf):
    """Last-seen state without its unreadable entries."""
    none = spark.createDataFrame([], "equipo_id string, last_seen timestamp")
    return state.upsert_last_seen(none, data.pings(spark, sf))


def _streamed(df: DataFrame, name: str) -> DataFrame:
    """Runs a stream over everything that is there and reads back its output."""
    spark = df.sparkSession
    out = scratch(spark, name)
    stream = df.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").option("path", f"{out}/rows")
    stream.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


# --- flagship -----------------------------------------------------------------------

@query
def critical_equipment_report(spark, sf):
    return rp.critical_equipment_report(data.maintenance(spark, sf), data.pings(spark, sf), AS_OF)


@query
def critical_equipment_report_600(spark, sf):
    return rp.critical_equipment_report(data.maintenance(spark, sf), data.pings(spark, sf), AS_OF, silent_min=600)


@query
def critical_report_totals(spark, sf):
    return rp.critical_report_totals(critical_equipment_report_600(spark, sf))


@query
def critical_faults(spark, sf):
    return rp.critical_faults(data.maintenance(spark, sf))


@query
def pending_faults(spark, sf):
    return rp.pending_faults(data.maintenance(spark, sf))


@query
def last_gps(spark, sf):
    return tm.last_gps(data.pings(spark, sf))


@query
def critical_equipment_gps(spark, sf):
    return rp.critical_equipment_gps(rp.critical_faults(data.maintenance(spark, sf)), tm.last_gps(data.pings(spark, sf)))


@query
def gps_state(spark, sf):
    return rp.gps_state(tm.last_gps(data.pings(spark, sf)), AS_OF, silent_min=600)


@query
def order_critical(spark, sf):
    joined = rp.critical_equipment_gps(rp.critical_faults(data.maintenance(spark, sf)), tm.last_gps(data.pings(spark, sf)))
    return rp.order_critical(rp.gps_state(joined, AS_OF)).select("equipo_id", "total_fallas_criticas", "minutos_sin_senal")


@query
def faults_by_equipment(spark, sf):
    return rp.faults_by_equipment(data.maintenance(spark, sf))


@query
def at_risk_equipment(spark, sf):
    return rp.at_risk_equipment(rp.faults_by_equipment(data.maintenance(spark, sf)))


@query
def maintenance_kpis(spark, sf):
    return rp.maintenance_kpis(data.mixed_maintenance(spark, sf))


@query
def maintenance_origin_split(spark, sf):
    manual, auto = rp.maintenance_origin_split(data.mixed_maintenance(spark, sf))
    return manual.withColumn("origen", F.lit("manual")).unionByName(auto.withColumn("origen", F.lit("auto")))


# --- GPS stream, statelessly ------------------------------------------------------------

@query
def decode_payload(spark, sf):
    return _decoded(spark, sf).select(
        "event_id", "copy", "equipo_id", "timestamp", "latitude", "longitude", "speed_kmh", "estado",
        F.col("_missing").alias("missing"),
    )


@query
def normalize_gps_fields(spark, sf):
    device = data.pings(spark, sf).select(
        "event_id", "equipo_id", "timestamp", F.col("latitude").alias("latitud"),
        F.col("longitude").alias("longitud"), F.col("speed_kmh").alias("velocidad"), "estado",
    )
    return tm.normalize_gps_fields(device)


@query
def rule_missing_fields(spark, sf):
    rows = _decoded(spark, sf).withColumn("reason", tm.rule_missing_fields(F.col("_missing")))
    return rows.filter("reason IS NOT NULL").select("event_id", "copy", "reason")


@query
def rule_lat_bbox(spark, sf):
    latitude = F.col("latitude")
    return data.pings(spark, sf).select("event_id", tm.rule_lat_bbox(latitude, number_text(latitude)).alias("reason"))


@query
def rule_lon_bbox(spark, sf):
    longitude = F.col("longitude")
    return data.pings(spark, sf).select("event_id", tm.rule_lon_bbox(longitude, number_text(longitude)).alias("reason"))


@query
def rule_timestamp_parse(spark, sf):
    text = F.col("timestamp")
    return data.faulty_pings(spark, sf).select(
        "event_id", "copy", tm.rule_timestamp_parse(iso_timestamp(text), text).alias("reason"),
        iso_timestamp(text).alias("event_ts"),
    )


@query
def rule_future(spark, sf):
    reason = tm.rule_future(F.col("event_ts"), F.col("arrival_ts"), F.col("timestamp"))
    return data.pings(spark, sf).select("event_id", tm.rejection_code(reason).alias("reason"))


@query
def rule_stale(spark, sf):
    reason = tm.rule_stale(F.col("event_ts"), F.col("arrival_ts"), F.col("timestamp"))
    return data.pings(spark, sf).select("event_id", tm.rejection_code(reason).alias("reason"))


@query
def validate_gps(spark, sf):
    return _checked(spark, sf).select("event_id", "copy", "event_ts", "rejection_reason")


@query
def split_valid_rejected(spark, sf):
    valid, rejected = tm.split_valid_rejected(_checked(spark, sf))
    kept = rejected.select(
        "event_id", "copy", "equipo_id", "latitude", "longitude", "speed_kmh", "estado",
        tm.rejection_code(F.col("rejection_reason")).alias("outcome"),
    )
    return kept.unionByName(valid.withColumn("outcome", F.lit("valid")).select(*kept.columns))


@query
def batch_summary(spark, sf):
    return tm.batch_summary(_checked(spark, sf))


@query
def rejections_by_reason(spark, sf):
    return tm.rejections_by_reason(_checked(spark, sf))


@query
def rejections_by_reason_5min(spark, sf):
    return tm.rejections_by_reason(_checked(spark, sf), by_device=False, bin="5 minutes")


@query
def hour_partition_columns(spark, sf):
    return tm.hour_partition_columns(data.pings(spark, sf)).select("event_id", "year", "month", "day", "hour")


@query
def dedup_batch(spark, sf):
    valid, _ = tm.split_valid_rejected(_checked(spark, sf))
    return tm.dedup_batch(valid, order=("arrival_ts", "copy")).select(
        "event_id", "copy", "equipo_id", "timestamp", "latitude", "longitude", "arrival_ts"
    )


@query(name="union_by_name")
def _union_by_name_query(spark, sf):
    pings = data.pings(spark, sf).select("equipo_id", F.col("event_ts").alias("momento"), "speed_kmh")
    faults = data.maintenance(spark, sf).select("equipo_id", "criticidad")
    return union_by_name([pings, faults])


# --- maintenance log -------------------------------------------------------------------

@query
def require_columns(spark, sf):
    return mt.require_columns(data.raw_maintenance(spark, sf)).select("equipo_id", "fecha", "tipo_falla", "criticidad")


@query
def normalize_maintenance(spark, sf):
    return _normal_log(spark, sf).withColumn("fecha_mantenimiento", F.col("fecha_mantenimiento").cast("string"))


@query(name="parse_mixed_date")
def _parse_mixed_date_query(spark, sf):
    return data.raw_maintenance(spark, sf).select(
        "order_id", parse_mixed_date(F.col("fecha")).cast("string").alias("fecha_mantenimiento")
    )


@query(name="null_token_normalize")
def _null_token_normalize_query(spark, sf):
    return data.raw_maintenance(spark, sf).select(
        "order_id", null_token_normalize(F.upper(strip(F.col("equipo_id")))).alias("equipo_id")
    )


def _one_reason(spark, sf, rule):
    log = _normal_log(spark, sf)
    return log.select("order_id", rule(log).alias("reason"))


@query
def rule_missing_equipo(spark, sf):
    return _one_reason(spark, sf, mt.rule_missing_equipo)


@query
def rule_criticidad(spark, sf):
    return _one_reason(spark, sf, mt.rule_criticidad)


@query
def rule_fecha(spark, sf):
    return _one_reason(spark, sf, mt.rule_fecha)


@query
def validate_maintenance(spark, sf):
    valid, rejected = mt.validate_maintenance(_normal_log(spark, sf))
    rows = rejected.unionByName(valid, allowMissingColumns=True)
    return rows.select("order_id", "equipo_id", F.col("fecha_mantenimiento").cast("string").alias("fecha_mantenimiento"), "rejection_reason")


@query
def ingest_summary(spark, sf):
    return mt.ingest_summary(mt.with_maintenance_reasons(_normal_log(spark, sf)))


# --- silence ------------------------------------------------------------------------------

@query
def minutes_silent(spark, sf):
    return sg.minutes_silent(data.device_state(spark, sf), AS_OF)


@query
def signal_loss_alert(spark, sf):
    return sg.signal_loss_alert(data.device_state(spark, sf), AS_OF, WIDE["alert_min"])


@query
def signal_loss_maintenance(spark, sf):
    return sg.signal_loss_maintenance(data.device_state(spark, sf), AS_OF, WIDE["maint_min"])


@query
def alert_payload(spark, sf):
    alerts = sg.signal_loss_alert(data.device_state(spark, sf), AS_OF, WIDE["alert_min"])
    return sg.alert_payload(alerts, AS_OF, **WIDE)


@query
def alert_documents(spark, sf):
    """The documents of a sweep put together again: the rows of the alert, each once."""
    alerts = sg.signal_loss_alert(data.device_state(spark, sf), AS_OF, WIDE["alert_min"])
    documents = sg.alert_documents(alerts, AS_OF, **WIDE, max_bytes=2_000)
    schema = (
        "alert_type string, detected_at timestamp, alert_threshold_min int, maint_threshold_min int, affected_count bigint, document int, "
        "documents int, affected_equipos array<struct<equipo_id: string, last_seen: string, minutes_silent: double>>"
    )
    read = documents.withColumn("read", F.from_json("body", schema)).withColumns({
        "small": F.octet_length("body") < 2_000 + 300,
        "numbered": (F.col("read.document") == F.col("document")) & F.col("document").between(1, F.col("documents")),
        "complete": documents.agg(F.count_distinct("document")).scalar() == F.col("documents"),
    })
    return read.select("read.*", "small", "numbered", "complete").select(
        "alert_type", "detected_at", "alert_threshold_min", "maint_threshold_min", "affected_count", "small", "numbered", "complete",
        F.inline("affected_equipos"),
    )


@query
def signal_sweep_now(spark, sf):
    """A sweep at the time of its call: the key in its summary is where its records are."""
    path, silver = scratch(spark, "last_seen"), scratch(spark, "maintenance")
    state.write_last_seen(_seen(spark, sf), path)
    alert, summary = jobs.signal_sweep(spark, path, silver)
    stored = spark.read.schema("equipo_id string, source_file string").parquet(silver)
    keys = summary.select("maint_key", "alert_lost", "maint_created").distinct()
    return stored.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("equipo_id").alias("devices")).join(
        keys, F.col("source_file") == F.col("maint_key")
    ).select("records", "devices", "alert_lost", "maint_created", alert.agg(F.count(F.lit(1))).scalar().alias("alert_rows"))


@query
def auto_maintenance_records(spark, sf):
    lost = sg.signal_loss_maintenance(data.device_state(spark, sf), AS_OF, WIDE["maint_min"])
    # devices with an odd number already have today's record
    known = data.device_state(spark, sf).filter(F.substring("equipo_id", -1, 1).isin("1", "3", "5", "7", "9")).select(
        "equipo_id", F.lit(AS_OF[:10]).alias("fecha_mantenimiento"),
        F.lit("GPS DESCONECTADO (31 min sin señal)").alias("tipo_falla"),
    )
    return sg.auto_maintenance_records(lost, AS_OF, known)


@query
def signal_sweep_summary(spark, sf):
    devices = data.device_state(spark, sf)
    return sg.signal_sweep_summary(
        sg.signal_loss_alert(devices, AS_OF, WIDE["alert_min"]),
        sg.signal_loss_maintenance(devices, AS_OF, WIDE["maint_min"]), AS_OF,
    )


@query
def fleet_status(spark, sf):
    return sg.fleet_status(data.device_state(spark, sf), AS_OF, **WIDE)


@query
def order_status(spark, sf):
    return sg.order_status(sg.fleet_status(data.device_state(spark, sf), AS_OF)).select("equipo_id", "minutos_sin_senal")


@query
def fleet_status_kpis(spark, sf):
    return sg.fleet_status_kpis(sg.fleet_status(data.device_state(spark, sf), AS_OF, **WIDE))


@query
def signal_loss_sessions(spark, sf):
    return sg.signal_loss_sessions(data.pings(spark, sf), AS_OF)


# --- data quality ----------------------------------------------------------------------------

@query
def dq_rules(spark, sf):
    """Each rule with the number of rows that break it."""
    parts = []
    for dataset, table in ((GPS_DATASET, _faulty_table(spark, sf)), (MAINTENANCE_DATASET, _log_table(spark, sf))):
        cases = dq.dq_failure_cases(table, dataset).select("column", "check")
        parts.append(cases.groupBy("column", "check").agg(F.count(F.lit(1)).alias("failures")).withColumn("dataset", F.lit(dataset)))
    return union_by_name(parts)


@query
def dq_failure_cases(spark, sf):
    return dq.dq_failure_cases(_faulty_table(spark, sf), GPS_DATASET).select("event_id", "copy", "column", "check", "failure_case")


@query
def dq_failure_cases_maintenance(spark, sf):
    return dq.dq_failure_cases(_log_table(spark, sf), MAINTENANCE_DATASET).select("order_id", "column", "check", "failure_case")


@query
def dq_split(spark, sf):
    valid, rejected = dq.dq_split(_faulty_table(spark, sf), GPS_DATASET)
    return valid.select("event_id", "copy", F.lit(None).cast("string").alias("rejection_reason")).unionByName(
        rejected.select("event_id", "copy", "rejection_reason")
    )


@query
def dq_rejection_reason(spark, sf):
    return dq.dq_rejection_reason(_log_table(spark, sf), MAINTENANCE_DATASET).select("order_id", "rejection_reason")


@query
def dq_duplicates(spark, sf):
    return union_by_name([
        dq.dq_duplicates(_faulty_table(spark, sf), GPS_DATASET).withColumn("dataset", F.lit(GPS_DATASET)),
        dq.dq_duplicates(_log_table(spark, sf), MAINTENANCE_DATASET).withColumn("dataset", F.lit(MAINTENANCE_DATASET)),
    ])


@query
def dq_completeness(spark, sf):
    return union_by_name([
        dq.dq_completeness(_faulty_table(spark, sf)).withColumn("dataset", F.lit(GPS_DATASET)),
        dq.dq_completeness(_log_table(spark, sf)).withColumn("dataset", F.lit(MAINTENANCE_DATASET)),
    ])


@query
def dq_out_of_range(spark, sf):
    return dq.dq_out_of_range(_faulty_table(spark, sf), GPS_DATASET)


@query
def dq_metrics(spark, sf):
    return union_by_name([
        dq.dq_metrics(_faulty_table(spark, sf), GPS_DATASET, AS_OF),
        dq.dq_metrics(_log_table(spark, sf), MAINTENANCE_DATASET, AS_OF),
    ]).drop("completeness_pct", "out_of_range_pct")


@query
def dq_column_status(spark, sf):
    return union_by_name([
        dq.dq_column_status(dq.dq_metrics(_faulty_table(spark, sf), GPS_DATASET, AS_OF)),
        dq.dq_column_status(dq.dq_metrics(_log_table(spark, sf), MAINTENANCE_DATASET, AS_OF)),
    ])


def _stored_tables(spark, sf) -> str:
    silver = scratch(spark, "silver")
    writers.write_silver_gps(_faulty_table(spark, sf).drop("event_id", "copy"), f"{silver}/{GPS_DATASET}", AS_OF)
    writers.write_silver_maintenance(_log_table(spark, sf).drop("order_id"), f"{silver}/{MAINTENANCE_DATASET}")
    return silver


def _quality_runs(spark, sf) -> str:
    gold, silver = scratch(spark, "gold"), _stored_tables(spark, sf)
    jobs.dq_run(spark, silver, gold, run_ts=datetime(2024, 1, 30, tzinfo=timezone.utc))
    writers.write_silver_maintenance(data.mixed_maintenance(spark, sf).drop("order_id").withColumn("source_file", F.lit("mixta.csv")), f"{silver}/{MAINTENANCE_DATASET}")
    jobs.dq_run(spark, silver, gold, run_ts=datetime(2024, 1, 31, tzinfo=timezone.utc))
    return gold


@query
def dq_run(spark, sf):
    gold = scratch(spark, "gold")
    jobs.dq_run(spark, _stored_tables(spark, sf), gold, run_ts=datetime(2024, 1, 31, tzinfo=timezone.utc))
    return spark.read.parquet(f"{gold}/parquet").drop("completeness_pct", "out_of_range_pct", "run")


@query
def dq_run_incremental(spark, sf):
    """Three increments, one of them written twice and two merged before the last run: as one full run."""
    path, gold = scratch(spark, "silver"), scratch(spark, "gold")
    rows = _faulty_table(spark, sf)
    for third in range(3):
        some = rows.filter(F.col("event_id") % 3 == third).drop("event_id", "copy")
        for attempt in range(1 + (third == 1)):
            writers.write_silver_gps(some.limit(100) if third == 1 and attempt == 0 else some, path, f"2024-01-31 0{third // 2}:00:00", batch=f"part-{third}")
            metrics = jobs.dq_run_incremental(spark, path, gold, run_ts=datetime(2024, 1, 31, tzinfo=timezone.utc))
        if third == 1:
            hours.merge_hours(spark, path, GPS_SILVER, datetime(2024, 2, 1, tzinfo=timezone.utc))
    return metrics.drop("completeness_pct", "out_of_range_pct")


@query
def write_quality_metrics(spark, sf):
    gold = scratch(spark, "gold")
    for _run in range(2):  # repeated, it replaces itself
        writers.write_quality_metrics(dq.dq_metrics(_faulty_table(spark, sf), GPS_DATASET, AS_OF), gold)
    stored = spark.read.parquet(f"{gold}/parquet")
    share = F.from_json("completeness_pct", "map<string,double>")["speed_kmh"]
    return stored.select("dataset", "total_rows", "valid_pct", share.alias("speed_completeness"))


@query
def read_quality_history(spark, sf):
    gold = _quality_runs(spark, sf)
    return union_by_name([
        readers.read_quality_history(spark, gold, name).drop("completeness_pct", "out_of_range_pct")
        for name in (GPS_DATASET, MAINTENANCE_DATASET)
    ])


@query
def dq_latest_and_trend(spark, sf):
    latest, trend = dq.dq_latest_and_trend(readers.read_quality_history(spark, _quality_runs(spark, sf), MAINTENANCE_DATASET))
    return latest.select("run_timestamp", "total_rows", "valid_pct", F.lit("latest").alias("part")).unionByName(
        trend.select("run_timestamp", F.lit(None).cast("bigint").alias("total_rows"), "valid_pct", F.lit("trend").alias("part"))
    )


# --- sources and sinks -----------------------------------------------------------------------

@query
def read_telemetry_stream(spark, sf):
    folder = scratch(spark, "messages")
    data.envelopes(spark, sf).write.text(folder)
    received = readers.read_telemetry_stream(spark, folder, arrival="transport")
    return tm.decode_payload(_streamed(received, "received")).select(
        "equipo_id", "timestamp", "latitude", "longitude", "speed_kmh", "estado", "arrival_ts"
    )


@query
def read_maintenance_csv(spark, sf):
    folder = scratch(spark, "csv")
    data.raw_maintenance(spark, sf).drop("source_file").write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return readers.read_maintenance_csv(spark, folder).drop("source_file")


@query
def read_silver(spark, sf):
    path = scratch(spark, "silver")
    writers.write_silver_gps(data.pings(spark, sf).drop("event_id"), path, AS_OF)
    return readers.read_silver(spark, path, GPS_SILVER).drop(tm.OTHER_FIELDS)


@query
def write_silver_gps(spark, sf):
    path = scratch(spark, "silver")
    valid, _ = tm.split_valid_rejected(_checked(spark, sf))
    writers.write_silver_gps(valid, path, AS_OF)
    return spark.read.parquet(path).groupBy("year", "month", "day", "hour", "equipo_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_ts").alias("last_event")
    )


@query
def last_gps_since(spark, sf):
    """Pings stored in two batches a day, after their arrival, some days merged, then read from a day on."""
    path = scratch(spark, "silver")
    valid, _ = tm.split_valid_rejected(_checked(spark, sf))
    for half in range(2):
        some = valid.filter(F.col("event_id") % 2 == half).drop("event_id", "copy")
        writers.write_silver_gps(some, path, F.date_trunc("day", F.col("arrival_ts")) + F.expr("INTERVAL 1 DAY"), batch=f"half-{half}")
    hours.merge_hours(spark, path, GPS_SILVER, datetime(2024, 1, 20, tzinfo=timezone.utc))
    rows = readers.read_silver(spark, path, GPS_SILVER, since="2024-01-15 00:00:00")
    everything = readers.read_silver(spark, path, GPS_SILVER).agg(F.count(F.lit(1))).scalar()
    return tm.last_gps(rows).join(rows.groupBy("equipo_id").agg(F.count(F.lit(1)).alias("pings")), "equipo_id").withColumn("stored", everything)


def _rejected_zone(spark, sf) -> str:
    path = scratch(spark, "rejected")
    _, rejected = tm.split_valid_rejected(_checked(spark, sf))
    writers.write_rejected_gps(rejected.drop("event_id", "copy", "event_ts"), path, AS_OF)
    return path


@query
def write_rejected_gps(spark, sf):
    rows = spark.read.json(_rejected_zone(spark, sf))
    return rows.groupBy("year", "month", "day", "hour", tm.rejection_code(F.col("rejection_reason")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def read_rejected(spark, sf):
    return readers.read_rejected(spark, _rejected_zone(spark, sf)).select(
        "equipo_id", F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"), "timestamp", "arrival_ts", "rejection_reason",
        F.col("_raw").isNotNull().alias("raw_kept"),
    )


@query
def rejected_sample(spark, sf):
    """Which file is the newest depends on the run, so there is no SQL for it."""
    return readers.rejected_sample(spark, _rejected_zone(spark, sf)).select("equipo_id", "latitude", "longitude", "rejection_reason")


@query
def rejected_sample_facts(spark, sf):
    """What holds of the sample whichever file is the newest."""
    path = _rejected_zone(spark, sf)
    sample = readers.rejected_sample(spark, path).withColumn("row", F.monotonically_increasing_id())
    stored = readers.read_rejected(spark, path)
    newest = stored.agg(F.max(F.struct("modified", "file")).alias("newest")).select("newest.file")
    known = stored.join(newest, "file", "left_semi").select("_raw").distinct()
    return sample.join(known.withColumn("known", F.lit(True)), "_raw", "left").agg(
        F.count_distinct("row").alias("n"), F.bool_and(F.col("rejection_reason").isNotNull()).alias("all_with_reason"),
        F.bool_and(F.col("known").isNotNull()).alias("all_from_newest"),
    )


@query
def write_silver_maintenance(spark, sf):
    """Ingested twice; the second run replaces the first."""
    path = scratch(spark, "maintenance")
    checked = mt.with_maintenance_reasons(_normal_log(spark, sf))
    valid, _ = mt.validate_maintenance(_normal_log(spark, sf))
    for _run in range(2):
        writers.write_silver_maintenance(valid.drop("order_id"), path, mt.ingest_summary(checked))
    return spark.read.parquet(path).groupBy("source_file", "criticidad").agg(
        F.count(F.lit(1)).alias("n"), F.max("fecha_mantenimiento").alias("last_date")
    )


@query
def write_rejected_maintenance(spark, sf):
    path = scratch(spark, "rejected")
    _, rejected = mt.validate_maintenance(_normal_log(spark, sf))
    for _run in range(2):
        writers.write_rejected_maintenance(rejected.drop("order_id"), path)
    return spark.read.json(path).groupBy("source_file", "rejection_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def ingest_maintenance(spark, sf):
    """CSV files in, per-file summary out; the files are those of batches of orders.

    Some have their columns in another order, and half of the last batch lacks one.
    """
    folder, out = scratch(spark, "csv"), scratch(spark, "ingest")
    log = data.raw_maintenance(spark, sf)
    batch, even = F.regexp_extract("source_file", "[0-9]+", 0).cast("int"), F.col("order_id") % 2 == 0
    layouts = {
        "plain": log.filter(batch < 3).drop("order_id"),
        "turned": log.filter((batch >= 3) & ~((batch == 6) & even)).select("criticidad", "tipo_falla", "fecha", "equipo_id", "source_file"),
        "short": log.filter((batch == 6) & even).drop("order_id", "tipo_falla"),
    }
    for name, rows in layouts.items():
        rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).partitionBy("source_file").csv(f"{folder}/{name}")
    summary = jobs.ingest_maintenance(spark, f"{folder}/*/*", f"{out}/silver", f"{out}/rejected")
    batch = F.regexp_extract("source_file", "source_file=(mant_[0-9]+)", 1)
    return summary.groupBy(batch.alias("batch")).agg(*[F.sum(c).alias(c) for c in ("total", "valid", "rejected")])


@query
def upsert_last_seen(spark, sf):
    """Two halves of the pings merged one after the other."""
    pings, half = data.pings(spark, sf), F.col("event_id") % 2
    none = spark.createDataFrame([], "equipo_id string, last_seen timestamp")
    first = state.upsert_last_seen(none, pings.filter(half == 0))
    return state.upsert_last_seen(first, pings.filter(half == 1))


@query
def read_last_seen(spark, sf):
    path = scratch(spark, "last_seen")
    state.write_last_seen(_seen(spark, sf), path)
    return state.read_last_seen(spark, path)


@query
def append_auto_maintenance(spark, sf):
    """A sweep stored over the maintenance table, then the faults per device."""
    path = scratch(spark, "maintenance")
    writers.write_silver_maintenance(
        data.maintenance(spark, sf).drop("order_id").withColumn("source_file", F.lit("taller.csv")), path
    )
    lost = sg.signal_loss_maintenance(_seen(spark, sf), AS_OF, WIDE["maint_min"])
    for _run in range(2):
        writers.append_auto_maintenance(sg.auto_maintenance_records(lost, AS_OF), path, AS_OF)
    return rp.faults_by_equipment(readers.read_silver(spark, path, MAINTENANCE_SILVER))


@query
def create_tables(spark, sf):
    """The flagship in SQL's place of work: over catalog tables."""
    silver = scratch(spark, "silver")
    writers.write_silver_gps(data.pings(spark, sf).drop("event_id"), f"{silver}/{GPS_DATASET}", AS_OF)
    writers.write_silver_maintenance(
        data.maintenance(spark, sf).drop("order_id").withColumn("source_file", F.lit("taller.csv")),
        f"{silver}/{MAINTENANCE_DATASET}",
    )
    database = "fleetpulse_" + silver.rsplit("-", 1)[-1]
    make_tables(spark, database, silver)
    return rp.critical_equipment_report(
        spark.table(f"{database}.{MAINTENANCE_DATASET}"), spark.table(f"{database}.{GPS_DATASET}"), AS_OF, silent_min=600
    )


# --- streaming -----------------------------------------------------------------------------------

def _event_stream(spark, sf) -> DataFrame:
    """The event table as a file stream, as pings."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    device = F.format_string("CAM_%06d", F.col("user_id"))
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", device.alias("equipo_id"), ts.alias("event_ts"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
    )


@query
def dedup_stream(spark, sf):
    pings = _event_stream(spark, sf)
    replayed = pings.withColumn("copy", F.explode(F.when(F.col("event_id") % 20 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return _streamed(first_arrivals(replayed), "dedup").select("event_id", "equipo_id", "timestamp")


@query
def signal_loss_stream(spark, sf):
    return _streamed(silent_sessions(_event_stream(spark, sf)), "silent")


def _disordered_sessions(spark, sf) -> tuple[str, list[DataFrame]]:
    """The pings in files of mixed time order, followed in two runs of several micro-batches with losses announced after each."""
    folder, path = scratch(spark, "pings"), scratch(spark, "sessions")
    pings = data.pings(spark, sf).select("event_id", "equipo_id", "event_ts")
    changes = []
    for half in range(2):
        some = pings.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).drop("event_id")
        some.repartition(3, F.xxhash64("event_ts")).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(some.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        follow_sessions(stream, path, f"{path}-checkpoint", available_now=True, compact_every=4).awaitTermination()
        changes.append(announce_losses(spark, path, AS_OF))
    return path, changes


@query
def signal_loss_disordered(spark, sf):
    """A backlog in any order has the losses of the batch form: no ping is too late."""
    path, _ = _disordered_sessions(spark, sf)
    return read_losses(spark, path, AS_OF)


@query
def signal_loss_announced(spark, sf):
    """Losses given out less those taken back are the losses."""
    _, changes = _disordered_sessions(spark, sf)
    given = union_by_name(changes).groupBy("equipo_id", "first_ping", "last_ping", "lost_at", "pings").agg(
        F.sum(F.when(F.col("state") == "LOST", 1).otherwise(-1)).alias("net")
    )
    return given.where("net <> 0").select("equipo_id", "first_ping", "last_ping", "lost_at", "pings", F.col("net").cast("int").alias("net"))


def _pipeline_output(spark, envelopes: DataFrame, max_files: int | None = None) -> str:
    folder, out = scratch(spark, "messages"), scratch(spark, "pipeline")
    envelopes.write.text(folder)
    for running in run_pipeline(spark, folder, out, f"{out}/checkpoint", available_now=True, max_files=max_files, arrival="transport"):
        running.awaitTermination()
    return out


@query
def dedup_stream_disordered(spark, sf):
    """Weeks of messages in files of mixed time order, one file a micro-batch: none is late."""
    shuffled = data.envelopes(spark, sf).repartition(5, F.xxhash64("value"))
    out = _pipeline_output(spark, shuffled, max_files=1)
    return readers.read_silver(spark, f"{out}/silver/{GPS_DATASET}", GPS_SILVER).select("equipo_id", "timestamp")


@query
def pipeline_accounting(spark, sf):
    """Every message is valid, a copy, or rejected, and is in one place only."""
    messages = data.envelopes(spark, sf)
    out = _pipeline_output(spark, messages)
    silver = readers.read_silver(spark, f"{out}/silver/{GPS_DATASET}", GPS_SILVER).select("equipo_id", "timestamp")
    rejected = readers.read_rejected(spark, f"{out}/rejected/{GPS_DATASET}").select("equipo_id", "timestamp", "arrival_ts", "rejection_reason")
    judged = spark.read.parquet(f"{out}/landing/{GPS_DATASET}")
    accepted = judged.filter("rejection_reason IS NULL").select(*silver.columns)
    refused = judged.filter("rejection_reason IS NOT NULL").select(*rejected.columns)
    once = accepted.distinct()
    counts = {
        "received": messages, "valid": silver, "copies": accepted.exceptAll(once), "rejected": rejected,
        "lost": union_by_name([once.exceptAll(silver), refused.exceptAll(rejected).select(*silver.columns)]),
        "twice": union_by_name([silver.exceptAll(once), rejected.exceptAll(refused).select(*silver.columns)]),
    }
    return union_by_name([
        rows.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(part)) for part, rows in counts.items()
    ])


@query
def stream_and_backfill(spark, sf):
    """One half of the pings streamed, the other stored twice as one batch: each is read once."""
    out, half = scratch(spark, "silver"), F.col("event_id") % 2
    streamed = _event_stream(spark, sf).filter(half == 0)
    stream_silver_gps(first_arrivals(streamed).drop("event_id"), f"{out}/rows", f"{out}/checkpoint", available_now=True).awaitTermination()
    for _run in range(2):
        writers.write_silver_gps(data.pings(spark, sf).filter(half == 1).drop("event_id"), f"{out}/rows", AS_OF, batch="backfill")
    return readers.read_silver(spark, f"{out}/rows", GPS_SILVER).select("equipo_id", "timestamp", "event_ts")


@query(name="telemetry_end_to_end")
def _telemetry_end_to_end(spark, sf):
    """The streaming queries of telemetry_pipeline, over everything there is."""
    out = _pipeline_output(spark, data.envelopes(spark, sf))
    silver = readers.read_silver(spark, f"{out}/silver/{GPS_DATASET}", GPS_SILVER)
    rejected = readers.read_rejected(spark, f"{out}/rejected/{GPS_DATASET}")
    seen = state.read_last_seen(spark, f"{out}/state/last_seen")
    counted = [
        silver.groupBy(F.col("equipo_id").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("silver")),
        rejected.groupBy(tm.rejection_code(F.col("rejection_reason")).alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("rejected")),
        seen.select(F.col("equipo_id").alias("name"), F.unix_micros("last_seen").alias("n"), F.lit("last_seen").alias("part")),
    ]
    return union_by_name(counted)


def _other_fields(rows: DataFrame, part: str) -> DataFrame:
    """Undeclared fields read back by path, each with its kind of JSON value."""
    at = lambda path, kind="variant": F.try_variant_get(tm.OTHER_FIELDS, path, kind)
    kind = F.regexp_replace(F.schema_of_variant(at("$.heading")), "^(DECIMAL|BIGINT|DOUBLE).*", "NUMBER")
    return rows.select(
        F.lit(part).alias("part"), "equipo_id", "timestamp", F.col("speed_kmh").cast("double").alias("speed_kmh"), at("$.heading", "string").alias("heading"),
        kind.alias("heading_kind"), at("$.fuel.level", "int").alias("fuel_level"), at("$.engine_on", "boolean").alias("engine_on"),
        F.is_variant_null(at("$.driver")).alias("driver_null"), F.col(tm.OTHER_FIELDS).isNotNull().alias("has_more"),
    )


@query
def unknown_fields_end_to_end(spark, sf):
    """Fields that nothing declares, through the whole stream, in silver and rejected zone."""
    out = _pipeline_output(spark, data.envelopes(spark, sf, data.rich_messages))
    silver = readers.read_silver(spark, f"{out}/silver/{GPS_DATASET}", GPS_SILVER)
    return _other_fields(silver, "silver").unionByName(_other_fields(readers.read_rejected(spark, f"{out}/rejected/{GPS_DATASET}"), "rejected"))


@query
def observed_batch_counts(spark, sf):
    """What the running stream counted, micro-batch by micro-batch, added up."""
    out = _pipeline_output(spark, data.envelopes(spark, sf).repartition(4, F.xxhash64("value")), max_files=1)
    metrics = counted.read_batch_metrics(spark, f"{out}/metrics/{GPS_DATASET}")
    totals = counted.batch_totals(metrics)
    age = metrics.where(F.col("stage") == counted.LAST_SEEN).agg(F.max("oldest_age_seconds").alias("n")).select(F.lit("oldest_age").alias("name"), "n")
    number = lambda df, c: df.select(F.lit(c).alias("name"), F.col(c).cast("double").alias("n"))
    return union_by_name([
        *(number(totals, c) for c in totals.columns), age,
        counted.rejected_totals(metrics).select(F.col("reason").alias("name"), F.col("rejections").cast("double").alias("n")),
    ])


@query
def pipeline_alarms(spark, sf):
    """The standing alarms over the stream's own counts: these old messages raise the age alarm, and nothing failed."""
    out = _pipeline_output(spark, data.envelopes(spark, sf))
    changes = counted.pipeline_alarms(counted.read_batch_metrics(spark, f"{out}/metrics/{GPS_DATASET}"))
    failed = changes.where(F.col("alarm").isin("validate_errors", "sweep_errors", "dead_letter_count"))
    return failed.agg(F.count(F.lit(1)).alias("failures"))


# --- monitoring --------------------------------------------------------------------------------------

@query
def windowed_threshold_alarm(spark, sf):
    return mon.windowed_threshold_alarm(data.pings(spark, sf), "event_ts", "speed_kmh", "sum", "6 hours", 400.0, 3, ["estado"])


@query
def windowed_threshold_alarm_p99(spark, sf):
    return mon.windowed_threshold_alarm(data.pings(spark, sf), "event_ts", "speed_kmh", "p99", "1 day", 150.0, 2, ["estado"])


def _errors(spark, sf):
    """Some failures count several errors, so that a minute of the sparse data can breach."""
    return data.pings(spark, sf).withColumn("errors", F.when(F.col("estado") == "error", F.col("event_id") % 10).otherwise(0))


@query
def alarm_validate_errors(spark, sf):
    return mon.preset_alarm(_errors(spark, sf), "validate_errors", "event_ts", "errors")


@query
def alarm_sweep_errors(spark, sf):
    return mon.preset_alarm(_errors(spark, sf), "sweep_errors", "event_ts", "errors")


@query
def alarm_oldest_message_age(spark, sf):
    age = (F.unix_micros("arrival_ts") - F.unix_micros("event_ts")) / F.lit(1e6)
    return mon.preset_alarm(data.pings(spark, sf).withColumn("age", age), "oldest_message_age_seconds", "arrival_ts", "age")


@query
def alarm_dead_letter_count(spark, sf):
    rows = data.faulty_pings(spark, sf).withColumn("dead", F.when(F.col("timestamp") == "not-a-date", 1).otherwise(0))
    return mon.preset_alarm(rows, "dead_letter_count", "arrival_ts", "dead")


@query
def alarm_validate_duration(spark, sf):
    rows = data.pings(spark, sf).withColumn("duration_ms", F.col("speed_kmh") * F.lit(1000.0))
    return mon.preset_alarm(rows, "validate_duration_ms", "event_ts", "duration_ms")


@query
def alarm_timeline(spark, sf):
    """Long gaps are filled; a period without data clears the alarm."""
    return mon.alarm_timeline(data.pings(spark, sf), "event_ts", "speed_kmh", "sum", "6 hours", 150.0, 2, ["estado"], AS_OF)


@query
def alarm_changes(spark, sf):
    return mon.alarm_changes(data.pings(spark, sf), "event_ts", "speed_kmh", "sum", "6 hours", 150.0, 2, ["estado"], AS_OF)


def _preset_rows(spark, sf) -> dict[str, tuple[DataFrame, str, str]]:
    """What each standing alarm watches: (rows, time column, value column)."""
    age = (F.unix_micros("arrival_ts") - F.unix_micros("event_ts")) / F.lit(1e6)
    dead = F.when(F.col("timestamp") == "not-a-date", 1).otherwise(0)
    return {
        "validate_errors": (_errors(spark, sf), "event_ts", "errors"),
        "sweep_errors": (_errors(spark, sf), "event_ts", "errors"),
        "oldest_message_age_seconds": (data.pings(spark, sf).withColumn("age", age), "arrival_ts", "age"),
        "dead_letter_count": (data.faulty_pings(spark, sf).withColumn("dead", dead), "arrival_ts", "dead"),
        "validate_duration_ms": (data.pings(spark, sf).withColumn("duration_ms", F.col("speed_kmh") * F.lit(1000.0)), "event_ts", "duration_ms"),
    }


@query
def preset_alarm_changes(spark, sf):
    """When each of the five standing alarms went on and off, per kind of event."""
    return union_by_name([
        mon.preset_changes(rows, name, ts, value, ["estado"], AS_OF).withColumn("alarm", F.lit(name))
        for name, (rows, ts, value) in _preset_rows(spark, sf).items()
    ])


@query
def preset_alarm_timeline(spark, sf):
    """Periods of each standing alarm, those without data among them, counted by state and day."""
    return union_by_name([
        mon.preset_timeline(rows, name, ts, value, ["estado"], AS_OF)
        .groupBy("estado", F.date_format("period_start", "yyyy-MM-dd").alias("day"), "breaching", "alarm")
        .agg(F.count(F.lit(1)).alias("periods"), F.count("value").alias("with_data")).withColumn("name", F.lit(name))
        for name, (rows, ts, value) in _preset_rows(spark, sf).items()
    ])
