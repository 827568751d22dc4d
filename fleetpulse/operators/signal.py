"""Silent devices: alerts, automatic maintenance records, fleet status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetpulse.constants import (
    ALERT_MINUTES, ALERT_TYPE, AUTO_FAULT, AUTO_FAULT_FORMAT, AUTO_SOURCE, CRITICAL, FLEET_ALERT, FLEET_BAD_DATA,
    FLEET_NO_RECORD, FLEET_OK, FLEET_SILENT, MAINTENANCE_MINUTES, NO_SIGNAL_TEXT,
)
from fleetpulse.functions.iso_time import iso_timestamp
from fleetpulse.functions.moments import before, moment
from fleetpulse.functions.rounding import round_half_even
from fleetpulse.sources.storage import checkpointed

DOCUMENT_BYTES = 200_000  # of a document's device list; message services take 256 KB


def _seen_ts(last_seen: DataFrame) -> Column:
    column = F.col("last_seen")
    return iso_timestamp(column) if dict(last_seen.dtypes)["last_seen"] == "string" else column


def _elapsed_minutes(seen_ts: Column, as_of: Column) -> Column:
    seconds = (F.unix_micros(as_of) - F.unix_micros(seen_ts)).cast("double") / F.lit(1e6)
    return round_half_even(seconds / F.lit(60.0), 1)


def minutes_silent(last_seen: DataFrame, as_of=None) -> DataFrame:
    """``(equipo_id, last_seen, minutes_silent)``; devices without a readable time are left out."""
    seen = _seen_ts(last_seen)
    return last_seen.filter(seen.isNotNull()).select(
        F.coalesce("equipo_id", F.lit("UNKNOWN")).alias("equipo_id"),
        "last_seen",
        _elapsed_minutes(seen, moment(as_of)).alias("minutes_silent"),
    )


def _silent_longer(last_seen: DataFrame, as_of, minutes: float) -> DataFrame:
    """Compared before rounding, strictly, on the bare column so that the scan can skip files."""
    return minutes_silent(last_seen.filter(_seen_ts(last_seen) < before(moment(as_of), minutes=minutes)), as_of)


def signal_loss_alert(last_seen: DataFrame, as_of=None, threshold_min: float = ALERT_MINUTES) -> DataFrame:
    """Devices an operator should look at."""
    return _silent_longer(last_seen, as_of, threshold_min)


def signal_loss_maintenance(
    last_seen: DataFrame, as_of=None, threshold_min: float = MAINTENANCE_MINUTES
) -> DataFrame:
    """Devices silent long enough to open a maintenance record."""
    return _silent_longer(last_seen, as_of, threshold_min)


def alert_payload(
    alerts: DataFrame, as_of=None, alert_min: int = ALERT_MINUTES, maint_min: int = MAINTENANCE_MINUTES
) -> DataFrame:
    """The alert for the devices in ``alerts``: one row each, under the alert's header columns.

    The shape is the same for any number of devices; without any there is no row.
    """
    return alerts.select(
        F.lit(ALERT_TYPE).alias("alert_type"),
        moment(as_of).alias("detected_at"),
        F.lit(alert_min).alias("alert_threshold_min"),
        F.lit(maint_min).alias("maint_threshold_min"),
        alerts.agg(F.count(F.lit(1))).scalar().alias("affected_count"),
        "equipo_id", "last_seen", "minutes_silent",
    )


def alert_documents(
    alerts: DataFrame, as_of=None, alert_min: int = ALERT_MINUTES, maint_min: int = MAINTENANCE_MINUTES,
    max_bytes: int = DOCUMENT_BYTES,
) -> DataFrame:
    """The alert as grouped JSON documents: ``(document, documents, devices, body)``.

    Each has the header, its number, the number of documents and of all devices, and its
    share of the devices in order of name. The list of a document has ``max_bytes`` at most, as
    long as no single device takes half of that. Devices are sorted by ranges, and a running
    sum within a range cuts them, so no task holds the fleet; a range begins a document. Without
    devices there is none.
    """
    entry = F.struct("equipo_id", "last_seen", "minutes_silent")
    rows = alerts.select(entry.alias("entry"), (F.octet_length(F.to_json(entry)) + 1).alias("bytes"))
    ranged = checkpointed(rows.repartitionByRange("entry.equipo_id", "entry").withColumn("range", F.spark_partition_id()))
    upto = Window.partitionBy("range").orderBy("entry").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # An entry that begins below the limit ends a document at most its own size beyond it.
    cut = ranged.withColumn("part", F.floor((F.sum("bytes").over(upto) - F.col("bytes")) / F.lit(max(1, max_bytes // 2))))
    grouped = cut.groupBy("range", "part").agg(F.sort_array(F.collect_list("entry")).alias("affected_equipos"))
    grouped = checkpointed(grouped)
    # One row a document from here on, without the lists.
    numbers = grouped.select("range", "part", F.row_number().over(Window.orderBy("range", "part")).alias("document"))
    total = grouped.agg(F.count(F.lit(1))).scalar()
    affected = ranged.agg(F.count(F.lit(1))).scalar()
    named = grouped.join(numbers, ["range", "part"]).withColumns({"documents": total, "affected_count": affected})
    body = F.to_json(F.struct(
        F.lit(ALERT_TYPE).alias("alert_type"), moment(as_of).alias("detected_at"), F.lit(alert_min).alias("alert_threshold_min"),
        F.lit(maint_min).alias("maint_threshold_min"), "affected_count", "document", "documents", "affected_equipos",
    ))
    return named.select("document", F.col("documents").cast("int").alias("documents"), F.size("affected_equipos").alias("devices"), body.alias("body"))


def sweep_name(as_of=None) -> Column:
    """Names the automatic records of the sweep at ``as_of`` in the maintenance table."""
    return F.concat(F.lit(AUTO_SOURCE), F.date_format(moment(as_of), "yyyyMMdd_HHmmss"))


def signal_sweep_summary(alerts: DataFrame, maint: DataFrame, as_of=None) -> DataFrame:
    """Counts of a sweep, where its records went, and one row for each device alerted.

    ``maint_key`` is null if no record was opened. A quiet sweep still gives one row, whose
    ``equipo_id`` is null.
    """
    alerted, opened = (df.agg(F.count(F.lit(1))).scalar() for df in (alerts, maint))
    quiet = alerts.sparkSession.range(1).where(alerted == 0).select(F.lit(None).cast("string").alias("equipo_id"))
    return alerts.select("equipo_id").union(quiet).select(
        alerted.alias("alert_lost"), opened.alias("maint_created"),
        F.when(opened > 0, sweep_name(as_of)).alias("maint_key"), "equipo_id",
    )


def auto_maintenance_records(lost: DataFrame, as_of=None, existing: DataFrame | None = None) -> DataFrame:
    """Maintenance rows for devices in ``lost`` (from ``signal_loss_maintenance``).

    Given the ``existing`` table, a device that already has an automatic row of the same day
    gets no second one, so that repeated sweeps do not inflate its fault count.
    """
    day = F.date_format(moment(as_of), "yyyy-MM-dd")
    whole = F.bround("minutes_silent", 0).cast("bigint").cast("string")
    rows = lost.select(
        "equipo_id",
        day.alias("fecha_mantenimiento"),
        F.format_string(AUTO_FAULT_FORMAT, whole).alias("tipo_falla"),
        F.lit(CRITICAL).alias("criticidad"),
    )
    if existing is None:
        return rows
    known = existing.filter(
        (F.col("fecha_mantenimiento").cast("string") == day) & F.col("tipo_falla").contains(AUTO_FAULT)
    ).select("equipo_id")
    return rows.join(known, "equipo_id", "left_anti")


def fleet_status(
    last_seen: DataFrame, as_of=None, alert_min: float = ALERT_MINUTES, maint_min: float = MAINTENANCE_MINUTES
) -> DataFrame:
    """Every device with its class; compared after rounding, as it is displayed."""
    text = F.col("last_seen").cast("string")
    given = F.coalesce(text != "", F.lit(False))
    seen = _seen_ts(last_seen)
    shown = last_seen.select(
        F.coalesce("equipo_id", F.lit("")).alias("equipo_id"),
        F.when(given, F.replace(F.substring(text, 1, 19), F.lit("T"), F.lit(" "))).otherwise(NO_SIGNAL_TEXT).alias("ultima_senal"),
        _elapsed_minutes(seen, moment(as_of)).alias("minutos_sin_senal"),
        given.alias("_given"),
    )
    minutes = F.col("minutos_sin_senal")
    return shown.withColumn(
        "estado",
        F.when(~F.col("_given"), FLEET_NO_RECORD)
        .when(minutes.isNull(), FLEET_BAD_DATA)
        .when(minutes <= alert_min, FLEET_OK)
        .when(minutes <= maint_min, FLEET_ALERT)
        .otherwise(FLEET_SILENT),
    ).drop("_given")


def order_status(status: DataFrame) -> DataFrame:
    """Longest silence first, unknown silence last; by name where equal, which also lets the
    sort split a large group of equal silences."""
    return status.orderBy(F.desc_nulls_last("minutos_sin_senal"), "equipo_id")


def fleet_status_kpis(status: DataFrame) -> DataFrame:
    """One row: devices in all and per class."""
    def of(state: str) -> Column:
        return F.count_if(F.col("estado") == state)

    return status.agg(
        F.count(F.lit(1)).alias("total_equipos"),
        of(FLEET_OK).alias("senal_ok"),
        of(FLEET_ALERT).alias("alerta"),
        of(FLEET_SILENT).alias("sin_senal"),
        of(FLEET_BAD_DATA).alias("dato_invalido"),
        of(FLEET_NO_RECORD).alias("sin_registro"),
    )


def ping_slots(gps: DataFrame, gap_minutes: float = ALERT_MINUTES) -> DataFrame:
    """(equipo_id, slot, first, last, n): a device's pings folded by slots of the gap's length.

    Pings of one slot can never be further apart than the gap.
    """
    gap = int(gap_minutes * 60_000_000)
    micros = F.unix_micros("event_ts")
    return gps.filter(F.col("event_ts").isNotNull() & F.col("equipo_id").isNotNull()).groupBy(
        "equipo_id", (micros - F.pmod(micros, F.lit(gap))).alias("slot")
    ).agg(F.min(micros).alias("first"), F.max(micros).alias("last"), F.count(F.lit(1)).alias("n"))


def signal_loss_sessions(gps: DataFrame, as_of=None, gap_minutes: int = ALERT_MINUTES) -> DataFrame:
    """Each stretch of pings that ended in a silence of more than ``gap_minutes``.

    Pings of one device in one ``gap_minutes`` slot can never be that far apart, so they
    are folded to (first, last, count) before the exchange. The window then sorts at most
    one row per device and slot, however many pings a busy device sends.
    """
    gap = gap_minutes * 60_000_000
    slots = ping_slots(gps, gap_minutes)
    by_time = Window.partitionBy("equipo_id").orderBy("slot")
    starts = F.coalesce(F.col("first") - F.lag("last").over(by_time) > gap, F.lit(True))
    numbered = slots.withColumn("starts", starts.cast("int")).withColumn(
        "stretch", F.sum("starts").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return (
        numbered.groupBy("equipo_id", "stretch")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("pings"))
        .filter(F.col("last") < F.unix_micros(moment(as_of)) - gap)
        .select(
            "equipo_id",
            F.timestamp_micros("first").alias("first_ping"),
            F.timestamp_micros("last").alias("last_ping"),
            F.timestamp_micros(F.col("last") + gap).alias("lost_at"),
            "pings",
        )
    )
