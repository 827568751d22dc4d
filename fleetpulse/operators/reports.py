"""Fault reports over the maintenance table and the signal state of its machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetpulse.constants import (
    ALERT_MINUTES, AUTO_FAULT, CRITICAL, GPS_OK, GPS_SILENT, MIN_CRITICAL_FAULTS, RESOLVED,
)
from fleetpulse.functions.moments import moment
from fleetpulse.operators.telemetry import last_gps


def _pending() -> Column:
    """Faults known to be open; a fault without a state is not counted."""
    return F.count_if(F.col("estado") != RESOLVED)


def _critical(mant: DataFrame) -> DataFrame:
    return mant.filter(F.col("criticidad") == CRITICAL)


def _with_state(mant: DataFrame) -> DataFrame:
    return mant if "estado" in mant.columns else mant.withColumn("estado", F.lit(None).cast("string"))


def critical_faults(mant: DataFrame, min_faults: int = MIN_CRITICAL_FAULTS) -> DataFrame:
    """Machines with more than ``min_faults`` critical faults.

    Counts and a DATE maximum fold into one row per machine and task before the exchange.
    """
    return (
        _critical(_with_state(mant))
        .groupBy("equipo_id")
        .agg(
            F.count(F.lit(1)).alias("total_fallas_criticas"),
            F.count_if(F.col("criticidad") == CRITICAL).alias("fallas_alta"),
            _pending().alias("fallas_pendientes"),
            F.max("fecha_mantenimiento").alias("ultimo_mantenimiento"),
        )
        .filter(F.col("total_fallas_criticas") > min_faults)
    )


def pending_faults(mant: DataFrame) -> DataFrame:
    """Open critical faults per machine."""
    return _critical(_with_state(mant)).groupBy("equipo_id").agg(_pending().alias("fallas_pendientes"))


def critical_equipment_gps(faults: DataFrame, gps_last: DataFrame) -> DataFrame:
    """Fault counts with the last ping; machines never heard of keep a NULL.

    Both sides are one row per machine and already distributed by it, so the join needs no
    exchange of its own.
    """
    return faults.join(gps_last, "equipo_id", "left")


def gps_state(df: DataFrame, as_of=None, silent_min: int = ALERT_MINUTES) -> DataFrame:
    """Adds OK / SIN_SEÑAL and the complete minutes since the last ping."""
    minutes = F.timestamp_diff("MINUTE", F.col("ultima_fecha_gps"), moment(as_of))
    return df.withColumns({
        "estado_gps": F.when(minutes <= silent_min, GPS_OK).otherwise(GPS_SILENT),
        "minutos_sin_senal": minutes,
    })


def order_critical(df: DataFrame) -> DataFrame:
    """Most faults first, then longest silence, unknown silence last.

    Most machines tie on both, so the name is the last key: a range sort could not split
    one huge group of equal keys over several tasks.
    """
    return df.orderBy(F.desc("total_fallas_criticas"), F.desc_nulls_last("minutos_sin_senal"), "equipo_id")


def critical_equipment_report(
    mant: DataFrame, gps: DataFrame, as_of=None,
    min_faults: int = MIN_CRITICAL_FAULTS, silent_min: int = ALERT_MINUTES, since: Column | None = None,
) -> DataFrame:
    """Which machines have repeated critical faults, and are they still reporting?"""
    joined = critical_equipment_gps(critical_faults(mant, min_faults), last_gps(gps, since))
    return order_critical(gps_state(joined, as_of, silent_min))


def critical_report_totals(report: DataFrame) -> DataFrame:
    """The report's footer: machines listed, reporting and silent."""
    return report.agg(
        F.count(F.lit(1)).alias("total_equipos"),
        F.count_if(F.col("estado_gps") == GPS_OK).alias("ok"),
        F.count_if(F.col("estado_gps") == GPS_SILENT).alias("sin_senal"),
    )


def faults_by_equipment(mant: DataFrame) -> DataFrame:
    """Critical faults per machine, most first."""
    return (
        _critical(mant).groupBy("equipo_id").agg(F.count(F.lit(1)).alias("fallas_alta"))
        .orderBy(F.desc("fallas_alta"), "equipo_id")
    )


def at_risk_equipment(faults: DataFrame, min_faults: int = MIN_CRITICAL_FAULTS) -> DataFrame:
    return faults.filter(F.col("fallas_alta") > min_faults)


def _automatic() -> Column:
    return F.coalesce(F.col("tipo_falla").contains(AUTO_FAULT), F.lit(False))


def maintenance_kpis(mant: DataFrame) -> DataFrame:
    """One row: records in all, critical, entered by hand, raised by the silence sweep."""
    return mant.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_if(F.col("criticidad") == CRITICAL).alias("criticidad_alta"),
        F.count_if(~_automatic()).alias("registros_manuales"),
        F.count_if(_automatic()).alias("auto_generados"),
    )


def maintenance_origin_split(mant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entered by hand, raised by the silence sweep)."""
    return mant.filter(~_automatic()), mant.filter(_automatic())
