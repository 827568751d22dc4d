"""Maintenance log: column check, cleaning, validation, per-file summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetpulse.constants import CRITICIDAD
from fleetpulse.functions.dates import parse_mixed_date
from fleetpulse.functions.text import null_token_normalize, strip
from fleetpulse.operators.relations import evaluate_once

REASON = "rejection_reason"


def missing_columns(df: DataFrame) -> list[str]:
    """Names of the columns a maintenance log must have and ``df`` lacks."""
    needed = {"equipo_id", "tipo_falla"}
    if "fecha_mantenimiento" not in df.columns:
        needed.add("fecha")
    return sorted(needed - set(df.columns))


def require_columns(df: DataFrame) -> DataFrame:
    """``df`` itself, or ValueError naming the columns it lacks."""
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"maintenance log lacks columns: {', '.join(missing)}")
    return df


def normalize_maintenance(df: DataFrame) -> DataFrame:
    """Trimmed, upper-cased and re-dated rows; ``fecha_mantenimiento`` becomes a DATE."""
    if "fecha" in df.columns and "fecha_mantenimiento" not in df.columns:
        df = df.withColumnRenamed("fecha", "fecha_mantenimiento")
    if dict(df.dtypes).get("fecha_mantenimiento") == "string":
        dated = evaluate_once(df, "_date", parse_mixed_date(F.col("fecha_mantenimiento")))
        df = dated.withColumn("fecha_mantenimiento", F.col("_date")).drop("_date")
    cleaned = {
        name: null_token_normalize(F.upper(strip(F.col(name))))
        for name in ("equipo_id", "criticidad")
        if name in df.columns
    }
    if "tipo_falla" in df.columns:
        cleaned["tipo_falla"] = strip(F.col("tipo_falla"))
    return df.withColumns(cleaned)


def rule_missing_equipo(df: DataFrame):
    return F.when(F.col("equipo_id").isNull(), "missing_equipo_id")


def rule_criticidad(df: DataFrame):
    """Not applied to a log without the column."""
    if "criticidad" not in df.columns:
        return F.lit(None).cast("string")
    known = F.coalesce(F.col("criticidad").isin(CRITICIDAD), F.lit(False))
    return F.when(~known, F.concat(F.lit("invalid_criticidad:"), F.coalesce("criticidad", F.lit("null"))))


def rule_fecha(df: DataFrame):
    return F.when(F.col("fecha_mantenimiento").isNull(), "invalid_fecha_mantenimiento")


def with_maintenance_reasons(df: DataFrame) -> DataFrame:
    """Adds ``rejection_reason``: every rule broken, joined by ``;``, NULL if none."""
    reasons = F.concat_ws(";", rule_missing_equipo(df), rule_criticidad(df), rule_fecha(df))
    return df.withColumn(REASON, F.nullif(reasons, F.lit("")))


def validate_maintenance(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of a normalized log."""
    checked = with_maintenance_reasons(df)
    return (
        checked.filter(F.col(REASON).isNull()).drop(REASON),
        checked.filter(F.col(REASON).isNotNull()),
    )


def ingest_summary(checked: DataFrame) -> DataFrame:
    """Rows total, valid and rejected per source file, from ``with_maintenance_reasons``."""
    valid = F.col(REASON).isNull()
    return checked.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("rejected"),
    )
