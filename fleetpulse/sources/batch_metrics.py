"""What each micro-batch did: counted while it is stored, kept by batch, watched by alarms."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fleetpulse.constants import REJECTION_CODES
from fleetpulse.operators.monitoring import preset_changes
from fleetpulse.operators.relations import union_by_name
from fleetpulse.operators.telemetry import REASON, rejection_code
from fleetpulse.sources.schemas import BATCH_METRICS
from fleetpulse.sources.storage import exists
from fleetpulse.sources.writers import batch_name

Store = Callable[[DataFrame, int], None]
SILVER, REJECTED, LAST_SEEN, SWEEP = "silver", "rejected", "last_seen", "sweep"


def _watched(batch: DataFrame) -> list:
    """Aggregates over the columns that a micro-batch has."""
    out = [F.count(F.lit(1)).alias("rows")]
    if {"arrival_ts", "event_ts"} <= set(batch.columns):
        out.append(F.max((F.unix_micros("arrival_ts") - F.unix_micros("event_ts")) / F.lit(1e6)).alias("oldest_age_seconds"))
    if REASON in batch.columns:
        out += [F.count_if(rejection_code(F.col(REASON)) == code).alias(code) for code in REJECTION_CODES]
    return out


def record_batch(spark: SparkSession, path: str, name: str, stage: str, batch_id: int | None, began: float, seen: dict, errors: int = 0) -> None:
    """One row of the metrics table, as the partition ``name``; a row of that name is replaced."""
    codes = {c: seen[c] for c in REJECTION_CODES if seen.get(c)}
    row = (
        stage, batch_id, datetime.now(timezone.utc), int(1000 * (time.monotonic() - began)), seen.get("rows"), errors,
        seen.get("oldest_age_seconds"), codes,
    )
    (
        spark.createDataFrame([row], BATCH_METRICS).withColumn("batch", F.lit(name)).coalesce(1).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    )


def observed(store: Store, path: str | None, stage: str) -> Store:
    """``store`` with its micro-batches counted on the way to storage, without another pass.

    A repeated micro-batch replaces its row. A failure is a row of its own with ``errors`` 1,
    which stays when the repetition succeeds, and is raised again.
    """
    if path is None:
        return store

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, began, seen = batch.sparkSession, time.monotonic(), Observation()
        name = batch_name(batch, batch_id)
        try:
            store(batch.observe(seen, *_watched(batch)), batch_id)
        except Exception:
            record_batch(spark, path, f"{name}-failed-{uuid.uuid4().hex[:8]}", stage, batch_id, began, {}, 1)
            raise
        record_batch(spark, path, name, stage, batch_id, began, seen.get)

    return run


def read_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row for each micro-batch and stage, failed attempts apart; empty before the first."""
    if not exists(spark, path):
        return spark.createDataFrame([], BATCH_METRICS)
    return spark.read.schema(BATCH_METRICS).parquet(path)


def batch_totals(metrics: DataFrame) -> DataFrame:
    """One row: valid (first copies), rejected and total, as ``batch_summary`` counts them.

    ``total`` is what the followers of all verdicts saw: accepted with its copies, and rejected.
    """
    rows = lambda *stages: F.coalesce(F.sum(F.when(F.col("stage").isin(*stages), F.col("rows"))), F.lit(0))
    return metrics.agg(rows(SILVER).alias("valid"), rows(REJECTED).alias("rejected"), rows(LAST_SEEN, REJECTED).alias("total"))


def rejected_totals(metrics: DataFrame) -> DataFrame:
    """(reason, rejections) over all micro-batches."""
    codes = metrics.where(F.col("stage") == REJECTED).select(F.explode("rejected").alias("reason", "n"))
    return codes.groupBy("reason").agg(F.sum("n").alias("rejections"))


def pipeline_alarms(metrics: DataFrame, until=None) -> DataFrame:
    """(alarm, period_start, state): when each standing alarm went on and off.

    Errors are failed attempts to store a micro-batch, or failed sweeps; dead letters are the
    messages that could not be decoded; age and duration are those of the micro-batches.
    """
    streamed = F.col("stage") != SWEEP
    watched = {
        "validate_errors": F.when(streamed, F.col("errors")),
        "sweep_errors": F.when(~streamed, F.col("errors")),
        "oldest_message_age_seconds": F.col("oldest_age_seconds"),
        "dead_letter_count": F.when(F.col("stage") == REJECTED, F.coalesce(F.col("rejected")["decode_error"], F.lit(0))),
        "validate_duration_ms": F.when(streamed & (F.col("errors") == 0), F.col("duration_ms")),
    }
    return union_by_name([
        preset_changes(metrics.withColumn("_value", value), name, "taken_at", "_value", (), until).withColumn("alarm", F.lit(name))
        for name, value in watched.items()
    ])
