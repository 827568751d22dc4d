"""Sessions of pings as a stored state that any ping may still change, and the losses in it.

A session is an interval of a device's pings, none more than the gap after the one before.
Joining intervals does not depend on their order, so a micro-batch only stores the intervals of
its own pings; they are joined when losses are read, and now and then into a snapshot. No ping
is too late: it widens a session, or joins two and so takes back a loss between them.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetpulse.constants import ALERT_MINUTES
from fleetpulse.functions.moments import moment
from fleetpulse.operators.signal import ping_slots
from fleetpulse.sources.last_seen import KEEP_SECONDS, committed, parts_of
from fleetpulse.sources.schemas import LOSS_CHANGES, SESSIONS
from fleetpulse.sources.storage import child_names, delete, exists, modified_ms
from fleetpulse.sources.writers import batch_name

BUCKETS = 64  # of devices, in snapshots: a snapshot is written and read in ranges of them


def join_sessions(intervals: DataFrame, gap_minutes: float = ALERT_MINUTES) -> DataFrame:
    """(equipo_id, first, last, pings): intervals that overlap or lie at most the gap apart as one.

    A device's intervals are sorted together: one for each micro-batch and stretch, not its pings.
    """
    gap = int(gap_minutes * 60_000_000)
    before = Window.partitionBy("equipo_id").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("equipo_id").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = F.coalesce(F.col("first") - F.max("last").over(before) > gap, F.lit(True)).cast("int")
    numbered = intervals.withColumn("_starts", starts).withColumn("_session", F.sum("_starts").over(upto))
    return numbered.groupBy("equipo_id", "_session").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("pings").alias("pings")
    ).drop("_session")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    newest = next(iter(committed(spark, path)[::-1]), None)
    since = parts_of(path, newest)
    files = [] if newest is None else [f"{path}/v={newest}"]
    files += [f"{since}/{name}" for name in child_names(spark, since) if exists(spark, f"{since}/{name}/_SUCCESS")]
    return spark.read.schema(SESSIONS).parquet(*files) if files else spark.createDataFrame([], SESSIONS)


def read_sessions(spark: SparkSession, path: str, gap_minutes: float = ALERT_MINUTES) -> DataFrame:
    """All sessions of all pings stored so far."""
    return join_sessions(_stored(spark, path), gap_minutes)


def compact_sessions(spark: SparkSession, path: str, gap_minutes: float = ALERT_MINUTES, keep_seconds: float = KEEP_SECONDS) -> None:
    """Joins snapshot and micro-batches into the next snapshot; what it replaces stays for a while."""
    versions = committed(spark, path)
    following = versions[-1] + 1 if versions else 0
    joined = read_sessions(spark, path, gap_minutes).repartition(BUCKETS, "equipo_id")
    joined.write.mode("overwrite").parquet(f"{path}/v={following}")
    limit = 1000 * (time.time() - keep_seconds)
    versions.append(following)
    for version, later in zip([None, *versions], versions):
        if modified_ms(spark, f"{path}/v={later}/_SUCCESS") < limit:
            delete(spark, parts_of(path, version))
            if version is not None:
                delete(spark, f"{path}/v={version}")


def session_sink(path: str, gap_minutes: float = ALERT_MINUTES, compact_every: int = 100, keep_seconds: float = KEEP_SECONDS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stores the sessions of each micro-batch's valid pings.

    Work follows the micro-batch; a repeated one replaces its own intervals.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = next(iter(committed(spark, path)[::-1]), None)
        slots = ping_slots(batch, gap_minutes).select("equipo_id", "first", "last", F.col("n").alias("pings"))
        join_sessions(slots, gap_minutes).write.mode("overwrite").parquet(f"{parts_of(path, newest)}/{batch_name(batch, batch_id)}")
        if batch_id % compact_every == compact_every - 1:
            compact_sessions(spark, path, gap_minutes, keep_seconds)

    return store


def read_losses(spark: SparkSession, path: str, as_of=None, gap_minutes: float = ALERT_MINUTES) -> DataFrame:
    """Sessions that ended in a silence of more than the gap, as known now.

    The same rows as ``signal_loss_sessions`` over all pings stored, whatever their order.
    """
    gap = int(gap_minutes * 60_000_000)
    return read_sessions(spark, path, gap_minutes).where(F.col("last") < F.unix_micros(moment(as_of)) - gap).select(
        "equipo_id", F.timestamp_micros("first").alias("first_ping"), F.timestamp_micros("last").alias("last_ping"),
        F.timestamp_micros(F.col("last") + gap).alias("lost_at"), "pings",
    )


def announce_losses(spark: SparkSession, path: str, as_of=None, gap_minutes: float = ALERT_MINUTES) -> DataFrame:
    """What changed since the last call: losses given out (``LOST``) and taken back (``WITHDRAWN``).

    A late ping that lengthens or joins sessions withdraws the losses they were given out as, and
    gives out the right one. Each call's changes are kept as a version, so a call that died is
    repeated as a whole. One caller at a time.
    """
    told = f"{path}/announced"
    versions = committed(spark, told)
    following = versions[-1] + 1 if versions else 0
    losses = read_losses(spark, path, as_of, gap_minutes)
    before = spark.read.schema(losses.schema).parquet(f"{told}/v={versions[-1]}") if versions else losses.limit(0)
    losses.write.mode("overwrite").parquet(f"{told}/next")
    now = spark.read.schema(losses.schema).parquet(f"{told}/next")
    columns = losses.columns
    changes = now.join(before, columns, "left_anti").withColumn("state", F.lit("LOST")).unionByName(
        before.join(now, columns, "left_anti").withColumn("state", F.lit("WITHDRAWN"))
    )
    changes.write.mode("overwrite").parquet(f"{path}/changes/v={following}")
    now.write.mode("overwrite").parquet(f"{told}/v={following}")  # complete from its marker on
    return spark.read.schema(LOSS_CHANGES).parquet(f"{path}/changes/v={following}").drop("v")
