"""Keyed state: the last valid ping of every device, as snapshots and the micro-batches since."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetpulse.sources.schemas import LAST_SEEN
from fleetpulse.sources.storage import child_names, delete, exists, modified_ms
from fleetpulse.sources.writers import batch_name

KEEP_SECONDS = 86_400


def upsert_last_seen(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` state merged with pings ``new``: the latest event time per device wins.

    ``new`` has ``equipo_id`` and ``event_ts``. Pings without a device are left out. A late
    ping never moves a device backwards, and merging the same pings twice changes nothing.
    """
    pings = new.filter(F.col("equipo_id").isNotNull() & F.col("event_ts").isNotNull()).select(
        "equipo_id", F.col("event_ts").alias("last_seen")
    )
    return old.select("equipo_id", "last_seen").unionByName(pings).groupBy("equipo_id").agg(
        F.max("last_seen").alias("last_seen")
    )


def committed(spark: SparkSession, path: str) -> list[int]:
    """Versions of a snapshot table that are complete."""
    versions = [int(n[2:]) for n in child_names(spark, path) if n.startswith("v=") and n[2:].isdigit()]
    return sorted(v for v in versions if exists(spark, f"{path}/v={v}/_SUCCESS"))


def parts_of(path: str, version: int | None) -> str:
    """Folder of the micro-batches merged since that snapshot."""
    return f"{path}/after-{'start' if version is None else version}"


def read_last_seen(spark: SparkSession, path: str) -> DataFrame:
    """``(equipo_id, last_seen)`` of the newest complete snapshot and what came after it.

    Empty before the first. The files behind the frame stay for as long as
    ``compact_last_seen`` is told to keep them.
    """
    newest = next(iter(committed(spark, path)[::-1]), None)
    since = parts_of(path, newest)
    files = [] if newest is None else [f"{path}/v={newest}"]
    files += [f"{since}/{name}" for name in child_names(spark, since) if exists(spark, f"{since}/{name}/_SUCCESS")]
    if not files:
        return spark.createDataFrame([], LAST_SEEN)
    state = spark.read.schema(LAST_SEEN).parquet(*files)
    return state.groupBy("equipo_id").agg(F.max("last_seen").alias("last_seen")) if len(files) > 1 else state


def write_last_seen(state: DataFrame, path: str) -> None:
    """Stores ``state`` as the next snapshot. Nothing is deleted.

    A snapshot counts from its success marker on, so a write that dies half-way is never read
    and is overwritten by the next one. One writer at a time.
    """
    versions = committed(state.sparkSession, path)
    state.write.mode("overwrite").parquet(f"{path}/v={versions[-1] + 1 if versions else 0}")


def compact_last_seen(spark: SparkSession, path: str, keep_seconds: float = KEEP_SECONDS) -> None:
    """Folds snapshot and micro-batches into the next snapshot.

    Of the older ones, those go that were superseded more than ``keep_seconds`` ago: a frame
    read before stays readable for so long.
    """
    write_last_seen(read_last_seen(spark, path), path)
    versions = committed(spark, path)
    limit = 1000 * (time.time() - keep_seconds)
    for version, following in zip([None, *versions], versions):
        if modified_ms(spark, f"{path}/v={following}/_SUCCESS") < limit:
            delete(spark, parts_of(path, version))
            if version is not None:
                delete(spark, f"{path}/v={version}")


def last_seen_sink(
    path: str, compact_every: int = 100, keep_seconds: float = KEEP_SECONDS
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds each micro-batch's latest pings to the state at ``path``.

    A micro-batch stores one row for each device seen in it; the whole fleet is rewritten only
    every ``compact_every`` micro-batches. A repeated micro-batch replaces its own rows.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = next(iter(committed(spark, path)[::-1]), None)
        none = spark.createDataFrame([], LAST_SEEN)
        part = f"{parts_of(path, newest)}/{batch_name(batch, batch_id)}"
        upsert_last_seen(none, batch).write.mode("overwrite").parquet(part)
        if batch_id % compact_every == compact_every - 1:
            compact_last_seen(spark, path, keep_seconds)

    return merge
