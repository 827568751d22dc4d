"""The ping pipeline as streaming queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetpulse.constants import DEDUP_KEYS_GPS, DEDUP_TTL, GPS_DATASET
from fleetpulse.operators.telemetry import decode_payload, split_valid_rejected, validate_gps
from fleetpulse.session import prepare
from fleetpulse.sources.batch_metrics import LAST_SEEN, REJECTED, SILVER, observed
from fleetpulse.sources.last_seen import last_seen_sink
from fleetpulse.sources.readers import read_telemetry_stream
from fleetpulse.sources.storage import make_dir
from fleetpulse.sources.writers import start_query, stream_rejected_gps, stream_silver_gps

SPREAD = 16  # shares over which the copies of one key are dealt


def dedup_stream(
    df: DataFrame, keys: Sequence[str] = tuple(DEDUP_KEYS_GPS), ttl: str = DEDUP_TTL, spread: int = SPREAD
) -> DataFrame:
    """First arrival per key, remembered for ``ttl`` across batches and restarts.

    ``ttl`` runs from when a micro-batch took the row in, a time that never goes back. So no
    row is ever late: a backlog in any order of event times loses nothing to a watermark.

    Copies are first left out within ``spread`` shares into which rows are dealt, whatever their
    key. A key with very many copies is thus met by many tasks, and of all its copies within
    ``ttl`` at most ``spread`` reach the one task that knows it. A key is remembered twice for it;
    ``spread=1`` saves that where no key has many copies.
    """
    taken = df.withColumn("_taken", F.current_timestamp()).withWatermark("_taken", ttl)
    if spread > 1:
        dealt = taken.withColumn("_share", F.floor(F.rand(17) * spread).cast("int"))
        taken = dealt.dropDuplicatesWithinWatermark([*keys, "_share"]).drop("_share")
    return taken.dropDuplicatesWithinWatermark(list(keys)).drop("_taken")


def stream_judged(
    spark: SparkSession, source: str, landing: str, checkpoint: str, available_now: bool = False,
    interval: str | None = None, max_files: int | None = None, arrival: str = "processing",
    passthrough: Mapping[str, str] | None = None, retention: str | None = None,
) -> tuple[StreamingQuery, StructType]:
    """Decodes, stamps and validates each message once; stores it with ``arrival_ts`` and reason.

    Returns the query and the schema of the stored rows. Exactly once by the sink's commit
    log, which every follower of the table reads by. With ``retention`` ("7 days") the log
    forgets files older than that when it is compacted, so it stops growing; from then on they
    can be deleted. No follower may trail by more.
    """
    judged = validate_gps(decode_payload(read_telemetry_stream(spark, source, max_files, arrival), passthrough=passthrough))
    make_dir(spark, landing)
    writer = judged.writeStream.format("parquet").option("path", landing).outputMode("append")
    if retention:
        writer = writer.option("retention", retention)
    return start_query(writer, checkpoint, None, available_now, interval), judged.schema


def telemetry_pipeline(
    spark: SparkSession, source: str, out: str, checkpoint: str, available_now: bool = False,
    interval: str | None = None, max_files: int | None = None, arrival: str = "processing",
    passthrough: Mapping[str, str] | None = None, metrics: bool = True,
    retention: str | None = None,
) -> list[StreamingQuery]:
    """Messages to valid pings, rejected pings and last-seen state, as four queries.

    The first judges every message and lands it under ``landing``; the others follow that
    table. So a message has one verdict, however far apart the stages run and whichever of
    them was down: it is stored as valid, as a copy left out, or as rejected, and never in two
    places. Each query has its own checkpoint and restarts alone. ``available_now`` works off
    what is there and stops; the verdicts are then finished before the others follow them.
    ``passthrough`` names further message fields to store as columns, with their types; what
    else a message holds is stored in ``other_fields``.

    ``retention`` bounds the landing table's log (``stream_judged``); the hours of silver and rejected
    zone are merged by ``sources.hours.merge_hours``, on a schedule of the user's.

    The followers count their micro-batches while they store them, into ``metrics``
    (``read_batch_metrics``). The session is set to UTC and, for its streams, to the RocksDB
    state store and merged sessions (``session.STREAMING``), also for other queries in it.
    """
    prepare(spark)
    counts = f"{out}/metrics/{GPS_DATASET}" if metrics else None
    landing = f"{out}/landing/{GPS_DATASET}"
    first, schema = stream_judged(
        spark, source, landing, f"{checkpoint}/landing", available_now, interval, max_files, arrival, passthrough, retention
    )
    if available_now:
        first.awaitTermination()
    valid, rejected = split_valid_rejected(spark.readStream.schema(schema).parquet(landing))
    second = stream_silver_gps(
        dedup_stream(valid), f"{out}/silver/{GPS_DATASET}", f"{checkpoint}/silver", available_now, interval,
        wrap=lambda store: observed(store, counts, SILVER),
    )
    third = stream_rejected_gps(
        rejected, f"{out}/rejected/{GPS_DATASET}", f"{checkpoint}/rejected", available_now, interval,
        wrap=lambda store: observed(store, counts, REJECTED),
    )
    # Copies share their event time, so the latest ping needs no rows without them.
    latest = observed(last_seen_sink(f"{out}/state/last_seen"), counts, LAST_SEEN)
    seen = valid.select("equipo_id", "event_ts", "arrival_ts").writeStream.foreachBatch(latest)
    return [first, second, third, start_query(seen, f"{checkpoint}/last_seen", None, available_now, interval)]
