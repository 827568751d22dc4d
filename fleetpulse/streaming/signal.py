"""Silence detection on the stream itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetpulse.constants import ALERT_MINUTES
from fleetpulse.sources.silence import session_sink
from fleetpulse.sources.writers import start_query


def signal_loss_stream(stream: DataFrame, gap: str = "10 minutes", lateness: str = "1 hour") -> DataFrame:
    """One row when a device has been silent for more than ``gap`` after its last valid ping.

    A device's pings form a session that ends ``gap`` after the last of them; in append mode
    the session is given out once the watermark passes that end, which is the loss. A ping
    exactly ``gap`` after the one before continues the session. ``lateness`` matches how old
    a valid ping may be; a ping later than that is not counted. Where that must not happen,
    use ``follow_sessions``.

    Use it with ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition=true``
    where single devices send a large share of all pings: each task then merges its own
    pings into sessions before they are exchanged.
    """
    return (
        stream.filter(F.col("equipo_id").isNotNull())
        .withWatermark("event_ts", lateness)
        .groupBy("equipo_id", F.session_window("event_ts", gap).alias("session"))
        .agg(F.max("event_ts").alias("last_ping"), F.min("event_ts").alias("first_ping"), F.count(F.lit(1)).alias("pings"))
        .select("equipo_id", "first_ping", "last_ping", F.col("session.end").alias("lost_at"), "pings")
    )


def follow_sessions(
    stream: DataFrame, path: str, checkpoint: str, gap_minutes: float = ALERT_MINUTES, available_now: bool = False,
    interval: str | None = None, compact_every: int = 100,
) -> StreamingQuery:
    """Keeps the sessions of a stream of valid pings under ``path``, in whatever order they come.

    No watermark: every ping counts. ``sources.silence.read_losses`` gives the losses as known,
    ``announce_losses`` what is new and what a late ping took back.
    """
    rows = stream.select("equipo_id", "event_ts")
    return start_query(rows.writeStream.foreachBatch(session_sink(path, gap_minutes, compact_every)), checkpoint, None, available_now, interval)
