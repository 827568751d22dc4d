"""Writing the stored tables.

Every write of pings, maintenance rows, sweeps and quality runs replaces its own partitions, so a
repeated one does not double rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetpulse.functions.moments import moment
from fleetpulse.operators.signal import sweep_name
from fleetpulse.operators.telemetry import hour_partition_columns
from fleetpulse.sources.schemas import GPS_SILVER, MAINTENANCE_SILVER, PING_PARTITIONS
from fleetpulse.sources.storage import child_names, delete

_REPLACE_PARTITIONS = {"partitionOverwriteMode": "dynamic"}


def _at_hour(df: DataFrame, now: Column) -> DataFrame:
    return hour_partition_columns(df.withColumn("_now", now), "_now").drop("_now")


def silver_gps_columns(df: DataFrame) -> DataFrame:
    """The stored columns of a valid ping; further columns of the frame are kept after them."""
    declared = [c for c in GPS_SILVER.fieldNames() if c in df.columns]
    extra = [c for c in df.columns if c not in declared and c not in ("body", "arrival_ts", "rejection_reason")]
    return df.select(*declared, *extra)


def rejected_gps_columns(df: DataFrame) -> DataFrame:
    """A rejected ping with its reason and, whole, the text it came from."""
    return df.withColumnRenamed("body", "_raw") if "body" in df.columns else df


def _store_batch(df: DataFrame, path: str, kind: str, batch: str) -> None:
    """Puts ``df`` under its hours, in partitions named ``batch``; those of that name are replaced."""
    (
        df.withColumn("batch", F.lit(batch)).write.mode("overwrite").options(**_REPLACE_PARTITIONS)
        .partitionBy(*PING_PARTITIONS).format(kind).save(path)
    )


def write_silver_gps(df: DataFrame, path: str, now=None, batch: str | None = None) -> None:
    """Stores valid pings under the hour of writing; an empty frame writes no data file.

    A write with the ``batch`` name and the hour of an earlier one replaces it. Without a name
    it is a batch of its own and adds to what is there. Streams write into the same table in
    the same way, so what either of them stores is read alike.
    """
    _store_batch(silver_gps_columns(_at_hour(df, moment(now))), path, "parquet", batch or uuid.uuid4().hex)


def write_rejected_gps(df: DataFrame, path: str, now=None, batch: str | None = None) -> None:
    """Stores rejected pings as JSON lines, by hour and batch like the valid ones."""
    _store_batch(rejected_gps_columns(_at_hour(df, moment(now))), path, "json", batch or uuid.uuid4().hex)


def start_query(writer, checkpoint: str, name: str | None, available_now: bool, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """Of a micro-batch: the same when it is repeated after a failure, and no other's."""
    return f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"


def _batch_sink(path: str, kind: str):
    """The hours are columns of the stream: a repeated micro-batch keeps its time, and so
    replaces what its first attempt wrote."""

    def store(batch: DataFrame, batch_id: int) -> None:
        _store_batch(batch, path, kind, batch_name(batch, batch_id))

    return store


def stream_silver_gps(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str | None = None,
    name: str | None = None, wrap=lambda store: store,
) -> StreamingQuery:
    """Valid pings of a stream to Parquet, each micro-batch once. ``wrap`` may add to its storing."""
    rows = silver_gps_columns(_at_hour(df, F.current_timestamp()))
    return start_query(rows.writeStream.foreachBatch(wrap(_batch_sink(path, "parquet"))), checkpoint, name, available_now, interval)


def stream_rejected_gps(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str | None = None,
    name: str | None = None, wrap=lambda store: store,
) -> StreamingQuery:
    """Rejected pings of a stream to JSON lines, as a query of its own: its failures do not
    hold up the valid pings."""
    rows = rejected_gps_columns(_at_hour(df, F.current_timestamp()))
    return start_query(rows.writeStream.foreachBatch(wrap(_batch_sink(path, "json"))), checkpoint, name, available_now, interval)


def _maintenance_columns(df: DataFrame) -> DataFrame:
    """Declared columns first, as text like the stored table; columns a log lacks are not made up."""
    declared = [c for c in MAINTENANCE_SILVER.fieldNames() if c in df.columns]
    extra = [c for c in df.columns if c not in declared]
    return df.select(*[F.col(c).cast("string").alias(c) for c in declared], *extra)


def write_silver_maintenance(valid: DataFrame, path: str, ingested: DataFrame | None = None) -> None:
    """Valid rows to Parquet, one partition per input file; a file read again replaces its own.

    ``ingested``, as ``ingest_summary`` gives it, names the files of this run. A file that no
    longer has a valid row has its old partition removed, which overwriting alone would leave.
    """
    (
        _maintenance_columns(valid).write.mode("overwrite").options(**_REPLACE_PARTITIONS)
        .option("compression", "snappy").partitionBy("source_file").parquet(path)
    )
    if ingested is not None:
        _drop_partitions(path, ingested.filter("valid = 0"))


def write_rejected_maintenance(rejected: DataFrame, path: str, ingested: DataFrame | None = None) -> None:
    """Rejected rows to JSON lines, replaced by input file like the valid ones."""
    rejected.write.mode("overwrite").options(**_REPLACE_PARTITIONS).partitionBy("source_file").json(path)
    if ingested is not None:
        _drop_partitions(path, ingested.filter("rejected = 0"))


# What Spark writes as % and two hexadecimal digits in a partition's folder name.
_ENCODED = "%\"#'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))


def partition_folder(path: str, column: str) -> Column:
    """The folder below ``path`` that holds the rows with this row's value of ``column``."""
    value = F.col(column)
    for character in _ENCODED:  # the percent sign comes first
        value = F.replace(value, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return F.concat(F.lit(f"{path}/{column}="), value)


def _drop_partitions(path: str, files: DataFrame) -> None:
    """Removes the partitions of ``files``, one row per input file, where they exist.

    The table is listed once; only partitions that are there and stale come back.
    """
    spark = files.sparkSession
    stored = [(f"{path}/{name}",) for name in child_names(spark, path)]
    stale = files.select(partition_folder(path, "source_file").alias("folder"))
    for row in spark.createDataFrame(stored, "folder string").join(stale, "folder").toLocalIterator():
        delete(spark, row["folder"])


def write_quality_metrics(metrics: DataFrame, path: str) -> None:
    """One run's metrics: JSON with nested maps, and Parquet with the maps as JSON text.

    ``metrics`` is one row, materialized here once so that the two files cannot differ. A run
    is a partition of its dataset and time: repeated, it replaces its own row.
    """
    spark = metrics.sparkSession
    row = spark.createDataFrame(metrics.collect(), metrics.schema)
    row = row.withColumn("run", F.date_format("run_timestamp", "'t'yyyyMMddHHmmssSSSSSS"))
    flat = row.withColumns({c: F.to_json(c) for c in ("completeness_pct", "out_of_range_pct")})
    for kind, rows in (("json", row), ("parquet", flat)):
        writer = rows.write.mode("overwrite").options(**_REPLACE_PARTITIONS).partitionBy("dataset", "run").format(kind)
        writer.save(f"{path}/{kind}")


def append_auto_maintenance(records: DataFrame, path: str, as_of=None) -> None:
    """The sweep's automatic records as one partition of the maintenance table.

    The partition is named after ``as_of``: other sweeps' records stay, and repeating a
    sweep that failed half-way replaces its own.
    """
    (
        _maintenance_columns(records.withColumn("source_file", sweep_name(as_of))).write.mode("overwrite")
        .options(**_REPLACE_PARTITIONS).option("compression", "snappy").partitionBy("source_file").parquet(path)
    )
