"""Hour partitions of the ping tables: which to read, and merging those of closed hours.

Micro-batches leave a folder each below their hour. ``merge_hours`` rewrites the folders of an
hour into one. What a reader sees is decided by a manifest entry, a single file that appears at
once: before it the merged folder does not count, from then on the folders it replaces do not.
These stay on disk until no reader that was planned before can still need them.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from fleetpulse.constants import FUTURE_GRACE_SECONDS, MAX_AGE_SECONDS
from fleetpulse.functions.moments import before, moment
from fleetpulse.sources.schemas import HOUR_PARTITIONS, PING_PARTITIONS
from fleetpulse.sources.storage import child_names, delete, exists, matching, matching_since, modified_ms, read_small, write_small

MANIFEST = "_merged"
MERGED = "merged-"
KEEP_SECONDS = 86_400
# Given with the schema, so that a folder name of digits is not taken for a number.
PARTITION_SCHEMA = StructType([*(StructField(c, IntegerType()) for c in HOUR_PARTITIONS), StructField("batch", StringType())])


def written_at() -> Column:
    """The start of the hour in which a row was stored, from its partition columns alone."""
    return F.make_timestamp(*[F.col(c).cast("int") for c in HOUR_PARTITIONS], F.lit(0), F.lit(0), F.lit("UTC"))


def hours_of(since=None, until=None, lag_seconds: float | None = None, grace: int = FUTURE_GRACE_SECONDS, max_age: int = MAX_AGE_SECONDS) -> Column:
    """Predicate on partition columns: the hours that can hold valid pings of an event-time range.

    A valid ping arrives at most ``grace`` before and ``max_age`` after its own time, and is stored
    after that: so nothing from ``since`` on lies in an hour that ended earlier than ``grace``
    before it. How long storing may take has no bound of itself; ``until`` only cuts hours if
    ``lag_seconds`` gives one. Holds for tables stored under the time of writing or arrival.
    """
    out = F.lit(True)
    if since is not None:
        out = out & (written_at() >= F.date_trunc("hour", before(moment(since), seconds=grace)))
    if until is not None and lag_seconds is not None:
        out = out & (written_at() <= before(moment(until), seconds=-(max_age + lag_seconds)))
    return out


def _key(parts: dict) -> str:
    return "/".join([*(str(int(parts[c])) for c in HOUR_PARTITIONS), parts["batch"]])


def _entries(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Committed merges, each with the folders (as keys) that it replaces and that are still there."""
    manifest = f"{path}/{MANIFEST}"
    files = set(child_names(spark, manifest))
    names = [n[: -len(".json")] for n in files if n.endswith(".json")]
    return {n: [] if f"{n}.purged" in files else json.loads(read_small(spark, f"{manifest}/{n}.json")) for n in names}


def visible(spark: SparkSession, path: str) -> Column:
    """Predicate on partition columns: folders that count.

    Its size is that of the manifest: one name a merge, and the folders replaced of late.
    """
    entries = _entries(spark, path)
    merged = F.startswith("batch", F.lit(MERGED))
    if not entries:
        return ~merged
    key = folder_key()
    counts = F.col("batch").isin(list(entries)) | ~merged
    replaced = [k for keys in entries.values() for k in keys]
    return counts & ~key.isin(replaced) if replaced else counts


def folders(spark: SparkSession, path: str) -> list[dict]:
    """The partition values of every folder below ``path``: its layout, not its files."""
    layout = "/".join(f"{c}=*" for c in PING_PARTITIONS)
    return [dict(part.split("=", 1) for part in found.split("/")) for found in matching(spark, path, layout)]


def counting(spark: SparkSession, path: str) -> list[dict]:
    """Of the folders those that count."""
    entries = _entries(spark, path)
    hidden = {k for keys in entries.values() for k in keys}
    return [
        p for p in folders(spark, path)
        if (not p["batch"].startswith(MERGED) or p["batch"] in entries) and _key(p) not in hidden
    ]


def contents(spark: SparkSession, path: str) -> dict[str, str]:
    """Of the folders that count, key -> key and time of the last change: what a state is made from."""
    layout = "/".join(f"{c}=*" for c in PING_PARTITIONS)
    changed = {_key(dict(x.split("=", 1) for x in k.split("/"))): t for k, t in matching_since(spark, path, layout).items()}
    return {k: f"{k}@{changed[k]}" for k in map(_key, counting(spark, path)) if k in changed}


def folder_key() -> Column:
    """The key of the folder that a row lies in."""
    return F.concat_ws("/", *[F.col(c).cast("int").cast("string") for c in HOUR_PARTITIONS], "batch")


def folder(path: str, key: str) -> str:
    year, month, day, hour, batch = key.split("/", 4)
    return f"{path}/year={year}/month={int(month):02d}/day={int(day):02d}/hour={int(hour):02d}/batch={batch}"


def merge_hours(
    spark: SparkSession, path: str, schema: StructType, closed_before: datetime, kind: str = "parquet",
    rows_per_file: int = 2_000_000, keep_seconds: float = KEEP_SECONDS,
) -> int:
    """Merges the folders of each hour that ended by ``closed_before`` (UTC); returns how many hours.

    Rows are read and written by Spark, an hour in as many files as its rows need. A folder
    that comes later, from a micro-batch repeated long after, counts beside the merged one and
    is taken in by the next merge. Folders replaced more than ``keep_seconds`` ago are removed,
    as are merges that died before their entry. One merge at a time.
    """
    _purge(spark, path, keep_seconds)
    limit, hours = closed_before.strftime("%Y%m%d%H"), {}
    for parts in counting(spark, path):
        if "".join(parts[c].zfill(2) for c in HOUR_PARTITIONS) < limit:
            key = _key(parts)
            hours.setdefault(key.rsplit("/", 1)[0], []).append(key)
    crowded = {h: keys for h, keys in hours.items() if len(keys) > 1}
    if not crowded:
        return 0
    name = f"{MERGED}{uuid.uuid4().hex}"
    hour = F.concat_ws("/", *[F.col(c).cast("string") for c in HOUR_PARTITIONS])
    rows = spark.read.schema(StructType([*schema.fields, *PARTITION_SCHEMA.fields])).format(kind).load(path)
    rows = rows.where(hour.isin(list(crowded)) & visible(spark, path))
    # An hour is dealt over several tasks, a number that follows from its rows. Each sorts its own, 300 bytes a row.
    sizes = rows.groupBy(*HOUR_PARTITIONS).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    dealt = rows.join(sizes, HOUR_PARTITIONS).withColumn("_file", F.pmod(F.xxhash64("equipo_id", "timestamp"), F.col("_files")))
    stored = dealt.repartition(*HOUR_PARTITIONS, "_file").drop("_files", "_file").withColumn("batch", F.lit(name))
    padded = {c: F.lpad(F.col(c).cast("string"), 4 if c == "year" else 2, "0") for c in HOUR_PARTITIONS}
    (
        stored.withColumns(padded).write.mode("append").option("maxRecordsPerFile", 2 * rows_per_file)
        .partitionBy(*PING_PARTITIONS).format(kind).save(path)
    )
    write_small(spark, f"{path}/{MANIFEST}/{name}.json", json.dumps([k for keys in crowded.values() for k in keys]))
    return len(crowded)


def _purge(spark: SparkSession, path: str, keep_seconds: float) -> None:
    """Removes replaced folders, and merges without an entry, once they are old enough."""
    limit = 1000 * (time.time() - keep_seconds)
    entries = _entries(spark, path)
    for name, keys in entries.items():
        entry = f"{path}/{MANIFEST}/{name}"
        if keys and modified_ms(spark, f"{entry}.json") < limit:
            for key in keys:
                delete(spark, folder(path, key))
            write_small(spark, f"{entry}.purged", "")
    for parts in folders(spark, path):
        place = folder(path, _key(parts))
        if parts["batch"].startswith(MERGED) and parts["batch"] not in entries and modified_ms(spark, place) < limit:
            delete(spark, place)


def read_hours(spark: SparkSession, path: str, schema: StructType, since=None, until=None, lag_seconds: float | None = None) -> DataFrame:
    """Stored pings with event times from ``since`` to ``until``, reading only hours that can hold them."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, *PARTITION_SCHEMA.fields])).parquet(path)
    rows = rows.where(visible(spark, path) & hours_of(since, until, lag_seconds)).drop(*PING_PARTITIONS)
    if since is not None:
        rows = rows.where(F.col("event_ts") >= moment(since))
    return rows.where(F.col("event_ts") <= moment(until)) if until is not None else rows
