"""The scheduled jobs: maintenance ingest, silence sweep, quality run."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fleetpulse.constants import ALERT_MINUTES, GPS_DATASET, MAINTENANCE_DATASET, MAINTENANCE_MINUTES
from fleetpulse.operators.maintenance import (
    ingest_summary, missing_columns, normalize_maintenance, require_columns, with_maintenance_reasons,
)
from fleetpulse.operators.quality import DATASETS, dq_key_counts, dq_metrics, dq_metrics_of_states, dq_states
from fleetpulse.operators.signal import (
    alert_payload, auto_maintenance_records, signal_loss_alert, signal_loss_maintenance, signal_sweep_summary,
)
from fleetpulse.operators.relations import union_by_name
from fleetpulse.sources.batch_metrics import SWEEP, record_batch
from fleetpulse.sources.hours import PARTITION_SCHEMA, contents, folder_key
from fleetpulse.sources.last_seen import committed, read_last_seen
from fleetpulse.sources.readers import maintenance_layouts, read_auto_maintenance, read_maintenance_csv, read_silver
from fleetpulse.sources.schemas import GPS_SILVER, MAINTENANCE_SILVER, PING_PARTITIONS
from fleetpulse.sources.storage import checkpointed, write_small
from fleetpulse.sources.writers import (
    append_auto_maintenance, partition_folder, write_quality_metrics, write_rejected_maintenance, write_silver_maintenance,
)


def ingest_frames(layouts: Sequence[DataFrame], silver: str, rejected: str) -> DataFrame:
    """Cleans, validates and stores raw maintenance rows; returns the per-file summary.

    Each layout is judged by the columns it has. Rows of one without a required column are
    all rejected, with the columns' names; if no layout has them, nothing is taken in and
    ValueError says what is missing. The rows are parsed and judged once, into the shared
    folder, so that summary, valid and rejected rows agree even if a file changes meanwhile.
    The summary, one row per file, is kept: it tells which files lost all their valid or all
    their rejected rows, and as ``silver_key`` where a file's valid rows are stored.
    """
    fit = [df for df in layouts if not missing_columns(df)] or [require_columns(layouts[0])]
    judged = union_by_name([with_maintenance_reasons(normalize_maintenance(df)) for df in fit])
    unfit = [
        normalize_maintenance(df).withColumn("rejection_reason", F.lit(f"missing_columns:{','.join(missing_columns(df))}"))
        for df in layouts if missing_columns(df)
    ]
    checked = checkpointed(union_by_name([judged, *unfit]))
    bad = F.col("rejection_reason").isNotNull()
    summary = checkpointed(ingest_summary(checked).withColumn("silver_key", partition_folder(silver, "source_file")))
    write_silver_maintenance(checked.filter(~bad).select(*judged.columns).drop("rejection_reason"), silver, summary)
    write_rejected_maintenance(checked.filter(bad), rejected, summary)
    return summary


def ingest_frame(raw: DataFrame, silver: str, rejected: str) -> DataFrame:
    """As ``ingest_frames`` for rows of one layout."""
    return ingest_frames([raw], silver, rejected)


def ingest_maintenance(
    spark: SparkSession, path: str | list[str], silver: str, rejected: str, mixed_headers: bool = True
) -> DataFrame:
    """CSV files to the maintenance table and the rejected zone, each by its own header.

    ``mixed_headers=False`` saves the pass that finds the headers where all files share one.
    """
    layouts = maintenance_layouts(spark, path) if mixed_headers else [read_maintenance_csv(spark, path)]
    return ingest_frames(layouts, silver, rejected)


def signal_sweep(
    spark: SparkSession, state: str, silver_maintenance: str, as_of=None,
    alert_min: int = ALERT_MINUTES, maint_min: int = MAINTENANCE_MINUTES, skip_repeated: bool = True,
    metrics: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(alert, summary) of one sweep; opens maintenance records on the way.

    A sweep has one time, ``as_of`` or that of the call: alert, stored records, their key in
    the summary and all counts are of it. A sweep repeated at the same ``as_of`` replaces its
    own records and no others, so a device that became silent in between is added and none is
    lost. ``skip_repeated=False`` opens a record at every sweep for a device that stays silent.
    ``metrics`` names the table of ``batch_metrics`` in which to note the sweep, or its failure.
    """
    as_of, began = datetime.now(timezone.utc) if as_of is None else as_of, time.monotonic()
    try:
        out = _sweep(spark, state, silver_maintenance, as_of, alert_min, maint_min, skip_repeated)
    except Exception:
        if metrics:
            record_batch(spark, metrics, f"sweep-{uuid.uuid4().hex}", SWEEP, None, began, {}, 1)
        raise
    if metrics:
        record_batch(spark, metrics, f"sweep-{uuid.uuid4().hex}", SWEEP, None, began, {})
    return out


def _sweep(
    spark: SparkSession, state: str, silver_maintenance: str, as_of, alert_min: int, maint_min: int, skip_repeated: bool
) -> tuple[DataFrame, DataFrame]:
    seen = read_last_seen(spark, state)
    alerts = signal_loss_alert(seen, as_of, alert_min)
    lost = signal_loss_maintenance(seen, as_of, maint_min)
    existing = read_auto_maintenance(spark, silver_maintenance, as_of, other_sweeps=True) if skip_repeated else None
    append_auto_maintenance(auto_maintenance_records(lost, as_of, existing), silver_maintenance, as_of)
    return alert_payload(alerts, as_of, alert_min, maint_min), signal_sweep_summary(alerts, lost, as_of)


def dq_run(
    spark: SparkSession, silver: str, gold: str, datasets: list[str] | None = None, run_ts=None,
    schemas: dict[str, StructType] | None = None,
) -> list[dict]:
    """Metrics of each dataset's stored table, written to ``gold``; one entry per dataset.

    Unknown names are skipped; a dataset without rows is reported as ``no_data``. Tables are
    read with their declared schemas, or those in ``schemas``, without a pass over all footers.
    """
    schemas = {GPS_DATASET: GPS_SILVER, MAINTENANCE_DATASET: MAINTENANCE_SILVER, **(schemas or {})}
    results = []
    for dataset in datasets if datasets is not None else [GPS_DATASET, MAINTENANCE_DATASET]:
        if dataset not in DATASETS:
            continue
        table = read_silver(spark, f"{silver}/{dataset}", schemas.get(dataset))
        if not table.columns or table.isEmpty():
            results.append({"dataset": dataset, "status": "no_data"})
            continue
        metrics = dq_metrics(table, dataset, run_ts)
        row = metrics.head()
        write_quality_metrics(spark.createDataFrame([row], metrics.schema), gold)
        results.append({
            "dataset": dataset, "status": "ok", "total_rows": row["total_rows"],
            "valid_pct": row["valid_pct"], "duplicates_pct": row["duplicates_pct"],
        })
    return results


def dq_run_incremental(spark: SparkSession, table: str, gold: str, dataset: str = GPS_DATASET, schema: StructType = GPS_SILVER, run_ts=None) -> DataFrame:
    """One run's metrics of a table of hour folders, reading only folders that changed since the last.

    Counters are kept for each folder and add up. Keys are kept with their counts, by folder as
    well, so that duplicates across folders stay exact; a run reads all of these names, 16 bytes
    a key, but no row of a folder it knows. A folder that was merged away or written anew takes
    its counters and keys with it. The state of a run is one version, complete from its marker
    on; a run that died is repeated from the one before. Metrics are written as by ``dq_run``.
    """
    states = f"{gold}/states/{dataset}"
    versions = committed(spark, states)
    following = versions[-1] + 1 if versions else 0
    now = contents(spark, table)
    kept = lambda name: spark.read.parquet(*[f"{states}/v={v}/{name}" for v in versions]) if versions else None
    counters, keys = kept("counters"), kept("keys")
    known = {r["source"] for r in counters.select("source").distinct().toLocalIterator()} if versions else set()
    new = {key: source for key, source in now.items() if source not in known}
    rows = spark.read.schema(StructType([*schema.fields, *PARTITION_SCHEMA.fields])).parquet(table) if now else spark.createDataFrame([], StructType([*schema.fields, *PARTITION_SCHEMA.fields]))
    named = spark.createDataFrame(list(new.items()), "_folder string, source string")
    # The driver's own lists of folders are sent to the rows: a join by folder would put each folder into one task.
    changed = rows.where(folder_key().isin(list(new))).withColumn("_folder", folder_key()).join(F.broadcast(named), "_folder").drop("_folder", *PING_PARTITIONS)
    place = f"{states}/v={following}"
    dq_states(changed, dataset, "source").write.mode("overwrite").parquet(f"{place}/counters")
    dq_key_counts(changed, dataset, "source").write.mode("overwrite").parquet(f"{place}/keys")
    write_small(spark, f"{place}/_SUCCESS", "")
    versions = [*versions, following]
    live = F.broadcast(spark.createDataFrame([(s,) for s in now.values()], "source string"))
    counters, keys = (kept_all.join(live, "source", "left_semi") for kept_all in (
        spark.read.parquet(*[f"{states}/v={v}/{name}" for v in versions]) for name in ("counters", "keys")
    ))
    metrics = dq_metrics_of_states(counters, keys, dataset, run_ts)
    row = metrics.head()
    stored = spark.createDataFrame([row], metrics.schema)
    write_quality_metrics(stored, gold)
    return stored
