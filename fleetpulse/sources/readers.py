"""Reading what the pipeline takes in and what it has stored."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, VariantType

from fleetpulse.constants import AUTO_SOURCE, CSV_NULL_TOKENS
from fleetpulse.functions.moments import moment
from fleetpulse.functions.rounding import round_half_even
from fleetpulse.operators.relations import union_by_name
from fleetpulse.operators.signal import sweep_name
from fleetpulse.operators.telemetry import unwrap_envelope
from fleetpulse.sources.hours import MANIFEST, PARTITION_SCHEMA, read_hours, visible
from fleetpulse.sources.schemas import GPS_REJECTED, GPS_SILVER, MAINTENANCE_SILVER, PING_PARTITIONS, QUALITY_RUN
from fleetpulse.sources.storage import exists

CSV_OPTIONS = {
    "header": True,
    # Columns are taken by position from one header, so a file with another header must fail.
    "enforceSchema": False,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_telemetry_stream(
    spark: SparkSession, path: str, max_files: int | None = None, arrival: str = "processing"
) -> DataFrame:
    """Streaming ``(body, arrival_ts)`` of a folder of message files, one record per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return unwrap_envelope(reader.load(path), arrival=arrival)


def read_telemetry(spark: SparkSession, path: str, arrival: str = "processing") -> DataFrame:
    """The same folder as a bounded table, for backfills."""
    return unwrap_envelope(spark.read.text(path), arrival=arrival)


def listed_path(file: Column) -> Column:
    """A path to read from the encoded one in a row's metadata; a plus sign stands for itself."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def csv_cells(df: DataFrame) -> DataFrame:
    """Missing-value words to NULL, and the file each row came from."""
    cells = [F.when(~F.col(f"`{c}`").isin(CSV_NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns if c != "source_file"]
    return df.select(*cells, F.col("_metadata.file_path").alias("source_file"))


def read_maintenance_csv(spark: SparkSession, path: str | list[str], mixed_headers: bool = False) -> DataFrame:
    """CSV files with a header, all columns as text, plus ``source_file``.

    All files must share one header; the read fails on a file that does not, rather than
    put its values into the wrong columns. ``mixed_headers=True`` takes files of different
    layouts: one light pass over the text finds each file's header, and the files are read
    layout by layout and stacked by name.
    """
    if not mixed_headers:
        return csv_cells(spark.read.options(**CSV_OPTIONS).csv(path))
    return union_by_name(maintenance_layouts(spark, path))


def maintenance_layouts(spark: SparkSession, path: str | list[str]) -> list[DataFrame]:
    """The CSV files as one frame per header that occurs among them."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("position"),
    )
    headers = (
        lines.filter((F.col("start") == 0) & (F.trim("value") != ""))
        .groupBy("file")
        .agg(F.min_by("value", "position").alias("header"))
    )
    # One row per layout, with the names of its files, which the driver's listing holds anyway.
    layouts = headers.groupBy("header").agg(F.sort_array(F.collect_list(listed_path(F.col("file")))).alias("files")).orderBy("header")
    frames = [csv_cells(spark.read.options(**CSV_OPTIONS).csv(row["files"])) for row in layouts.toLocalIterator()]
    if not frames:
        raise ValueError(f"no CSV header found under {path}")
    return frames


def read_silver(spark: SparkSession, path: str, schema: StructType | None = None, since=None, until=None, lag_seconds: float | None = None) -> DataFrame:
    """All Parquet files under ``path`` by column name; an empty frame if there are none.

    With ``schema`` no footer is read to plan the scan, and columns a file lacks are NULL.
    Without it the schemas of all files are merged. Partition columns are dropped: they
    describe where a row is stored, not the row. Of a table of pings with merged hours each
    row is read once.

    ``since`` and ``until`` limit a table of pings by event time; of its hours only those are
    listed for reading that can hold such pings (``hours.hours_of``).
    """
    if since is not None or until is not None:
        return read_hours(spark, path, schema or GPS_SILVER, since, until, lag_seconds)
    if not exists(spark, path):
        return spark.createDataFrame([], schema or StructType([]))
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    try:
        df = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], StructType([]))
    if set(PING_PARTITIONS) <= set(df.columns):
        df = df.where(visible(spark, path))
    return df.drop(*PING_PARTITIONS, "source_file")


def read_auto_maintenance(spark: SparkSession, path: str, as_of=None, other_sweeps: bool = False) -> DataFrame:
    """The automatic records opened on the day of ``as_of``; only their partitions are read.

    ``other_sweeps`` leaves out those of the sweep at ``as_of`` itself.
    """
    stored = StructType(MAINTENANCE_SILVER.fields).add("source_file", "string")
    if not exists(spark, path):
        return spark.createDataFrame([], MAINTENANCE_SILVER)
    today = F.concat(F.lit(AUTO_SOURCE), F.date_format(moment(as_of), "yyyyMMdd"))
    rows = spark.read.schema(stored).parquet(path)
    rows = rows.filter(F.startswith("source_file", today))
    return (rows.filter(F.col("source_file") != sweep_name(as_of)) if other_sweeps else rows).drop("source_file")


def read_quality_history(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """One row per quality run of ``dataset``, oldest first; absent numbers are 0, absent maps empty."""
    folder = f"{path}/json/dataset={dataset}"
    empty = F.create_map().cast("map<string,double>")
    if not exists(spark, folder):
        runs = spark.createDataFrame([], QUALITY_RUN)
    else:
        runs = spark.read.schema(QUALITY_RUN).json(folder)
    count = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("total_rows", "pandera_failures")}
    share = {c: round_half_even(F.coalesce(F.col(c), F.lit(0.0)), 1) for c in ("valid_pct", "duplicates_pct")}
    maps = {c: F.coalesce(F.col(c), empty) for c in ("completeness_pct", "out_of_range_pct")}
    return (
        runs.withColumn("dataset", F.lit(dataset))
        .withColumns({**count, **share, **maps})
        .select("dataset", "run_timestamp", *count, *share, *maps)
        .orderBy("run_timestamp")
    )


def read_rejected(spark: SparkSession, path: str, schema: StructType = GPS_REJECTED) -> DataFrame:
    """Rejected records with the file they are in and its modification time."""
    if not exists(spark, path):
        found = spark.createDataFrame([], schema)
        return found.withColumns({"file": F.lit(None).cast("string"), "modified": F.lit(None).cast("timestamp")})
    rows = spark.read.schema(StructType([*schema.fields, *PARTITION_SCHEMA.fields])).json(path) if exists(spark, f"{path}/{MANIFEST}") else None
    rows = spark.read.schema(schema).json(path) if rows is None else rows.where(visible(spark, path))
    return rows.select(
        *schema.fieldNames(),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def rejected_sample(spark: SparkSession, path: str, n: int = 5, schema: StructType = GPS_REJECTED) -> DataFrame:
    """The first ``n`` records, by their columns, of the newest rejected file.

    The newest file is found from the listing alone; only that one file is then read.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
        .filter(F.col("length") > 0)
    )
    newest = files.agg(F.max(F.struct("modificationTime", "path")).alias("newest")).head()["newest"]
    if newest is None:
        return spark.createDataFrame([], schema)
    sortable = [f.name for f in schema if not isinstance(f.dataType, VariantType)]
    return spark.read.schema(schema).json(newest["path"]).orderBy(*sortable).limit(n)
