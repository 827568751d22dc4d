"""Incremental maintenance ingest: each new CSV file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetpulse.plans.jobs import ingest_frame, ingest_maintenance
from fleetpulse.sources.readers import CSV_OPTIONS, csv_cells, listed_path


def ingest_maintenance_stream(
    spark: SparkSession, path: str, schema: StructType | None, silver: str, rejected: str, checkpoint: str
) -> StreamingQuery:
    """Takes in the files that arrived under ``path`` since the last run, then stops.

    ``schema`` is the header's columns, all text, in file order; a file with others stops
    the query. With None each file is read by its own header, and one that lacks a required
    column is rejected alone. Writes are keyed by input file, so a batch repeated after a
    failure replaces its own rows.
    """
    if schema is None:
        def take(batch: DataFrame, _batch_id: int) -> None:
            names = [row["file"] for row in batch.distinct().toLocalIterator()]
            if names:
                ingest_maintenance(batch.sparkSession, names, silver, rejected)

        names = spark.readStream.text(path).filter("trim(value) <> ''").select(listed_path(F.col("_metadata.file_path")).alias("file"))
        return (
            names.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    files = spark.readStream.schema(schema).options(**CSV_OPTIONS).csv(path)

    def store(batch: DataFrame, _batch_id: int) -> None:
        ingest_frame(batch, silver, rejected)

    return (
        csv_cells(files).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
