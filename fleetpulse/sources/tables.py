"""Catalog tables over the stored files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from fleetpulse.constants import GPS_DATASET, MAINTENANCE_DATASET
from fleetpulse.sources.hours import MANIFEST, counting, folder
from fleetpulse.sources.schemas import PING_PARTITIONS
from fleetpulse.sources.storage import exists

_GPS = """
    equipo_id STRING, latitude DOUBLE, longitude DOUBLE, timestamp STRING, speed_kmh DOUBLE,
    heading DOUBLE, estado STRING, event_ts TIMESTAMP, other_fields VARIANT, year INT, month INT, day INT, hour INT,
    batch STRING
"""
_MAINTENANCE = """
    equipo_id STRING, fecha_mantenimiento STRING, tipo_falla STRING, criticidad STRING,
    descripcion STRING, tecnico STRING, estado STRING, source_file STRING
"""


def create_tables(spark: SparkSession, database: str, silver_path: str) -> None:
    """External tables over ``silver_path``; existing ones are kept. No data is moved."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{silver_path}/_{database}'")
    for name, columns, partitions in (
        (GPS_DATASET, _GPS, "year, month, day, hour, batch"),
        (MAINTENANCE_DATASET, _MAINTENANCE, "source_file"),
    ):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet "
            f"PARTITIONED BY ({partitions}) LOCATION '{silver_path}/{name}'"
        )
    refresh_tables(spark, database)


def refresh_tables(spark: SparkSession, database: str) -> None:
    """Registers partitions written since; run after loading new data or merging hours.

    Of a table with merged hours the folders that no longer count are taken out first, and the
    merged ones put in after that, so no row is there twice. That needs a metastore which keeps
    partitions; Spark's in-memory catalog lists all folders itself, so there a table is right
    once the replaced folders are removed (``read_silver`` is always).
    """
    for name in (GPS_DATASET, MAINTENANCE_DATASET):
        path = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").where("col_name = 'Location'").head()["data_type"]
        if not exists(spark, f"{path}/{MANIFEST}"):
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
            continue
        counted = {tuple(p[c] if c == "batch" else int(p[c]) for c in PING_PARTITIONS) for p in counting(spark, path)}
        known = set()
        for row in spark.sql(f"SHOW PARTITIONS {database}.{name}").toLocalIterator():
            parts = dict(x.split("=", 1) for x in row["partition"].split("/"))
            known.add(tuple(parts[c] if c == "batch" else int(parts[c]) for c in PING_PARTITIONS))
        for verb, keys in (("DROP IF EXISTS", known - counted), ("ADD IF NOT EXISTS", counted - known)):
            for key in sorted(keys):
                year, month, day, hour, batch = key
                where = f" LOCATION '{folder(path, '/'.join(map(str, key)))}'" if verb.startswith("ADD") else ""
                spark.sql(
                    f"ALTER TABLE {database}.{name} {verb} PARTITION (year={year}, month={month}, day={day}, hour={hour}, batch='{batch}'){where}"
                )
        spark.sql(f"REFRESH TABLE {database}.{name}")
