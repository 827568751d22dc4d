"""One explicit schema per stored table."""

from pyspark.sql import types as T

HOUR_PARTITIONS = ["year", "month", "day", "hour"]
PING_PARTITIONS = [*HOUR_PARTITIONS, "batch"]

GPS_SILVER = T.StructType([
    T.StructField("equipo_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("estado", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    # What a message holds beyond its declared fields.
    T.StructField("other_fields", T.VariantType()),
])

GPS_REJECTED = T.StructType([
    T.StructField("equipo_id", T.StringType()),
    T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("speed_kmh", T.StringType()),
    T.StructField("estado", T.StringType()),
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("rejection_reason", T.StringType()),
    T.StructField("_raw", T.StringType()),
    T.StructField("other_fields", T.VariantType()),
])

MAINTENANCE_SILVER = T.StructType([
    T.StructField("equipo_id", T.StringType()),
    T.StructField("fecha_mantenimiento", T.StringType()),
    T.StructField("tipo_falla", T.StringType()),
    T.StructField("criticidad", T.StringType()),
    T.StructField("descripcion", T.StringType()),
    T.StructField("tecnico", T.StringType()),
    T.StructField("estado", T.StringType()),
])

MAINTENANCE_REJECTED = T.StructType([
    T.StructField("equipo_id", T.StringType()),
    T.StructField("fecha_mantenimiento", T.StringType()),
    T.StructField("tipo_falla", T.StringType()),
    T.StructField("criticidad", T.StringType()),
    T.StructField("rejection_reason", T.StringType()),
])

LAST_SEEN = T.StructType([
    T.StructField("equipo_id", T.StringType()),
    T.StructField("last_seen", T.TimestampType()),
])

QUALITY_RUN = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("run_timestamp", T.TimestampType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("valid_rows", T.LongType()),
    T.StructField("rejected_rows", T.LongType()),
    T.StructField("valid_pct", T.DoubleType()),
    T.StructField("duplicates_count", T.LongType()),
    T.StructField("duplicates_pct", T.DoubleType()),
    T.StructField("completeness_pct", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("out_of_range_pct", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("pandera_failures", T.LongType()),
])

BATCH_METRICS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("taken_at", T.TimestampType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("oldest_age_seconds", T.DoubleType()),
    T.StructField("rejected", T.MapType(T.StringType(), T.LongType())),
])

SESSIONS = T.StructType([
    T.StructField("equipo_id", T.StringType()),
    T.StructField("first", T.LongType()),
    T.StructField("last", T.LongType()),
    T.StructField("pings", T.LongType()),
])

LOSS_CHANGES = T.StructType([
    T.StructField("equipo_id", T.StringType()),
    T.StructField("first_ping", T.TimestampType()),
    T.StructField("last_ping", T.TimestampType()),
    T.StructField("lost_at", T.TimestampType()),
    T.StructField("pings", T.LongType()),
    T.StructField("state", T.StringType()),
])
