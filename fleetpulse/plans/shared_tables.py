"""The shared test tables seen as fleet data.

``events`` become GPS pings and ``orders`` a maintenance log. Remainders of the row ids put
faults of every kind into known rows, so each rule is met on whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2024-01-31 00:00:00"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _device(number: Column) -> Column:
    return F.format_string("CAM_%06d", number)


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One good ping per event, positions in and around the box."""
    e = _table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    lag = ((F.col("event_id") % 40) - 2) * F.lit(120_000_000)
    return e.select(
        "event_id",
        _device(F.col("user_id")).alias("equipo_id"),
        (F.lit(-10.9) + ((F.col("event_id") * 7) % 341) / F.lit(100.0)).alias("latitude"),
        (F.lit(-78.9) + ((F.col("event_id") * 13) % 281) / F.lit(100.0)).alias("longitude"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        F.when(F.col("event_id") % 29 != 0, F.col("value")).alias("speed_kmh"),
        F.col("event_type").alias("estado"),
        ts.alias("event_ts"),
        F.timestamp_micros(F.unix_micros(ts) + lag).alias("arrival_ts"),
    )


def faulty_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings with devices missing, unreadable times, and replayed copies."""
    good = pings(spark, sf_dir).drop("event_ts")
    ids = F.col("event_id")
    broken = good.withColumns({
        "equipo_id": F.when(ids % 50 != 7, F.col("equipo_id")),
        "timestamp": F.when(ids % 61 == 5, "not-a-date").otherwise(F.col("timestamp")),
    })
    # copy 1 is a replay of the same message
    copies = F.when(ids % 20 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return broken.withColumn("copy", F.explode(copies))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty pings as JSON messages in the device's spelling; NULLs are absent keys.

    Pings are dealt over tasks before their text is made: the table may be a single row group.
    """
    body = F.to_json(F.struct(
        "equipo_id", "timestamp",
        F.col("latitude").alias("latitud"), F.col("longitude").alias("longitud"),
        F.col("speed_kmh").alias("velocidad"), "estado",
    ))
    dealt = faulty_pings(spark, sf_dir).repartition("event_id")
    return dealt.select("event_id", "copy", "arrival_ts", body.alias("body"))


def rich_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages with further fields: numbers, objects, booleans, nulls, a key twice, a second spelling."""
    ids = F.col("event_id")
    more = F.concat(
        F.when(ids % 11 == 0, ',"speed_kmh":1.5').otherwise(""),
        F.when(ids % 3 != 0, F.concat(F.lit(',"heading":'), (ids % 360).cast("string"), F.lit(".5"))).otherwise(""),
        F.when(ids % 4 == 0, F.concat(F.lit(', "fuel" : {"level":'), (ids % 100).cast("string"), F.lit(',"unit":"%"}'))).otherwise(""),
        F.when(ids % 5 == 0, ',"engine_on":true').otherwise(""),
        F.when(ids % 7 == 0, ',"driver":null').otherwise(""),
        F.when(ids % 9 == 1, ',"heading":"N: up"').otherwise(""),
    )
    closed = F.expr("substring(body, 1, length(body) - 1)")
    return messages(spark, sf_dir).withColumn("body", F.concat(closed, more, F.lit("}")))


def envelopes(spark: SparkSession, sf_dir: str, bodies=messages) -> DataFrame:
    """Messages as transported: queue messages and base64 stream records in turn."""
    queued = F.to_json(F.struct(
        "body",
        F.struct(F.unix_millis("arrival_ts").cast("string").alias("SentTimestamp")).alias("attributes"),
    ))
    streamed = F.to_json(F.struct(F.struct(
        F.base64(F.col("body").cast("binary")).alias("data"),
        (F.unix_millis("arrival_ts") / F.lit(1000.0)).alias("approximateArrivalTimestamp"),
    ).alias("kinesis")))
    return bodies(spark, sf_dir).select(F.when(F.col("event_id") % 2 == 0, queued).otherwise(streamed).alias("value"))


def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean maintenance table; one fault per order."""
    o = _table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return o.select(
        key.alias("order_id"),
        _device(F.col("o_custkey")).alias("equipo_id"),
        F.col("o_orderdate").cast("date").alias("fecha_mantenimiento"),
        F.col("o_orderpriority").alias("tipo_falla"),
        # nested, so that a filter on the result folds back to a filter on the stored column
        F.when(status == "F", "ALTA").otherwise(F.when(status == "O", "MEDIA").otherwise("BAJA")).alias("criticidad"),
        F.when(key % 4 == 0, "RESUELTO").when(key % 4 != 1, "PENDIENTE").alias("estado"),
    )


def mixed_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table with some rows raised by the silence sweep."""
    return maintenance(spark, sf_dir).withColumn(
        "tipo_falla",
        F.when(F.col("order_id") % 11 == 0, "GPS DESCONECTADO (45 min sin señal)")
        .when(F.col("order_id") % 13 != 0, F.col("tipo_falla")),
    )


def raw_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as people typed it: layouts mixed, values missing or wrong."""
    o = _table(spark, sf_dir, "orders")
    key, status, day = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    return o.select(
        key.alias("order_id"),
        F.when(key % 53 == 1, " nan ")
        .when(key % 53 != 0, F.format_string(" cam_%06d ", F.col("o_custkey"))).alias("equipo_id"),
        F.when(key % 41 == 0, "not-a-date")
        .when(key % 3 == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 3 == 1, F.date_format(day, "yyyyMMdd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("fecha"),
        F.col("o_orderpriority").alias("tipo_falla"),
        F.when(key % 37 == 0, "urgente").when(status == "F", "alta").when(status == "O", " Media ")
        .otherwise("BAJA").alias("criticidad"),
        F.concat(F.lit("mant_"), (key % 7).cast("string"), F.lit(".csv")).alias("source_file"),
    )


def device_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last-seen state as text, some of it missing or unreadable."""
    last = _table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.col("ts").cast("timestamp")).alias("seen"))
    text = F.date_format("seen", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return last.select(
        _device(F.col("user_id")).alias("equipo_id"),
        F.when(F.col("user_id") % 41 == 0, "sin dato").when(F.col("user_id") % 37 != 0, text).alias("last_seen"),
    )
