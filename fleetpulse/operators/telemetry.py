"""GPS pings: decoding, renaming, validation, routing, de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetpulse.constants import (
    DEDUP_KEYS_GPS,
    FUTURE_GRACE_SECONDS,
    GPS_RENAMES,
    GPS_REQUIRED,
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    MAX_AGE_SECONDS,
)
from fleetpulse.functions.binding import let
from fleetpulse.functions.iso_time import iso_text, iso_timestamp
from fleetpulse.functions.json_values import describe_values, json_text, number_text
from fleetpulse.operators.relations import evaluate_once

REASON = "rejection_reason"
OTHER_FIELDS = "other_fields"  # VARIANT of the message fields that nothing declares
# What decode_payload found out about a record that is not plainly well formed.
EVIDENCE = ["_decode_error", "_missing", "_latitude_text", "_longitude_text", "_timestamp_text"]
_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNumericLeadingZeros": "false"}
_DATED = r"^\d{4}-\d{2}-\d{2}"


# --- decoding -------------------------------------------------------------------

def unwrap_envelope(df: DataFrame, value: str = "value", arrival: str = "processing") -> DataFrame:
    """Transport records to ``(body, arrival_ts)``.

    A record is the event itself, a queue message with a ``body``, or a stream record with a
    base64 ``kinesis.data``. ``arrival="processing"`` stamps the time of the batch, which is
    what validation in real time needs; ``"transport"`` uses the sending time that the
    transport recorded, so that a backlog is judged as it would have been then.
    """
    schema = (
        "kinesis struct<data:string,approximateArrivalTimestamp:double>, body string, "
        "attributes struct<SentTimestamp:string>"
    )
    enveloped = F.col(value).contains('"kinesis"') | F.col(value).contains('"body"')
    df = evaluate_once(df, "_envelope", F.when(enveloped, F.from_json(value, schema)))
    envelope = F.col("_envelope")
    body = (
        F.when(envelope["kinesis"].isNotNull(), F.try_to_binary(envelope["kinesis"]["data"], F.lit("base64")).cast("string"))
        .when(envelope["body"].isNotNull(), envelope["body"])
        .otherwise(F.col(value))
    )
    sent = F.coalesce(
        F.timestamp_millis(envelope["attributes"]["SentTimestamp"].try_cast("bigint")),
        F.timestamp_micros(
            F.round(envelope["kinesis"]["approximateArrivalTimestamp"] * F.lit(1e6)).cast("bigint")
        ),
    )
    if arrival == "processing":
        arrived = F.current_timestamp()
    elif arrival == "transport":
        arrived = F.coalesce(sent, F.current_timestamp())
    else:
        raise ValueError(f"arrival must be 'processing' or 'transport', not {arrival!r}")
    return df.select(
        *[c for c in df.columns if c not in (value, "_envelope")],
        body.alias("body"),
        arrived.alias("arrival_ts"),
    )


def decode_payload(
    df: DataFrame, body: str = "body", passthrough: Mapping[str, str] | None = None
) -> DataFrame:
    """JSON text to device fields, by both spellings, ``event_ts``, the evidence columns, and
    ``other_fields``: a VARIANT object of all fields that are not declared, NULL without any.

    ``passthrough`` names further message fields to keep as columns, with their types.

    Most records are well formed, so they are parsed once, straight into typed fields. Only
    records for which that cannot settle the outcome (a field absent, null or of another
    type, a whole number out of range, or both spellings at once) are parsed again, each value
    keeping its JSON type, to tell an absent key from a null and a number from text.

    The text is parsed inside brackets: anything after the closing brace then makes it
    malformed instead of being ignored.

    A well-formed record whose colons are all accounted for, one to each field read and
    those inside the texts read, has no other field. Only the others are parsed into keys and
    values. Of a key that occurs twice the last value counts.
    """
    passthrough = {"estado": "string", **(passthrough or {})}
    spellings = list(GPS_RENAMES) + list(GPS_RENAMES.values())
    typed = ", ".join(
        ["equipo_id:string", "timestamp:string"]
        + [f"{name}:double" for name in spellings]
        + [f"{name}:{kind}" for name, kind in passthrough.items()]
    )
    untyped = ", ".join(
        f"{name}:variant" for name in ["equipo_id", "timestamp", *spellings, *passthrough]
    )
    text = F.concat(F.lit("["), F.col(body), F.lit("]"))

    df = evaluate_once(df, "_typed", F.from_json(text, f"array<struct<{typed}>>", _JSON_OPTIONS))
    df = df.select("*", F.get("_typed", F.lit(0)).alias("_first"))
    first = F.col("_first")

    def clear(es: str, en: str, bounds: tuple[float, float]) -> Column:
        """A number whose spelling, if it is to be reported, is that of the double: 20.5, not 20."""
        value = F.coalesce(first[es], first[en])
        return value.between(*bounds) | (value != F.rint(value))

    # No two of these spellings in one record, and no key hidden by an escape.
    single = [~(F.col(body).contains(f'"{en}"') & F.col(body).contains(f'"{es}"')) for es, en in GPS_RENAMES.items()]
    settled = (
        (F.size("_typed") == 1)
        & first["equipo_id"].isNotNull()
        & clear("latitud", "latitude", LATITUDE_RANGE)
        & clear("longitud", "longitude", LONGITUDE_RANGE)
        & first["timestamp"].rlike(_DATED)
        & single[0] & single[1] & single[2]
        & ~F.col(body).contains("\\u")
    )
    texts = [first[name] for name in ("equipo_id", "timestamp", *(n for n, kind in passthrough.items() if kind == "string"))]
    present = [F.when(first[name].isNotNull(), 1).otherwise(0) for name in dict.fromkeys(["equipo_id", "timestamp", *spellings, *passthrough])]
    accounted = reduce(Column.__add__, [*present, *(F.coalesce(_colons(text), F.lit(0)) for text in texts)])
    # Settled in a projection of its own, compiled, so that the next step only tests a flag.
    df = df.withColumn("_settled", F.coalesce(settled, F.lit(False))).withColumns({
        "_event_ts": F.when(F.col("_settled"), iso_timestamp(first["timestamp"])),
        "_more": ~F.col("_settled") | (_colons(F.col(body)) > accounted),
    })
    settled = F.col("_settled")
    exact = let(
        F.from_json(text, f"array<struct<{untyped}>>", _JSON_OPTIONS),
        lambda a: F.when(F.size(a) == 1, _exact_fields(F.get(a, F.lit(0)), body, passthrough)),
    )
    declared = ["equipo_id", "timestamp", *spellings, *passthrough]
    others = let(
        F.from_json(text, "array<map<string,variant>>", _JSON_OPTIONS),
        lambda a: F.when(F.size(a) == 1, let(F.map_filter(F.get(a, F.lit(0)), lambda key, _value: ~key.isin(declared)), _as_object)),
    )
    slow = F.struct(F.when(~settled, exact).alias("exact"), others.alias("others"))
    df = evaluate_once(df, "_slow", F.when(F.col("_more"), slow))
    exact = F.col("_slow.exact")

    def pick(name: str, parsed: Column) -> Column:
        return F.when(settled, parsed).otherwise(exact[name]).alias(name)

    def number(en: str, es: str) -> Column:
        return F.nanvl(F.coalesce(first[es], first[en]), F.lit(None).cast("double"))

    kept = [c for c in df.columns if not c.startswith("_")]
    return df.select(
        *kept,
        pick("equipo_id", first["equipo_id"]),
        pick("timestamp", first["timestamp"]),
        *[pick(en, number(en, es)) for es, en in GPS_RENAMES.items()],
        *[pick(name, first[name]) for name in passthrough],
        pick("event_ts", F.col("_event_ts")),
        F.col("_slow.others").alias(OTHER_FIELDS),
        F.when(~settled & exact.isNull(), "not_a_json_object").alias("_decode_error"),
        *[exact[name].alias(name) for name in EVIDENCE if name != "_decode_error"],
    )


def _colons(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(":"), F.lit("")))


def _as_object(fields: Column) -> Column:
    """A VARIANT object of a map of parsed values, NULL if it is empty."""
    keys, values = F.map_keys(fields), F.map_values(fields)
    places = F.sequence(F.lit(0), F.size(keys) - 1)
    last = F.filter(places, lambda i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), F.get(keys, i)))
    once = F.map_from_arrays(F.transform(last, lambda i: F.get(keys, i)), F.transform(last, lambda i: F.get(values, i)))
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(F.size(fields) > 0, F.to_variant_object(F.when(repeated, once).otherwise(fields)))


def _exact_fields(record: Column, body: str, passthrough: Mapping[str, str]) -> Column:
    """Fields and evidence of a record whose values kept their JSON types; NULL if it is none."""
    keys = F.json_object_keys(body)

    def chosen(es: str, en: str) -> Column:
        """When both spellings of a field occur, the later key of the object wins."""
        later = F.array_position(keys, en) > F.array_position(keys, es)
        return (
            F.when(record[es].isNull(), record[en])
            .when(record[en].isNull(), record[es])
            .otherwise(F.when(later, record[en]).otherwise(record[es]))
        )

    named = [*GPS_RENAMES.values(), "timestamp"]
    values = describe_values(F.array(*[chosen(es, en) for es, en in GPS_RENAMES.items()], record["timestamp"]))

    def fields(v: Column) -> Column:
        of = {name: F.get(v, F.lit(position)) for position, name in enumerate(named)}
        gone = {name: of[name]["absent"] for name in ("latitude", "longitude", "timestamp")}
        gone["equipo_id"] = record["equipo_id"].isNull()
        names = F.array_compact(F.array(*[F.when(gone[name], F.lit(name)) for name in sorted(GPS_REQUIRED)]))
        timestamp = json_text(record["timestamp"])
        return F.struct(
            F.try_variant_get(record["equipo_id"], "$", "string").alias("equipo_id"),
            timestamp.alias("timestamp"),
            let(timestamp, iso_timestamp).alias("event_ts"),
            *[of[en]["number"].alias(en) for en in GPS_RENAMES.values()],
            *[F.try_variant_get(record[name], "$", kind).alias(name) for name, kind in passthrough.items()],
            F.nullif(F.array_join(names, ","), F.lit("")).alias("_missing"),
            of["latitude"]["text"].alias("_latitude_text"),
            of["longitude"]["text"].alias("_longitude_text"),
            of["timestamp"]["text"].alias("_timestamp_text"),
        )

    return F.when(record.isNotNull(), let(values, fields))


def normalize_gps_fields(df: DataFrame) -> DataFrame:
    """Device spellings to internal ones on an already tabular frame.

    Where a frame has both spellings, the one further right wins, row by row if it is set.
    """
    order = {name: position for position, name in enumerate(df.columns)}
    for es, en in GPS_RENAMES.items():
        if es not in order:
            continue
        if en in order:
            last, other = (en, es) if order[en] > order[es] else (es, en)
            df = df.withColumn(en, F.coalesce(F.col(last), F.col(other))).drop(es)
        else:
            df = df.withColumnRenamed(es, en)
    return df


# --- validation rules: NULL when the record passes, else "code:detail" --------------

def rule_missing_fields(missing: Column) -> Column:
    """``missing`` lists the absent required keys, or is NULL."""
    return F.when(missing.isNotNull(), F.concat(F.lit("missing_fields:"), missing))


def _outside(value: Column, bounds: tuple[float, float]) -> Column:
    return ~F.coalesce(value.between(*bounds), F.lit(False))


def rule_lat_bbox(latitude: Column, detail: Column, bounds: tuple[float, float] = LATITUDE_RANGE) -> Column:
    return F.when(_outside(latitude, bounds), F.concat(F.lit("lat_out_of_bbox:"), detail))


def rule_lon_bbox(longitude: Column, detail: Column, bounds: tuple[float, float] = LONGITUDE_RANGE) -> Column:
    return F.when(_outside(longitude, bounds), F.concat(F.lit("lon_out_of_bbox:"), detail))


def rule_timestamp_parse(event_ts: Column, detail: Column) -> Column:
    return F.when(event_ts.isNull(), F.concat(F.lit("unparseable_timestamp:"), detail))


def _lag_micros(event_ts: Column, arrival_ts: Column) -> Column:
    return F.unix_micros(arrival_ts) - F.unix_micros(event_ts)


def rule_future(event_ts: Column, arrival_ts: Column, detail: Column, grace: int = FUTURE_GRACE_SECONDS) -> Column:
    early = _lag_micros(event_ts, arrival_ts) < F.lit(-grace * 1_000_000)
    return F.when(early, F.concat(F.lit("future_timestamp:"), detail))


def rule_stale(event_ts: Column, arrival_ts: Column, detail: Column, max_age: int = MAX_AGE_SECONDS) -> Column:
    late = _lag_micros(event_ts, arrival_ts) > F.lit(max_age * 1_000_000)
    return F.when(late, F.concat(F.lit("stale_timestamp:"), detail))


def validate_gps(
    df: DataFrame,
    arrival: str = "arrival_ts",
    latitude_range: tuple[float, float] = LATITUDE_RANGE,
    longitude_range: tuple[float, float] = LONGITUDE_RANGE,
    grace: int = FUTURE_GRACE_SECONDS,
    max_age: int = MAX_AGE_SECONDS,
) -> DataFrame:
    """Adds ``event_ts`` and ``rejection_reason``: the first rule broken, or NULL.

    Takes the output of ``decode_payload``, or a plain table of pings, in which a NULL in a
    required column counts as an absent field.
    """
    decoded = "_missing" in df.columns
    if decoded:
        missing = F.col("_missing")
        latitude_text, longitude_text, timestamp_text = (
            F.coalesce("_latitude_text", number_text(F.col("latitude"))),
            F.coalesce("_longitude_text", number_text(F.col("longitude"))),
            F.coalesce("_timestamp_text", "timestamp"),
        )
    else:
        gaps = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in sorted(GPS_REQUIRED)]))
        missing = F.when(F.size(gaps) > 0, F.array_join(gaps, ","))
        latitude_text, longitude_text = number_text(F.col("latitude")), number_text(F.col("longitude"))
        timestamp_text = F.col("timestamp")

    if "event_ts" not in df.columns:
        df = evaluate_once(df, "event_ts", iso_timestamp(F.col("timestamp")))
    event_ts, arrival_ts = F.col("event_ts"), F.col(arrival)
    spelled = iso_text(F.col("timestamp"))
    reason = F.coalesce(
        *([F.concat(F.lit("decode_error:"), F.col("_decode_error"))] if decoded else []),
        rule_missing_fields(missing),
        rule_lat_bbox(F.col("latitude"), latitude_text, latitude_range),
        rule_lon_bbox(F.col("longitude"), longitude_text, longitude_range),
        rule_timestamp_parse(event_ts, F.coalesce(timestamp_text, F.lit("None"))),
        rule_future(event_ts, arrival_ts, spelled, grace),
        rule_stale(event_ts, arrival_ts, spelled, max_age),
    )
    return df.withColumn(REASON, reason).drop(*EVIDENCE)


def rejection_code(reason: Column) -> Column:
    """The rule's name, without the offending value."""
    return F.substring_index(reason, ":", 1)


def split_valid_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Routes validated rows; rejected ones keep every column and the reason."""
    return (
        df.filter(F.col(REASON).isNull()).drop(REASON),
        df.filter(F.col(REASON).isNotNull()),
    )


def batch_summary(df: DataFrame, keys: Sequence[str] = tuple(DEDUP_KEYS_GPS)) -> DataFrame:
    """One row: valid (first copies only), rejected, total (every record).

    Grouping by key first lets each task fold its copies and all its rejects into one row
    before anything is exchanged.
    """
    accepted = F.col(REASON).isNull()
    per_key = df.groupBy(
        accepted.alias("accepted"), *[F.when(accepted, F.col(k)).alias(k) for k in keys]
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count_if("accepted").alias("valid"),
        F.coalesce(F.sum(F.when(~F.col("accepted"), F.col("n"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )


def rejections_by_reason(
    df: DataFrame, by_device: bool = True, bin: str | None = None, ts: str = "arrival_ts"
) -> DataFrame:
    """Rejected rows counted by rule, and optionally by device and by time bin."""
    groups = [rejection_code(F.col(REASON)).alias("reason")]
    if by_device:
        groups.append(F.col("equipo_id"))
    if bin:
        groups.append(F.window(ts, bin)["start"].alias("bin_start"))
    return df.filter(F.col(REASON).isNotNull()).groupBy(*groups).agg(F.count(F.lit(1)).alias("rejections"))


# --- routing helpers ------------------------------------------------------------------

def hour_partition_columns(df: DataFrame, ts: str = "arrival_ts") -> DataFrame:
    """Zero-padded ``year``, ``month``, ``day``, ``hour`` of a UTC timestamp column."""
    return df.withColumns({
        name: F.date_format(ts, pattern)
        for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))
    })


def dedup_batch(
    df: DataFrame, keys: Sequence[str] = tuple(DEDUP_KEYS_GPS), order: Sequence[str] = ("arrival_ts",)
) -> DataFrame:
    """First row per key in ``order``; NULL keys equal each other.

    ``row_number() = 1`` is planned with a limit per group on both sides of the exchange, so
    a key with a huge number of copies sends one row per task, not all of them.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def last_gps(gps: DataFrame, since: Column | None = None) -> DataFrame:
    """Latest event time per device; ``since`` cuts old rows before grouping."""
    if "event_ts" not in gps.columns:
        gps = gps.withColumn("event_ts", iso_timestamp(F.col("timestamp")))
    if since is not None:
        gps = gps.filter(F.col("event_ts") >= since)
    return gps.groupBy("equipo_id").agg(F.max("event_ts").alias("ultima_fecha_gps"))
