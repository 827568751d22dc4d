"""Decoding, rules, routing and de-duplication of pings."""

import base64
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.telemetry import (
    batch_summary, decode_payload, dedup_batch, hour_partition_columns, last_gps, normalize_gps_fields,
    rejections_by_reason, split_valid_rejected, unwrap_envelope, validate_gps,
)

NOW = datetime(2026, 5, 20, 12, 0, 0, tzinfo=timezone.utc)


def good(**over):
    record = {
        "equipo_id": "CAM_001", "timestamp": NOW.isoformat(), "latitud": -9.1, "longitud": -77.5,
        "velocidad": 60.0, "estado": "ACTIVO",
    }
    record.update(over)
    return {k: v for k, v in record.items() if v is not ...}


def checked(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    df = spark.createDataFrame([(i, t, NOW) for i, t in enumerate(texts)], "i int, body string, arrival_ts timestamp")
    return validate_gps(decode_payload(df)).orderBy("i")


def reasons(spark, *bodies):
    return [r["rejection_reason"] for r in checked(spark, *bodies).collect()]


def test_good_record_passes_with_internal_names(spark):
    row = checked(spark, good()).head()
    assert row["rejection_reason"] is None
    assert (row["latitude"], row["longitude"], row["speed_kmh"], row["estado"]) == (-9.1, -77.5, 60.0, "ACTIVO")
    assert not {"latitud", "longitud", "velocidad"} & set(row.asDict())


RULES = [
    ({"equipo_id": ...}, "missing_fields:equipo_id"),
    ({"latitud": ..., "timestamp": ..., "equipo_id": ...}, "missing_fields:equipo_id,latitude,timestamp"),
    ({"latitud": 20.0}, "lat_out_of_bbox:20.0"),
    ({"latitud": 20}, "lat_out_of_bbox:20"),
    ({"latitud": -11.0}, "lat_out_of_bbox:-11.0"),
    ({"latitud": 72.29}, "lat_out_of_bbox:72.29"),
    ({"latitud": "-9.1"}, "lat_out_of_bbox:-9.1"),
    ({"latitud": None}, "lat_out_of_bbox:None"),
    ({"latitud": True}, "lat_out_of_bbox:True"),
    ({"longitud": -60.0}, "lon_out_of_bbox:-60.0"),
    ({"longitud": None}, "lon_out_of_bbox:None"),
    ({"timestamp": "not-a-date"}, "unparseable_timestamp:not-a-date"),
    ({"timestamp": 20260520}, "unparseable_timestamp:20260520"),
    ({"timestamp": None}, "unparseable_timestamp:None"),
    ({"timestamp": "2026"}, "unparseable_timestamp:2026"),
    ({"timestamp": "2026-05-20T13:00:00Z"}, "future_timestamp:2026-05-20T13:00:00+00:00"),
    ({"timestamp": "2026-05-20T10:00:00.5"}, "stale_timestamp:2026-05-20T10:00:00.500000+00:00"),
    ({"timestamp": "2026-05-20T05:00:00-05:00"}, "stale_timestamp:2026-05-20T05:00:00-05:00"),
]


def test_each_rule(spark):
    assert reasons(spark, *[good(**over) for over, _ in RULES]) == [want for _, want in RULES]


PASSING = [
    {"latitud": -10.5}, {"latitud": -7.8}, {"longitud": -78.5}, {"longitud": -76.5}, {"latitud": -9},
    {"equipo_id": None}, {"equipo_id": 7},
    {"timestamp": (NOW + timedelta(seconds=30)).isoformat()},
    {"timestamp": (NOW - timedelta(hours=1)).isoformat()},
    {"timestamp": "20260520T120000"}, {"timestamp": "2026-05-20T12:00:00"}, {"timestamp": "2026-W21-3T12:00"},
    {"velocidad": ...}, {"velocidad": "fast"}, {"estado": ...}, {"extra": {"deep": [1, 2]}},
]


def test_edges_and_harmless_oddities_pass(spark):
    got = reasons(spark, *[good(**over) for over in PASSING])
    assert [o for o, r in zip(PASSING, got) if r] == []


def test_just_past_the_time_limits(spark):
    late = (NOW - timedelta(hours=1, microseconds=1)).isoformat()
    early = (NOW + timedelta(seconds=30, microseconds=1)).isoformat()
    assert [r.split(":")[0] for r in reasons(spark, good(timestamp=late), good(timestamp=early))] == [
        "stale_timestamp", "future_timestamp",
    ]


def test_first_broken_rule_wins(spark):
    assert reasons(spark, good(latitud=1.5, longitud=1.5, timestamp="x")) == ["lat_out_of_bbox:1.5"]


def test_not_a_number_is_rejected_as_position_and_dropped_as_speed(spark):
    rows = checked(
        spark, json.dumps(good(latitud=float("nan"))), json.dumps(good(velocidad=float("nan"))),
    ).collect()
    assert rows[0]["rejection_reason"].startswith("lat_out_of_bbox:")
    assert rows[1]["rejection_reason"] is None and rows[1]["speed_kmh"] is None


BROKEN = ["{bad", "[1]", '"s"', "null", "", "{} x", '{"a":1} {"b":2}', '{"a":1},{"b":2}', "{'a': 1}", '{"a":1,}', "12"]


def test_undecodable_text(spark):
    assert {r.split(":")[0] for r in reasons(spark, *BROKEN)} == {"decode_error"}


def test_undecodable_text_is_kept_whole(spark):
    long = "{" + "x" * 2000
    assert checked(spark, long).head()["body"] == long


def test_later_spelling_wins(spark):
    """Also when it is null, repeated, or spelled with an escape."""
    record = good()
    assert reasons(
        spark,
        {**record, "latitude": 50.0},
        {"latitude": 50.0, **record},
        {**record, "latitude": None},
        json.dumps(record)[:-1] + ', "latit\\u0075de": 50.5}',
    ) == ["lat_out_of_bbox:50.0", None, "lat_out_of_bbox:None", "lat_out_of_bbox:50.5"]


def test_repeated_key_takes_its_last_value(spark):
    assert reasons(spark, json.dumps(good())[:-1] + ', "latitud": 33.5}') == ["lat_out_of_bbox:33.5"]


def test_doubtful_record_keeps_its_fields(spark):
    row = checked(spark, good(equipo_id=None, extra=1)).head()
    assert (row["latitude"], row["speed_kmh"], row["estado"], row["timestamp"]) == (-9.1, 60.0, "ACTIVO", NOW.isoformat())


def test_envelopes(spark):
    body = json.dumps(good())
    lines = [
        body,
        json.dumps({"body": body, "attributes": {"SentTimestamp": "1779278400123"}}),
        json.dumps({"kinesis": {"data": base64.b64encode(body.encode()).decode(), "approximateArrivalTimestamp": 1779278400.5}}),
        json.dumps({"kinesis": {"data": "%%%"}, "body": body}),
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = unwrap_envelope(df, arrival="transport").collect()
    assert [r["body"] for r in rows] == [body, body, body, None]
    assert rows[1]["arrival_ts"].microsecond == 123000 and rows[2]["arrival_ts"].microsecond == 500000
    reasons_ = [r["rejection_reason"] for r in validate_gps(decode_payload(unwrap_envelope(df, arrival="transport"))).collect()]
    assert reasons_[3].startswith("decode_error:")
    with pytest.raises(ValueError):
        unwrap_envelope(df, arrival="whenever")


def test_plain_table_validation(spark):
    df = spark.createDataFrame(
        [("A", -9.1, -77.5, NOW.isoformat(), NOW), (None, -9.1, -77.5, NOW.isoformat(), NOW), ("B", 3.5, -77.5, NOW.isoformat(), NOW)],
        "equipo_id string, latitude double, longitude double, timestamp string, arrival_ts timestamp",
    )
    got = [r["rejection_reason"] for r in validate_gps(df).collect()]
    assert got == [None, "missing_fields:equipo_id", "lat_out_of_bbox:3.5"]


def test_routing_and_summary(spark):
    df = checked(spark, good(), good(), good(equipo_id="CAM_002"), good(latitud=1.5), "{bad")
    valid, rejected = split_valid_rejected(df)
    assert (valid.count(), rejected.count()) == (3, 2)
    assert "rejection_reason" not in valid.columns
    assert tuple(batch_summary(df).head()) == (2, 2, 5)
    assert tuple(batch_summary(df.limit(0)).head()) == (0, 0, 0)
    counted = {(r["reason"], r["equipo_id"]): r["rejections"] for r in rejections_by_reason(df).collect()}
    assert counted == {("lat_out_of_bbox", "CAM_001"): 1, ("decode_error", None): 1}
    assert rejections_by_reason(df, by_device=False, bin="5 minutes").count() == 2


def test_json_is_parsed_once_under_a_filter(spark):
    valid, _ = split_valid_rejected(checked(spark, good()))
    plan = valid.select("equipo_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(StructType(StructField(equipo_id,StringType") == 1


def test_dedup_batch_takes_first_arrival_and_limits_before_the_exchange(spark):
    rows = [("A", "t1", 2, "late"), ("A", "t1", 1, "first"), ("A", "t1+00:00", 3, "other"), (None, "t1", 1, "n1"), (None, "t1", 2, "n2")]
    df = spark.createDataFrame(rows, "equipo_id string, timestamp string, arrival_ts int, tag string")
    kept = dedup_batch(df)
    assert {r["tag"] for r in kept.collect()} == {"first", "other", "n1"}
    plan = dedup_batch(df)._jdf.queryExecution().executedPlan().toString()
    assert ", 1, Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_normalize_gps_fields(spark):
    df = spark.createDataFrame([("A", 1.5, 2.5, 3.5, 9.5)], "equipo_id string, latitud double, longitud double, velocidad double, latitude double")
    row = normalize_gps_fields(df).head()
    assert (row["latitude"], row["longitude"], row["speed_kmh"]) == (9.5, 2.5, 3.5)


def test_hour_partitions_are_padded(spark):
    df = spark.createDataFrame([(datetime(2026, 5, 3, 4, tzinfo=timezone.utc),)], "arrival_ts timestamp")
    assert tuple(hour_partition_columns(df).select("year", "month", "day", "hour").head()) == ("2026", "05", "03", "04")


def test_last_gps(spark):
    df = spark.createDataFrame([("A", "2026-05-20T10:00:00Z"), ("A", "2026-05-20T09:00:00-05:00"), ("B", "x")], "equipo_id string, timestamp string")
    got = {r["equipo_id"]: r["ultima_fecha_gps"] for r in last_gps(df).collect()}
    assert got["B"] is None
    assert last_gps(df, since=F.lit("2026-05-20 13:00:00").cast("timestamp")).count() == 1


def test_other_fields_keep_their_json_types(spark):
    base = '"equipo_id":"C:1","timestamp":"2024-01-01T00:00:01Z","latitud":-9.1,"longitud":-77.1'
    more = {
        "": None,
        ',"estado":"EN: RUTA"': None,
        ',"heading":12.50': '{"heading":12.5}',
        ', "fuel" : {"level":3,"x":[1,null]},"on":true,"driver":null,"heading":1,"heading":"x"': '{"driver":null,"fuel":{"level":3,"x":[1,null]},"heading":"x","on":true}',
        ',"estado":"A:B","k\\u0061":1': '{"ka":1}',
        ',"velocidad":1,"speed_kmh":2,"q":"a:b"': '{"q":"a:b"}',
        ',"estado":null': None,
    }
    bodies = ["{%s%s}" % (base, m) for m in more] + ['{"heading":1,"latitude":-50}', '{"a":1} x', "[1]", "{}", ""]
    df = decode_payload(spark.createDataFrame([(b, k) for k, b in enumerate(bodies)], "body string, k int"))
    got = [r["o"] for r in df.select("k", F.to_json("other_fields").alias("o")).orderBy("k").collect()]
    assert got == [*more.values(), '{"heading":1}', None, None, None, None]
    named = decode_payload(spark.createDataFrame([("{%s,\"heading\":7}" % base,)], "body string"), passthrough={"heading": "double"}).head()
    assert (named["heading"], named["other_fields"]) == (7.0, None)
