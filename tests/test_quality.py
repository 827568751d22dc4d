"""Data-quality rules and metrics."""

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.quality import (
    dq_column_status, dq_completeness, dq_duplicates, dq_failure_cases, dq_latest_and_trend, dq_metrics,
    dq_out_of_range, dq_rejection_reason, dq_rules, dq_split,
)

GPS = "equipo_id string, latitude double, longitude double, timestamp string, speed_kmh double, estado string"
GOOD = [
    ("CAM_001", -9.1, -77.5, "2026-05-20T10:00:00+00:00", 60.0, "ACTIVO"),
    ("CAM_002", -9.5, -77.0, "2026-05-20T10:00:00+00:00", 80.0, "EN_RUTA"),
    ("CAM_003", -8.0, -76.6, "2026-05-20T10:00:00+00:00", 30.0, "DETENIDO"),
]
FIELDS = [f.split()[0] for f in GPS.split(", ")]


def gps(spark, **over):
    first = tuple(over.get(name, value) for name, value in zip(FIELDS, GOOD[0]))
    return spark.createDataFrame([first, *GOOD[1:]], GPS)


def mant(spark, criticidad="ALTA", tipo="Motor"):
    return spark.createDataFrame(
        [("CAM_001", "2026-05-20", tipo, criticidad), ("CAM_002", "2026-04-10", "Cambio aceite", "BAJA")],
        "equipo_id string, fecha_mantenimiento string, tipo_falla string, criticidad string",
    )


def test_good_tables_pass(spark):
    for df, name, n in ((gps(spark), "gps_eventos", 3), (mant(spark), "mantenimientos", 2)):
        row = dq_metrics(df, name).head()
        assert (row["total_rows"], row["valid_rows"], row["valid_pct"], row["pandera_failures"], row["duplicates_count"]) == (n, n, 100.0, 0, 0)
        assert row["out_of_range_pct"] == {} and set(row["completeness_pct"].values()) == {100.0}


BAD = [
    ({"latitude": 20.0}, "latitude:in_range(-10.5, -7.8)"),
    ({"longitude": -60.0}, "longitude:in_range(-78.5, -76.5)"),
    ({"equipo_id": None}, "equipo_id:not_nullable"),
    ({"equipo_id": "X" * 21}, "equipo_id:str_length(1, 20)"),
    ({"speed_kmh": 999.0}, "speed_kmh:in_range(0, 200)"),
    ({"latitude": 20.0, "speed_kmh": -1.0}, "latitude:in_range(-10.5, -7.8); speed_kmh:in_range(0, 200)"),
]


def test_each_gps_rule(spark):
    rows = [tuple(over.get(name, value) for name, value in zip(FIELDS, GOOD[0])) for over, _ in BAD]
    valid, rejected = dq_split(spark.createDataFrame([*rows, *GOOD], GPS), "gps_eventos")
    assert valid.count() == 3
    assert sorted(r["rejection_reason"] for r in rejected.collect()) == sorted(want for _, want in BAD)


def test_nulls_and_nan_skip_all_but_not_null(spark):
    df = gps(spark, speed_kmh=float("nan"))
    row = dq_metrics(df, "gps_eventos").head()
    assert row["valid_rows"] == 3 and row["completeness_pct"]["speed_kmh"] == 66.67
    assert dq_rejection_reason(gps(spark, latitude=None), "gps_eventos").head()["rejection_reason"] == "latitude:not_nullable"


def test_maintenance_rules(spark):
    _, rejected = dq_split(mant(spark, "URGENTE", "x" * 201), "mantenimientos")
    assert rejected.head()["rejection_reason"] == "tipo_falla:str_length(None, 200); criticidad:isin(['ALTA', 'MEDIA', 'BAJA'])"


def test_metrics_with_failures_and_duplicates(spark):
    bad = gps(spark, latitude=20.0)
    row = dq_metrics(bad.union(bad.limit(1)), "gps_eventos").head()
    assert (row["total_rows"], row["valid_rows"], row["rejected_rows"]) == (4, 2, 2)
    assert (row["duplicates_count"], row["duplicates_pct"], row["pandera_failures"]) == (1, 25.0, 2)
    assert row["out_of_range_pct"] == {"latitude": 50.0}


def test_null_keys_are_duplicates_of_each_other(spark):
    df = gps(spark, equipo_id=None)
    assert dq_duplicates(df.union(df.limit(1)), "gps_eventos").head()[0] == 1
    assert dq_duplicates(df.select("latitude"), "gps_eventos").head()[0] == 0
    assert dq_duplicates(gps(spark).select("equipo_id").union(gps(spark).select("equipo_id")), "gps_eventos").head()[0] == 3


def test_missing_column_counts_but_rejects_nothing(spark):
    df = gps(spark).drop("timestamp")
    row = dq_metrics(df, "gps_eventos").head()
    assert (row["valid_rows"], row["pandera_failures"]) == (3, 1)
    cases = dq_failure_cases(df, "gps_eventos").collect()
    assert [(c["column"], c["check"], c["equipo_id"]) for c in cases] == [("timestamp", "column_in_dataframe", None)]


def test_text_columns_are_coerced(spark):
    df = gps(spark).withColumn("latitude", F.when(F.col("equipo_id") == "CAM_001", "abc").otherwise(F.col("latitude").cast("string")))
    assert [(c["column"], c["check"], c["failure_case"]) for c in dq_failure_cases(df, "gps_eventos").collect()] == [
        ("latitude", "coerce_dtype('float64')", "abc")
    ]


def test_empty_table(spark):
    row = dq_metrics(gps(spark).limit(0), "gps_eventos").head()
    assert (row["total_rows"], row["valid_pct"], row["duplicates_pct"], row["duplicates_count"]) == (0, 0.0, 0.0, 0)


def test_long_forms_and_status(spark):
    df = gps(spark, latitude=20.0, speed_kmh=None)
    assert {r["column"]: r["completeness_pct"] for r in dq_completeness(df).collect()}["speed_kmh"] == 66.67
    assert [tuple(r) for r in dq_out_of_range(df, "gps_eventos").collect()] == [("latitude", 33.33)]
    status = {r["column"]: r["estado"] for r in dq_column_status(dq_metrics(df, "gps_eventos")).collect()}
    assert (status["latitude"], status["speed_kmh"], status["estado"]) == ("revisar", "crítico", "OK")


def test_unknown_dataset(spark):
    with pytest.raises(ValueError, match="No schema registered"):
        dq_rules("unknown_dataset")


def test_latest_and_trend(spark):
    first = dq_metrics(gps(spark), "gps_eventos", "2026-05-20 00:00:00")
    runs = first.unionByName(dq_metrics(gps(spark, latitude=20.0), "gps_eventos", "2026-05-21 00:00:00"))
    latest, trend = dq_latest_and_trend(runs)
    assert latest.head()["valid_rows"] == 2
    assert [r["valid_pct"] for r in trend.collect()] == [100.0, 66.7]


def test_metrics_scan_reads_rows_once_and_keys_once(spark, tmp_path):
    path = str(tmp_path / "gps")
    gps(spark).write.parquet(path)
    plan = dq_metrics(spark.read.parquet(path), "gps_eventos")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert "ReadSchema: struct<equipo_id:string,timestamp:string>" in plan
