"""Cleaning and validating the maintenance log."""

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.maintenance import (
    ingest_summary, normalize_maintenance, require_columns, validate_maintenance, with_maintenance_reasons,
)

SCHEMA = "equipo_id string, fecha string, tipo_falla string, criticidad string"


def log(spark, *rows):
    return normalize_maintenance(spark.createDataFrame(list(rows), SCHEMA))


def test_names_case_spaces_and_dates(spark):
    row = log(spark, ("  cam_001 ", "20/05/2026", " Falla Motor ", "alta")).head()
    assert (row["equipo_id"], str(row["fecha_mantenimiento"]), row["tipo_falla"], row["criticidad"]) == (
        "CAM_001", "2026-05-20", "Falla Motor", "ALTA",
    )
    assert "fecha" not in row.asDict()


def test_existing_internal_date_column_is_kept(spark):
    df = spark.createDataFrame([("A", "1/2/2026", "2026-05-20", "x", "BAJA")], "equipo_id string, fecha string, fecha_mantenimiento string, tipo_falla string, criticidad string")
    row = normalize_maintenance(df).head()
    assert str(row["fecha_mantenimiento"]) == "2026-05-20" and row["fecha"] == "1/2/2026"


REASONS = [
    (("CAM_001", "2026-05-20", "x", "ALTA"), None),
    (("CAM_001", "2026-05-20", None, "BAJA"), None),
    (("CAM_001", "2026-05-20", "x", "urgente"), "invalid_criticidad:URGENTE"),
    (("CAM_001", "2026-05-20", "x", None), "invalid_criticidad:null"),
    ((None, "2026-05-20", "x", "ALTA"), "missing_equipo_id"),
    ((" nan ", "2026-05-20", "x", "ALTA"), "missing_equipo_id"),
    (("CAM_001", "not-a-date", "x", "ALTA"), "invalid_fecha_mantenimiento"),
    ((None, "x", "x", "x"), "missing_equipo_id;invalid_criticidad:X;invalid_fecha_mantenimiento"),
]


def test_reasons_accumulate(spark):
    got = with_maintenance_reasons(log(spark, *[row for row, _ in REASONS])).collect()
    assert [r["rejection_reason"] for r in got] == [want for _, want in REASONS]


def test_split_and_summary(spark):
    df = log(spark, ("A", "2026-05-20", "x", "ALTA"), (None, "2026-05-20", "x", "ALTA")).withColumn("source_file", F.lit("f.csv"))
    valid, rejected = validate_maintenance(df)
    assert (valid.count(), rejected.count()) == (1, 1)
    assert tuple(ingest_summary(with_maintenance_reasons(df)).head()) == ("f.csv", 2, 1, 1)


def test_log_without_criticidad_skips_the_rule(spark):
    df = spark.createDataFrame([("A", "2026-05-20", "x")], "equipo_id string, fecha string, tipo_falla string")
    assert with_maintenance_reasons(normalize_maintenance(require_columns(df))).head()["rejection_reason"] is None


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="fecha, tipo_falla"):
        require_columns(spark.createDataFrame([("A",)], "equipo_id string"))
