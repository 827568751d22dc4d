"""Fault reports."""

from datetime import date, datetime, timedelta, timezone

from fleetpulse.operators.relations import union_by_name
from fleetpulse.operators.reports import (
    at_risk_equipment, critical_equipment_report, critical_faults, critical_report_totals, faults_by_equipment,
    maintenance_kpis, maintenance_origin_split, pending_faults,
)

AS_OF = datetime(2026, 5, 31, 12, 0, 0, tzinfo=timezone.utc)
# machine -> criticality of its faults, as in the sample log
SAMPLE = {"CAM_001": "AAAA", "CAM_002": "AB", "CAM_003": "AAAMB", "CAM_004": "M", "CAM_005": "A"}
WORDS = {"A": "ALTA", "M": "MEDIA", "B": "BAJA"}


def log(spark, faults=SAMPLE, estado="PENDIENTE"):
    rows = [
        (machine, date(2026, 5, 1 + i), "Motor", WORDS[c], estado)
        for machine, kinds in faults.items() for i, c in enumerate(kinds)
    ]
    return spark.createDataFrame(rows, "equipo_id string, fecha_mantenimiento date, tipo_falla string, criticidad string, estado string")


def pings(spark, **seconds):
    rows = [(m, AS_OF - timedelta(seconds=s)) for m, s in seconds.items()]
    return spark.createDataFrame(rows, "equipo_id string, event_ts timestamp")


def test_only_machines_with_more_than_three_critical_faults(spark):
    rows = critical_faults(log(spark)).collect()
    assert [(r["equipo_id"], r["total_fallas_criticas"], r["fallas_alta"], r["fallas_pendientes"], r["ultimo_mantenimiento"]) for r in rows] == [
        ("CAM_001", 4, 4, 4, date(2026, 5, 4))
    ]


def test_faults_without_a_state_are_not_pending(spark):
    df = union_by_name([log(spark, {"X": "AA"}, None), log(spark, {"X": "A"}, "RESUELTO"), log(spark, {"X": "AA"})])
    assert critical_faults(df).head()["fallas_pendientes"] == 2
    assert pending_faults(df).head()["fallas_pendientes"] == 2
    assert critical_faults(log(spark).drop("estado")).head()["fallas_pendientes"] == 0


def test_report_states_and_order(spark):
    faults = {"ok": "AAAA", "silent": "AAAA", "unknown": "AAAA", "worst": "AAAAAA"}
    gps = pings(spark, ok=10 * 60 + 59, silent=11 * 60, worst=0)
    report = critical_equipment_report(log(spark, faults), gps, AS_OF)
    rows = report.collect()
    assert [(r["equipo_id"], r["estado_gps"], r["minutos_sin_senal"]) for r in rows] == [
        ("worst", "OK", 0), ("silent", "SIN_SEÑAL", 11), ("ok", "OK", 10), ("unknown", "SIN_SEÑAL", None),
    ]
    assert tuple(critical_report_totals(report).head()) == (4, 2, 2)


def test_report_aggregates_before_joining(spark):
    plan = critical_equipment_report(log(spark), pings(spark, a=1), AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftOuter")
    assert plan.index("Aggregate", join) > join and "Window" not in plan


def test_sql_over_the_same_tables_agrees(spark):
    log(spark).createOrReplaceTempView("mant_t")
    pings(spark, CAM_001=700).createOrReplaceTempView("gps_t")
    sql = spark.sql("""
        SELECT m.equipo_id, n, seen FROM
          (SELECT equipo_id, count(*) AS n FROM mant_t WHERE criticidad = 'ALTA' GROUP BY 1 HAVING count(*) > 3) m
          LEFT JOIN (SELECT equipo_id, max(event_ts) AS seen FROM gps_t GROUP BY 1) g ON m.equipo_id = g.equipo_id""")
    report = critical_equipment_report(spark.table("mant_t"), spark.table("gps_t"), AS_OF)
    assert sql.collect() == report.select("equipo_id", report.total_fallas_criticas.alias("n"), report.ultima_fecha_gps.alias("seen")).collect()


def test_dashboard_counts(spark):
    faults = faults_by_equipment(log(spark))
    assert [(r[0], r[1]) for r in faults.collect()][:2] == [("CAM_001", 4), ("CAM_003", 3)]
    assert [r["equipo_id"] for r in at_risk_equipment(faults).collect()] == ["CAM_001"]
    auto = spark.createDataFrame([("Z", "GPS DESCONECTADO (45 min sin señal)", "ALTA"), ("Y", None, "BAJA")], "equipo_id string, tipo_falla string, criticidad string")
    df = union_by_name([log(spark), auto])
    assert tuple(maintenance_kpis(df).head()) == (15, 10, 14, 1)
    manual, automatic = maintenance_origin_split(df)
    assert (manual.count(), automatic.count()) == (14, 1)
