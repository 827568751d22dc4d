"""The SQL each registered query is compared with, for DuckDB over the same tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# --- the shared tables seen as fleet data -------------------------------------------

_PINGS = """
pings AS (
  SELECT event_id,
         'CAM_' || format('{:06d}', user_id) AS equipo_id,
         CAST(-10.9 AS DOUBLE) + ((event_id * 7) % 341) / CAST(100 AS DOUBLE) AS latitude,
         CAST(-78.9 AS DOUBLE) + ((event_id * 13) % 281) / CAST(100 AS DOUBLE) AS longitude,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS "timestamp",
         CASE WHEN event_id % 29 <> 0 THEN value END AS speed_kmh,
         event_type AS estado,
         ts AS event_ts,
         ts + to_minutes(2 * CAST((event_id % 40) - 2 AS INTEGER)) AS arrival_ts
  FROM events
)"""

_FAULTY = _PINGS + """,
faulty AS (
  SELECT event_id, copy,
         CASE WHEN event_id % 50 <> 7 THEN equipo_id END AS equipo_id,
         latitude, longitude,
         CASE WHEN event_id % 61 = 5 THEN 'not-a-date' ELSE "timestamp" END AS "timestamp",
         speed_kmh, estado,
         CASE WHEN event_id % 61 <> 5 THEN event_ts END AS event_ts,
         arrival_ts
  FROM (SELECT *, 0 AS copy FROM pings
        UNION ALL
        SELECT *, 1 AS copy FROM pings WHERE event_id % 20 = 3)
)"""

_CHECKED = _FAULTY + """,
checked AS (
  SELECT *,
    CASE
      WHEN equipo_id IS NULL THEN 'missing_fields:equipo_id'
      WHEN latitude < -10.5 OR latitude > -7.8 THEN 'lat_out_of_bbox:' || CAST(latitude AS VARCHAR)
      WHEN longitude < -78.5 OR longitude > -76.5 THEN 'lon_out_of_bbox:' || CAST(longitude AS VARCHAR)
      WHEN event_ts IS NULL THEN 'unparseable_timestamp:' || "timestamp"
      WHEN event_ts > arrival_ts + INTERVAL 30 SECONDS THEN 'future_timestamp:' || shown
      WHEN event_ts < arrival_ts - INTERVAL 1 HOUR THEN 'stale_timestamp:' || shown
    END AS rejection_reason
  FROM (SELECT *, replace(replace("timestamp", '.000000', ''), 'Z', '+00:00') AS shown FROM faulty)
),
coded AS (SELECT *, split_part(rejection_reason, ':', 1) AS code FROM checked)"""

_MAINTENANCE = """
maintenance AS (
  SELECT o_orderkey AS order_id,
         'CAM_' || format('{:06d}', o_custkey) AS equipo_id,
         CAST(o_orderdate AS DATE) AS fecha_mantenimiento,
         o_orderpriority AS tipo_falla,
         CASE o_orderstatus WHEN 'F' THEN 'ALTA' WHEN 'O' THEN 'MEDIA' ELSE 'BAJA' END AS criticidad,
         CASE WHEN o_orderkey % 4 = 0 THEN 'RESUELTO' WHEN o_orderkey % 4 <> 1 THEN 'PENDIENTE' END AS estado
  FROM orders
)"""

_MIXED = _MAINTENANCE + """,
mixed AS (
  SELECT order_id, equipo_id, fecha_mantenimiento, criticidad, estado,
         CASE WHEN order_id % 11 = 0 THEN 'GPS DESCONECTADO (45 min sin señal)'
              WHEN order_id % 13 <> 0 THEN tipo_falla END AS tipo_falla
  FROM maintenance
)"""

_RAW = """
raw_log AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 53 = 1 THEN ' nan '
              WHEN o_orderkey % 53 <> 0 THEN ' cam_' || format('{:06d}', o_custkey) || ' ' END AS equipo_id,
         CASE WHEN o_orderkey % 41 = 0 THEN 'not-a-date'
              WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
              WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y%m%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha,
         o_orderpriority AS tipo_falla,
         CASE WHEN o_orderkey % 37 = 0 THEN 'urgente' WHEN o_orderstatus = 'F' THEN 'alta'
              WHEN o_orderstatus = 'O' THEN ' Media ' ELSE 'BAJA' END AS criticidad,
         'mant_' || CAST(o_orderkey % 7 AS VARCHAR) || '.csv' AS source_file
  FROM orders
)"""

_LOG = _RAW + """,
log AS (
  SELECT order_id, tipo_falla, source_file,
         CASE WHEN upper(trim(equipo_id)) <> 'NAN' THEN upper(trim(equipo_id)) END AS equipo_id,
         upper(trim(criticidad)) AS criticidad,
         CASE WHEN fecha = 'not-a-date' THEN NULL
              WHEN length(fecha) = 8 THEN substr(fecha, 1, 4) || '-' || substr(fecha, 5, 2) || '-' || substr(fecha, 7, 2)
              WHEN fecha LIKE '%/%' AND CAST(substr(fecha, 1, 2) AS INTEGER) <= 12
                THEN substr(fecha, 7, 4) || '-' || substr(fecha, 1, 2) || '-' || substr(fecha, 4, 2)
              WHEN fecha LIKE '%/%' THEN substr(fecha, 7, 4) || '-' || substr(fecha, 4, 2) || '-' || substr(fecha, 1, 2)
              ELSE fecha END AS fecha_mantenimiento
  FROM raw_log
),
judged AS (
  SELECT *, nullif(concat_ws(';',
      CASE WHEN equipo_id IS NULL THEN 'missing_equipo_id' END,
      CASE WHEN criticidad NOT IN ('ALTA', 'MEDIA', 'BAJA') THEN 'invalid_criticidad:' || criticidad END,
      CASE WHEN fecha_mantenimiento IS NULL THEN 'invalid_fecha_mantenimiento' END), '') AS rejection_reason
  FROM log
)"""

_DEVICES = """
devices AS (
  SELECT 'CAM_' || format('{:06d}', user_id) AS equipo_id, seen,
         CASE WHEN user_id % 41 = 0 THEN 'sin dato'
              WHEN user_id % 37 <> 0 THEN strftime(seen, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS last_seen,
         user_id % 41 <> 0 AND user_id % 37 <> 0 AS readable
  FROM (SELECT user_id, max(ts) AS seen FROM events GROUP BY user_id)
),
silent AS (
  SELECT equipo_id, last_seen, seen,
         CAST(printf('%.1f', (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(seen)) / CAST(1000000 AS DOUBLE) / 60) AS DOUBLE) AS minutes_silent
  FROM devices WHERE readable
)"""

_FAULTS = _MAINTENANCE + """,
faults AS (
  SELECT equipo_id, count(*) AS total_fallas_criticas, count(*) AS fallas_alta,
         count(*) FILTER (WHERE estado <> 'RESUELTO') AS fallas_pendientes,
         max(fecha_mantenimiento) AS ultimo_mantenimiento
  FROM maintenance WHERE criticidad = 'ALTA' GROUP BY equipo_id HAVING count(*) > 3
)"""

_LAST = "last_ping AS (SELECT equipo_id, max(event_ts) AS ultima_fecha_gps FROM pings GROUP BY equipo_id)"


def _report(silent_min: int, date: str = "ultimo_mantenimiento") -> str:
    return f"""WITH {_FAULTS}, {_PINGS}, {_LAST},
report AS (
  SELECT f.equipo_id, total_fallas_criticas, fallas_alta, fallas_pendientes, {date} AS ultimo_mantenimiento, ultima_fecha_gps,
         CASE WHEN date_sub('minute', ultima_fecha_gps, {AS_OF}) <= {silent_min} THEN 'OK' ELSE 'SIN_SEÑAL' END AS estado_gps,
         date_sub('minute', ultima_fecha_gps, {AS_OF}) AS minutos_sin_senal
  FROM faults f LEFT JOIN last_ping g ON f.equipo_id = g.equipo_id
)"""


def _rounded(value: str, digits: int) -> str:
    """Rounded on the stored bits: round() itself goes by the decimal spelling."""
    return f"CAST(printf('%.{digits}f', {value}) AS DOUBLE)"


def _pct(part: str, total: str, digits: int = 2) -> str:
    return _rounded(f"({part}) / CAST({total} AS DOUBLE) * 100", digits)


# --- data quality -------------------------------------------------------------------------

# dataset -> (CTEs, table, row id columns, key columns, [(column, check, failed)])
_DQ = {
    "gps_eventos": (
        _FAULTY, "faulty", "event_id, copy", "equipo_id, \"timestamp\"",
        [
            ("equipo_id", "not_nullable", "equipo_id IS NULL"),
            ("equipo_id", "str_length(1, 20)", "length(equipo_id) NOT BETWEEN 1 AND 20"),
            ("latitude", "in_range(-10.5, -7.8)", "latitude NOT BETWEEN -10.5 AND -7.8"),
            ("longitude", "in_range(-78.5, -76.5)", "longitude NOT BETWEEN -78.5 AND -76.5"),
            ("timestamp", r"str_matches('^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}')",
             r"""NOT regexp_matches("timestamp", '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}')"""),
            ("speed_kmh", "in_range(0, 200)", "speed_kmh NOT BETWEEN 0 AND 200"),
        ],
    ),
    "mantenimientos": (
        _LOG, "log", "order_id", "equipo_id, fecha_mantenimiento, tipo_falla",
        [
            ("equipo_id", "not_nullable", "equipo_id IS NULL"),
            ("fecha_mantenimiento", "not_nullable", "fecha_mantenimiento IS NULL"),
            ("criticidad", "isin(['ALTA', 'MEDIA', 'BAJA'])", "criticidad NOT IN ('ALTA', 'MEDIA', 'BAJA')"),
        ],
    ),
}
_GPS_COLUMNS = ["event_id", "equipo_id", "latitude", "longitude", "timestamp", "speed_kmh", "estado", "arrival_ts", "copy", "event_ts"]
_LOG_COLUMNS = ["order_id", "equipo_id", "fecha_mantenimiento", "tipo_falla", "criticidad", "source_file"]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _cases(dataset: str) -> str:
    ctes, table, ids, _, rules = _DQ[dataset]
    return " UNION ALL ".join(
        f"""SELECT {ids}, {_quoted(column)} AS "column", {_quoted(check)} AS "check", CAST("{column}" AS VARCHAR) AS failure_case
        FROM {table} WHERE {failed}"""
        for column, check, failed in rules
    )


def _bad(dataset: str) -> str:
    return " OR ".join(f"coalesce({failed}, FALSE)" for _, _, failed in _DQ[dataset][4])


def _reason(dataset: str) -> str:
    texts = ", ".join(f"CASE WHEN {failed} THEN {_quoted(column + ':' + check)} END" for column, check, failed in _DQ[dataset][4])
    return f"nullif(concat_ws('; ', {texts}), '')"


def _metrics(dataset: str, day: str = "2024-01-31") -> str:
    """One metrics row, without the maps; needs the dataset's CTEs in scope."""
    _, table, _, keys, rules = _DQ[dataset]
    failures = " + ".join(f"CAST(coalesce({failed}, FALSE) AS INTEGER)" for _, _, failed in rules)
    return f"""SELECT '{dataset}' AS dataset, TIMESTAMP '{day} 00:00:00' AS run_timestamp, total_rows,
       total_rows - rejected_rows AS valid_rows, rejected_rows,
       {_pct('total_rows - rejected_rows', 'total_rows')} AS valid_pct, duplicates_count,
       {_pct('duplicates_count', 'total_rows')} AS duplicates_pct, pandera_failures
FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE {_bad(dataset)}) AS rejected_rows,
             CAST(sum({failures}) AS BIGINT) AS pandera_failures FROM {table}),
     (SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates_count FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys}))"""


def _completeness(dataset: str) -> str:
    table, columns = _DQ[dataset][1], _GPS_COLUMNS if dataset == "gps_eventos" else _LOG_COLUMNS
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{c}' AS "column", {_pct(f'count("{c}")', 'count(*)')} AS completeness_pct FROM {table}"""
        for c in columns
    )


def _out_of_range(dataset: str) -> str:
    _, table, _, _, rules = _DQ[dataset]
    ranges = [(c, failed) for c, check, failed in rules if check.startswith("in_range")]
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{c}' AS "column", {_pct(f'count(*) FILTER (WHERE {failed})', 'count(*)')} AS out_of_range_pct FROM {table}"""
        for c, failed in ranges
    ) or """SELECT '' AS dataset, '' AS "column", CAST(0 AS DOUBLE) AS out_of_range_pct WHERE FALSE"""


def _status(dataset: str) -> str:
    return f"""SELECT dataset, "column", completeness_pct, coalesce(out_of_range_pct, 0) AS out_of_range_pct,
       CASE WHEN completeness_pct = 100 AND coalesce(out_of_range_pct, 0) = 0 THEN 'OK'
            WHEN completeness_pct >= 95 THEN 'revisar' ELSE 'crítico' END AS estado
FROM ({_completeness(dataset)}) LEFT JOIN ({_out_of_range(dataset)}) USING (dataset, "column")"""


_BOTH = f"WITH {_FAULTY}, {_LOG}"
# The stored maintenance table of the second quality run: the log plus the mixed table.
_GROWN = _BOTH + f""", {_MIXED},
grown AS (
  SELECT equipo_id, fecha_mantenimiento, tipo_falla, criticidad FROM log
  UNION ALL
  SELECT equipo_id, CAST(fecha_mantenimiento AS VARCHAR), tipo_falla, criticidad FROM mixed
)"""


def _history() -> str:
    grown = _metrics("mantenimientos").replace("FROM log", "FROM grown")
    return f"""{_GROWN}, runs AS (
{_metrics('gps_eventos', '2024-01-30')} UNION ALL {_metrics('gps_eventos')} UNION ALL
{_metrics('mantenimientos', '2024-01-30')} UNION ALL {grown}),
history AS (SELECT dataset, run_timestamp, total_rows, pandera_failures, {_rounded('valid_pct', 1)} AS valid_pct,
                   {_rounded('duplicates_pct', 1)} AS duplicates_pct FROM runs)"""


# --- monitoring ---------------------------------------------------------------------------------

def _alarm(rows: str, ts: str, value: str, agg: str, period: str, threshold: float, periods: int, by: str = "") -> str:
    """``rows`` is a FROM item with ``ts``, ``value`` and maybe ``by``."""
    shown = f"quantile_disc({value}, 0.99)" if agg == "p99" else f"{agg}({value})"
    group = f"{by}, " if by else ""
    back = " AND ".join(
        ["a.breaching"]
        + [f"EXISTS (SELECT 1 FROM periods b WHERE b.breaching AND b.period_start = a.period_start - {k} * INTERVAL '{period}'"
           + (f" AND b.{by} = a.{by}" if by else "") + ")" for k in range(1, periods)]
    )
    return f""", periods AS (
  SELECT *, value > {threshold} AS breaching FROM (
    SELECT {group}time_bucket(INTERVAL '{period}', {ts}) AS period_start, CAST({shown} AS DOUBLE) AS value
    FROM {rows} WHERE {value} IS NOT NULL GROUP BY ALL))
SELECT {group}period_start, value, breaching, {back} AS alarm FROM periods a"""


def _timeline(rows: str, ts: str, value: str, agg: str, period: str, threshold: float, periods: int, by: str) -> str:
    """A SELECT over every period of each series up to AS_OF, states by a window over all of them."""
    shown = f"quantile_disc({value}, 0.99)" if agg == "p99" else f"{agg}({value})"
    recent = f"(PARTITION BY {by} ORDER BY period_start ROWS {periods - 1} PRECEDING)"
    return f"""(
  SELECT {by}, period_start, value, breaching,
         bool_and(breaching) OVER {recent} AND count(*) OVER {recent} = {periods} AS alarm
  FROM (
    SELECT {by}, s.period_start, value, coalesce(value > {threshold}, false) AS breaching
    FROM (SELECT {by}, unnest(generate_series(min(time_bucket(INTERVAL '{period}', {ts})), time_bucket(INTERVAL '{period}', {AS_OF}), INTERVAL '{period}')) AS period_start
          FROM {rows} WHERE {value} IS NOT NULL GROUP BY {by}) s
    LEFT JOIN (SELECT {by}, time_bucket(INTERVAL '{period}', {ts}) AS period_start, CAST({shown} AS DOUBLE) AS value
          FROM {rows} WHERE {value} IS NOT NULL GROUP BY ALL) v USING ({by}, period_start)))"""


def _changes(timeline: str, by: str) -> str:
    return f"""SELECT {by}, period_start, CASE WHEN alarm THEN 'ALARM' ELSE 'OK' END AS state
        FROM (SELECT *, lag(alarm, 1, false) OVER (PARTITION BY {by} ORDER BY period_start) AS before FROM {timeline}) WHERE alarm <> before"""


_ERRORS = "(SELECT estado, event_ts, CASE WHEN estado = 'error' THEN event_id % 10 ELSE 0 END AS e FROM pings)"
_PRESETS = {
    "validate_errors": (_ERRORS, "event_ts", "e", "sum", "1 minute", 5, 1),
    "sweep_errors": (_ERRORS, "event_ts", "e", "sum", "5 minutes", 1, 1),
    "oldest_message_age_seconds": (
        "(SELECT estado, arrival_ts, (epoch_us(arrival_ts) - epoch_us(event_ts)) / CAST(1000000 AS DOUBLE) AS age FROM pings)",
        "arrival_ts", "age", "max", "1 minute", 60, 2),
    "dead_letter_count": (
        """(SELECT estado, arrival_ts, CASE WHEN "timestamp" = 'not-a-date' THEN 1 ELSE 0 END AS dead FROM faulty)""",
        "arrival_ts", "dead", "sum", "1 minute", 0, 1),
    "validate_duration_ms": ("(SELECT estado, event_ts, speed_kmh * 1000 AS ms FROM pings)", "event_ts", "ms", "p99", "1 minute", 45000, 3),
}


_GAPPED = _PINGS + """,
gaps AS (
  SELECT equipo_id, event_ts,
         CASE WHEN event_ts - lag(event_ts) OVER w <= INTERVAL 10 MINUTES THEN 0 ELSE 1 END AS starts
  FROM pings WINDOW w AS (PARTITION BY equipo_id ORDER BY event_ts)
),
stretches AS (
  SELECT equipo_id, min(event_ts) AS first_ping, max(event_ts) AS last_ping,
         max(event_ts) + INTERVAL 10 MINUTES AS lost_at, count(*) AS pings
  FROM (SELECT *, sum(starts) OVER (PARTITION BY equipo_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS stretch FROM gaps)
  GROUP BY equipo_id, stretch
)"""


def _sweep(minutes: int) -> str:
    return f"SELECT equipo_id, last_seen, minutes_silent FROM silent WHERE seen < {AS_OF} - INTERVAL {minutes} MINUTES"


def _fleet(alert: int, maint: int) -> str:
    return f"""SELECT d.equipo_id, CASE WHEN d.last_seen IS NULL THEN '—' ELSE replace(substr(d.last_seen, 1, 19), 'T', ' ') END AS ultima_senal,
       minutes_silent AS minutos_sin_senal,
       CASE WHEN d.last_seen IS NULL THEN 'SIN REGISTRO' WHEN minutes_silent IS NULL THEN 'DATO INVÁLIDO'
            WHEN minutes_silent <= {alert} THEN 'OK' WHEN minutes_silent <= {maint} THEN 'ALERTA' ELSE 'SIN SEÑAL' END AS estado
FROM devices d LEFT JOIN silent s ON d.equipo_id = s.equipo_id"""


_KEPT_FIRST = f"""WITH {_CHECKED}, kept AS (
  SELECT *, row_number() OVER (PARTITION BY equipo_id, "timestamp" ORDER BY arrival_ts, copy) AS k
  FROM checked WHERE rejection_reason IS NULL)"""

_AUTO = f"""SELECT equipo_id, '2024-01-31' AS fecha_mantenimiento,
       'GPS DESCONECTADO (' || CAST(CAST(round_even(minutes_silent, 0) AS BIGINT) AS VARCHAR) || ' min sin señal)' AS tipo_falla,
       'ALTA' AS criticidad FROM ({_sweep(1800)})"""

ORACLE: dict[str, str] = {
    # flagship
    "critical_equipment_report": _report(10) + " SELECT * FROM report",
    "critical_equipment_report_600": _report(600) + " SELECT * FROM report",
    "critical_report_totals": _report(600) + """ SELECT count(*) AS total_equipos, count(*) FILTER (WHERE estado_gps = 'OK') AS ok,
        count(*) FILTER (WHERE estado_gps = 'SIN_SEÑAL') AS sin_senal FROM report""",
    "critical_faults": f"WITH {_FAULTS} SELECT * FROM faults",
    "pending_faults": f"""WITH {_MAINTENANCE} SELECT equipo_id, count(*) FILTER (WHERE estado <> 'RESUELTO') AS fallas_pendientes
        FROM maintenance WHERE criticidad = 'ALTA' GROUP BY equipo_id""",
    "last_gps": f"WITH {_PINGS}, {_LAST} SELECT * FROM last_ping",
    "critical_equipment_gps": f"""WITH {_FAULTS}, {_PINGS}, {_LAST}
        SELECT f.*, ultima_fecha_gps FROM faults f LEFT JOIN last_ping g ON f.equipo_id = g.equipo_id""",
    "gps_state": f"""WITH {_PINGS}, {_LAST} SELECT equipo_id, ultima_fecha_gps,
        CASE WHEN date_sub('minute', ultima_fecha_gps, {AS_OF}) > 600 THEN 'SIN_SEÑAL' ELSE 'OK' END AS estado_gps,
        date_sub('minute', ultima_fecha_gps, {AS_OF}) AS minutos_sin_senal FROM last_ping""",
    "order_critical": _report(10) + " SELECT equipo_id, total_fallas_criticas, minutos_sin_senal FROM report",
    "faults_by_equipment": f"""WITH {_MAINTENANCE} SELECT equipo_id, count(*) AS fallas_alta
        FROM maintenance WHERE criticidad = 'ALTA' GROUP BY equipo_id""",
    "at_risk_equipment": f"""WITH {_MAINTENANCE} SELECT equipo_id, count(*) AS fallas_alta
        FROM maintenance WHERE criticidad = 'ALTA' GROUP BY equipo_id HAVING count(*) > 3""",
    "maintenance_kpis": f"""WITH {_MIXED} SELECT count(*) AS total_registros, count(*) FILTER (WHERE criticidad = 'ALTA') AS criticidad_alta,
        count(*) - count(*) FILTER (WHERE tipo_falla LIKE '%GPS DESCONECTADO%') AS registros_manuales,
        count(*) FILTER (WHERE tipo_falla LIKE '%GPS DESCONECTADO%') AS auto_generados FROM mixed""",
    "maintenance_origin_split": f"""WITH {_MIXED} SELECT *,
        CASE WHEN tipo_falla LIKE '%GPS DESCONECTADO%' THEN 'auto' ELSE 'manual' END AS origen FROM mixed""",
    # GPS stream
    "decode_payload": f"""WITH {_FAULTY} SELECT event_id, copy, equipo_id, "timestamp", latitude, longitude, speed_kmh, estado,
        CASE WHEN equipo_id IS NULL THEN 'equipo_id' END AS missing FROM faulty""",
    "normalize_gps_fields": f"""WITH {_PINGS} SELECT event_id, equipo_id, "timestamp", latitude, longitude, speed_kmh, estado FROM pings""",
    "rule_missing_fields": f"""WITH {_FAULTY} SELECT event_id, copy, 'missing_fields:equipo_id' AS reason FROM faulty WHERE equipo_id IS NULL""",
    "rule_lat_bbox": f"""WITH {_PINGS} SELECT event_id, CASE WHEN latitude NOT BETWEEN -10.5 AND -7.8
        THEN 'lat_out_of_bbox:' || CAST(latitude AS VARCHAR) END AS reason FROM pings""",
    "rule_lon_bbox": f"""WITH {_PINGS} SELECT event_id, CASE WHEN longitude NOT BETWEEN -78.5 AND -76.5
        THEN 'lon_out_of_bbox:' || CAST(longitude AS VARCHAR) END AS reason FROM pings""",
    "rule_timestamp_parse": f"""WITH {_FAULTY} SELECT event_id, copy, event_ts,
        CASE WHEN event_ts IS NULL THEN 'unparseable_timestamp:' || "timestamp" END AS reason FROM faulty""",
    "rule_future": f"""WITH {_PINGS} SELECT event_id, CASE WHEN event_ts > arrival_ts + INTERVAL 30 SECONDS
        THEN 'future_timestamp' END AS reason FROM pings""",
    "rule_stale": f"""WITH {_PINGS} SELECT event_id, CASE WHEN event_ts < arrival_ts - INTERVAL 1 HOUR
        THEN 'stale_timestamp' END AS reason FROM pings""",
    "validate_gps": f"WITH {_CHECKED} SELECT event_id, copy, event_ts, rejection_reason FROM checked",
    "split_valid_rejected": f"""WITH {_CHECKED} SELECT event_id, copy, equipo_id, latitude, longitude, speed_kmh, estado,
        coalesce(code, 'valid') AS outcome FROM coded""",
    "batch_summary": f"""WITH {_CHECKED} SELECT
        (SELECT count(*) FROM (SELECT DISTINCT equipo_id, "timestamp" FROM checked WHERE rejection_reason IS NULL)) AS valid,
        count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rejected, count(*) AS total FROM checked""",
    "rejections_by_reason": f"""WITH {_CHECKED} SELECT code AS reason, equipo_id, count(*) AS rejections
        FROM coded WHERE code IS NOT NULL GROUP BY code, equipo_id""",
    "rejections_by_reason_5min": f"""WITH {_CHECKED} SELECT code AS reason, time_bucket(INTERVAL '5 minutes', arrival_ts) AS bin_start,
        count(*) AS rejections FROM coded WHERE code IS NOT NULL GROUP BY ALL""",
    "hour_partition_columns": f"""WITH {_PINGS} SELECT event_id, strftime(arrival_ts, '%Y') AS "year", strftime(arrival_ts, '%m') AS "month",
        strftime(arrival_ts, '%d') AS "day", strftime(arrival_ts, '%H') AS "hour" FROM pings""",
    "dedup_batch": _KEPT_FIRST + """ SELECT event_id, copy, equipo_id, "timestamp", latitude, longitude, arrival_ts FROM kept WHERE k = 1""",
    "union_by_name": f"""WITH {_PINGS}, {_MAINTENANCE} SELECT equipo_id, event_ts AS momento, speed_kmh, NULL AS criticidad FROM pings
        UNION ALL SELECT equipo_id, NULL, NULL, criticidad FROM maintenance""",
    # maintenance log
    "require_columns": f"WITH {_RAW} SELECT equipo_id, fecha, tipo_falla, criticidad FROM raw_log",
    "normalize_maintenance": f"WITH {_LOG} SELECT * FROM log",
    "parse_mixed_date": f"WITH {_LOG} SELECT order_id, fecha_mantenimiento FROM log",
    "null_token_normalize": f"WITH {_LOG} SELECT order_id, equipo_id FROM log",
    "rule_missing_equipo": f"WITH {_LOG} SELECT order_id, CASE WHEN equipo_id IS NULL THEN 'missing_equipo_id' END AS reason FROM log",
    "rule_criticidad": f"""WITH {_LOG} SELECT order_id, CASE WHEN criticidad NOT IN ('ALTA', 'MEDIA', 'BAJA')
        THEN 'invalid_criticidad:' || criticidad END AS reason FROM log""",
    "rule_fecha": f"""WITH {_LOG} SELECT order_id, CASE WHEN fecha_mantenimiento IS NULL
        THEN 'invalid_fecha_mantenimiento' END AS reason FROM log""",
    "validate_maintenance": f"WITH {_LOG} SELECT order_id, equipo_id, fecha_mantenimiento, rejection_reason FROM judged",
    "ingest_summary": f"""WITH {_LOG} SELECT source_file, count(*) AS total, count(*) FILTER (WHERE rejection_reason IS NULL) AS valid,
        count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rejected FROM judged GROUP BY source_file""",
    # silence
    "minutes_silent": f"WITH {_DEVICES} SELECT equipo_id, last_seen, minutes_silent FROM silent",
    "signal_loss_alert": f"WITH {_DEVICES} {_sweep(600)}",
    "signal_loss_maintenance": f"WITH {_DEVICES} {_sweep(1800)}",
    "alert_payload": f"""WITH {_DEVICES}, lost AS ({_sweep(600)}) SELECT 'SIGNAL_LOSS' AS alert_type, {AS_OF} AS detected_at,
        600 AS alert_threshold_min, 1800 AS maint_threshold_min, (SELECT count(*) FROM lost) AS affected_count, * FROM lost""",
    "auto_maintenance_records": f"""WITH {_DEVICES} SELECT * FROM ({_AUTO}) WHERE right(equipo_id, 1) NOT IN ('1', '3', '5', '7', '9')""",
    "signal_sweep_summary": f"""WITH {_DEVICES} SELECT (SELECT count(*) FROM ({_sweep(600)})) AS alert_lost,
        (SELECT count(*) FROM ({_sweep(1800)})) AS maint_created,
        CASE WHEN (SELECT count(*) FROM ({_sweep(1800)})) > 0 THEN 'auto_gps_loss_' || strftime({AS_OF}, '%Y%m%d_%H%M%S') END AS maint_key,
        equipo_id FROM ({_sweep(600)})""",
    "fleet_status": f"WITH {_DEVICES} {_fleet(600, 1800)}",
    "order_status": f"WITH {_DEVICES} SELECT equipo_id, minutos_sin_senal FROM ({_fleet(10, 30)})",
    "fleet_status_kpis": f"""WITH {_DEVICES} SELECT count(*) AS total_equipos, count(*) FILTER (WHERE estado = 'OK') AS senal_ok,
        count(*) FILTER (WHERE estado = 'ALERTA') AS alerta, count(*) FILTER (WHERE estado = 'SIN SEÑAL') AS sin_senal,
        count(*) FILTER (WHERE estado = 'DATO INVÁLIDO') AS dato_invalido, count(*) FILTER (WHERE estado = 'SIN REGISTRO') AS sin_registro
        FROM ({_fleet(600, 1800)})""",
    "signal_loss_sessions": f"WITH {_GAPPED} SELECT * FROM stretches WHERE last_ping < {AS_OF} - INTERVAL 10 MINUTES",
    # data quality
    "dq_rules": _BOTH + " " + " UNION ALL ".join(
        f"""SELECT '{d}' AS dataset, "column", "check", count(*) AS failures FROM ({_cases(d)}) GROUP BY "column", "check" """ for d in _DQ),
    "dq_failure_cases": f"WITH {_FAULTY} {_cases('gps_eventos')}",
    "dq_failure_cases_maintenance": f"WITH {_LOG} {_cases('mantenimientos')}",
    "dq_split": f"WITH {_FAULTY} SELECT event_id, copy, {_reason('gps_eventos')} AS rejection_reason FROM faulty",
    "dq_rejection_reason": f"WITH {_LOG} SELECT order_id, {_reason('mantenimientos')} AS rejection_reason FROM log",
    "dq_duplicates": _BOTH + " " + " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, CAST(sum(n - 1) AS BIGINT) AS duplicates_count FROM (SELECT count(*) AS n FROM {_DQ[d][1]} GROUP BY {_DQ[d][3]})"
        for d in _DQ),
    "dq_completeness": _BOTH + " " + " UNION ALL ".join(_completeness(d) for d in _DQ),
    "dq_out_of_range": f"""WITH {_FAULTY} SELECT "column", out_of_range_pct FROM ({_out_of_range('gps_eventos')}) WHERE out_of_range_pct > 0""",
    "dq_metrics": _BOTH + " " + " UNION ALL ".join(_metrics(d) for d in _DQ),
    "dq_column_status": _BOTH + " " + " UNION ALL ".join(_status(d) for d in _DQ),
    "dq_run": _BOTH + " " + " UNION ALL ".join(_metrics(d) for d in _DQ),
    "write_quality_metrics": f"""WITH {_FAULTY} SELECT dataset, total_rows, valid_pct,
        (SELECT {_pct('count(speed_kmh)', 'count(*)')} FROM faulty) AS speed_completeness FROM ({_metrics('gps_eventos')})""",
    "read_quality_history": _history() + " SELECT * FROM history",
    "dq_latest_and_trend": _history() + """, mine AS (SELECT * FROM history WHERE dataset = 'mantenimientos')
        SELECT run_timestamp, total_rows, valid_pct, 'latest' AS part FROM mine WHERE run_timestamp = (SELECT max(run_timestamp) FROM mine)
        UNION ALL SELECT run_timestamp, NULL, valid_pct, 'trend' FROM mine""",
    # sources and sinks
    "read_telemetry_stream": f"""WITH {_FAULTY} SELECT equipo_id, "timestamp", latitude, longitude, speed_kmh, estado,
        date_trunc('millisecond', arrival_ts) AS arrival_ts FROM faulty""",
    "read_maintenance_csv": f"WITH {_RAW} SELECT CAST(order_id AS VARCHAR) AS order_id, equipo_id, fecha, tipo_falla, criticidad FROM raw_log",
    "read_silver": f"""WITH {_PINGS} SELECT equipo_id, latitude, longitude, "timestamp", speed_kmh, estado, event_ts FROM pings""",
    "write_silver_gps": f"""WITH {_CHECKED} SELECT 2024 AS "year", 1 AS "month", 31 AS "day", 0 AS "hour", equipo_id, count(*) AS n,
        max(event_ts) AS last_event FROM checked WHERE rejection_reason IS NULL GROUP BY equipo_id""",
    "write_rejected_gps": f"""WITH {_CHECKED} SELECT 2024 AS "year", 1 AS "month", 31 AS "day", 0 AS "hour", code AS reason, count(*) AS n
        FROM coded WHERE code IS NOT NULL GROUP BY code""",
    "read_rejected": f"""WITH {_CHECKED} SELECT equipo_id, latitude, longitude, "timestamp", date_trunc('millisecond', arrival_ts) AS arrival_ts, rejection_reason, TRUE AS raw_kept
        FROM checked WHERE rejection_reason IS NOT NULL""",
    "rejected_sample_facts": f"""WITH {_CHECKED} SELECT least(5, count(*)) AS n, TRUE AS all_with_reason, TRUE AS all_from_newest
        FROM coded WHERE code IS NOT NULL""",
    "write_silver_maintenance": f"""WITH {_LOG} SELECT source_file, criticidad, count(*) AS n, max(fecha_mantenimiento) AS last_date
        FROM judged WHERE rejection_reason IS NULL GROUP BY source_file, criticidad""",
    "write_rejected_maintenance": f"""WITH {_LOG} SELECT source_file, rejection_reason, count(*) AS n
        FROM judged WHERE rejection_reason IS NOT NULL GROUP BY source_file, rejection_reason""",
    "ingest_maintenance": f"""WITH {_LOG} SELECT replace(source_file, '.csv', '') AS batch, count(*) AS total,
        count(*) FILTER (WHERE rejection_reason IS NULL AND NOT lacking) AS valid,
        count(*) FILTER (WHERE rejection_reason IS NOT NULL OR lacking) AS rejected
        FROM (SELECT *, source_file = 'mant_6.csv' AND order_id % 2 = 0 AS lacking FROM judged) GROUP BY batch""",
    "upsert_last_seen": f"WITH {_PINGS} SELECT equipo_id, max(event_ts) AS last_seen FROM pings GROUP BY equipo_id",
    "read_last_seen": f"WITH {_PINGS} SELECT equipo_id, max(event_ts) AS last_seen FROM pings GROUP BY equipo_id",
    "append_auto_maintenance": f"""WITH {_MAINTENANCE}, {_PINGS}, {_LAST} SELECT equipo_id, count(*) AS fallas_alta FROM (
        SELECT equipo_id FROM maintenance WHERE criticidad = 'ALTA' UNION ALL
        SELECT equipo_id FROM last_ping WHERE ultima_fecha_gps < {AS_OF} - INTERVAL 1800 MINUTES) GROUP BY equipo_id""",
    "create_tables": _report(600, "CAST(ultimo_mantenimiento AS VARCHAR)") + " SELECT * FROM report",
    # streaming
    "dedup_stream": f"""WITH {_PINGS} SELECT event_id, equipo_id, "timestamp" FROM pings""",
    "signal_loss_stream": f"""WITH {_GAPPED} SELECT * FROM stretches
        WHERE lost_at <= (SELECT date_trunc('millisecond', max(event_ts)) FROM pings) - INTERVAL 1 HOUR""",
    "dedup_stream_disordered": _KEPT_FIRST + """ SELECT equipo_id, "timestamp" FROM kept WHERE k = 1""",
    "pipeline_accounting": _KEPT_FIRST + """ SELECT count(*) AS n, 'received' AS part FROM coded
        UNION ALL SELECT count(*), 'valid' FROM kept WHERE k = 1
        UNION ALL SELECT count(*), 'copies' FROM kept WHERE k > 1
        UNION ALL SELECT count(*), 'rejected' FROM coded WHERE code IS NOT NULL
        UNION ALL SELECT 0, 'lost'
        UNION ALL SELECT 0, 'twice'""",
    "stream_and_backfill": f"""WITH {_PINGS} SELECT equipo_id, "timestamp", event_ts FROM pings""",
    "telemetry_end_to_end": _KEPT_FIRST + """, once AS (SELECT * FROM kept WHERE k = 1)
        SELECT equipo_id AS name, count(*) AS n, 'silver' AS part FROM once GROUP BY equipo_id
        UNION ALL SELECT code, count(*), 'rejected' FROM coded WHERE code IS NOT NULL GROUP BY code
        UNION ALL SELECT equipo_id, epoch_us(max(event_ts)), 'last_seen' FROM once GROUP BY equipo_id""",
    "unknown_fields_end_to_end": _KEPT_FIRST + """, stored AS (
          SELECT event_id, 'silver' AS part, equipo_id, "timestamp", speed_kmh FROM kept WHERE k = 1
          UNION ALL SELECT event_id, 'rejected', equipo_id, "timestamp", speed_kmh FROM coded WHERE code IS NOT NULL)
        SELECT part, equipo_id, "timestamp", CASE WHEN event_id % 11 = 0 THEN 1.5 ELSE speed_kmh END AS speed_kmh,
          CASE WHEN event_id % 9 = 1 THEN 'N: up' WHEN event_id % 3 <> 0 THEN CAST(event_id % 360 AS VARCHAR) || '.5' END AS heading,
          CASE WHEN event_id % 9 = 1 THEN 'STRING' WHEN event_id % 3 <> 0 THEN 'NUMBER' END AS heading_kind,
          CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 100 AS INTEGER) END AS fuel_level,
          CASE WHEN event_id % 5 = 0 THEN TRUE END AS engine_on, CASE WHEN event_id % 7 = 0 THEN TRUE ELSE FALSE END AS driver_null,
          event_id % 3 <> 0 OR event_id % 4 = 0 OR event_id % 5 = 0 OR event_id % 7 = 0 AS has_more
        FROM stored""",
    # monitoring
    "windowed_threshold_alarm": f"WITH {_PINGS}" + _alarm("pings", "event_ts", "speed_kmh", "sum", "6 hours", 400, 3, "estado"),
    "windowed_threshold_alarm_p99": f"WITH {_PINGS}" + _alarm("pings", "event_ts", "speed_kmh", "p99", "1 day", 150, 2, "estado"),
    "alarm_validate_errors": f"WITH {_PINGS}" + _alarm(
        "(SELECT event_ts, CASE WHEN estado = 'error' THEN event_id % 10 ELSE 0 END AS e FROM pings)", "event_ts", "e", "sum", "1 minute", 5, 1),
    "alarm_sweep_errors": f"WITH {_PINGS}" + _alarm(
        "(SELECT event_ts, CASE WHEN estado = 'error' THEN event_id % 10 ELSE 0 END AS e FROM pings)", "event_ts", "e", "sum", "5 minutes", 1, 1),
    "alarm_oldest_message_age": f"WITH {_PINGS}" + _alarm(
        "(SELECT arrival_ts, (epoch_us(arrival_ts) - epoch_us(event_ts)) / CAST(1000000 AS DOUBLE) AS age FROM pings)",
        "arrival_ts", "age", "max", "1 minute", 60, 2),
    "alarm_dead_letter_count": f"WITH {_FAULTY}" + _alarm(
        """(SELECT arrival_ts, CASE WHEN "timestamp" = 'not-a-date' THEN 1 ELSE 0 END AS dead FROM faulty)""",
        "arrival_ts", "dead", "sum", "1 minute", 0, 1),
    "alarm_validate_duration": f"WITH {_PINGS}" + _alarm(
        "(SELECT event_ts, speed_kmh * 1000 AS ms FROM pings)", "event_ts", "ms", "p99", "1 minute", 45000, 3),
    "alarm_timeline": f"WITH {_PINGS} SELECT * FROM " + _timeline("pings", "event_ts", "speed_kmh", "sum", "6 hours", 150, 2, "estado"),
    "alarm_changes": f"WITH {_PINGS} " + _changes(_timeline("pings", "event_ts", "speed_kmh", "sum", "6 hours", 150, 2, "estado"), "estado"),
    "preset_alarm_changes": f"WITH {_FAULTY} " + " UNION ALL ".join(
        f"SELECT *, '{name}' AS alarm FROM ({_changes(_timeline(*spec, 'estado'), 'estado')})" for name, spec in _PRESETS.items()),
    "preset_alarm_timeline": f"WITH {_FAULTY} " + " UNION ALL ".join(
        f"""SELECT estado, strftime(period_start, '%Y-%m-%d') AS day, breaching, alarm, count(*) AS periods, count(value) AS with_data, '{name}' AS name
        FROM {_timeline(*spec, 'estado')} GROUP BY ALL""" for name, spec in _PRESETS.items()),
    "alert_documents": f"""WITH {_DEVICES} SELECT 'SIGNAL_LOSS' AS alert_type, {AS_OF} AS detected_at, 600 AS alert_threshold_min,
        1800 AS maint_threshold_min, count(*) OVER () AS affected_count, TRUE AS small, TRUE AS numbered, TRUE AS complete,
        equipo_id, last_seen, minutes_silent FROM silent WHERE seen < {AS_OF} - INTERVAL 600 MINUTES""",
    "signal_sweep_now": f"""WITH {_PINGS}, {_LAST} SELECT count(*) AS records, count(*) AS devices, count(*) AS alert_lost,
        count(*) AS maint_created, count(*) AS alert_rows FROM last_ping""",
    "observed_batch_counts": _KEPT_FIRST + """ SELECT 'valid' AS name, CAST(count(*) AS DOUBLE) AS n FROM kept WHERE k = 1
        UNION ALL SELECT 'rejected', count(*) FROM coded WHERE code IS NOT NULL
        UNION ALL SELECT 'total', count(*) FROM coded
        UNION ALL SELECT 'oldest_age', max((epoch_us(date_trunc('millisecond', arrival_ts)) - epoch_us(event_ts)) / CAST(1000000 AS DOUBLE)) FROM coded WHERE code IS NULL
        UNION ALL SELECT code, count(*) FROM coded WHERE code IS NOT NULL GROUP BY code""",
    "pipeline_alarms": "SELECT 0 AS failures",
    "last_gps_since": f"""WITH {_CHECKED}, valid AS (SELECT * FROM checked WHERE rejection_reason IS NULL)
        SELECT equipo_id, max(event_ts) AS ultima_fecha_gps, count(*) AS pings, (SELECT count(*) FROM valid) AS stored
        FROM valid WHERE event_ts >= TIMESTAMP '2024-01-15' GROUP BY equipo_id""",
    "signal_loss_disordered": f"WITH {_GAPPED} SELECT * FROM stretches WHERE last_ping < {AS_OF} - INTERVAL 10 MINUTES",
    "signal_loss_announced": f"WITH {_GAPPED} SELECT *, CAST(1 AS INTEGER) AS net FROM stretches WHERE last_ping < {AS_OF} - INTERVAL 10 MINUTES",
    "dq_run_incremental": f"WITH {_FAULTY} SELECT * FROM ({_metrics('gps_eventos')})",
}
