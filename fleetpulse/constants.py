"""Fixed values of the data contract: names, limits, word lists and patterns."""

# --- GPS stream -----------------------------------------------------------
LATITUDE_RANGE = (-10.5, -7.8)
LONGITUDE_RANGE = (-78.5, -76.5)
SPEED_RANGE = (0.0, 200.0)
FUTURE_GRACE_SECONDS = 30
MAX_AGE_SECONDS = 3600
DEDUP_KEYS_GPS = ["equipo_id", "timestamp"]
DEDUP_TTL = "24 hours"
REJECTION_CODES = [
    "decode_error", "missing_fields", "lat_out_of_bbox", "lon_out_of_bbox", "unparseable_timestamp", "future_timestamp", "stale_timestamp",
]
GPS_REQUIRED = ["equipo_id", "latitude", "longitude", "timestamp"]
# device spelling -> internal spelling
GPS_RENAMES = {
    "latitud": "latitude",
    "longitud": "longitude",
    "velocidad": "speed_kmh",
}

# --- maintenance log --------------------------------------------------------
CRITICIDAD = ["ALTA", "MEDIA", "BAJA"]
CRITICAL = "ALTA"
RESOLVED = "RESUELTO"
NULL_TOKENS = ["NAN", "NONE", "NULL", "NA", ""]
DEDUP_KEYS_MAINTENANCE = ["equipo_id", "fecha_mantenimiento", "tipo_falla"]
MAX_TIPO_FALLA = 200
MIN_CRITICAL_FAULTS = 3
AUTO_FAULT = "GPS DESCONECTADO"
AUTO_SOURCE = "auto_gps_loss_"
AUTO_FAULT_FORMAT = "GPS DESCONECTADO (%s min sin señal)"
# cell texts that a CSV reader takes as missing
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- silence thresholds, minutes ---------------------------------------------
ALERT_MINUTES = 10
MAINTENANCE_MINUTES = 30
ALERT_TYPE = "SIGNAL_LOSS"

# --- states shown to users ----------------------------------------------------
GPS_OK = "OK"
GPS_SILENT = "SIN_SEÑAL"
FLEET_OK = "OK"
FLEET_ALERT = "ALERTA"
FLEET_SILENT = "SIN SEÑAL"
FLEET_BAD_DATA = "DATO INVÁLIDO"
FLEET_NO_RECORD = "SIN REGISTRO"
NO_SIGNAL_TEXT = "—"
COLUMN_OK = "OK"
COLUMN_REVIEW = "revisar"
COLUMN_CRITICAL = "crítico"
COLUMN_REVIEW_FROM_PCT = 95.0

# --- data quality --------------------------------------------------------------
GPS_DATASET = "gps_eventos"
MAINTENANCE_DATASET = "mantenimientos"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# --- monitoring: metric, aggregate, period, threshold, periods in a row ----------
ALARMS = {
    "validate_errors": ("sum", "1 minute", 5.0, 1),
    "sweep_errors": ("sum", "5 minutes", 1.0, 1),
    "oldest_message_age_seconds": ("max", "1 minute", 60.0, 2),
    "dead_letter_count": ("sum", "1 minute", 0.0, 1),
    "validate_duration_ms": ("p99", "1 minute", 45000.0, 3),
}
