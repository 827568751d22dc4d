"""Reading JSON values without losing what kind of value they were."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetpulse.functions.binding import let_sql

_IS_NUMBER = "schema_of_variant(v) RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)'"

# Plain digits from 1e-4 up to 1e16, where Spark would use an exponent from 1e-3 down and 1e7 up.
_SPELL = """n -> CASE
  WHEN isnan(n) THEN 'nan'
  WHEN abs(n) = double('infinity') THEN if(n > 0, 'inf', '-inf')
  WHEN (abs(n) >= 1e7D AND abs(n) < 1e16D) OR (abs(n) < 1e-3D AND abs(n) >= 1e-4D)
    THEN regexp_replace(regexp_replace(CAST(CAST(n AS DECIMAL(38, 18)) AS STRING), '0+$', ''), '[.]$', '.0')
  ELSE CAST(n AS STRING) END"""

_DESCRIBE = f"""v -> named_struct(
  'absent', v IS NULL,
  'number', CASE WHEN {_IS_NUMBER} THEN nanvl(try_variant_get(v, '$', 'double'), NULL) END,
  'text', CASE
    WHEN v IS NULL OR is_variant_null(v) THEN 'None'
    WHEN schema_of_variant(v) IN ('STRING', 'BIGINT') THEN try_variant_get(v, '$', 'string')
    WHEN schema_of_variant(v) = 'BOOLEAN' THEN initcap(try_variant_get(v, '$', 'string'))
    WHEN {_IS_NUMBER} THEN get(transform(array(try_variant_get(v, '$', 'double')), {_SPELL}), 0)
    ELSE to_json(v) END)"""


def json_text(value: Column) -> Column:
    """STRING of a JSON string; NULL for any other kind of value."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def describe_values(values: Column) -> Column:
    """Per JSON value of an array: ``absent``, ``number`` (NULL if it is none or not a number),
    and ``text`` as the rejection reasons spell it."""
    return F.call_function("transform", values, F.expr(_DESCRIBE))


def number_text(value: Column) -> Column:
    """A DOUBLE as the rejection reasons spell it."""
    usual = F.abs(value).between(1e-3, 1e7 - 1)
    return F.when(usual, value.cast("string")).otherwise(let_sql(value, _SPELL))
