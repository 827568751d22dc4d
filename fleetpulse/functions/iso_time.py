"""ISO-8601 text to instants, with the acceptance rules of the producers' clients.

A plain cast is both too lax (``2026``, ``10:00``) and too strict (``20260520``,
``2026-W21-3``, an offset of 23 hours), so the usual shape is recognised by one pattern
and cast at once, and only other shapes go through the general rewrite.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetpulse.functions.binding import let

_CLOCK = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?"
_USUAL = _CLOCK + r"(Z|[+-](0\d|1[0-7]):[0-5]\d)$"
_USUAL_NAIVE = _CLOCK + "$"
_CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.(?!0{6})\d{6})?(Z|\+\d{2}:[0-5]\d)$"

_DATE = r"\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?"
_TIME = r"\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?(?:[.,]\d+)?"
_OFFSET = r"Z|[+-]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
_GENERAL = rf"^({_DATE})(?:[^\d]({_TIME})({_OFFSET})?)?$"

_DAY_SECONDS = 86400


def _week_date(text: Column) -> Column:
    """Calendar date of ``YYYYWww[D]`` (dashes already removed), NULL if there is none."""
    year = F.substring(text, 1, 4)
    week = F.substring(text, 6, 2).cast("int")
    day = F.when(F.length(text) > 7, F.substring(text, 8, 1).cast("int")).otherwise(1)
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    start = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    real = week.between(1, 52) | ((week == 53) & (F.weekofyear(start) == 53))
    return F.when(real & day.between(1, 7), F.date_add(start, day - 1)).cast("string")


def _offset_seconds(zone: Column) -> Column:
    span = F.rpad(F.regexp_replace(F.regexp_replace(zone, "[.,].*$", ""), "[^0-9]", ""), 6, "0")
    return let(span, lambda digits: (
        F.substring(digits, 1, 2).cast("int") * 3600
        + F.substring(digits, 3, 2).cast("int") * 60
        + F.substring(digits, 5, 2).cast("int")
    )) * F.when(zone.startswith("-"), -1).otherwise(1)


def _parts(text: Column) -> Column:
    """Struct of general ISO text: date and clock texts, fraction of 6 digits, offset seconds."""
    date = let(
        F.regexp_replace(F.regexp_extract(text, _GENERAL, 1), "-", ""),
        lambda d: F.when(d.contains("W"), _week_date(d)).otherwise(
            F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))
        ),
    )
    time = F.regexp_extract(text, _GENERAL, 2)
    clock = let(
        F.rpad(F.regexp_replace(F.regexp_replace(time, "[.,].*$", ""), ":", ""), 6, "0"),
        lambda d: F.concat_ws(":", F.substring(d, 1, 2), F.substring(d, 3, 2), F.substring(d, 5, 2)),
    )
    return F.struct(
        date.alias("date"),
        clock.alias("clock"),
        F.substring(F.rpad(F.regexp_extract(time, r"[.,](\d+)", 1), 6, "0"), 1, 6).alias("fraction"),
        _offset_seconds(F.regexp_extract(text, _GENERAL, 3)).alias("offset"),
    )


def _general_timestamp(text: Column) -> Column:
    def instant(p: Column) -> Column:
        local = F.concat(p["date"], F.lit("T"), p["clock"], F.lit("."), p["fraction"], F.lit("Z")).try_cast("timestamp")
        shifted = F.unix_micros(local) - p["offset"].cast("bigint") * F.lit(1_000_000)
        return F.when(F.abs(p["offset"]) < _DAY_SECONDS, F.timestamp_micros(shifted))

    legal = text.rlike(_GENERAL) & ~text.startswith("0000")
    return F.when(legal, let(_parts(text), instant))


def iso_timestamp(text: Column) -> Column:
    """TIMESTAMP of ISO-8601 text; text without an offset is UTC; NULL if not ISO-8601."""
    return (
        F.when(text.rlike(_USUAL) & ~text.startswith("0000"), text.try_cast("timestamp"))
        .when(
            text.rlike(_USUAL_NAIVE) & ~text.startswith("0000"),
            F.concat(text, F.lit("Z")).try_cast("timestamp"),
        )
        .otherwise(_general_timestamp(text))
    )


def iso_text(text: Column) -> Column:
    """The canonical spelling of ISO-8601 text, in its own offset (+00:00 if it had none)."""

    def two(number: Column) -> Column:
        return F.lpad(F.floor(number).cast("string"), 2, "0")

    def zone(offset: Column) -> Column:
        size = F.abs(offset)
        return F.concat(
            F.when(offset < 0, "-").otherwise("+"),
            two(size / 3600), F.lit(":"), two(size % 3600 / 60),
            F.when(size % 60 != 0, F.concat(F.lit(":"), two(size % 60))).otherwise(""),
        )

    general = let(_parts(text), lambda p: F.concat(
        p["date"], F.lit("T"), p["clock"],
        F.when(p["fraction"] != "000000", F.concat(F.lit("."), p["fraction"])).otherwise(""),
        zone(p["offset"]),
    ))
    return F.when(text.rlike(_CANONICAL), F.regexp_replace(text, "Z$", "+00:00")).otherwise(general)
