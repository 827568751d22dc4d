"""Dates typed by people: one column, many layouts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetpulse.functions.binding import let
from fleetpulse.functions.text import strip

# a clock time after the date is accepted and dropped
_CLOCK = r"(?:[T ]([01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
_YEAR_FIRST = r"^(\d{4})[-/.](\d{1,2})(?:[-/.](\d{1,2})" + _CLOCK + "|$)"
_YEAR_LAST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})" + _CLOCK
_MONTH_YEAR = r"^(\d{1,2})[-/.](\d{4})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:([01]\d|2[0-3])[0-5]\d[0-5]\d)?$"
_YEAR_ONLY = r"^\d{4}$"
_MONTH = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_NAMED_DAY_FIRST = r"(?i)^(\d{1,2})[- ]" + _MONTH + r"[- ,]+(\d{4})$"
_NAMED_MONTH_FIRST = "(?i)^" + _MONTH + r"[- ](\d{1,2})[- ,]+(\d{4})$"


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day).try_cast("date")


def _month_number(name: Column) -> Column:
    names = F.array(*[F.lit(m) for m in _MONTHS])
    return F.array_position(names, F.lower(F.substring(name, 1, 3))).cast("string")


def _numbers(text: Column, pattern: str, year: int, month: int, day: int) -> Column:
    """DATE from the groups of ``pattern``; a group 0 or an empty one is the first."""
    groups = [F.regexp_extract(text, pattern, g) if g else F.lit("1") for g in (year, month, day)]
    return _date(groups[0], groups[1], F.coalesce(F.nullif(groups[2], F.lit("")), F.lit("1")))


def _year_last(text: Column) -> Column:
    """Day and month in either order, then the year."""
    def order(p: Column) -> Column:
        month_first = p["a"].cast("int") <= 12
        # two-digit years: 00-68 are this century, the rest the last
        year = F.when(F.length(p["y"]) == 4, p["y"]).otherwise(
            F.concat(F.when(p["y"].cast("int") <= 68, "20").otherwise("19"), p["y"])
        )
        return _date(year, F.when(month_first, p["a"]).otherwise(p["b"]), F.when(month_first, p["b"]).otherwise(p["a"]))

    a, b, y = (F.regexp_extract(text, _YEAR_LAST, g) for g in (1, 2, 3))
    return let(F.struct(a.alias("a"), b.alias("b"), y.alias("y")), order)


def _named(text: Column, pattern: str, month: int, day: int) -> Column:
    return _date(
        F.regexp_extract(text, pattern, 3), _month_number(F.regexp_extract(text, pattern, month)),
        F.regexp_extract(text, pattern, day),
    )


def parse_mixed_date(text: Column) -> Column:
    """DATE of text in any supported layout; NULL for anything else.

    Ambiguous day and month are read month first, unless that month would be over 12.
    Every layout is recognised by pattern before it is cast, so a column of mixed layouts
    costs no failed parses. The three layouts that logs mostly use are cut out by position.
    """
    def piece(start: int, size: int) -> Column:
        return F.substring(text, start, size)

    month_first = piece(1, 2) <= "12"
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
        .when(
            text.rlike(r"^\d{2}/\d{2}/\d{4}$"),
            _date(piece(7, 4), F.when(month_first, piece(1, 2)).otherwise(piece(4, 2)), F.when(month_first, piece(4, 2)).otherwise(piece(1, 2))),
        )
        .when(text.rlike(r"^\d{8}$"), _date(piece(1, 4), piece(5, 2), piece(7, 2)))
        .otherwise(let(strip(text), _any_layout))
    )


def _any_layout(t: Column) -> Column:
    return (
        F.when(t.rlike(_YEAR_FIRST), _numbers(t, _YEAR_FIRST, 1, 2, 3))
        .when(t.rlike(_YEAR_LAST), _year_last(t))
        .when(t.rlike(_COMPACT), _numbers(t, _COMPACT, 1, 2, 3))
        .when(t.rlike(_YEAR_ONLY), _date(t, F.lit("1"), F.lit("1")))
        .when(t.rlike(_MONTH_YEAR), _numbers(t, _MONTH_YEAR, 2, 1, 0))
        .when(t.rlike(_NAMED_DAY_FIRST), _named(t, _NAMED_DAY_FIRST, 2, 1))
        .when(t.rlike(_NAMED_MONTH_FIRST), _named(t, _NAMED_MONTH_FIRST, 1, 2))
    )
