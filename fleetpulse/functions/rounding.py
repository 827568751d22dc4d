"""Half-even rounding of the binary value, as the producers' clients round."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetpulse.functions.binding import let_sql

_SCALE = 2 ** 60

# v is the value, unit 10**digits. ``spelled`` is the size by its decimal spelling in units of
# the last digit kept, ``stored`` and ``tie`` are the fractions of value and tie times 2**60.
_SPELLED = "(CAST(abs(v) AS DECIMAL(38, 12)) * {unit})"
_UNITS = f"CAST(floor({_SPELLED}) AS BIGINT)"
_STORED = f"CAST(CAST((abs(v) - floor(abs(v))) * {_SCALE}D AS BIGINT) AS DECIMAL(38, 0)) * (2 * {{unit}})"
_TIE = f"CAST({_UNITS} * 2 + 1 - floor(abs(v)) * (2 * {{unit}}) AS DECIMAL(38, 0)) * {_SCALE}"
_ROUND = f"""v -> CASE
  WHEN {_SPELLED} - floor({_SPELLED}) <> 0.5 OR v IS NULL THEN bround(v, {{digits}})
  WHEN {_STORED} > {_TIE} OR ({_STORED} = {_TIE} AND {_UNITS} % 2 = 1) THEN signum(v) * ({_UNITS} + 1) / {{unit}}D
  ELSE signum(v) * {_UNITS} / {{unit}}D END"""


def round_half_even(value: Column, digits: int) -> Column:
    """``value`` (DOUBLE) rounded to ``digits`` decimals.

    ``bround`` sees the decimal spelling of a double, so 10.05 looks like an exact tie and
    goes down, although the stored number is a little above the tie. Where the spelling is
    a tie, the side is decided on the stored bits, in integers. Exact for sizes below 2**53
    and, for ties, down to 2**-8, which covers every tie with one or two decimals.
    """
    return let_sql(value, _ROUND.format(unit=10 ** digits, digits=digits))


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    """``part`` of ``total`` in percent; 0.0 for an empty total."""
    share = part.cast("double") / total.cast("double") * F.lit(100.0)
    return F.when(total > 0, round_half_even(share, digits)).otherwise(F.lit(0.0))
