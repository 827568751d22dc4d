"""Threshold alarms over fixed periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetpulse.constants import ALARMS
from fleetpulse.functions.moments import moment

MARGIN = 0.001  # of the ranks, on both sides of a sketched percentile; ten times the sketch's error
BLOCK = 4096  # periods of a series that one row of the spine stands for until it is exchanged


def _percentile(rows: DataFrame, share: str) -> DataFrame:
    """(_series, _period, value): the nearest-rank percentile ``share`` of ``_v`` per group, exactly.

    A sketch brackets it; a second pass counts what lies below the bracket and each value
    inside. Only the bracket's distinct values of a group, a small part of it, are sorted
    together.
    """
    keys = ["_series", "_period"]
    at, n = float(share) / 100, F.col("n").cast("decimal(20,0)")
    sides = [max(0.0, at - MARGIN), min(1.0, at + MARGIN)]
    bracket = (
        rows.groupBy(*keys)
        .agg(F.count("_v").alias("n"), F.percentile_approx("_v", sides, 10_000).alias("q"))
        .select(
            F.col("_series").alias("_of"), F.col("_period").alias("_at"), F.col("q")[0].alias("low"), F.col("q")[1].alias("high"),
            F.ceil(n * F.lit(share).cast("decimal(6,3)") / 100).alias("rank"),
        )
    )
    same = [F.col("_series").eqNullSafe(F.col("_of")), F.col("_period") == F.col("_at")]
    inside = rows.join(bracket, same).where(F.col("_v") <= F.col("high"))
    counted = inside.groupBy(*keys, "rank", F.when(F.col("_v") >= F.col("low"), F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    upward = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("upto", F.sum("n").over(upward))
    reached = F.col("upto") >= F.col("rank")
    missed = F.coalesce(F.bool_or(F.col("_v").isNull() & reached), F.lit(False)) | ~F.bool_or(reached)
    return ranked.groupBy(*keys).agg(
        F.when(missed, F.raise_error(F.lit("the sketch did not bracket the percentile")).cast("double"))
        .otherwise(F.min(F.when(reached, F.col("_v")))).alias("value")
    )


def _micros(period: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {period}"))


def _measured(df: DataFrame, ts: str, value: str, agg: str, period: str, threshold: float, periods: int, by: Sequence[str]) -> DataFrame:
    """(_series, _period, value, breaching, alarm) for periods with data.

    A series is the struct of its ``by`` columns, whatever their names; a period the number
    of periods since 1970. The alarm is on where the last ``periods`` periods all exceed. Instead
    of a running count over one sorted window a series, every breach is credited to the
    ``periods`` periods it can contribute to, and an alarm is a period with full credit. That is
    a plain grouped sum, spread over all tasks.
    """
    series = F.struct(F.lit(0).alias("all"), *[F.col(f"`{c}`").alias(f"by{i}") for i, c in enumerate(by)])
    rows = df.filter(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(
        series.alias("_series"), F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / _micros(period)).alias("_period"),
        F.col(value).cast("double").alias("_v"),
    )
    if agg in ("sum", "max"):
        measured = rows.groupBy("_series", "_period").agg(getattr(F, agg)("_v").alias("value"))
    elif agg.startswith("p"):
        measured = _percentile(rows, agg[1:])
    else:
        raise ValueError(f"unknown aggregate {agg!r}: use sum, max or pNN")
    measured = measured.withColumn("breaching", F.col("value") > threshold)
    if periods == 1:
        return measured.withColumn("alarm", F.col("breaching"))
    ahead = F.when(F.col("breaching"), F.sequence(F.lit(0), F.lit(periods - 1))).otherwise(F.array(F.lit(0)))
    credited = measured.select("_series", "_period", "value", "breaching", F.explode(ahead).alias("ahead"))
    own = F.col("ahead") == 0
    return (
        credited.groupBy("_series", (F.col("_period") + F.col("ahead")).alias("_period"))
        .agg(
            F.max(F.when(own, F.col("value"))).alias("value"),
            F.max(F.when(own, F.col("breaching"))).alias("breaching"),
            F.count_if("breaching").alias("credit"),
        )
        .filter(F.col("breaching").isNotNull())
        .select("_series", "_period", "value", "breaching", (F.col("credit") == periods).alias("alarm"))
    )


def _named(rows: DataFrame, period: str, by: Sequence[str], *columns: str) -> DataFrame:
    """The series' own columns and the period's start instead of the keys."""
    keys = [F.col(f"_series.by{i}").alias(c) for i, c in enumerate(by)]
    return rows.select(*keys, F.timestamp_micros((F.col("_period") * _micros(period)).cast("long")).alias("period_start"), *columns)


def windowed_threshold_alarm(
    df: DataFrame, ts: str, value: str, agg: str, period: str, threshold: float, periods: int = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """Periods with data: aggregate, whether it exceeds ``threshold``, and the alarm.

    The alarm is on where the last ``periods`` periods all exceed; a period without data does
    not. ``alarm_timeline`` has the periods between as well, ``alarm_changes`` when the alarm
    went on and off.
    """
    return _named(_measured(df, ts, value, agg, period, threshold, periods, by), period, by, "value", "breaching", "alarm")


def alarm_timeline(
    df: DataFrame, ts: str, value: str, agg: str, period: str, threshold: float, periods: int = 1,
    by: Sequence[str] = (), until=None,
) -> DataFrame:
    """Every period of each series from its first with data on; one without data has no value,
    does not breach and clears the alarm.

    The last period is the one that holds ``until``, or the last of any series with data. A
    series is laid out in blocks of ``BLOCK`` periods, which are exchanged before they are filled,
    so that a long gap is spread over tasks.
    """
    known = _measured(df, ts, value, agg, period, threshold, periods, by)
    last = known.agg(F.max("_period")).scalar() if until is None else F.floor(F.unix_micros(moment(until)) / _micros(period))
    spans = known.groupBy("_series").agg(F.min("_period").alias("_first")).withColumn("_last", last)
    block = lambda p: F.floor(p / F.lit(BLOCK))
    blocks = spans.where("_last >= _first").select(
        "_series", "_first", "_last", F.explode(F.sequence(block(F.col("_first")), block(F.col("_last")))).alias("_block")
    ).repartition("_series", "_block")
    start = F.greatest("_first", F.col("_block") * BLOCK)
    end = F.least("_last", F.col("_block") * BLOCK + F.lit(BLOCK - 1))
    spine = blocks.select("_series", "_block", F.explode(F.sequence(start, end)).alias("_period"))
    filled = known.select(
        F.col("_series").alias("_of"), block(F.col("_period")).alias("_in"), F.col("_period").alias("_at"), "value", "breaching", "alarm"
    )
    same = [F.col("_series").eqNullSafe(F.col("_of")), F.col("_block") == F.col("_in"), F.col("_period") == F.col("_at")]
    out = spine.join(filled, same, "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("breaching", "alarm")})
    return _named(out, period, by, "value", "breaching", "alarm")


def alarm_changes(
    df: DataFrame, ts: str, value: str, agg: str, period: str, threshold: float, periods: int = 1,
    by: Sequence[str] = (), until=None,
) -> DataFrame:
    """(by, period_start, state): the periods in which an alarm goes on (``ALARM``) or off (``OK``).

    An alarm that is still on in the period of ``until`` (or in the last of any series with
    data) has not gone off. Two anti-joins of the alarm's periods with their neighbours: no
    period without an alarm is laid out.
    """
    known = _measured(df, ts, value, agg, period, threshold, periods, by)
    last = known.agg(F.max("_period")).scalar() if until is None else F.floor(F.unix_micros(moment(until)) / _micros(period))
    on = known.where("alarm").select("_series", "_period").where(F.col("_period") <= last)
    other = on.select(F.col("_series").alias("_of"), F.col("_period").alias("_at"))
    same = F.col("_series").eqNullSafe(F.col("_of"))
    begins = on.join(other, same & (F.col("_period") == F.col("_at") + 1), "left_anti").withColumn("state", F.lit("ALARM"))
    ends = (
        on.join(other, same & (F.col("_period") + 1 == F.col("_at")), "left_anti")
        .withColumn("_period", F.col("_period") + 1).where(F.col("_period") <= last).withColumn("state", F.lit("OK"))
    )
    return _named(begins.unionByName(ends), period, by, "state")


def preset_alarm(df: DataFrame, name: str, ts: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One of the five standing alarms in ``constants.ALARMS``."""
    return windowed_threshold_alarm(df, ts, value, *ALARMS[name], by)


def preset_timeline(df: DataFrame, name: str, ts: str, value: str, by: Sequence[str] = (), until=None) -> DataFrame:
    """As ``preset_alarm``, with the periods that have no data."""
    return alarm_timeline(df, ts, value, *ALARMS[name], by, until)


def preset_changes(df: DataFrame, name: str, ts: str, value: str, by: Sequence[str] = (), until=None) -> DataFrame:
    """When a standing alarm went on and off."""
    return alarm_changes(df, ts, value, *ALARMS[name], by, until)
