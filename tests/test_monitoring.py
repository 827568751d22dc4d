"""Threshold alarms."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import monitoring
from fleetpulse.operators.monitoring import alarm_changes, alarm_timeline, preset_alarm, windowed_threshold_alarm

START = datetime(2026, 5, 20, tzinfo=timezone.utc)


def series(spark, *points):
    """(minute, value) points."""
    rows = [(START + timedelta(minutes=m, seconds=5), float(v)) for m, v in points]
    return spark.createDataFrame(rows, "ts timestamp, value double")


def states(df):
    return {int((r["period_start"].replace(tzinfo=timezone.utc) - START).total_seconds() // 60): (r["breaching"], r["alarm"]) for r in df.collect()}


def test_sum_over_threshold(spark):
    df = series(spark, *[(0, 1)] * 5, *[(1, 1)] * 6)
    assert states(preset_alarm(df, "validate_errors", "ts", "value")) == {0: (False, False), 1: (True, True)}


def test_periods_in_a_row_and_gaps(spark):
    df = series(spark, (0, 61), (1, 61), (2, 60), (3, 61), (5, 61), (6, 99))
    got = states(preset_alarm(df, "oldest_message_age_seconds", "ts", "value"))
    assert got == {0: (True, False), 1: (True, True), 2: (False, False), 3: (True, False), 5: (True, False), 6: (True, True)}


def test_percentile_breach_is_exact(spark):
    under = [(0, 1)] * 99 + [(0, 50_000)]      # 99 of 100 within: the 99th percentile is within
    over = [(1, 1)] * 98 + [(1, 50_000)] * 2
    df = series(spark, *under, *over)
    rows = {r["period_start"].minute: r for r in windowed_threshold_alarm(df, "ts", "value", "p99", "1 minute", 45_000.0).collect()}
    assert (rows[0]["value"], rows[0]["breaching"]) == (1.0, False)
    assert (rows[1]["value"], rows[1]["breaching"]) == (50_000.0, True)


def test_against_brute_force(spark):
    random.seed(3)
    points = [(random.randrange(40), random.choice(["a", "b"]), random.random() * 100) for _ in range(400)]
    df = spark.createDataFrame([(START + timedelta(minutes=m), k, v) for m, k, v in points], "ts timestamp, k string, value double")
    for agg, fold in (("sum", sum), ("max", max), ("p90", lambda v: sorted(v)[-(-len(v) * 90 // 100) - 1])):
        groups = defaultdict(list)
        for m, k, v in points:
            groups[k, m].append(v)
        threshold = 200.0 if agg == "sum" else 60.0
        breach = {key for key, values in groups.items() if fold(values) > threshold}
        want = {(k, m) for k, m in breach if {(k, m - 1), (k, m - 2)} <= breach}
        rows = windowed_threshold_alarm(df, "ts", "value", agg, "1 minute", threshold, 3, ["k"]).collect()
        minute = lambda r: int((r["period_start"].replace(tzinfo=timezone.utc) - START).total_seconds() // 60)
        assert len(rows) == len(groups)
        assert {(r["k"], minute(r)) for r in rows if r["breaching"]} == breach
        assert {(r["k"], minute(r)) for r in rows if r["alarm"]} == want


def test_unknown_aggregate(spark):
    with pytest.raises(ValueError):
        windowed_threshold_alarm(series(spark, (0, 1)), "ts", "value", "mean", "1 minute", 1.0)


def test_percentile_of_a_large_group_is_exact(spark):
    n = 1_000_000
    mixed = F.pmod(F.xxhash64("id"), F.lit(10_000_019)) / F.lit(7.0)
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").alias("name"), F.lit(START).alias("ts"), mixed.alias("value")
    )
    got = {r["name"]: r["value"] for r in windowed_threshold_alarm(df, "ts", "value", "p99", "1 day", 1.0, 1, ["name"]).collect()}
    values = defaultdict(list)
    for name, value in df.select("name", "value").collect():
        values[name].append(value)
    assert got == {name: sorted(v)[-(-len(v) * 99 // 100) - 1] for name, v in values.items()}


@pytest.mark.parametrize("block", [4096, 3])
def test_timeline_fills_gaps_and_changes_show_the_clearing(spark, monkeypatch, block):
    monkeypatch.setattr(monitoring, "BLOCK", block)
    df = series(spark, (0, 61), (1, 61), (9, 99), (10, 99))
    args = ("ts", "value", "max", "1 minute", 60.0, 2)
    until = START + timedelta(minutes=12, seconds=30)
    got = states(alarm_timeline(df, *args, until=until))
    assert sorted(got) == list(range(13))
    assert [m for m, (_, alarm) in got.items() if alarm] == [1, 10] and got[5] == (False, False)
    minute = lambda r: int((r["period_start"].replace(tzinfo=timezone.utc) - START).total_seconds() // 60)
    changes = lambda **k: sorted((minute(r), r["state"]) for r in alarm_changes(df, *args, **k).collect())
    assert changes(until=until) == [(1, "ALARM"), (2, "OK"), (10, "ALARM"), (11, "OK")]
    assert changes() == [(1, "ALARM"), (2, "OK"), (10, "ALARM")]  # no period after the last with data
    assert alarm_timeline(df.limit(0), *args, until=until).count() == alarm_changes(df.limit(0), *args).count() == 0


def test_series_columns_of_any_name(spark):
    rows = [(START + timedelta(minutes=m), float(v), k, k, None) for m, v, k in [(0, 9, "a"), (1, 9, "a"), (0, 1, "b"), (3, 9, "a")]]
    df = spark.createDataFrame(rows, "ts timestamp, x double, n string, rank string, low int")
    by = ["n", "rank", "low"]
    for agg in ("p99", "sum"):
        got = {(r["n"], r["rank"], r["low"], r["period_start"].minute): r["alarm"] for r in windowed_threshold_alarm(df, "ts", "x", agg, "1 minute", 5.0, 2, by).collect()}
        assert got == {("a", "a", None, 0): False, ("a", "a", None, 1): True, ("b", "b", None, 0): False, ("a", "a", None, 3): False}
        changed = {(r["n"], r["period_start"].minute, r["state"]) for r in alarm_changes(df, "ts", "x", agg, "1 minute", 5.0, 2, by).collect()}
        assert changed == {("a", 1, "ALARM"), ("a", 2, "OK")}
