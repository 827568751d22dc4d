"""Column functions against the clients' own behaviour."""

import random
from datetime import datetime, timezone

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fleetpulse.functions.dates import parse_mixed_date
from fleetpulse.functions.iso_time import iso_text, iso_timestamp
from fleetpulse.functions.json_values import number_text
from fleetpulse.functions.rounding import percent, round_half_even
from fleetpulse.functions.text import null_token_normalize, strip

ISO = [
    "2026-05-20", "20260520", "2026-W21-3", "2026W213", "2026-W21", "2026-05", "2026", "10:00",
    "2026-05-20T10", "2026-05-20T10:00", "2026-05-20T1000", "2026-05-20T100000", "2026-05-20T10:00:00.1",
    "2026-05-20T10:00:00,123", "2026-05-20T10:00:00.1234567891", "2026-05-20x10:00:00", "2026-05-20 10:00:00Z",
    "2026-05-20T10:00:00z", "2026-05-20T10:00:00+05", "2026-05-20T10:00:00+0530", "2026-05-20T10:00:00+05:30",
    "2026-05-20T10:00:00+05:30:15", "2026-05-20T10:00:00+23:59", "2026-05-20T10:00:00+24:00",
    "2026-05-20T10:00:00+05:99", "2026-05-20T24:00:00", "2026-05-20T10:00:60", "2026-05-20T10:0000",
    "2026-05-20T1000:00", "20260520T10:00:00", "2026-05-20T", "2026-05-20T10:00Z", "2026-05-20Z", "2026-05-20T10Z",
    " 2026-05-20", "2026-05-20T10:00:00 ", "2026-W53-1", "2020-W53-1", "2021-W53-1", "2026-W21-8", "2026-W00-1",
    "2026-05-20T10:00:00.", "2026-0520", "2026-02-30", "0001-01-01T00:00:00", "0000-01-01T00:00:00", "+2026-05-20",
    "2026-05-20T10:00:00-00:00", "2026-05-20T10:00:00-05:00", "20260520T100000.5+0530", "202605201000",
    "not-a-date", "", "2026-05-20T10:00:00.000000Z", "2026-05-20T10:00:00.123456+00:00", "2024-02-29T23:59:59.999999Z",
    "2026-05-20T10:00:00-17:59", "2026-05-20T10:00:00-18:30",
]


def _python_iso(text):
    try:
        value = datetime.fromisoformat(text)
    except ValueError:
        return None, None
    value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"), value.isoformat()


def test_iso_timestamps_are_read_like_python_reads_them(spark):
    df = spark.createDataFrame([(t,) for t in ISO], "t string")
    rows = df.select(
        "t",
        F.date_format(iso_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("instant"),
        F.when(iso_timestamp(F.col("t")).isNotNull(), iso_text(F.col("t"))).alias("text"),
    ).collect()
    for row in rows:
        instant, text = _python_iso(row["t"])
        if instant and instant.startswith("1-"):  # strftime does not pad year 1
            instant = "000" + instant
        assert (row["instant"], row["text"]) == (instant, text), row["t"]


def test_iso_timestamp_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        df = spark.createDataFrame([("2026-05-20T10:00:00",), ("20260520T100000",)], "t string")
        micros = [r[0] for r in df.select(F.unix_micros(iso_timestamp(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert set(micros) == {int(datetime(2026, 5, 20, 10, tzinfo=timezone.utc).timestamp() * 1_000_000)}


DATES = [
    "2026-05-20", "05/06/2026", "20/05/2026", "20260520", "2026", "May 5 2026", "5 May 2026", "May 5, 2026",
    "05-May-2026", "2026/05/20", "5/6/26", "20-05-2026", "05-06-2026", "20.05.2026", "05.06.2026", "2026-05",
    "05/2026", "2026-05-20 10:00", "2026-05-20T10:00:00Z", "2026-05-20T23:00:00-05:00", "13/13/2026", "31/02/2026",
    "2026-5-6", "2026-13-01", "2026-20-05", "not-a-date", "", "nan", " 2026-05-20 ", "20/05/2026 10:30", "1/2/2026",
    "20260520101010", "1", "12", "2026.05.20", "00/05/2026", "32/05/2026", "12/31/2026", "31/12/2026",
    "2026-05-20 25:00", "20 de mayo", "1e5", "44000", "2026-02-30", "december 24 2025", "24 dec 2025", "24 juni 2025",
]


@pytest.mark.filterwarnings("ignore")
def test_mixed_dates_are_read_like_pandas_reads_them(spark):
    df = spark.createDataFrame([(t,) for t in DATES], "t string")
    for row in df.select("t", parse_mixed_date(F.col("t")).cast("string").alias("d")).collect():
        want = pd.to_datetime(pd.Series([row["t"]]), format="mixed", errors="coerce").iloc[0]
        assert row["d"] == (None if pd.isna(want) else want.strftime("%Y-%m-%d")), row["t"]


def test_rounding_is_on_the_stored_bits(spark):
    random.seed(7)
    one = [s / 60 for s in range(0, 4000)] + [random.uniform(0, 1e6) for _ in range(500)] + [0.05, 0.15, 10.05, 2.25, 5.35]
    two = [n / 20000 * 100 for n in range(0, 3000)] + [3.125, 0.005, 1.005, 2.675]
    for values, digits in ((one + [-v for v in one[:400]], 1), (two, 2)):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        for row in df.select("v", round_half_even(F.col("v"), digits).alias("r")).collect():
            assert row["r"] == round(row["v"], digits), (row["v"], digits)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=200))
def test_rounded_minutes_property(spark, micros):
    df = spark.createDataFrame([(m * 1000,) for m in micros], "m bigint")
    minutes = F.col("m").cast("double") / F.lit(1e6) / F.lit(60.0)
    for row in df.select("m", round_half_even(minutes, 1).alias("r")).collect():
        assert row["r"] == round(row["m"] / 1e6 / 60, 1)


def test_percent_of_nothing_is_zero(spark):
    row = spark.range(1).select(percent(F.lit(0), F.lit(0)).alias("a"), percent(F.lit(1), F.lit(3)).alias("b")).head()
    assert (row["a"], row["b"]) == (0.0, 33.33)


def test_numbers_are_spelled_like_python_spells_them(spark):
    values = [20.0, 72.29, -11.0, 1e7, 12345678.5, 0.0001, 0.5, -0.00025, 123456789012345.0, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(number_text(F.col("v"))).collect()] == [repr(v) for v in values]


def test_strip_and_null_words(spark):
    df = spark.createDataFrame([("  x\t\n",), (" nan ",), ("",), (None,)], "t string")
    got = [tuple(r) for r in df.select(strip(F.col("t")), null_token_normalize(F.upper(strip(F.col("t"))))).collect()]
    assert got == [("x", "X"), ("nan", None), ("", None), (None, None)]
