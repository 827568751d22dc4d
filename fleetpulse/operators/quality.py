"""Declarative data-quality rules and the metrics computed from them.

Each rule is one boolean column. Metrics sum those booleans in a single aggregate over a
single scan, with no strings built per row; texts are made only for rows that fail.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from fleetpulse.constants import (
    COLUMN_CRITICAL, COLUMN_OK, COLUMN_REVIEW, COLUMN_REVIEW_FROM_PCT, CRITICIDAD, DATE_PATTERN,
    DEDUP_KEYS_GPS, DEDUP_KEYS_MAINTENANCE, GPS_DATASET, LATITUDE_RANGE, LONGITUDE_RANGE,
    MAINTENANCE_DATASET, MAX_TIPO_FALLA, SPEED_RANGE, TIMESTAMP_PATTERN,
)
from fleetpulse.functions.moments import moment
from fleetpulse.functions.rounding import percent, round_half_even

REASON = "rejection_reason"
KEY_SHARES = 16  # shares over which the rows of one key are dealt while keys are counted
NOT_NULL, COERCE, RANGE, MISSING = "not_nullable", "coerce_dtype", "in_range", "column_in_dataframe"


# how the checks spell the declared types
TYPE_NAMES = {"string": "str", "double": "float64"}


@dataclass(frozen=True)
class Rule:
    """``failed(value)`` is true for a bad value of the declared type.

    NULL fails only NOT_NULL, and COERCE where the stored value was not NULL.
    """

    column: str
    kind: str
    check: str
    failed: Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    """One checked column: its type, whether it may be NULL, and its rules."""

    name: str
    type: str
    nullable: bool
    rules: tuple[Rule, ...] = ()


@dataclass(frozen=True)
class Dataset:
    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]


def not_null(column: str) -> Rule:
    return Rule(column, NOT_NULL, NOT_NULL, lambda v: v.isNull())


def in_range(column: str, low: float, high: float) -> Rule:
    return Rule(column, RANGE, f"in_range({low:g}, {high:g})", lambda v: ~v.between(low, high))


def str_length(column: str, least: int | None = None, most: int | None = None) -> Rule:
    def failed(v: Column) -> Column:
        size = F.char_length(v)
        bounds = [size < least] if least is not None else []
        bounds += [size > most] if most is not None else []
        return reduce(or_, bounds)

    return Rule(column, "str_length", f"str_length({least}, {most})", failed)


def matches(column: str, pattern: str) -> Rule:
    return Rule(column, "str_matches", f"str_matches('{pattern}')", lambda v: ~v.rlike(pattern))


def is_in(column: str, allowed: list[str]) -> Rule:
    return Rule(column, "isin", f"isin({allowed})", lambda v: ~v.isin(allowed))


DATASETS = {
    GPS_DATASET: Dataset(
        GPS_DATASET,
        (
            Field("equipo_id", "string", False, (str_length("equipo_id", 1, 20),)),
            Field("latitude", "double", False, (in_range("latitude", *LATITUDE_RANGE),)),
            Field("longitude", "double", False, (in_range("longitude", *LONGITUDE_RANGE),)),
            Field("timestamp", "string", False, (matches("timestamp", TIMESTAMP_PATTERN),)),
            Field("speed_kmh", "double", True, (in_range("speed_kmh", *SPEED_RANGE),)),
        ),
        tuple(DEDUP_KEYS_GPS),
    ),
    MAINTENANCE_DATASET: Dataset(
        MAINTENANCE_DATASET,
        (
            Field("equipo_id", "string", False, (str_length("equipo_id", 1),)),
            Field("fecha_mantenimiento", "string", False, (matches("fecha_mantenimiento", DATE_PATTERN),)),
            Field("tipo_falla", "string", True, (str_length("tipo_falla", None, MAX_TIPO_FALLA),)),
            Field("criticidad", "string", False, (is_in("criticidad", CRITICIDAD),)),
        ),
        tuple(DEDUP_KEYS_MAINTENANCE),
    ),
}


def _dataset(name: str) -> Dataset:
    if name not in DATASETS:
        raise ValueError(f"No schema registered for dataset {name!r}. Available: {sorted(DATASETS)}")
    return DATASETS[name]


def dq_rules(dataset: str) -> list[Rule]:
    """Every rule of a dataset in reporting order, type coercion and not-null included."""
    rules = []
    for field in _dataset(dataset).fields:
        rules.append(Rule(field.name, COERCE, f"{COERCE}('{TYPE_NAMES[field.type]}')", lambda v: v.isNull()))
        if not field.nullable:
            rules.append(not_null(field.name))
        rules.extend(field.rules)
    return rules


def _plain(kinds: dict[str, str], name: str) -> Column:
    """A column's value; not-a-number counts as missing, since Spark sorts it above all numbers."""
    kind = kinds[name]
    return F.nanvl(F.col(name), F.lit(None).cast(kind)) if kind in ("double", "float") else F.col(name)


def _checks(df: DataFrame, dataset: str) -> list[tuple[Rule, Column, Column]]:
    """(rule, value, failed) for every rule that applies to the columns of ``df``."""
    kinds = dict(df.dtypes)
    types = {field.name: field.type for field in _dataset(dataset).fields}
    checks = []
    for rule in dq_rules(dataset):
        if rule.column not in kinds:
            continue
        raw = _plain(kinds, rule.column)
        same = kinds[rule.column] == types[rule.column]
        value = raw if same else raw.try_cast(types[rule.column])
        if rule.kind == COERCE:
            if same or types[rule.column] == "string":
                continue  # cannot fail
            failed = raw.isNotNull() & rule.failed(value)
        elif rule.kind == NOT_NULL:
            failed = rule.failed(raw)
        else:
            failed = F.coalesce(rule.failed(value), F.lit(False))
        checks.append((rule, raw, failed))
    return checks


def _missing_columns(df: DataFrame, dataset: str) -> list[str]:
    return [field.name for field in _dataset(dataset).fields if field.name not in df.columns]


def _any_failed(checks) -> Column:
    return reduce(or_, (failed for _, _, failed in checks), F.lit(False))


def dq_rejection_reason(df: DataFrame, dataset: str) -> DataFrame:
    """Adds ``rejection_reason``: every failure as ``column:check``, NULL for a good row."""
    texts = [F.when(failed, F.lit(f"{rule.column}:{rule.check}")) for rule, _, failed in _checks(df, dataset)]
    return df.withColumn(REASON, F.nullif(F.concat_ws("; ", *texts), F.lit("")))


def dq_split(df: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with reason). A missing column rejects no row; duplicates stay."""
    bad = _any_failed(_checks(df, dataset))
    return df.filter(~bad), dq_rejection_reason(df.filter(bad), dataset)


def dq_failure_cases(df: DataFrame, dataset: str) -> DataFrame:
    """Long form: the row's own columns x ``column``, ``check``, ``failure_case``.

    A column the table lacks gives one case with no row behind it.
    """
    checks = _checks(df, dataset)
    cases = F.array_compact(F.array(*[
        F.when(failed, F.struct(
            F.lit(rule.column).alias("column"), F.lit(rule.check).alias("check"),
            value.cast("string").alias("failure_case"),
        ))
        for rule, value, failed in checks
    ]))
    found = df.filter(_any_failed(checks)).select("*", F.explode(cases).alias("_case")).select(
        *df.columns, "_case.*"
    )
    absent = _missing_columns(df, dataset)
    if not absent:
        return found
    table_level = df.sparkSession.createDataFrame(
        [(name, MISSING, None) for name in absent], "column string, check string, failure_case string"
    )
    return found.unionByName(table_level, allowMissingColumns=True)


def dq_duplicates(df: DataFrame, dataset: str) -> DataFrame:
    """One row: rows after the first of their key, NULLs equal; invalid rows count too."""
    keys = [k for k in _dataset(dataset).keys if k in df.columns]
    if not keys:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("duplicates_count"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_count"))


def _filled(df: DataFrame) -> dict[str, Column]:
    """Per column, the aggregate counting its values."""
    kinds = dict(df.dtypes)
    return {c: F.count(_plain(kinds, c)) for c in kinds if c != REASON}


def _counts(aggregates: dict[str, Column]) -> Column:
    """The aggregates as one array of (column, n)."""
    return F.array(*[F.struct(F.lit(c).alias("column"), n.alias("n")) for c, n in aggregates.items()])


def _percentages(counts: Column, total: Column, name: str) -> Column:
    """(column, n) entries to (column, percent of total)."""
    return F.transform(
        counts, lambda entry: F.struct(entry["column"].alias("column"), percent(entry["n"], total).alias(name))
    )


def dq_completeness(df: DataFrame) -> DataFrame:
    """``(column, completeness_pct)`` for every column."""
    wide = df.agg(F.count(F.lit(1)).alias("total"), _counts(_filled(df)).alias("counts"))
    return wide.select(F.inline(_percentages(F.col("counts"), F.col("total"), "completeness_pct")))


def _range_failures(df: DataFrame, dataset: str) -> dict[str, Column]:
    return {rule.column: F.count_if(failed) for rule, _, failed in _checks(df, dataset) if rule.kind == RANGE}


def dq_out_of_range(df: DataFrame, dataset: str) -> DataFrame:
    """``(column, out_of_range_pct)`` for columns with at least one value out of range."""
    counts = _range_failures(df, dataset)
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, out_of_range_pct double")
    wide = df.agg(F.count(F.lit(1)).alias("total"), _counts(counts).alias("counts"))
    failing = F.filter("counts", lambda entry: entry["n"] > 0)
    return wide.select(F.inline(_percentages(failing, F.col("total"), "out_of_range_pct")))


def dq_metrics(df: DataFrame, dataset: str, run_ts=None) -> DataFrame:
    """One row of metrics; the percentages per column are maps.

    Two aggregates: one over the whole table that exchanges a single row per task, and the
    duplicate count, which reads the key columns only. One aggregate with a distinct count
    would have to carry every counter through the exchange once per distinct key.
    """
    checks = _checks(df, dataset)
    ranges = _range_failures(df, dataset)
    absent = len(_missing_columns(df, dataset))
    failures = reduce(lambda a, b: a + b, (f.cast("bigint") for _, _, f in checks), F.lit(0).cast("bigint"))
    stats = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(_any_failed(checks)).alias("rejected_rows"),
        F.coalesce(F.sum(failures), F.lit(0)).alias("_failures"),
        _counts(_filled(df)).alias("_filled"),
        (_counts(ranges) if ranges else F.lit(None)).cast("array<struct<column:string,n:bigint>>").alias("_ranges"),
    )
    duplicates = dq_duplicates(df, dataset).scalar()
    return _metrics_row(stats.withColumn("duplicates_count", duplicates), dataset, run_ts, absent)


def _metrics_row(counted: DataFrame, dataset: str, run_ts, absent: int) -> DataFrame:
    """From one row of counters to the percentages."""
    total = F.col("total_rows")
    failing = F.filter(F.coalesce("_ranges", F.array().cast("array<struct<column:string,n:bigint>>")), lambda entry: entry["n"] > 0)
    complete = F.map_from_entries(_percentages(F.col("_filled"), total, "pct"))
    outside = F.map_from_entries(_percentages(failing, total, "pct"))
    return counted.select(
        F.lit(dataset).alias("dataset"),
        moment(run_ts).alias("run_timestamp"),
        "total_rows",
        (total - F.col("rejected_rows")).alias("valid_rows"),
        "rejected_rows",
        percent(total - F.col("rejected_rows"), total).alias("valid_pct"),
        "duplicates_count",
        percent(F.col("duplicates_count"), total).alias("duplicates_pct"),
        complete.alias("completeness_pct"),
        outside.alias("out_of_range_pct"),
        (F.col("_failures") + absent).alias("pandera_failures"),
    )


def dq_states(df: DataFrame, dataset: str, *groups: str) -> DataFrame:
    """(groups, kind, column, n): the counters behind ``dq_metrics``, which add up over groups."""
    checks, ranges = _checks(df, dataset), _range_failures(df, dataset)
    failures = reduce(lambda a, b: a + b, (f.cast("bigint") for _, _, f in checks), F.lit(0).cast("bigint"))
    kept = df.drop(*groups)
    entry = lambda kind, column, n: F.struct(F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column"), n.cast("bigint").alias("n"))
    counters = [
        entry("total", None, F.count(F.lit(1))), entry("rejected", None, F.count_if(_any_failed(checks))),
        entry("failures", None, F.coalesce(F.sum(failures), F.lit(0))),
        *(entry("filled", c, n) for c, n in _filled(kept).items()), *(entry("range", c, n) for c, n in ranges.items()),
    ]
    return df.groupBy(*groups).agg(F.array(*counters).alias("_counters")).select(*groups, F.inline("_counters"))


def dq_key_counts(df: DataFrame, dataset: str, *groups: str) -> DataFrame:
    """(groups, key, n): how often each key of the dataset occurs, NULLs equal, by a 128-bit name of it.

    Names are exchanged before they are counted, so that no task holds all those of its input.
    They are counted in KEY_SHARES random shares first: a key of very many rows is dealt over tasks.
    """
    keys = [k for k in _dataset(dataset).keys if k in df.columns]
    name = F.unhex(F.substring(F.sha2(F.to_json(F.struct(*keys)) if keys else F.monotonically_increasing_id().cast("string"), 256), 1, 32))
    share = F.floor(F.rand(17) * KEY_SHARES).cast("int")
    named = df.select(*groups, name.alias("key"), share.alias("_share")).repartition("key", "_share")
    shares = named.groupBy(*groups, "key", "_share").agg(F.count(F.lit(1)).alias("n"))
    return shares.repartition(*groups, "key").groupBy(*groups, "key").agg(F.sum("n").alias("n"))


def dq_metrics_of_states(states: DataFrame, key_counts: DataFrame, dataset: str, run_ts=None, absent: int = 0) -> DataFrame:
    """As ``dq_metrics``, from counters and key counts of the parts of a table."""
    summed = states.groupBy("kind", "column").agg(F.sum("n").alias("n"))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    entries = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("column", "n"))))
    stats = summed.agg(
        of("total").alias("total_rows"), of("rejected").alias("rejected_rows"), of("failures").alias("_failures"),
        entries("filled").alias("_filled"), entries("range").alias("_ranges"),
    )
    # A key has one row a part: it is exchanged first, so that no task holds all keys of the files it reads.
    per_key = key_counts.repartition("key").groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
    duplicates = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()
    return _metrics_row(stats.withColumn("duplicates_count", duplicates), dataset, run_ts, absent)


def dq_column_status(metrics: DataFrame) -> DataFrame:
    """Per column: OK, ``revisar`` from 95 % complete, else ``crítico``; from ``dq_metrics``."""
    outside = F.coalesce(F.col("out_of_range_pct")[F.col("column")], F.lit(0.0))
    complete = F.col("completeness_pct")
    return (
        metrics.select("dataset", "out_of_range_pct", F.explode("completeness_pct").alias("column", "completeness_pct"))
        .withColumn("out_of_range_pct", outside)
        .withColumn(
            "estado",
            F.when((complete == 100.0) & (F.col("out_of_range_pct") == 0.0), COLUMN_OK)
            .when(complete >= COLUMN_REVIEW_FROM_PCT, COLUMN_REVIEW)
            .otherwise(COLUMN_CRITICAL),
        )
    )


def dq_latest_and_trend(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(latest run, valid and duplicate percentages by run time) of one dataset's history."""
    latest = history.orderBy(F.desc("run_timestamp")).limit(1)
    trend = history.select(
        "run_timestamp",
        round_half_even(F.col("valid_pct"), 1).alias("valid_pct"),
        round_half_even(F.col("duplicates_pct"), 1).alias("duplicates_pct"),
    ).orderBy("run_timestamp")
    return latest, trend
