"""How document filters interact: failing-id tables, and joins that replay every order of them."""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import staged, words
from fleetpulse.operators.relations import evaluate_once

NAMED = 32  # hex digits of a row's or a text's name, 128 bits of its SHA-256
REPEATED = "E"  # the filter that compares texts with each other


def conditions(text: Column, w: Column) -> dict[str, Column]:
    """Failure condition of each filter that looks at one text and its words."""
    return {
        "A": F.size(w) < 100,
        "B": 100 * F.size(F.array_distinct(w)) < 80 * F.size(w),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]", "")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _name(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, NAMED))


def inspected(docs: DataFrame, conditions=conditions) -> DataFrame:
    """(id, doc_id, digest, part, fails, n): one row for each set of equal rows.

    ``fails`` joins the names of the filters that the text alone fails. One pass over the
    texts; what goes on holds names of fixed size instead of them.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    rows = evaluate_once(rows, "_words", words(F.col("_text")))
    failed = F.concat(*(F.when(c, name).otherwise("") for name, c in conditions(F.col("_text"), F.col("_words")).items()))
    rows = rows.select("doc_id", "part", _name(F.col("_text")).alias("digest"), failed.alias("fails"))
    rows = rows.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.hex("digest"), "part")
    return rows.select(_name(key).alias("id"), "doc_id", "digest", "part", "fails", "n")


def failing_tables(rows: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """For each filter the stored table of the ids that fail it.

    A text repeats if a smaller doc_id has it, in whatever part; an id that is null is
    larger than all. The first holder of each text passes: all rows less those, an anti-join
    by text and id, so that a text with very many copies is spread over tasks.
    """
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    passes = (F.col("_first").eqNullSafe(F.col("doc_id"))) & (F.col("_digest") == F.col("digest"))
    repeated = rows.join(first.withColumnRenamed("digest", "_digest"), passes, "left_anti")
    failing = {name: rows.where(F.col("fails").contains(name)) for name in names} | {REPEATED: repeated}
    return {name: staged(found.select("id"), f"failing-{name}") for name, found in failing.items()}


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``; an id labelled twice has what one label says.

    Rows without an id have no label and are spread by their name.
    """
    truth = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("id"), F.lit(1024))).otherwise(0)
    found = rows.withColumn("_spread", spread).join(
        truth.withColumn("_zero", F.lit(0).cast("long")), (F.col("doc_id") == F.col("_doc")) & (F.col("_spread") == F.col("_zero")), "left"
    )
    return found.select("id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")


def profiles(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """(part, profile, docs, good, toxic): documents by the set of filters that they fail.

    Each filter's table parts the rows by a semi- and an anti-join. All prefixes that treat
    two documents alike are settled here, so that the replay below handles at most one row
    a part and set of filters.
    """
    found = rows.withColumn("profile", F.lit(""))
    for name in sorted(failing):
        ids = failing[name]
        caught = found.join(ids, "id", "left_semi").withColumn("profile", F.concat("profile", F.lit(name)))
        found = staged(caught.unionByName(found.join(ids, "id", "left_anti")), f"profile-{name}")
    count = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return found.groupBy("part", "profile").agg(F.sum("n").alias("docs"), count("good"), count("toxic"))


def prefix_effects(found: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """What each set of filters leaves, and what one more filter does to that.

    (part, prefix, kept) and (part, prefix, filter, removed, good_lost, toxic_lost,
    redundant), for every set ``prefix``, written in the order of names. Survivors of a
    prefix are an anti-join with what its filters' tables hold, its victims a semi-join.
    """
    sets = ["".join(c) for k in range(len(names) + 1) for c in combinations(names, k)]
    fails = found.select("profile").distinct().select("profile", F.explode(F.split("profile", "")).alias("filter")).where("filter <> ''")
    members = found.sparkSession.createDataFrame([(p, f) for p in sets for f in p], "prefix string, filter string")
    caught = members.join(fails, "filter").select("prefix", "profile").distinct()
    lattice = found.withColumn("prefix", F.explode(F.array(*(F.lit(p) for p in sets))))
    survivors = lattice.join(caught, ["prefix", "profile"], "left_anti")
    victims = lattice.join(caught, ["prefix", "profile"], "left_semi")
    kept = survivors.groupBy("part", "prefix").agg(F.sum("docs").alias("kept"))
    step = ["part", "prefix", "filter"]
    removed = survivors.join(fails, "profile").groupBy(*step).agg(
        F.sum("docs").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")
    )
    redundant = victims.join(fails, "profile").groupBy(*step).agg(F.sum("docs").alias("redundant"))
    return kept, removed.join(redundant, step, "full")


def audit(docs: DataFrame, labels: DataFrame, conditions=conditions) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    A row for each part (language; null is the empty string), order of the filters and step.
    Counts are of documents, equal rows counted each. ``shapley`` is what the step's filter
    removes, summed over all orders. ``conditions`` gives the filters that look at one text
    (single capital letters); repeated texts, filter E, come on top of them.

    Null texts are empty ones, which repeat each other; a null doc_id is larger than all
    others and has no label; ties of text and id pass together. Long texts are read whole.
    An empty table has no parts and gives no rows; labels of unknown documents count
    nothing. Other columns are not read, so names cannot clash.
    """
    spark = docs.sparkSession
    alone = list(conditions(F.lit(""), F.array(F.lit(""))))
    names = sorted([*alone, REPEATED])
    rows = staged(inspected(docs, conditions), "inspected")
    found = staged(profiles(labelled(rows, labels), failing_tables(rows, alone)), "profiles")
    kept, effects = prefix_effects(found, names)
    written = lambda some: "".join(sorted(some))
    steps = [
        (k, "".join(order), s + 1, order[s], written(order[:s]), written(order[: s + 1]))
        for k, order in enumerate(permutations(names)) for s in range(len(names))
    ]
    steps = spark.createDataFrame(steps, "number int, filter_order string, step int, filter string, prefix string, after string")
    last = len(list(permutations(names))) - 1
    grid = found.select("part").distinct().withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(last)))).join(steps, "number")
    unique = found.select("part", F.col("profile").alias("filter"), F.col("docs").alias("unique_fails"))
    kept = kept.withColumnRenamed("prefix", "after")
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    out = grid.join(effects, ["part", "prefix", "filter"], "left").join(kept, ["part", "after"], "left").join(unique, ["part", "filter"], "left")
    out = out.select("part", "filter", "filter_order", "step", *(F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in counts))
    shapley = out.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return out.join(shapley, ["part", "filter"]).select("part", "filter_order", "step", *counts, "shapley")


def audit_sql() -> str:
    """The same for DuckDB, over the tables ``documents`` and ``labels``."""
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
        WITH base AS (
          SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
                 regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents),
        truth AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        flags AS (
          SELECT b.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                 min(b.doc_id) OVER (PARTITION BY t) AS first FROM base b LEFT JOIN truth USING (doc_id)),
        classes AS (
          SELECT part, good, toxic, count(*) AS n,
            CASE WHEN len(w) < 100 THEN 'A' ELSE '' END ||
            CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END ||
            CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END ||
            CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
            CASE WHEN coalesce(doc_id > first, first IS NOT NULL) THEN 'E' ELSE '' END AS fails
          FROM flags GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
          SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
          FROM letters a, letters b, letters c, letters d, letters e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (
          SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS f, left(filter_order, step - 1) AS prefix
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        counted AS (
          SELECT part, filter_order, step, f,
            sum(n) FILTER (NOT earlier AND NOT fail) AS kept, sum(n) FILTER (NOT earlier AND fail) AS removed,
            sum(n) FILTER (earlier AND fail) AS redundant, sum(n) FILTER (fails = f) AS unique_fails,
            sum(n) FILTER (NOT earlier AND fail AND good) AS good_lost, sum(n) FILTER (NOT earlier AND fail AND toxic) AS toxic_lost
          FROM (SELECT *, contains(fails, f) AS fail, translate(fails, prefix, '') <> fails AS earlier FROM classes, steps)
          GROUP BY part, filter_order, step, f)
        SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
        FROM counted"""
