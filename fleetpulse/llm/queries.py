"""Registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.audit import audit, audit_sql
from fleetpulse.llm.chat import digests, windows
from fleetpulse.llm.common import crc_mod, table, words
from fleetpulse.llm.decontaminate import contamination
from fleetpulse.llm.language import languages
from fleetpulse.llm.licenses import licenses, licenses_sql
from fleetpulse.llm.mixing import mix
from fleetpulse.llm.pages import extracted
from fleetpulse.llm.periodic import periodic_runs
from fleetpulse.llm.quality import quality
from fleetpulse.llm.scoring import scored
from fleetpulse.llm.simhash import near_duplicates
from fleetpulse.llm.suffixes import deduplicated
from fleetpulse.llm.toxicity import toxicity


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return digests(windows(turns))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=3, threshold=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"), text=False).drop("row_key")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 3) == 1)


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by crc32(doc_id) repeats p of its words from word a on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    repeated = F.expr("""
        transform(array(named_struct('w', _words, 'a', _g % size(_words))), x ->
          transform(array(1 + (size(x.w) - x.a) div (3 + _g % 8)), p ->
            array_join(transform(x.w, (word, i) -> if(i < x.a, word, x.w[cast(x.a + (i - x.a) % p as int)])), ' '))[0])[0]
    """)
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, words(F.col("text"))).alias("_words"))
    return rows.select("doc_id", F.when(F.size("_words") > 0, repeated).otherwise(F.col("text")).alias("text"))


def periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted_periods(table(spark, sf_dir, "documents")))
    lines = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))"
    # The first of the runs with the greatest length / period, compared as a fraction.
    best = """
        aggregate(runs, cast(null as struct<start: long, length: long, period: long>), (b, r) ->
          if(b is null or r.length * b.period > b.length * r.period, r, b))
    """
    return found.withColumn("_best", F.expr(best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 3) == 1)


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_chat_formatting": chat_formatting,
    "op2_simhash_near_dedup": simhash_near_dedup,
    "op3_suffix_array_dedup": suffix_array_dedup,
    "op4_decontamination": decontamination,
    "op5_lm_scoring": lm_scoring,
    "op6_quality_rules": quality_rules,
    "op7_language_id": language_id,
    "op8_license_scans": license_scans,
    "op9_html_extraction": html_extraction,
    "op10_mixing": mixing,
    "op11_periodic_runs": periodic_run_detection,
    "op12_toxicity": toxicity_scores,
    "op13_filter_audit": filter_audit,
}
ORACLE = {
    "op8_license_scans": licenses_sql(),
    "op13_filter_audit": audit_sql(),
}
